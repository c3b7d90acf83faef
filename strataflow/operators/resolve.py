"""Entity resolution with distance gates: joins on identifiers, or on grid cells and name tokens, then distances."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataflow.functions.geo import haversine_km
from strataflow.operators.reconcile import contained, first_by
from strataflow.sources.tables import kept

#: Degrees of a blocking cell. Its height is 11 km; gates of the name join are 6 km at most, and longitude degrees are widened by latitude.
CELL = 0.1


def near_cells(lat: str, lon: str, size: float = CELL):
    """A point's cell and its eight neighbours, in a grid whose columns widen towards the poles, so that 6 km (for other sizes, see `_wide`) never reach past a neighbour."""
    row = F.floor(F.col(lat) / size)
    cells = F.transform(F.sequence(F.lit(-1), F.lit(1)), lambda dy: F.transform(F.sequence(F.lit(-1), F.lit(1)), lambda dx: F.struct((row + dy).alias("y"), (_column(lon, row + dy, size) + dx).alias("x"))))
    return F.flatten(cells)


def _column(lon: str, row, size: float):
    """The column number in a row of cells: columns are size / cos(latitude of the row's outer edge) wide."""
    outer = F.least(F.greatest(F.abs(row * size), F.abs((row + 1) * size)), F.lit(85.0))
    return F.floor(F.col(lon) * F.cos(F.radians(outer)) / size)


def own_cell(lat: str, lon: str, size: float = CELL):
    row = F.floor(F.col(lat) / size)
    return F.struct(row.alias("y"), _column(lon, row, size).alias("x"))


def _wide(km: float) -> float:
    """Degrees of cells whose neighbours hold all within km: a tenth more than a degree's 111 km ask for, as columns of neighbouring rows differ."""
    return km / 100.0


def nearest(asked: DataFrame, have: DataFrame, keys: list[str], most: float) -> DataFrame:
    """The distinct (keys, lat, lon, gate) of asked with `best`, the nearest of have with the same keys within gate kilometres (`most` at most): struct of km, what, dlat, dlon, ties by what.

    have: keys, dlat, dlon, what. Places that several share count once. The search goes from small cells to ones of `most`: where something is found no farther than a cell is wide, it is settled, and only the others go on. So where
    places lie close together few are looked at, and none is left out.
    """
    by = [*keys, "lat", "lon", "gate"]
    left = asked.select(by).distinct()
    have = kept(have.groupBy(*keys, "dlat", "dlon").agg(F.min("what").alias("what")))
    out = None
    for km in (most / 32, most / 8, most):
        cells = left.withColumn("cell", F.explode(near_cells("lat", "lon", _wide(km))))
        met = cells.join(have.withColumn("cell", own_cell("dlat", "dlon", _wide(km))), [*keys, "cell"]).withColumn("km", haversine_km("lat", "lon", "dlat", "dlon"))
        best = met.where(F.col("km") <= F.least("gate", F.lit(float(most)))).groupBy(by).agg(F.min(F.struct("km", "what", "dlat", "dlon")).alias("best"))
        if km < most:
            tried = kept(left.join(best, by, "left"))
            best, left = tried.where(F.col("best.km") <= km), tried.where(~F.coalesce(F.col("best.km") <= km, F.lit(False))).select(by)
        out = best if out is None else out.unionByName(best)
    return out


def _names_nearby(asked: DataFrame, have: DataFrame, by: list[str]) -> DataFrame:
    """The distinct names of asked (by, cell, and all its other columns, with tokens) and of have (by, cell, dtokens, ..) in the same or a neighbouring cell one of which has all words of the other, as rows.

    As one name contains the other, they share the rarer name's rarest word, counted over both sides: each name offers all its words and asks by its own rarest, from either side, so a word that most names have
    brings together only names that have no other. asked has near, the cells nearby, besides its cell.
    """
    asked, have = asked.distinct(), have.distinct()
    words = asked.select(F.explode("tokens").alias("word")).unionByName(have.select(F.explode("dtokens").alias("word"))).groupBy("word").agg(F.count("*").alias("k"))
    rare = lambda side, c: side.select(F.col(c).alias("name")).distinct().select("name", F.explode("name").alias("word")).join(words, "word").groupBy("name").agg(F.min_by("word", F.struct("k", "word")).alias("rarest"))
    asked = asked.join(rare(asked, "tokens").withColumnRenamed("name", "tokens"), "tokens").withColumn("at", F.explode("near")).drop("near")
    have = have.join(rare(have, "dtokens").withColumnRenamed("name", "dtokens"), "dtokens").withColumnRenamed("cell", "at")
    one = asked.withColumn("token", F.col("rarest")).drop("rarest").join(have.withColumn("token", F.explode("dtokens")).drop("rarest"), [*by, "at", "token"])
    two = asked.withColumn("token", F.explode("tokens")).drop("rarest").join(have.withColumn("token", F.col("rarest")).drop("rarest"), [*by, "at", "token"])
    met = one.unionByName(two.select(one.columns)).drop("at", "token")
    return met.where((F.size(F.array_except("dtokens", "tokens")) == 0) | (F.size(F.array_except("tokens", "dtokens")) == 0)).distinct()


def gate_km(precision):
    """60, 25 or 12 km for 0, 1 or more stated decimals."""
    return F.when(F.col(precision) == 0, 60.0).when(F.col(precision) == 1, 25.0).otherwise(12.0)


def match_idents(rows: DataFrame, donors: DataFrame) -> DataFrame:
    """C14. (row_id, donor_id, km): the first ident of a title, then the nearest donor of the same state within the gate.

    rows: row_id, idents, state, lat, lon, precision. donors: donor_id, idents, state, lat, lon, and title if they have one. Also returned: ident, dlat, dlon and title of the donor met.
    """
    asked = rows.select("row_id", "state", "lat", "lon", gate_km("precision").alias("gate"), F.posexplode("idents").alias("pos", "ident"))
    have = donors.select("state", F.col("lat").alias("dlat"), F.col("lon").alias("dlon"), F.struct("donor_id", _title(donors)).alias("what"), F.explode("idents").alias("ident"))
    keys = ["ident", "state"]
    met = asked.join(nearest(asked, have, keys, 60.0), [*keys, "lat", "lon", "gate"])
    best = met.groupBy("row_id").agg(F.min(F.struct("pos", "best.km", "best.what", "ident", "best.dlat", "best.dlon")).alias("b"))  # partial: no sort of all that met
    return best.select("row_id", "b.what.donor_id", "b.km", "b.ident", "b.dlat", "b.dlon", "b.what.title")


def _title(donors: DataFrame):
    return (F.col("title") if "title" in donors.columns else F.lit(None).cast("string")).alias("title")


def match_names(rows: DataFrame, donors: DataFrame, wide: float = 6.0, close: float = 4.0) -> DataFrame:
    """C15. (row_id, donor_id, km, shared, dlat, dlon, title): the donor nearby one of whose names shares most words with one of the row's, then the nearest, then by id.

    rows: row_id, aliases (array of structs of tokens and variant), city_tokens, state, lat, lon, precision. donors: donor_id, names (as aliases), name_ok, state, lat, lon, and title if they have one; those that
    aren't name_ok (null: they are) take no part. The gate is `wide` for one decimal or fewer, else `close`. One name's words must contain the other's; two must be shared, or
    the names be equal and within `close`. Words that are all of the city's name don't do where the donor has further ones. A variant (auxiliary, outlying and the like) meets a donor
    that is none within 3 km only.

    First the different names of a cell meet those nearby (see `_names_nearby`), which says how many words are shared and how far a donor may be; then each place looks for the nearest donor of each such name.
    """
    asked = rows.withColumn("alias", F.explode("aliases")).select("row_id", "city_tokens", "state", "lat", "lon", "precision", F.sort_array(F.array_distinct("alias.tokens")).alias("tokens"), F.col("alias.variant").alias("variant"), own_cell("lat", "lon").alias("cell"))
    have = donors.where("name_ok is null or name_ok").withColumn("name", F.explode("names")).select(
        "state", F.col("lat").alias("dlat"), F.col("lon").alias("dlon"), F.struct("donor_id", _title(donors)).alias("what"), F.sort_array(F.array_distinct("name.tokens")).alias("dtokens"), F.coalesce("name.variant", F.lit(False)).alias("dvariant"), own_cell("lat", "lon").alias("cell"),
    )
    # neighbours of a cell as neighbours of all of its points: one point's may be other ones where columns shift
    near = asked.select("state", "cell", "city_tokens", "tokens", "variant", near_cells("lat", "lon").alias("near"))
    shared, further = F.array_intersect("tokens", "dtokens"), F.size(F.array_except("dtokens", "tokens")) > 0
    pairs = _names_nearby(near, have.select("state", "cell", "dtokens", "dvariant"), ["state"]).withColumn("shared", F.size(shared))
    only_city = (F.size(F.array_except(shared, "city_tokens")) == 0) & further
    pairs = pairs.where(((F.col("shared") >= 2) | ((F.col("shared") == F.size("tokens")) & ~further)) & ~only_city)
    apart = F.coalesce(F.col("variant") & ~F.col("dvariant"), F.lit(True))
    pairs = pairs.select("state", "cell", "tokens", "dtokens", "dvariant", "shared", F.col("variant").alias("_v"), F.col("city_tokens").alias("_c"), F.when(F.col("shared") < 2, close).alias("_g"), F.when(apart, 3.0).alias("_a"))
    same = [F.col(f"a.{c}") == F.col(f"p.{c}") for c in ("state", "cell", "tokens")] + [F.col("a.variant").eqNullSafe(F.col("p._v")), F.col("a.city_tokens").eqNullSafe(F.col("p._c"))]
    wanted = asked.alias("a").join(pairs.alias("p"), same).select("row_id", "a.state", "lat", "lon", "dtokens", "dvariant", "shared", F.least(F.when(F.col("precision") <= 1, wide).otherwise(close), "_g", "_a").alias("gate"))
    wanted = kept(wanted)  # read twice: for the places, and for the rows that are there
    keys = ["state", "dtokens", "dvariant"]
    met = wanted.join(nearest(wanted, have, keys, max(wide, close)), [*keys, "lat", "lon", "gate"])
    best = met.groupBy("row_id").agg(F.min(F.struct((-F.col("shared")).alias("s"), "best.km", "best.what", "best.dlat", "best.dlon")).alias("b"))
    return best.select("row_id", "b.what.donor_id", "b.km", (-F.col("b.s")).alias("shared"), "b.dlat", "b.dlon", "b.what.title")


def cascade(rows: DataFrame, donors: list[tuple[str, DataFrame]]) -> DataFrame:
    """C16. rows with match_donor, match_via (ident:<the identifier> or name), match_id, match_name (the donor's title), match_km, coord_source (the donor's label, else own) and lat and lon of the donor
    where their stated precision is 2 or less (own_lat and own_lon keep theirs).

    donors: (label, donors as C14 and C15 take them) in order of trust; in each, identifiers come before names, and the first hit stands. Rows marked skip (titles of former
    locations) aren't matched. Each hit carries its donor's place, so donors that share an id, or have none, stay apart.
    """
    asked, every = rows.where(~F.coalesce(F.col("skip"), F.lit(False))), None
    for i, (label, have) in enumerate(donors):
        by_ident = lambda left: match_idents(left, have).withColumn("match_via", F.concat(F.lit("ident:"), "ident"))  # noqa: B023, E731
        by_name = lambda left: match_names(left, have).withColumn("match_via", F.lit("name"))  # noqa: B023, E731
        for k, look in enumerate((by_ident, by_name)):
            found = kept(look(asked))
            asked = asked.join(found.select("row_id"), "row_id", "left_anti")  # the first hit stands: only the others go on
            one = found.select("row_id", F.col("donor_id").alias("match_id"), F.col("title").alias("match_name"), F.col("km").alias("match_km"), F.col("dlat").alias("_lat"), F.col("dlon").alias("_lon"), "match_via", F.lit(label).alias("match_donor"), F.lit(2 * i + k).alias("_try"))
            every = one if every is None else every.unionByName(one)
    hit = ["match_id", "match_name", "match_km", "match_via", "match_donor", "_lat", "_lon"]
    best = every.groupBy("row_id").agg(F.min_by(F.struct(*hit), F.struct("_try", "match_id")).alias("_b")).select("row_id", "_b.*")
    out = rows.join(best, "row_id", "left").withColumn("own_lat", F.col("lat")).withColumn("own_lon", F.col("lon"))
    use = F.col("match_donor").isNotNull() & (F.col("precision") <= 2)
    out = out.withColumn("coord_source", F.when(use, F.col("match_donor")).otherwise("own"))
    return out.withColumn("lat", F.when(use, F.col("_lat")).otherwise(F.col("lat"))).withColumn("lon", F.when(use, F.col("_lon")).otherwise(F.col("lon"))).drop("_lat", "_lon")


def unique_claims(matched: DataFrame) -> DataFrame:
    """D4. matched with `reverted`: of the rows that claim one donor (same label, state, and id, or name where it has no id), all but the nearest (distance to 2 places, then row_id) give it up.

    Those get their own coordinates and source back, and collision-reverted as match_via. matched: what `cascade` returns (match_name and coord_source may lack). One window over all rows: unmatched ones, and donors with
    neither id nor name, are groups of their own.
    """
    named = F.nullif(F.col("match_name"), F.lit("")) if "match_name" in matched.columns else F.lit(None).cast("string")
    whose = F.coalesce(F.nullif(F.col("match_id").cast("string"), F.lit("")), named)
    is_claim = F.col("match_donor").isNotNull() & whose.isNotNull()
    key = F.when(is_claim, F.struct(F.col("match_donor").alias("d"), whose.alias("i"), F.col("state").cast("string").alias("s"))).otherwise(F.struct(F.lit("").alias("d"), F.col("row_id").cast("string").alias("i"), F.lit("").alias("s")))
    out = matched.withColumn("_key", key)
    rank = F.row_number().over(Window.partitionBy("_key").orderBy(F.round("match_km", 2), "row_id"))
    out = out.withColumn("reverted", is_claim & (rank > 1)).drop("_key")
    back = F.col("reverted")
    for c, own in (("lat", F.col("own_lat")), ("lon", F.col("own_lon")), ("match_via", F.lit("collision-reverted")), ("coord_source", F.lit("own"))):
        if c in matched.columns:
            out = out.withColumn(c, F.when(back, own).otherwise(F.col(c)))
    return out


def nearby_lifespans(rows: DataFrame, spans: DataFrame, km: float = 3.0) -> DataFrame:
    """C17. rows whose missing start_year or stop_year come from the first span (by line) within `km` that has all words of one of their aliases, or the other way round; start_basis and end_basis, where rows have
    them, say `lifespan_csv` for what was filled in.

    rows: row_id, aliases (array of arrays of words), lat, lon, start_year, stop_year, status; spans: line, tokens, lat, lon, start_year, stop_year. Only rows without a start, or without a
    stop and not open, are looked at. A stop isn't filled in where the status is open; elsewhere it makes the status gone. A span or an alias without words matches nothing. Spans are looked through from small
    lines on, and places that are settled don't go on; places and names that several share count once.
    """
    is_open = F.coalesce(F.col("status") == "open", F.lit(False))
    lacking = rows.where(F.col("start_year").isNull() | (F.col("stop_year").isNull() & ~is_open))
    words = lambda c: F.sort_array(F.array_distinct(c))
    asked = lacking.select("row_id", "lat", "lon", F.explode("aliases").alias("tokens")).where(F.size("tokens") > 0).withColumn("tokens", words("tokens"))
    have = spans.where(F.size("tokens") > 0).select(F.col("lat").alias("dlat"), F.col("lon").alias("dlon"), words("tokens").alias("dtokens"), F.struct("line", F.col("start_year").alias("s"), F.col("stop_year").alias("e")).alias("b"))
    size = _wide(km)
    cell = own_cell("lat", "lon")
    pairs = kept(_names_nearby(asked.select(cell.alias("cell"), near_cells("lat", "lon").alias("near"), "tokens"), have.select(own_cell("dlat", "dlon").alias("cell"), "dtokens"), []))
    left = asked.select("lat", "lon", "tokens").distinct()
    have = kept(have.groupBy("dlat", "dlon", "dtokens").agg(F.min("b").alias("b")).withColumn("at", own_cell("dlat", "dlon", size)))
    parts = have.agg(F.percentile_approx("b.line", F.array(F.lit(1 / 64), F.lit(1 / 8)), 10_000)).first()[0] or []
    found = None
    for least in [*parts, None]:  # spans with small lines first: where one is found, later lines are none the better
        some = have if least is None else have.where((F.col("b.line") <= least) | F.col("b.line").isNull())
        near = left.withColumn("cell", cell).join(pairs, ["cell", "tokens"]).withColumn("at", F.explode(near_cells("lat", "lon", size)))
        met = near.join(some, ["dtokens", "at"]).where(haversine_km("lat", "lon", "dlat", "dlon") <= km)
        one = met.groupBy("lat", "lon", "tokens").agg(F.min("b").alias("b"))
        if least is not None:
            tried = kept(left.join(one, ["lat", "lon", "tokens"], "left"))
            one, left = tried.where("b is not null"), tried.where("b is null").drop("b")
        found = one if found is None else found.unionByName(one)
    best = asked.join(found, ["lat", "lon", "tokens"]).groupBy("row_id").agg(F.min("b").alias("b")).select("row_id", "b.s", "b.e")
    out, ended = rows.join(best, "row_id", "left"), F.col("stop_year").isNull() & ~is_open & F.col("e").isNotNull()
    begun = F.col("start_year").isNull() & F.col("s").isNotNull()
    filled = {"status": (ended, F.lit("gone")), "stop_year": (ended, F.col("e")), "start_year": (begun, F.col("s")), "end_basis": (ended, F.lit("lifespan_csv")), "start_basis": (begun, F.lit("lifespan_csv"))}
    new = lambda c: F.when(filled[c][0], filled[c][1]).otherwise(F.col(c)).alias(c) if c in filled else F.col(c)
    return out.select(*[new(c) for c in rows.columns])


def as_of(events: DataFrame, anchors: DataFrame, group: str, at: str, value: str, back: int | None = None) -> DataFrame:
    """C19. events with the last anchor at or before them in the group (and not more than `back` before).

    One window over both, so an event isn't joined with all anchors of its group.
    """
    kind = F.struct(F.col(at).alias("at"), F.col(value).alias("v"))
    both = events.select(group, at, F.struct(*events.columns).alias("_e"), F.lit(None).cast(anchors.select(kind.alias("k")).schema[0].dataType).alias("_a"), F.lit(1).alias("_o"))
    both = both.unionByName(anchors.select(group, at, F.lit(None).cast(both.schema["_e"].dataType).alias("_e"), kind.alias("_a"), F.lit(0).alias("_o")))
    w = Window.partitionBy(group).orderBy(at, "_o").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("_a", F.last("_a", ignorenulls=True).over(w)).where("_e is not null")
    ok = F.lit(True) if back is None else F.col(f"_e.{at}") - F.col("_a.at") <= back
    return found.select("_e.*", F.when(ok, F.col("_a.v")).alias(value))


def with_segment(entries: DataFrame, segments: DataFrame) -> DataFrame:
    """C18. entries with the text of their (page, name) segment; of several the last by line."""
    last = segments.groupBy("page", "name").agg(F.max_by("text", "line").alias("segment"))
    return entries.join(last, ["page", "name"], "left")


def dedupe_entries(entries: DataFrame, links: DataFrame) -> DataFrame:
    """E6. One entry for each (state, name): on a page that its state's index links first, then with an anchor, then by page; in first-seen order.

    links: (state, link), link the lower-case basename of a page (see H7). entries: state, name, page, anchor ('' or null: none), line.
    """
    known = links.select("state", "link").distinct().withColumn("_l", F.lit(1))
    linked = entries.withColumn("link", F.lower(F.regexp_extract("page", r"([^/]*)$", 1))).join(known, ["state", "link"], "left").drop("link")
    no_anchor = F.coalesce(F.col("anchor"), F.lit("")) == ""
    order = [F.desc(F.coalesce("_l", F.lit(0))), no_anchor, "page", "line"]
    first = F.min("line").over(Window.partitionBy("state", "name"))
    return first_by(linked.withColumn("first_seen", first), ["state", "name"], *order).drop("_l").orderBy("first_seen")


def donor_pool(rows: DataFrame, donors: DataFrame, locations: DataFrame) -> DataFrame:
    """C21. (row_id, donor_id): of the donors of a row's location, the same half first (if the row has one), then a whole sheet, then others; then the lowest edition (none: last).

    rows: row_id, location, half; donors: donor_id, name, half, edition; locations: position, location. A donor is of the first location (by position) that stands in its name. Names and
    locations are met on a location's rarest letters (see `contained`), not compared all with all. No row meets all donors of its location.
    """
    sheets = donors.select("donor_id", "name", F.col("half").alias("donor_half"), "edition")
    of = first_by(contained(locations.select("position", "location"), "location", sheets, "name"), ["donor_id"], "position")
    # rows of one location and half choose alike, from one donor of each half
    best = of.groupBy("location", "donor_half").agg(F.min(F.struct(F.col("edition").isNull().alias("_n"), "edition", "donor_id")).alias("_b"))
    fit = F.when(F.col("half") == F.col("donor_half"), 0).when(F.col("donor_half").isNull(), 1).otherwise(2)
    met = rows.select("location", "half").distinct().join(best, "location").groupBy("location", "half").agg(F.min(F.struct(fit.alias("_f"), "_b")).alias("_b"))
    chosen = rows.join(met.toDF("_l", "_h", "_b"), (F.col("location") == F.col("_l")) & F.col("half").eqNullSafe(F.col("_h")))
    return chosen.groupBy("row_id").agg(F.min("_b").alias("_b")).select("row_id", "_b._b.donor_id")
