"""Queries on catalogue rules, claims, donors and logs, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataflow.functions import expr as X
from strataflow.operators import cells as C
from strataflow.operators import logs as L
from strataflow.operators import reconcile as R
from strataflow.operators import resolve as E
from strataflow.plans.timeline import table
from strataflow.sources.writers import review_matrix


def _text(*parts):
    return F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])


def gap_notes(spark, sf_dir):
    """B18 on a note for each order."""
    key, days = F.col("o_orderkey"), (F.col("o_orderkey") % 900).cast("string")
    note = _text(F.when(key % 4 == 0, "latest-in-collection; ").otherwise("L; "), F.when(key % 7 == 0, "BLANK_MAP ").otherwise("B "), "GAP ", days, "d before next (1951-02-03)", F.when(key % 3 == 0, _text("; typ", (key % 50).cast("string"), "d")).otherwise(""))
    out = table(spark, sf_dir, "orders").select("o_orderkey", X.note_gap(F.when(key % 11 > 0, note)).alias("g"))
    return out.select("o_orderkey", "g.latest", "g.blank_map", "g.days", F.col("g.next").cast("string").alias("next"), "g.missing")


def archive_prefixes(spark, sf_dir):
    """B20 on the sections of an archive for each order line, some of them out of order, without leaves, beyond the cap or off the globe."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_orderkey") * 7 + F.col("l_linenumber")).alias("k"))
    n = lambda m, least=0: F.col("k") % m + least
    root, meta = F.when(n(13) == 0, 100).otherwise(127), F.lit(127) + 900
    leaf, leaf_n = meta + n(300_000), F.when(n(3) == 0, 0).otherwise(n(50_000))
    tiles = F.when(n(17) == 0, meta).otherwise(leaf + leaf_n)
    size = tiles + F.when(n(19) == 0, -1).otherwise(500)
    prefix = X.prefix_length(root, n(900), meta, n(300_000), leaf, leaf_n, tiles, size)
    w, s = (n(350) - 180) * 10_000_000 + 1234, (n(180) - 90) * 10_000_000 + 77
    box = X.header_bounds(w, s, w + 40_000_000, s + 40_000_000)
    return li.select("l_orderkey", "l_linenumber", prefix.cast("long").alias("prefix"), F.get(box, F.lit(0)).alias("west"), F.get(box, F.lit(1)).alias("south"), F.get(box, F.lit(2)).alias("east"), F.get(box, F.lit(3)).alias("north"))


def candidate_groups(spark, sf_dir):
    """B16 on a file for each order; some days, locations and stems are missing."""
    key = F.col("o_orderkey")
    start = F.when(key % 5 == 0, "").when(key % 6 == 0, F.date_format(F.col("o_orderdate"), "yyyy/M/d")).otherwise(F.date_format(F.col("o_orderdate"), "yyyy-MM-dd"))
    place = F.when(key % 9 == 0, " ").otherwise(_text("St. Louis, ", (key % 40).cast("string")))
    name = _text("scans/", F.when(key % 10 == 0, "(--)").otherwise(_text("Sheet (", key.cast("string"), ")")), F.when(key % 4 == 0, "-North").otherwise(""), ".tif")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", key.alias("line"), *[F.lit("").alias(f"gcp{i}_{a}") if i == 4 else F.lit("1.5").alias(f"gcp{i}_{a}") for i in range(1, 5) for a in ("px", "py")], start.alias("start"), place.alias("location"), name.alias("filename"))
    return rows.select("o_orderkey", X.candidate("start", "location", "filename").alias("c")).select("o_orderkey", "c.grp", "c.rank")


def split_titles(spark, sf_dir):
    """B26 and B27 on a title for each customer."""
    key = F.col("c_custkey")
    end = F.when(key % 4 == 0, ", ST").when(key % 4 == 1, " ST.").when(key % 4 == 2, "").otherwise(", XX")
    title = _text("Field / Smith ", key.cast("string"), " Airport (ABC) / Dale, Old, Town", end)
    raw = _text(" -_ Smith\n Field", key.cast("string"), F.when(key % 3 == 0, " (revised 3/15)").when(key % 3 == 1, "; revised 12/2001").otherwise(" (kept 3/15)"), " :")
    t = table(spark, sf_dir, "customer").select("c_custkey", X.split_title(title, F.lit("ST")).alias("t"), X.clean_title(raw).alias("clean"))
    return t.select("c_custkey", F.array_join("t.aliases", "|").alias("aliases"), "t.city", "clean")


_HOW = ["dole location/date Big Bend 1950-01-02", "rawtiffs cycle c1 has Big Bend", "dole sectional_files Big Bend ed 7", "basename a.tif in rawtiffs", "rawtiffs a.tif", "exact name"]


def claim_strength(spark, sf_dir):
    """B29 and B30 on a method and a file for each part."""
    key = F.col("p_partkey")
    how = F.element_at(F.array(*[F.lit(h) for h in _HOW]), (key % 6 + 1).cast("int"))
    ext = F.element_at(F.array(*[F.lit(x) for x in (".TIF", ".tiff", ".pdf", ".jpeg", ".jp2", ".zip", ".x", "")]), (key % 8 + 1).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", X.match_confidence(how).alias("confidence"), X.extension_rank(_text("d/f", ext)).alias("ext_rank"))


def row_faults(spark, sf_dir):
    """B37 on the days of each order: some locations, days and ends are missing, wrong or the wrong way round."""
    key, day = F.col("o_orderkey"), F.date_format(F.col("o_orderdate"), "yyyy-MM-dd")
    start, end = F.when(key % 5 == 0, "").when(key % 5 == 1, "soon").otherwise(day), F.when(key % 3 == 0, "").when(key % 3 == 1, "1990-01-01").otherwise("2030-13-01")
    found = X.row_issues(F.when(key % 7 == 0, " ").otherwise("x"), start, end)
    return table(spark, sf_dir, "orders").select("o_orderkey", F.array_join(found, "|").alias("issues"), X.end_missing(start, end).alias("end_missing"), X.edition_or_unknown(F.when(key % 2 == 0, " 7 ")).alias("edition"))


def claim_files(spark, sf_dir):
    """C4: a claim for each customer against the files and catalogue rows of all parts and suppliers."""
    key, to = F.col("c_custkey"), (F.col("c_custkey") % 90).cast("string")
    how = (
        F.when(key % 6 == 0, _text("dole location/date Place-", to, " 1950-01-02")).when(key % 6 == 1, _text("dole sectional_files place ", to, " ed ", (key % 4).cast("string")))
        .when(key % 6 == 2, _text("rawtiffs cycle c", (key % 5).cast("string"), " has F-", to)).when(key % 6 == 3, _text("rawtiffs F ", to, ".TIF")).when(key % 6 == 4, _text("basename f", to, ".tif in rawtiffs")).otherwise("dole location/date Pla 1950-01-03")
    )
    claims = table(spark, sf_dir, "customer").select(key.alias("rid"), F.when(key % 13 == 0, "new").otherwise("dup").alias("dup"), how.alias("how"))
    p = F.col("p_partkey")
    rows = table(spark, sf_dir, "part").where("p_size is not null").select(
        F.when(p % 2 == 0, _text("sectional_files/f", (p % 100).cast("string"), ".tif")).otherwise(_text("z", (p % 100).cast("string"), ".ZIP")).alias("filename"), _text("Place ", (p % 100).cast("string")).alias("location"),
        F.when(p % 3 == 0, "1950-01-02").otherwise("1950-01-03").alias("date"), (p % 4).cast("string").alias("edition"),
    )
    rows = rows.withColumn("filename", F.regexp_replace("filename", "^sectional_files/f", "sectional_files f"))
    s = F.col("s_suppkey")
    files = table(spark, sf_dir, "supplier").select(F.explode(F.array(
        _text("r/c", (s % 5).cast("string"), "/f", s.cast("string"), ".tif"), _text("r/c", (s % 5).cast("string"), "/sectional_files_f", s.cast("string"), ".tif"), _text("r/z", s.cast("string"), "/inner", s.cast("string"), ".tif"), _text("r/z", (s + 50).cast("string"), ".zip"),
    )).alias("path"))
    files = files.select("path", X.basename("path").alias("base"), X.stem("path").alias("stem"), F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("parent"), X.extension("path").alias("ext"))
    return R.claimed_matches(claims, rows, files).select("rid", F.array_join("matches", "|").alias("matches"))


def _points(spark, sf_dir, name, key, step, where="true"):
    """Rows of a table as places on a line of latitude, in five states."""
    k = F.col(key)
    return table(spark, sf_dir, name).where(where).select(k.alias("id"), (k % 5).cast("string").alias("state"), (F.lit(30.0) + (k * step % 977) * 0.002).alias("lat"), (F.lit(-100.0) + (k * 31 % 101) * 0.003).alias("lon"))


def _fields(spark, sf_dir):
    p = _points(spark, sf_dir, "customer", "c_custkey", 7)
    words, variant = F.array(_text("w", (F.col("id") % 11).cast("string")), F.lit("common")), F.col("id") % 3 == 0
    alias = lambda w: F.struct(w.alias("tokens"), variant.alias("variant"))
    return p.select(
        F.col("id").alias("row_id"), "state", "lat", "lon", (F.col("id") % 4).cast("int").alias("precision"), F.array(_text("I", (F.col("id") % 200).cast("string"))).alias("idents"),
        F.array(alias(words), alias(F.array(_text("v", (F.col("id") % 7).cast("string"))))).alias("aliases"), F.array(F.lit("common")).alias("city_tokens"), (F.col("id") % 10 == 0).alias("skip"),
    )


def _donors(spark, sf_dir, shift, where="true"):
    p = _points(spark, sf_dir, "part", "p_partkey", 13, where).withColumn("id", F.col("id") + shift)
    names = F.array(F.struct(F.array(_text("w", (F.col("id") % 11).cast("string")), F.lit("common"), F.when(F.col("id") % 2 == 0, "extra").otherwise("common")).alias("tokens"), (F.col("id") % 4 == 0).alias("variant")), F.struct(F.array(_text("v", (F.col("id") % 7).cast("string"))).alias("tokens"), F.lit(False).alias("variant")))
    return p.select(F.col("id").alias("donor_id"), "state", "lat", "lon", F.array(_text("I", (F.col("id") % 400).cast("string"))).alias("idents"), names.alias("names"), (F.col("id") % 6 > 0).alias("name_ok"))


def name_matches(spark, sf_dir):
    """Customers as fields, parts as donors."""
    return E.match_names(_fields(spark, sf_dir), _donors(spark, sf_dir, 0)).select("row_id", "donor_id", F.round("km", 3).alias("km"), "shared")


def cascade_claims(spark, sf_dir):
    """Identifiers, then names, of two donor lists; of the rows that claim one donor the nearest keeps it."""
    out = E.unique_claims(E.cascade(_fields(spark, sf_dir), [("a", _donors(spark, sf_dir, 0, "p_size <= 15")), ("b", _donors(spark, sf_dir, 100_000))]))
    return out.select("row_id", "match_donor", "match_via", "match_id", F.round("match_km", 3).alias("match_km"), F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"), "reverted")


def lifespan_fills(spark, sf_dir):
    """C17: spans of parts fill in what customers' fields lack."""
    k = F.col("row_id")
    rows = _fields(spark, sf_dir).select("row_id", F.array(F.col("aliases")[0]["tokens"], F.array().cast("array<string>")).alias("aliases"), "lat", "lon", F.when(k % 2 == 0, 1920).alias("start_year"), F.when(k % 3 == 0, 1960).alias("stop_year"), F.when(k % 5 == 0, "open").otherwise("unknown").alias("status"))
    d = _donors(spark, sf_dir, 0)
    spans = d.select(F.col("donor_id").alias("line"), F.when(F.col("donor_id") % 9 == 0, F.array().cast("array<string>")).otherwise(F.col("names")[0]["tokens"]).alias("tokens"), "lat", "lon", F.when(F.col("donor_id") % 4 > 0, 1930).alias("start_year"), F.when(F.col("donor_id") % 5 > 0, 1950).alias("stop_year"))
    return E.nearby_lifespans(rows, spans).select("row_id", "start_year", "stop_year", "status")


def timeline_groups(spark, sf_dir):
    """Customers as locations under extents that overlap best, by hand, or unmatched."""
    k = F.col("c_custkey")
    ref = F.when(k % 4 == 0, _text("extents/e", (k % 20).cast("string"))).when(k % 4 == 1, _text("sectional/new_york_", (k % 10).cast("string")))
    places = table(spark, sf_dir, "customer").select(_text("L", k.cast("string")).alias("location"), ref.alias("ref"), F.when(k % 2 == 0, "1960-01-01").otherwise("1980-01-01").alias("last_date"), (-k).alias("line"))
    best = table(spark, sf_dir, "nation").select(_text("extents/e", F.col("n_nationkey").cast("string")).alias("old"), _text("sectional/new_york_", (F.col("n_nationkey") % 8).cast("string")).alias("modern"))
    hand = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(_text("L", k.cast("string")).alias("location"), F.lit("sectional/salt_lake").alias("group"))
    return C.group_members(places, best, hand).select("group", "name", F.array_join("modern", "|").alias("modern"), F.array_join("old", "|").alias("old"))


def request_log(spark, sf_dir):
    """S1 at a rate of 1: each event is a request, some with a closed, an open, a short or no range."""
    k = F.col("event_id")
    head = F.when(k % 5 == 0, "bytes=0-1023").when(k % 5 == 1, "bytes=100-").when(k % 5 == 2, _text("bytes=10-", (k + 2000).cast("string"))).when(k % 5 == 3, "odd")
    return L.shaped(table(spark, sf_dir, "events").select(k.alias("key"), "ts", head.alias("range_header")), rate=1.0).select("key", "size", "weight")


def review_cells(spark, sf_dir):
    """Months by order priority, a cell for the last order."""
    k = F.col("o_orderkey")
    files = F.when(k % 3 == 0, "a.tif, b.tif").when(k % 3 == 1, "dir/a long file name.tif").otherwise("d/short.tif")
    rows = table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("date"), F.col("o_orderstatus").alias("location"), k.alias("line"), (k % 4).alias("num_files"), files.alias("source_files"))
    return review_matrix(rows, "line", locations=["F", "O", "P"])


def donor_choice(spark, sf_dir):
    """A donor sheet for each customer, by the first region whose name stands in the sheet's name."""
    places = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("position"), F.lower("n_name").alias("location"))
    rows = table(spark, sf_dir, "customer").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("row_id"), F.lower("n_name").alias("location"), F.when(F.col("c_custkey") % 3 == 0, "north").alias("half"))
    s = F.col("s_suppkey")
    sheets = table(spark, sf_dir, "supplier").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("s_nationkey") == F.col("n_nationkey")).select(s.alias("donor_id"), _text(F.lower("n_name"), "_sheet_", s.cast("string")).alias("name"), F.when(s % 3 == 0, "north").when(s % 3 == 1, "south").alias("half"), F.when(s % 4 > 0, s % 7).cast("int").alias("edition"))
    return E.donor_pool(rows, sheets, places)


def entry_dedupe(spark, sf_dir):
    """Parts as entries that share names on several pages."""
    k = F.col("p_partkey")
    rows = table(spark, sf_dir, "part").select(k.alias("line"), (k % 3).cast("string").alias("state"), _text("n", (k % 150).cast("string")).alias("name"), _text("s/Page_", (k % 17).cast("string"), ".HTM").alias("page"), F.when(k % 4 == 0, "a").otherwise("").alias("anchor"))
    links = table(spark, sf_dir, "nation").where("n_regionkey < 3").select((F.col("n_nationkey") % 3).cast("string").alias("state"), _text("page_", F.col("n_nationkey").cast("string"), ".htm").alias("link"))
    return E.dedupe_entries(rows, links).select("state", "name", "line", "page", "anchor", "first_seen")


def sheet_fits(spark, sf_dir):
    """Affine and similarity fits of each supplier's line items, and their greatest residuals."""
    p = table(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_quantity").cast("double").alias("x"), (F.col("l_linenumber") * 3.0).alias("y"), (F.col("l_quantity") * 2 + F.col("l_linenumber") + 5 + F.col("l_orderkey") % 3).cast("double").alias("u"), (F.col("l_linenumber") * 6.0 - F.col("l_quantity") * 0.5).alias("v"))
    a = L.affine_fits(p, "l_suppkey").select("l_suppkey", *[F.round(c, 4).alias(f"affine_{c}") for c in "abcdef"], F.round("max_residual", 4).alias("affine_residual"))
    s = L.similarity_fits(p, "l_suppkey").select("l_suppkey", "n", F.round("scale", 4).alias("scale"), F.round("tx", 4).alias("tx"), F.round("ty", 4).alias("ty"), F.round("max_residual", 4).alias("residual"))
    return a.join(s, "l_suppkey")


def catalogue_values(spark, sf_dir):
    """B1 to B4, B6 to B8, B10, B11, B23 to B25 on raw texts of each customer."""
    k = F.col("c_custkey")
    t = lambda *x: _text(*[v if not isinstance(v, int) else str(v) for v in x])
    n = lambda m: (k % m).cast("string")
    raw = {f"gcp{i}_{a}": t(" ", n(50), f".{i}") for i in range(1, 5) for a in ("px", "py", "lon", "lat")}
    raw["gcp4_py"] = F.when(k % 3 == 0, "nan").when(k % 3 == 1, "").otherwise("12.5 ")
    raw["gcp2_lat"] = F.when(k % 5 == 0, "x").otherwise("40.25")
    raw |= {"lcc_lat1": F.lit("33"), "lcc_lat2": F.lit(" 45 "), "lcc_lat0": n(90), "lcc_lon0": F.when(k % 7 == 0, " ").otherwise("-96.5"), "cutline_wkt": F.when(k % 4 == 0, "POLYGON ((0 0))"), "cutline": F.when(k % 4 < 2, " ref/a ").otherwise(""), "src_crs": F.when(k % 2 == 0, " EPSG:4269 ")}
    title = F.when(k % 3 == 0, t("Big Smith", n(9), " Municipal Field (NAS / A", n(9), "C, XYZ) (original)")).otherwise(t("The Old Smith-Jones (", n(100), ")"))
    c = table(spark, sf_dir, "customer").select("c_custkey", *[v.alias(x) for x, v in raw.items()], title.alias("title"), t(F.when(k % 2 == 0, "N").otherwise("S"), "4030", F.lpad(n(60), 2, "0"), "5").alias("dms"), t(n(80), ".", n(7), "0").alias("dec"))
    x, w = (k % 20).cast("double"), F.lit(20)
    box = X.bounds(X.corners("lon", "lat"))
    out = c.select(
        "c_custkey", F.element_at(X.corners("px", "py"), 4)["py"].alias("py4"), X.lcc_crs().alias("lcc"), X.cutline()["kind"].alias("cut_kind"), X.cutline()["value"].alias("cut_value"), X.gcp_ready().alias("ready"), X.has_gcp_data().alias("has_data"), X.source_crs().alias("crs"),
        X.west("dec").alias("west"), box["west"].alias("box_west"), box["north"].alias("box_north"), F.round(X.dms("dms"), 6).alias("degrees"), X.precision("dec", F.lit("1.25")).alias("precision"), F.array_join(X.title_idents("title"), "|").alias("idents"),
        F.array_join(F.array_sort(X.name_tokens("title")), "|").alias("words"), X.to_display(x, F.lit(5.0), w, F.lit(10), F.lit(90))["x"].alias("shown_x"), X.to_raw(x, F.lit(5.0), w, F.lit(10), F.lit(270))["y"].alias("raw_y"), X.turned_size(w, k % 11, (k % 4 * 90).cast("int"))["w"].alias("turned_w"),
    )
    return out


def row_targets(spark, sf_dir):
    """B43, with B40, on a file for each order: the first reason that leaves it out."""
    k = F.col("o_orderkey")
    name = _text("f", k.cast("string"), F.when(k % 9 == 0, ".pdf").otherwise(".TIF"))
    o = table(spark, sf_dir, "orders")
    rows = o.select(k.alias("line"), name.alias("filename"), (k % 8 > 0).alias("has_gcps"), _text("L", (k % 50).cast("string")).alias("location"))
    rows = R.patch_rows(rows, table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("line"), F.lit("Lx").alias("location"), F.lit(None).cast("boolean").alias("has_gcps")).distinct(), "line", ["location", "has_gcps"])
    files = o.where("o_orderpriority <> '1-URGENT'").select(name.alias("filename"), (F.col("o_orderstatus") != "P").alias("readable"), (F.col("o_orderpriority") == "2-HIGH").alias("georeferenced"))
    siblings = table(spark, sf_dir, "nation").select(_text("L", F.col("n_nationkey").cast("string")).alias("location"))
    return R.targets(rows, files, siblings, "filename", "location").select("line", "filename", "location", "status")


def row_texts(spark, sf_dir):
    """B9, B14, B33 to B36, B39, B41, B44 and H8 on texts of each order."""
    k = F.col("o_orderkey")
    n = lambda m: (k % m).cast("string")
    at = F.when(k % 4 == 0, _text("1950-03-0", n(9), "T05:06:07Z")).when(k % 4 == 1, _text("1950/3/", n(9))).when(k % 4 == 2, "March").otherwise(_text("1950-03-04 05:06:0", n(9)))
    url = _text("http://web/web/2020010", n(10), "030405id_/http://a.b/c ", n(5), "/x.pdf")
    place = F.when(k % 3 == 0, "Salt Lake, UT").when(k % 3 == 1, "New York, ny").otherwise("Seattle")
    act = F.when(k % 3 == 0, _text("ADD Salt Lake 1950-01-0", n(10), "->1951-01-01 ed ", n(7), " x")).when(k % 3 == 1, "SKIP-DUPLICATE same").otherwise(_text("ADD Y 1950-01-02->"))
    ring = F.transform(F.sequence(F.lit(0), (k % 200 + 5).cast("int")), lambda i: F.struct((i / F.lit(7.0)).alias("lon"), (i % 5).cast("double").alias("lat")))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", at.alias("at"), url.alias("url"), place.alias("place"), act.alias("act"), ring.alias("ring"))
    rows = rows.select("*", X.decimated("ring").alias("thin"), X.disposition("act").alias("d"), X.parse_timestamp("at").alias("seen"))
    return rows.select(
        "o_orderkey", X.parse_date("at").cast("string").alias("day"), F.date_format("seen", "yyyy-MM-dd HH:mm:ss").alias("moment"), X.normal_date("at").alias("normal"), F.date_format(X.capture_time("url"), "yyyy-MM-dd HH:mm:ss").alias("captured"), X.flattened_name("url").alias("flat"),
        X.location_matches("place", " LAKE ").alias("matches"), X.state_of("place").alias("state"), F.coalesce(X.in_dates("at", "1950-03-06", "1950-03-03"), F.lit(False)).alias("in_dates"), F.col("d.verb").alias("verb"), F.col("d.location").alias("said_location"),
        F.col("d.start").cast("string").alias("said_start"), F.col("d.end").cast("string").alias("said_end"), F.col("d.edition").alias("said_edition"), F.size("thin").alias("thin_points"), F.element_at("thin", 2)["lon"].alias("thin_lon"), X.alnum("place").alias("alnum"), X.slug("place", {"seattle": "sea"}).alias("slug"),
    )


QUERIES = {f.__name__: f for f in (
    gap_notes, archive_prefixes, candidate_groups, split_titles, claim_strength, row_faults, claim_files, name_matches, cascade_claims, lifespan_fills, timeline_groups, request_log, review_cells, donor_choice,
    entry_dedupe, sheet_fits, catalogue_values, row_targets, row_texts,
)}

_KM = "2 * 6371.0 * asin(sqrt(pow(sin(radians({1}.lat - {0}.lat) / 2), 2) + cos(radians({0}.lat)) * cos(radians({1}.lat)) * pow(sin(radians({1}.lon - {0}.lon) / 2), 2)))"
_FIELDS = """f AS (SELECT c_custkey AS row_id, CAST(c_custkey % 5 AS VARCHAR) AS state, 30.0::DOUBLE + (c_custkey * 7 % 977) * 0.002::DOUBLE AS lat, -100.0::DOUBLE + (c_custkey * 31 % 101) * 0.003::DOUBLE AS lon, c_custkey % 4 AS precision,
  'I' || (c_custkey % 200) AS ident, ['w' || (c_custkey % 11), 'common'] AS t1, ['v' || (c_custkey % 7)] AS t2, c_custkey % 3 = 0 AS variant, c_custkey % 10 = 0 AS skip FROM customer)"""
_DONORS = """{0} AS (SELECT p_partkey + {1} AS donor_id, CAST(p_partkey % 5 AS VARCHAR) AS state, 30.0::DOUBLE + (p_partkey * 13 % 977) * 0.002::DOUBLE AS lat, -100.0::DOUBLE + (p_partkey * 31 % 101) * 0.003::DOUBLE AS lon,
  'I' || ((p_partkey + {1}) % 400) AS ident, list_sort(list_distinct(['w' || ((p_partkey + {1}) % 11), 'common', CASE WHEN (p_partkey + {1}) % 2 = 0 THEN 'extra' ELSE 'common' END])) AS d1, ['v' || ((p_partkey + {1}) % 7)] AS d2,
  (p_partkey + {1}) % 4 = 0 AS dvariant, (p_partkey + {1}) % 6 > 0 AS name_ok FROM part {2})"""
_NAMES = """{0} AS (SELECT row_id, donor_id, km, shared FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY shared DESC, km, donor_id) AS k FROM (
  SELECT a.row_id, d.donor_id, {1} AS km, len(list_intersect(a.t, d.t)) AS shared, len(a.t) AS na, len(d.t) AS nd, len(list_intersect(a.t, d.t)) - CASE WHEN list_contains(a.t, 'common') AND list_contains(d.t, 'common') THEN 1 ELSE 0 END AS own, a.variant, d.v, a.precision
  FROM (SELECT *, unnest([t1, t2]) AS t FROM f WHERE {3}) a JOIN (SELECT *, unnest([d1, d2]) AS t, unnest([dvariant, false]) AS v FROM {2} WHERE name_ok) d USING (state))
  WHERE km <= CASE WHEN precision <= 1 THEN 6.0 ELSE 4.0 END AND shared > 0 AND (shared = na OR shared = nd) AND (shared >= 2 OR (na = nd AND shared = na AND km <= 4.0)) AND NOT (own = 0 AND nd > shared) AND NOT (variant AND NOT v AND km > 3.0)) WHERE k = 1)"""
_IDENTS = """{0} AS (SELECT row_id, donor_id, km FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY km, donor_id) AS k FROM (SELECT f.row_id, d.donor_id, f.precision, {1} AS km FROM f JOIN {2} d USING (state, ident) WHERE NOT skip)
  WHERE km <= CASE precision WHEN 0 THEN 60.0 WHEN 1 THEN 25.0 ELSE 12.0 END) WHERE k = 1)"""
_AD, _FD = _KM.format("a", "d"), _KM.format("f", "d")
_ALNUM = "regexp_replace(lower({0}), '[^a-z0-9]', '', 'g')"

ORACLE = {
    "gap_notes": """WITH o AS (SELECT o_orderkey, o_orderkey % 11 > 0 AS has, o_orderkey % 900 AS d, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 50 END AS typ FROM orders)
SELECT o_orderkey, has AND o_orderkey % 4 = 0 AS latest, has AND o_orderkey % 7 = 0 AS blank_map, CASE WHEN has THEN CAST(d AS INTEGER) END AS days, CASE WHEN has THEN '1951-02-03' END AS next,
  CASE WHEN has AND typ > 0 THEN greatest(1, CAST(round_even(d::DOUBLE / typ, 0) AS INTEGER) - 1) END AS missing FROM o""",
    "archive_prefixes": """WITH k AS (SELECT l_orderkey, l_linenumber, l_orderkey * 7 + l_linenumber AS k FROM lineitem),
a AS (SELECT *, CASE WHEN k % 13 = 0 THEN 100 ELSE 127 END AS root, k % 900 AS root_n, 1027 AS meta, k % 300000 AS meta_n, 1027 + k % 300000 AS leaf, CASE WHEN k % 3 = 0 THEN 0 ELSE k % 50000 END AS leaf_n FROM k),
t AS (SELECT *, CASE WHEN k % 17 = 0 THEN meta ELSE leaf + leaf_n END AS tiles FROM a), z AS (SELECT *, tiles + CASE WHEN k % 19 = 0 THEN -1 ELSE 500 END AS size, (k % 350 - 180) * 10000000 + 1234 AS w, (k % 180 - 90) * 10000000 + 77 AS s FROM t),
b AS (SELECT *, root >= 127 AND root + root_n <= meta AND (CASE WHEN leaf_n = 0 THEN meta + meta_n <= tiles ELSE meta + meta_n <= leaf AND leaf + leaf_n <= tiles END) AND tiles <= size AS ok, (w + 40000000) <= 1800000000 AND s >= -860000000 AND s + 40000000 <= 860000000 AS on_globe FROM z)
SELECT l_orderkey, l_linenumber, CASE WHEN ok THEN CASE WHEN tiles <= 262144 OR leaf_n = 0 THEN tiles ELSE leaf END END AS prefix, CASE WHEN on_globe THEN floor(w / 1e5) / 100 END AS west, CASE WHEN on_globe THEN floor(s / 1e5) / 100 END AS south,
  CASE WHEN on_globe THEN ceil((w + 40000000) / 1e5) / 100 END AS east, CASE WHEN on_globe THEN ceil((s + 40000000) / 1e5) / 100 END AS north FROM b""",
    "candidate_groups": """SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 0 AND o_orderkey % 9 > 0 THEN strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') || '|st_louis_' || (o_orderkey % 40) || CASE WHEN o_orderkey % 4 = 0 THEN '|north' ELSE '' END
  ELSE 'undated|' || CASE WHEN o_orderkey % 10 = 0 THEN CASE WHEN o_orderkey % 4 = 0 THEN 'north' ELSE 'row' || o_orderkey END ELSE 'sheet_' || o_orderkey || CASE WHEN o_orderkey % 4 = 0 THEN '_north' ELSE '' END END END AS grp, 2 AS rank FROM orders""",
    "split_titles": """SELECT c_custkey, CASE WHEN c_custkey % 4 = 3 THEN 'Smith ' || c_custkey || ' Airport (ABC)|Dale, Old, Town' ELSE 'Smith ' || c_custkey || ' Airport (ABC)|Dale, Old' END AS aliases, CASE WHEN c_custkey % 4 = 3 THEN 'XX' ELSE 'Town' END AS city,
  'Smith Field' || c_custkey || CASE WHEN c_custkey % 3 = 2 THEN ' (kept 3/15)' ELSE '' END AS clean FROM customer""",
    "claim_strength": "SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 2 ELSE 3 END AS confidence, CASE p_partkey % 8 WHEN 0 THEN 0 WHEN 1 THEN 0 WHEN 2 THEN 1 WHEN 3 THEN 2 WHEN 5 THEN 3 ELSE 4 END AS ext_rank FROM part",
    "row_faults": """SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'missing location' ELSE concat_ws('|', CASE WHEN o_orderkey % 5 = 1 THEN 'invalid date' END, CASE WHEN o_orderkey % 3 = 2 THEN 'invalid end_date' END,
  CASE WHEN o_orderkey % 3 = 1 AND o_orderkey % 5 > 1 AND CAST(o_orderdate AS DATE) > DATE '1990-01-01' THEN 'end_date before date' END) END AS issues, o_orderkey % 5 > 1 AND o_orderkey % 3 <> 1 AS end_missing, CASE WHEN o_orderkey % 2 = 0 THEN '7' ELSE 'Unknown' END AS edition FROM orders""",
    "claim_files": f"""WITH a AS (SELECT c_custkey AS rid, c_custkey % 6 AS m, c_custkey % 90 AS n, c_custkey % 4 AS ed, c_custkey % 5 AS cyc FROM customer WHERE c_custkey % 13 > 0),
r AS (SELECT CASE WHEN p_partkey % 2 = 0 THEN 'sectional_files f' || (p_partkey % 100) || '.tif' ELSE 'z' || (p_partkey % 100) || '.ZIP' END AS filename, p_partkey % 100 AS loc, CASE WHEN p_partkey % 3 = 0 THEN 2 ELSE 3 END AS day, p_partkey % 4 AS ed FROM part WHERE p_size IS NOT NULL),
fl AS (SELECT unnest(['r/c' || (s_suppkey % 5) || '/f' || s_suppkey || '.tif', 'r/c' || (s_suppkey % 5) || '/sectional_files_f' || s_suppkey || '.tif', 'r/z' || s_suppkey || '/inner' || s_suppkey || '.tif', 'r/z' || (s_suppkey + 50) || '.zip']) AS path FROM supplier),
fi AS (SELECT path, string_split(path, '/')[-1] AS base, string_split(path, '/')[-2] AS parent, path LIKE '%.tif' AS image FROM fl),
first AS (SELECT DISTINCT rid, filename FROM a JOIN r ON (m = 0 AND loc = n AND day = 2) OR (m = 1 AND filename LIKE '%sectional_files%' AND loc = n AND r.ed = a.ed)),
lead AS (SELECT filename, path FROM (SELECT DISTINCT filename FROM r) n2 JOIN fi ON (filename LIKE '%.tif' AND image AND {_ALNUM.format('base')} = {_ALNUM.format('filename')})
  OR (filename LIKE '%.ZIP' AND CASE WHEN image THEN parent = replace(filename, '.ZIP', '') ELSE base = lower(filename) AND NOT EXISTS (SELECT 1 FROM fi g WHERE g.image AND g.parent = replace(n2.filename, '.ZIP', '')) END)),
led AS (SELECT rid, path FROM first JOIN lead USING (filename)),
second AS (SELECT DISTINCT rid, filename FROM a JOIN r ON (m = 0 AND day = 2 AND starts_with('place' || loc, 'place' || n)) OR (m = 5 AND day = 3) WHERE rid NOT IN (SELECT rid FROM led)),
hit AS (SELECT rid, path FROM a JOIN fi ON m = 2 AND image AND parent = 'c' || cyc AND contains({_ALNUM.format('base')}, 'f' || n)
  UNION ALL SELECT rid, path FROM a JOIN fi ON m IN (3, 4) AND image AND {_ALNUM.format('base')} = 'f' || n || 'tif'
  UNION ALL SELECT rid, path FROM led UNION ALL SELECT rid, path FROM second JOIN lead USING (filename))
SELECT rid, array_to_string(list_sort(list(DISTINCT path)), '|') AS matches FROM hit GROUP BY rid""",
    "name_matches": f"WITH {_FIELDS}, {_DONORS.format('da', 0, '')}, {_NAMES.format('m', _AD, 'da', 'true')} SELECT row_id, donor_id, round(km, 3) AS km, CAST(shared AS INTEGER) AS shared FROM m",
    "cascade_claims": f"""WITH {_FIELDS}, {_DONORS.format('da', 0, 'WHERE p_size <= 15')}, {_DONORS.format('db', 100000, '')}, {_IDENTS.format('i0', _FD, 'da')}, {_NAMES.format('n0', _AD, 'da', 'NOT skip')}, {_IDENTS.format('i1', _FD, 'db')}, {_NAMES.format('n1', _AD, 'db', 'NOT skip')},
every AS (SELECT 0 AS t, row_id, donor_id, km FROM i0 UNION ALL SELECT 1, row_id, donor_id, km FROM n0 UNION ALL SELECT 2, row_id, donor_id, km FROM i1 UNION ALL SELECT 3, row_id, donor_id, km FROM n1),
best AS (SELECT * FROM every QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY t) = 1), d AS (SELECT donor_id, lat, lon FROM da UNION ALL SELECT donor_id, lat, lon FROM db),
c AS (SELECT f.row_id, f.ident, f.lat AS own_lat, f.lon AS own_lon, f.precision, d.lat, d.lon, t, donor_id, km, donor_id IS NOT NULL AND row_number() OVER (PARTITION BY donor_id, f.state ORDER BY round(km, 2), f.row_id) > 1 AS reverted FROM f LEFT JOIN best USING (row_id) LEFT JOIN d USING (donor_id))
SELECT row_id, CASE WHEN t < 2 THEN 'a' WHEN t >= 2 THEN 'b' END AS match_donor, CASE WHEN reverted THEN 'collision-reverted' WHEN t % 2 = 0 THEN 'ident:' || ident WHEN t % 2 = 1 THEN 'name' END AS match_via, donor_id AS match_id, round(km, 3) AS match_km,
  round(CASE WHEN donor_id IS NOT NULL AND NOT reverted AND precision <= 2 THEN lat ELSE own_lat END, 6) AS lat, round(CASE WHEN donor_id IS NOT NULL AND NOT reverted AND precision <= 2 THEN lon ELSE own_lon END, 6) AS lon, reverted FROM c""",
    "lifespan_fills": f"""WITH {_FIELDS}, {_DONORS.format('da', 0, '')}, r AS (SELECT *, CASE WHEN row_id % 2 = 0 THEN 1920 END AS start_year, CASE WHEN row_id % 3 = 0 THEN 1960 END AS stop_year, CASE WHEN row_id % 5 = 0 THEN 'open' ELSE 'unknown' END AS status FROM f),
m AS (SELECT row_id, donor_id, row_number() OVER (PARTITION BY row_id ORDER BY donor_id) AS k FROM (SELECT r.row_id, d.donor_id, {_KM.format('r', 'd')} AS km FROM r JOIN da d ON d.donor_id % 9 > 0 AND list_has_all(d.d1, r.t1) WHERE r.start_year IS NULL OR (r.stop_year IS NULL AND r.status <> 'open')) WHERE km <= 3.0),
x AS (SELECT row_id, CASE WHEN donor_id % 4 > 0 THEN 1930 END AS s, CASE WHEN donor_id % 5 > 0 THEN 1950 END AS e FROM m WHERE k = 1)
SELECT row_id, coalesce(start_year, s) AS start_year, CASE WHEN stop_year IS NULL AND status <> 'open' THEN e ELSE stop_year END AS stop_year, CASE WHEN stop_year IS NULL AND status <> 'open' AND e IS NOT NULL THEN 'gone' ELSE status END AS status FROM r LEFT JOIN x USING (row_id)""",
    "timeline_groups": """WITH l AS (SELECT 'L' || c_custkey AS location, c_custkey AS k, c_acctbal FROM customer),
p AS (SELECT location, k, k % 4 = 0 OR (k % 4 = 2) AS is_old, CASE WHEN k % 4 = 1 THEN 'sectional/new_york_' || (k % 10) WHEN k % 4 = 0 THEN 'sectional/new_york_' || (k % 20 % 8) WHEN k % 4 = 2 THEN CASE WHEN c_acctbal > 0 THEN 'sectional/salt_lake' ELSE '__unmatched__' END END AS "group" FROM l),
g AS (SELECT "group", coalesce(array_to_string(list_sort(list(location) FILTER (NOT is_old)), '|'), '') AS modern, coalesce(array_to_string(list_sort(list(location) FILTER (is_old)), '|'), '') AS old, arg_max(location, k) FILTER (NOT is_old) AS first FROM p GROUP BY "group")
SELECT "group", CASE WHEN first IS NOT NULL THEN first WHEN "group" LIKE '%salt_lake' THEN 'Salt Lake' WHEN "group" = '__unmatched__' THEN '  Unmatched  ' ELSE 'New York ' || right("group", 1) END AS name, modern, old FROM g""",
    "request_log": "SELECT event_id AS key, CAST(CASE WHEN event_id % 5 = 2 THEN event_id + 1991 ELSE 0 END AS BIGINT) AS size, 1.0 AS weight FROM events WHERE event_id % 5 > 1",
    "review_cells": """WITH o AS (SELECT strftime(CAST(o_orderdate AS DATE), '%Y-%m') AS date, o_orderstatus, o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN '---' WHEN o_orderkey % 3 = 0 THEN '(2 files)' WHEN o_orderkey % 3 = 1 THEN 'a long fi...' ELSE 'short.tif' END AS cell FROM orders)
SELECT date, coalesce(arg_max(cell, o_orderkey) FILTER (o_orderstatus = 'F'), '---') AS "F", coalesce(arg_max(cell, o_orderkey) FILTER (o_orderstatus = 'O'), '---') AS "O", coalesce(arg_max(cell, o_orderkey) FILTER (o_orderstatus = 'P'), '---') AS "P" FROM o GROUP BY date""",
    "donor_choice": """WITH n AS (SELECT n_nationkey AS p, lower(n_name) AS location FROM nation), s AS (SELECT s_suppkey AS id, lower(n_name) || '_sheet_' || s_suppkey AS name, CASE s_suppkey % 3 WHEN 0 THEN 'north' WHEN 1 THEN 'south' END AS half, CASE WHEN s_suppkey % 4 > 0 THEN s_suppkey % 7 END AS edition FROM supplier JOIN nation ON s_nationkey = n_nationkey),
d AS (SELECT s.*, arg_min(location, p) AS location FROM s JOIN n ON contains(name, location) GROUP BY ALL)
SELECT row_id, id AS donor_id FROM (SELECT c_custkey AS row_id, id, row_number() OVER (PARTITION BY c_custkey ORDER BY CASE WHEN c_custkey % 3 = 0 AND half = 'north' THEN 0 WHEN half IS NULL THEN 1 ELSE 2 END, edition NULLS LAST, id) AS k
  FROM customer JOIN n ON c_nationkey = p JOIN d USING (location)) WHERE k = 1""",
    "entry_dedupe": """WITH e AS (SELECT p_partkey AS line, CAST(p_partkey % 3 AS VARCHAR) AS state, 'n' || (p_partkey % 150) AS name, 's/Page_' || (p_partkey % 17) || '.HTM' AS page, CASE WHEN p_partkey % 4 = 0 THEN 'a' ELSE '' END AS anchor,
  EXISTS (SELECT 1 FROM nation WHERE n_regionkey < 3 AND n_nationkey % 3 = p_partkey % 3 AND n_nationkey = p_partkey % 17) AS linked FROM part)
SELECT state, name, line, page, anchor, first_seen FROM (SELECT *, min(line) OVER (PARTITION BY state, name) AS first_seen, row_number() OVER (PARTITION BY state, name ORDER BY linked DESC, anchor = '', page, line) AS k FROM e) WHERE k = 1""",
    "sheet_fits": """WITH p AS (SELECT l_suppkey, l_quantity::DOUBLE AS x, l_linenumber * 3.0::DOUBLE AS y, (l_quantity * 2 + l_linenumber + 5 + l_orderkey % 3)::DOUBLE AS u, l_linenumber * 6.0::DOUBLE - l_quantity::DOUBLE * 0.5 AS v FROM lineitem),
m AS (SELECT l_suppkey, count(*) AS n, avg(x) AS mx, avg(y) AS my, avg(u) AS mu, avg(v) AS mv, var_pop(x) AS xx, var_pop(y) AS yy, covar_pop(x, y) AS xy, covar_pop(x, u) AS xu, covar_pop(y, u) AS yu, covar_pop(x, v) AS xv, covar_pop(y, v) AS yv FROM p GROUP BY 1),
g AS (SELECT *, (yy * xu - xy * yu) / (xx * yy - xy * xy) AS a, (xx * yu - xy * xu) / (xx * yy - xy * xy) AS b, (yy * xv - xy * yv) / (xx * yy - xy * xy) AS d, (xx * yv - xy * xv) / (xx * yy - xy * xy) AS e, (xu + yv) / (xx + yy) AS scale FROM m),
h AS (SELECT *, mu - a * mx - b * my AS c, mv - d * mx - e * my AS f, mu - scale * mx AS tx, mv - scale * my AS ty FROM g),
r AS (SELECT l_suppkey, max(sqrt(pow(u - (a * x + b * y + c), 2) + pow(v - (d * x + e * y + f), 2))) AS ra, max(sqrt(pow(u - (scale * x + tx), 2) + pow(v - (scale * y + ty), 2))) AS rs FROM p JOIN h USING (l_suppkey) GROUP BY 1)
SELECT l_suppkey, round(a, 4) AS affine_a, round(b, 4) AS affine_b, round(c, 4) AS affine_c, round(d, 4) AS affine_d, round(e, 4) AS affine_e, round(f, 4) AS affine_f, round(ra, 4) AS affine_residual, n, round(scale, 4) AS scale, round(tx, 4) AS tx, round(ty, 4) AS ty, round(rs, 4) AS residual FROM h JOIN r USING (l_suppkey)""",
    "catalogue_values": """WITH k AS (SELECT c_custkey AS k FROM customer), d AS (SELECT *, k % 3 = 2 AS px_ok, k % 5 > 0 AS lat_ok FROM k)
SELECT k AS c_custkey, CASE WHEN px_ok THEN 12.5::DOUBLE END AS py4, CASE WHEN k % 7 > 0 THEN '+proj=lcc +lat_1=33 +lat_2=45 +lat_0=' || (k % 90) || ' +lon_0=-96.5 +x_0=0 +y_0=0 +datum=NAD83 +units=m +no_defs' END AS lcc,
  CASE k % 4 WHEN 0 THEN 'wkt' WHEN 1 THEN 'ref' END AS cut_kind, CASE k % 4 WHEN 0 THEN 'POLYGON ((0 0))' WHEN 1 THEN 'ref/a' END AS cut_value, px_ok AND lat_ok AS ready, true AS has_data, CASE WHEN k % 2 = 0 THEN 'EPSG:4269' ELSE '' END AS crs,
  -CAST((k % 80) || '.' || (k % 7) AS DOUBLE) AS west, CASE WHEN lat_ok THEN CAST((k % 50) || '.1' AS DOUBLE) END AS box_west, CASE WHEN lat_ok THEN greatest(40.25::DOUBLE, CAST((k % 50) || '.4' AS DOUBLE)) END AS box_north,
  round((CASE WHEN k % 2 = 0 THEN 1 ELSE -1 END) * (40 + 30 / 60.0::DOUBLE + (k % 60 + 0.5::DOUBLE) / 3600), 6) AS degrees, CASE WHEN k % 7 = 0 THEN 0 ELSE 1 END AS precision,
  CASE WHEN k % 3 = 0 THEN 'A' || (k % 9) || 'C|XYZ' WHEN k % 100 >= 10 THEN CAST(k % 100 AS VARCHAR) ELSE '' END AS idents, CASE WHEN k % 3 = 0 THEN 'big|smith' || (k % 9) ELSE 'jones|smith' END AS words,
  CAST(10 - 5 AS DOUBLE) AS shown_x, CAST(k % 20 AS DOUBLE) AS raw_y, CASE WHEN k % 4 IN (1, 3) THEN k % 11 ELSE 20 END AS turned_w FROM d""",
    "row_targets": """WITH r AS (SELECT o.*, o_orderkey AS k, 'f' || o_orderkey || CASE WHEN o_orderkey % 9 = 0 THEN '.pdf' ELSE '.TIF' END AS filename, CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') THEN 'Lx' ELSE 'L' || (o_orderkey % 50) END AS location FROM orders o)
SELECT k AS line, filename, location, CASE WHEN k % 9 = 0 THEN 'extension' WHEN k % 8 = 0 THEN 'no GCPs' WHEN o_orderpriority = '1-URGENT' THEN 'file missing' WHEN o_orderstatus = 'P' THEN 'unreadable' WHEN o_orderpriority = '2-HIGH' THEN 'already georeferenced'
  WHEN location = 'Lx' OR k % 50 >= 25 THEN 'no sibling' ELSE 'ok' END AS status FROM r""",
    "row_texts": """WITH k AS (SELECT o_orderkey AS k FROM orders), a AS (SELECT k, CASE k % 4 WHEN 0 THEN make_date(1950, 3, CASE WHEN k % 9 = 0 THEN 1 ELSE (k % 9)::INT END) WHEN 1 THEN make_date(1950, 3, CASE WHEN k % 9 = 0 THEN 1 ELSE (k % 9)::INT END) WHEN 3 THEN DATE '1950-03-04' END AS d FROM k),
b AS (SELECT k, CASE WHEN k % 4 < 2 AND k % 9 = 0 THEN NULL ELSE d END AS d, CASE k % 4 WHEN 0 THEN '1950-03-0' || (k % 9) || 'T05:06:07Z' WHEN 1 THEN '1950/3/' || (k % 9) WHEN 2 THEN 'March' ELSE '1950-03-04 05:06:0' || (k % 9) END AS raw FROM a),
s AS (SELECT k, greatest(1, (k % 200 + 6) // 48) AS step, k % 200 + 5 AS last FROM k)
SELECT k AS o_orderkey, strftime(d, '%Y-%m-%d') AS day, CASE WHEN d IS NOT NULL THEN strftime(d, '%Y-%m-%d') || CASE k % 4 WHEN 0 THEN ' 05:06:07' WHEN 3 THEN ' 05:06:0' || (k % 9) ELSE ' 00:00:00' END END AS moment, coalesce(strftime(d, '%Y-%m-%d'), raw) AS normal,
  CASE WHEN k % 10 > 0 THEN '2020-01-0' || (k % 10) || ' 03:04:05' END AS captured, 'web_2020010' || (k % 10) || '030405id__http:__a.b_c_' || (k % 5) || '_x.pdf' AS flat, k % 3 = 0 AS matches, CASE WHEN k % 3 = 0 THEN 'UT' END AS state, coalesce(d BETWEEN DATE '1950-03-03' AND DATE '1950-03-06', false) AS in_dates,
  CASE WHEN k % 3 = 1 THEN 'SKIP-DUPLICATE' ELSE 'ADD' END AS verb, CASE k % 3 WHEN 0 THEN 'Salt Lake' WHEN 2 THEN 'Y' END AS said_location, CASE k % 3 WHEN 0 THEN CASE WHEN k % 10 > 0 THEN '1950-01-0' || (k % 10) END WHEN 2 THEN '1950-01-02' END AS said_start, CASE WHEN k % 3 = 0 THEN '1951-01-01' END AS said_end,
  CASE WHEN k % 3 = 0 THEN CAST(k % 7 AS VARCHAR) END AS said_edition, CAST(last // step + 2 AS INTEGER) AS thin_points, round_even(step / 7.0::DOUBLE, 3) AS thin_lon, CASE k % 3 WHEN 0 THEN 'saltlakeut' WHEN 1 THEN 'newyorkny' ELSE 'seattle' END AS alnum, CASE k % 3 WHEN 0 THEN 'salt_lake_ut' WHEN 1 THEN 'new_york_ny' ELSE 'sea' END AS slug
FROM b JOIN s USING (k)""",
}
