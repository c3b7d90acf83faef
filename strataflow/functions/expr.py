"""Column expressions on catalogue rows. Blank and null both mean missing; nothing here leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stop lists, patterns and the projection text of the catalogue format.
IDENT_STOP = ["NAS", "AAF", "AFB", "NAAS", "NOLF", "NALF", "NAAF", "MCAS", "MCAF", "CGAS", "NAF", "ANG", "AUX", "USN", "USAF", "AAAF", "AFS", "NRAB"]
NAME_STOP = [
    "airport", "airfield", "field", "airpark", "airstrip", "strip", "municipal", "muni", "county", "city", "memorial", "regional", "international", "intl",
    "landing", "intermediate", "auxiliary", "aux", "army", "naval", "navy", "air", "force", "base", "station", "the", "original", "location", "no", "new", "old",
]
GAP = r"GAP (\d+)d before next \((\d{4}-\d{2}-\d{2})\)"
TYPICAL = r"typ(\d+)d"
LATEST, BLANK_MAP = "latest-in-collection", "BLANK_MAP"
# How the methods of claims begin.
BY_DATE, BY_CYCLE, BY_EDITION, BY_NAME, BY_BASENAME = "dole location/date", "rawtiffs cycle", "dole sectional_files", "rawtiffs", "basename"
#: Bytes of an archive's header, and the latitude that its bounds may reach.
HEADER_BYTES, MOST_LATITUDE = 127, 86
LCC = "+proj=lcc +lat_1=%s +lat_2=%s +lat_0=%s +lon_0=%s +x_0=0 +y_0=0 +datum=NAD83 +units=m +no_defs"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text(c) -> Column:
    """The trimmed text, '' for null."""
    return F.trim(F.coalesce(col(c).cast("string"), F.lit("")))


def blank(c) -> Column:
    return text(c) == ""


def number(c) -> Column:
    """B1. A finite number, else null."""
    x = text(c).try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def whole(c) -> Column:
    """An integer written as one, else null ('12.0' isn't)."""
    return F.when(text(c).rlike(r"^[+-]?\d+$"), text(c).try_cast("int"))


def corners(a: str, b: str) -> Column:
    """B2. array<struct<a, b>> of the four corners' columns gcp<i>_<a> and gcp<i>_<b>, null if any is missing."""
    points = [F.struct(number(f"gcp{i}_{a}").alias(a), number(f"gcp{i}_{b}").alias(b)) for i in range(1, 5)]
    whole_ = [number(f"gcp{i}_{x}").isNotNull() for i in range(1, 5) for x in (a, b)]
    return F.when(_all(whole_), F.array(*points))


def _all(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def lcc_crs() -> Column:
    """B3. The projection text, if all four parameters are there."""
    names = ["lcc_lat1", "lcc_lat2", "lcc_lat0", "lcc_lon0"]
    return F.when(_all([number(n).isNotNull() for n in names]), F.format_string(LCC, *[text(n) for n in names]))


def cutline() -> Column:
    """B4. struct<kind, value>: WKT in the row before a shape reference, else null."""
    pair = lambda kind, c: F.struct(F.lit(kind).alias("kind"), text(c).alias("value"))
    return F.when(~blank("cutline_wkt"), pair("wkt", "cutline_wkt")).when(~blank("cutline"), pair("ref", "cutline"))


def rotation(c) -> Column:
    """B5. 90, 180 or 270, else 0."""
    turn = F.pmod(number(c).try_cast("int"), F.lit(360))
    return F.when(turn.isin(90, 180, 270), turn).otherwise(0)


def to_display(x, y, w, h, turn) -> Column:
    """B6. A raw pixel in the frame that is turned clockwise."""
    x, y, w, h = map(col, (x, y, w, h))
    return _turned(col(turn), (x, y), (h - y, x), (w - x, h - y), (y, w - x))


def to_raw(x, y, w, h, turn) -> Column:
    """B6. The inverse of to_display; w and h are those of the raw frame."""
    x, y, w, h = map(col, (x, y, w, h))
    return _turned(col(turn), (x, y), (y, h - x), (w - x, h - y), (w - y, x))


def _turned(turn, *by_quarter) -> Column:
    point = [F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")) for x, y in by_quarter]
    return F.when(turn == 90, point[1]).when(turn == 180, point[2]).when(turn == 270, point[3]).otherwise(point[0])


def turned_size(w, h, turn) -> Column:
    """B6. Width and height of the turned frame."""
    swap = col(turn).isin(90, 270)
    return F.struct(F.when(swap, col(h)).otherwise(col(w)).alias("w"), F.when(swap, col(w)).otherwise(col(h)).alias("h"))


def gcp_ready() -> Column:
    """B7. Pixel and geographic corners are complete."""
    return corners("px", "py").isNotNull() & corners("lon", "lat").isNotNull()


def has_gcp_data() -> Column:
    """B7. All pixel corners, or any geographic number."""
    some = F.coalesce(*[number(f"gcp{i}_{x}") for i in range(1, 5) for x in ("lat", "lon")])
    return corners("px", "py").isNotNull() | some.isNotNull()


def source_crs(c="src_crs") -> Column:
    """B8."""
    return text(c)


def parse_timestamp(c) -> Column:
    """B9. ISO date or time, y-m-d, y/m/d or `y-m-d H:M:S`; a zone suffix is cut off, not applied."""
    plain = F.regexp_replace(F.regexp_replace(text(c), r"(?<=\d)(Z|[+-]\d\d:?\d\d)$", ""), r"(?<=\d)T(?=\d)", " ")
    plain = F.when(plain.rlike(r"^\d{4}[-/]\d{1,2}[-/]\d{1,2}$") | plain.rlike(r"\d\d:\d\d"), plain)
    return F.coalesce(*[F.try_to_timestamp(plain, F.lit(f)) for f in ("yyyy-M-d", "yyyy/M/d", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd HH:mm")])


def parse_date(c) -> Column:
    """B9. The day of parse_timestamp."""
    return parse_timestamp(c).cast("date")


def strict_date(c) -> Column:
    """B9. Only yyyy-MM-dd."""
    return F.when(text(c).rlike(r"^\d{4}-\d{2}-\d{2}$"), text(c).try_cast("date"))


def normal_date(c) -> Column:
    """B9. yyyy-MM-dd if it parses, else the text as it is."""
    return F.coalesce(parse_date(c).cast("string"), text(c))


def west(c) -> Column:
    """B10. Longitudes are west of Greenwich."""
    return -F.abs(number(c))


def bounds(points, x="lon", y="lat") -> Column:
    """B11. struct<west, south, east, north> of an array of points."""
    xs, ys = F.transform(col(points), lambda p: p[x]), F.transform(col(points), lambda p: p[y])
    return F.struct(F.array_min(xs).alias("west"), F.array_min(ys).alias("south"), F.array_max(xs).alias("east"), F.array_max(ys).alias("north"))


def slug(c, abbreviations: dict[str, str] | None = None) -> Column:
    """B12. Lower case; space, hyphen and full stop as one underscore; commas go; then the abbreviation map."""
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(text(c)), ",", ""), r"[ .\-]", "_"), "_+", "_")
    if not abbreviations:
        return plain
    known = F.create_map(*[F.lit(x) for kv in sorted(abbreviations.items()) for x in kv])
    return F.coalesce(F.element_at(known, plain), plain)


def safe_filename(c) -> Column:
    """B12."""
    return F.lower(F.regexp_replace(F.regexp_replace(F.regexp_replace(F.coalesce(col(c), F.lit("")), "[(),]", ""), r"[ .\-]", "_"), "_+", "_"))


def alnum(c) -> Column:
    """B12. Lower-case letters and digits only."""
    return F.regexp_replace(F.lower(text(c)), "[^a-z0-9]", "")


def basename(c) -> Column:
    return F.regexp_extract(F.translate(text(c), "\\", "/"), r"([^/]*)$", 1)


def stem(c) -> Column:
    """B12. Basename without its last extension, lower case."""
    return F.lower(F.regexp_replace(basename(c), r"(?<=.)\.[^.]*$", ""))


def extension(c) -> Column:
    return F.lower(F.regexp_extract(basename(c), r"(?<=.)\.([^.]+)$", 1))


def validity_key(start, end) -> Column:
    """B13. start, or start_to_end if the end is another day."""
    return F.when(blank(end) | (text(start) == text(end)), text(start)).otherwise(F.concat_ws("_to_", text(start), text(end)))


def capture_time(url) -> Column:
    """B14. The 14 digits after /web/ as a timestamp."""
    return F.try_to_timestamp(F.regexp_extract(text(url), r"/web/(\d{14})", 1), F.lit("yyyyMMddHHmmss"))


def half(c) -> Column:
    """B15. north, south, east or west at the end of a stem, else null."""
    return F.nullif(F.lower(F.regexp_extract(stem(c), r"(?i)[\s_-](north|south|east|west)$", 1)), F.lit(""))


def half_and_edition(c, location) -> Column:
    """B15. struct<half, edition> of a stem once the first occurrence of its location is cut out: its first word that is a half, and its first number of three digits at most, words being parted by
    all but a-z and 0-9."""
    t, place = stem(c), F.lower(text(location))
    at = F.instr(t, place)
    rest = F.when((at > 0) & (place != ""), F.concat(F.substring(t, F.lit(1), at - 1), F.lit(" "), F.substring(t, at + F.length(place), F.length(t)))).otherwise(t)
    words = F.split(rest, "[^a-z0-9]+")
    return F.struct(
        F.get(F.filter(words, lambda w: w.isin("north", "south", "east", "west")), F.lit(0)).alias("half"),
        F.get(F.filter(words, lambda w: w.rlike(r"^\d{1,3}$")), F.lit(0)).cast("int").alias("edition"),
    )


def candidate(start, location, filename, line="line", abbreviations: dict[str, str] | None = None) -> Column:
    """B16. struct<grp, rank>: what competes, and 1 for rows with all pixel corners, else 2.

    Rows with a day and a location compete by day, location slug and half; others by their stem, with all but letters, digits and underscores folded to one underscore, or, if
    nothing is left of it, by their line.
    """
    place, token = slug(location, abbreviations), F.btrim(F.regexp_replace(F.regexp_replace(stem(filename), "[^a-z0-9_]+", "_"), "_+", "_"), F.lit("_"))
    undated = F.concat(F.lit("undated|"), F.when(token == "", F.concat(F.lit("row"), col(line).cast("string"))).otherwise(token))
    grp = F.when(parse_date(start).isNotNull() & (place != ""), F.concat_ws("|", normal_date(start), place, half(filename))).otherwise(undated)
    return F.struct(grp.alias("grp"), F.when(corners("px", "py").isNotNull(), 1).otherwise(2).alias("rank"))


def chart_key(location, start, filename) -> Column:
    """B17. chart/<slug>/<date>[-half]; null unless slug and date are well formed."""
    name = slug(location)
    ok = name.rlike("^[a-z0-9_]+$") & strict_date(start).isNotNull()
    return F.when(ok, F.concat(F.lit("chart/"), name, F.lit("/"), F.concat_ws("-", text(start), half(filename))))


def note_gap(note) -> Column:
    """B18. struct<latest, blank_map, days, next, typical, missing>: what a note says on the gap after a chart."""
    days, usual = [F.nullif(F.regexp_extract(text(note), p, 1), F.lit("")).cast("int") for p in (GAP, TYPICAL)]
    return F.struct(
        text(note).contains(LATEST).alias("latest"), text(note).contains(BLANK_MAP).alias("blank_map"), days.alias("days"),
        F.regexp_extract(text(note), GAP, 2).try_cast("date").alias("next"), usual.alias("typical"),
        F.when(usual > 0, F.greatest(F.lit(1), F.bround(days / usual).cast("int") - 1)).alias("missing"),
    )


def key_dates(key) -> Column:
    """B19. struct<start, end, decade> of a validity key; nulls if it isn't one."""
    m = lambda g: F.nullif(F.regexp_extract(text(key), r"^(\d{4}-\d{2}-\d{2})(?:_to_(\d{4}-\d{2}-\d{2}))?$", g), F.lit(""))
    return F.struct(m(1).try_cast("date").alias("start"), F.coalesce(m(2), m(1)).try_cast("date").alias("end"), F.concat(F.substring(m(1), 1, 3), F.lit("0s")).alias("decade"))


def prefix_length(root_offset, root_length, metadata_offset, metadata_length, leaf_offset, leaf_length, tile_offset, size, cap: int = 262_144) -> Column:
    """B20. Bytes to read from an archive's beginning: all before the tiles if that is within cap, else all before the leaves (without leaves: before the tiles).

    Null if the sections aren't header, root, metadata, leaves, tiles in this order and within the file. Without leaves (length 0) their offset doesn't matter.
    """
    root, root_n, meta, meta_n, leaf, leaf_n, tiles, size = map(col, (root_offset, root_length, metadata_offset, metadata_length, leaf_offset, leaf_length, tile_offset, size))
    leafless = leaf_n == 0
    ordered = (root >= HEADER_BYTES) & (root + root_n <= meta) & (meta + meta_n <= F.when(leafless, tiles).otherwise(leaf)) & (leafless | (leaf + leaf_n <= tiles)) & (tiles <= size)
    return F.when(ordered, F.when((tiles <= cap) | leafless, tiles).otherwise(leaf))


def header_bounds(w, s, e, n) -> Column:
    """B20. Bounds from 1e-7 degrees, rounded outward to 2 places; null if wrapped, empty, off the globe or beyond MOST_LATITUDE."""
    w, s, e, n = [col(c).cast("double") / 1e7 for c in (w, s, e, n)]
    ok = (w < e) & (s < n) & (w >= -180) & (e <= 180) & (s >= -MOST_LATITUDE) & (n <= MOST_LATITUDE)
    down, up = lambda x: F.floor(x * 100) / 100, lambda x: F.ceil(x * 100) / 100
    return F.when(ok, F.array(down(w), down(s), up(e), up(n)))


def plausible_archive(size, tile_offset, tile_length, tiles) -> Column:
    """B20."""
    return (col(size) >= 4096) & (col(tile_offset) + col(tile_length) <= col(size)) & (col(tiles) > 0)


def payload_kind(content) -> Column:
    """B21. pdf or zip by the first bytes, whatever the name says; else other."""
    head = F.hex(F.substring(col(content).cast("binary"), 1, 4))
    return F.when(head == "25504446", "pdf").when(head == "504B0304", "zip").otherwise("other")


def ident_like(t) -> Column:
    """B25."""
    t = col(t)
    return t.rlike("^[A-Z0-9]{2,4}$") & ~t.isin(IDENT_STOP) & (t.rlike(r"\d") | t.rlike("^[A-Z]{3,4}$"))


def title_idents(title) -> Column:
    """B25. Identifiers in a title's parentheses, in order."""
    inside = F.regexp_extract_all(text(title), F.lit(r"\(([^)]{1,40})\)"), 1)
    return F.array_distinct(F.filter(F.transform(F.flatten(F.transform(inside, lambda x: F.split(x, "[/,]"))), lambda x: F.trim(x)), ident_like))


def name_tokens(name) -> Column:
    """B26. Words of a name without parentheses (of 1 to 40 characters) and stop words."""
    words = F.split(F.regexp_replace(F.lower(F.regexp_replace(text(name), r"\([^)]{1,40}\)", " ")), "[^a-z0-9]+", " "), " ")
    return F.array_except(F.array_distinct(words), F.array(*[F.lit(w) for w in ["", *NAME_STOP]]))


def split_title(title, state) -> Column:
    """B26. struct<aliases, city>: a title without its last words `, ST` or ` ST.` (ST: the row's state, if it has one), parted at the last comma; what stands before
    parted at slashes, without names that have no words of their own."""
    cut = F.when(blank(state), text(title)).otherwise(F.regexp_replace(text(title), F.concat(F.lit(r"[,\s]+\Q"), text(state), F.lit(r"\E\.?\s*$")), F.lit("")))
    head = F.when(cut.contains(","), F.regexp_extract(cut, r"(?s)^(.*),([^,]*)$", 1)).otherwise(cut)
    return F.struct(F.filter(F.transform(F.split(head, "/"), lambda x: F.trim(x)), lambda x: F.size(name_tokens(x)) > 0).alias("aliases"), F.trim(F.regexp_extract(cut, r"(?s)^(.*),([^,]*)$", 2)).alias("city"))


def clean_title(title) -> Column:
    """B27. White space folded, marks at the ends cut, then a last `(revised m/y)` (parentheses may lack), then marks again."""
    marks = F.lit(" \t-–—_:;")
    folded = F.btrim(F.regexp_replace(F.coalesce(col(title), F.lit("")), r"\s+", " "), marks)
    return F.btrim(F.regexp_replace(folded, r"(?i)\(?\s*revised\s+[\d/]+\s*\)?\s*$", ""), marks)


def dms(c, degree_digits: int = 2) -> Column:
    """B23. Hemisphere letter, degrees, minutes, seconds and tenths in fixed width as degrees."""
    t, d = text(c), degree_digits
    part = lambda at, n: F.substring(t, at, n).try_cast("int")
    seconds = part(d + 4, 2) + F.coalesce(part(d + 6, 1), F.lit(0)) / 10
    value = part(2, d) + part(d + 2, 2) / 60 + seconds / 3600
    return F.when(t.rlike(rf"^[NSEW]\d{{{d + 4},}}$"), F.when(F.substring(t, 1, 1).isin("S", "W"), -value).otherwise(value))


def decimals(c) -> Column:
    """B24. Decimal places as stated, without trailing zeros."""
    return F.length(F.regexp_extract(text(c), r"\.(\d*?)0*$", 1))


def precision(lat, lon) -> Column:
    """B24."""
    return F.least(decimals(lat), decimals(lon))


def match_confidence(how) -> Column:
    """B29. How strong a claim of equality is by its method: 1 for location and date, 2 for a name in a cycle's folder or location and edition, 3 for a name."""
    return F.when(col(how).startswith(BY_DATE), 1).when(col(how).startswith(BY_CYCLE) | col(how).startswith(BY_EDITION), 2).otherwise(3)


def extension_rank(path) -> Column:
    """B30. tif before pdf, image, zip and others."""
    e = extension(path)
    return F.when(e.isin("tif", "tiff"), 0).when(e == "pdf", 1).when(e.isin("jpg", "jpeg", "png"), 2).when(e == "zip", 3).otherwise(4)


def open_range(header) -> Column:
    """B35. Whether a range is `bytes=a-`, without an end."""
    return F.coalesce(col(header), F.lit("")).rlike(r"^bytes=\d+-$")


def byte_range(header) -> Column:
    """B35. struct<first, last, size> of `bytes=a-b`; open or malformed ranges are null."""
    m = lambda g: F.nullif(F.regexp_extract(text(header), r"^bytes=(\d+)-(\d+)$", g), F.lit("")).cast("long")
    return F.when(m(1) <= m(2), F.struct(m(1).alias("first"), m(2).alias("last"), (m(2) - m(1) + 1).alias("size")))


def location_matches(location, wanted: str) -> Column:
    """B36. Substring, case-insensitive; an empty one matches all."""
    return F.lower(text(location)).contains(wanted.strip().lower())


def state_of(location) -> Column:
    """B36. The two letters after the last comma, else null."""
    return F.nullif(F.regexp_extract(text(location), r",\s*([A-Z]{2})$", 1), F.lit(""))


def row_issues(location, start, end) -> Column:
    """B37. array<string> of what is wrong with a catalogue row: its location is missing (nothing else is then looked at), a day that is given isn't one, or the end lies before the start."""
    d, e = parse_date(start), parse_date(end)
    dates = [F.when(~blank(start) & d.isNull(), "invalid date"), F.when(~blank(end) & e.isNull(), "invalid end_date"), F.when(e < d, "end_date before date")]
    return F.when(blank(location), F.array(F.lit("missing location"))).otherwise(F.array_compact(F.array(*dates)))


def end_missing(start, end) -> Column:
    """B37. Whether a row has a start day but no end day."""
    return parse_date(start).isNotNull() & parse_date(end).isNull()


def edition_or_unknown(edition) -> Column:
    """B37."""
    return F.coalesce(F.nullif(text(edition), F.lit("")), F.lit("Unknown"))


def distinct_in_order(values) -> Column:
    """D15. An array's values without repeats, in the order in which they first come."""
    return F.array_distinct(col(values))


def rescaled_8bit(pixels) -> Column:
    """B38. 16-bit values as 8-bit ones: 0..65535 onto 0..255."""
    return F.transform(col(pixels), lambda v: F.round(v * 255 / 65535).cast("int"))


def inverted_8bit(pixels) -> Column:
    """B38. A negative's 8-bit values: 255 less each."""
    return F.transform(col(pixels), lambda v: F.lit(255) - v)


def decimated(ring, most: int = 48) -> Column:
    """B39. Every n-th point of a closed ring (n so that about `most` stay), rounded to 3 places, closed again."""
    step = F.greatest(F.lit(1), F.floor(F.size(col(ring)) / most).cast("int"))
    kept = F.transform(F.filter(col(ring), lambda p, i: i % step == 0), lambda p: F.struct(F.bround(p["lon"], 3).alias("lon"), F.bround(p["lat"], 3).alias("lat")))
    return F.when(F.element_at(kept, 1) == F.element_at(kept, -1), kept).otherwise(F.concat(kept, F.slice(kept, 1, 1)))


def in_dates(start, first: str, last: str) -> Column:
    """B41. Start day between two days, given in either order; rows without a day go."""
    return parse_date(start).between(F.least(F.lit(first), F.lit(last)).cast("date"), F.greatest(F.lit(first), F.lit(last)).cast("date"))


def backlog() -> Column:
    """B42. array<string>: the backlogs that a catalogue row is on."""
    return F.array_compact(F.array(F.when(number("gcp1_px").isNull() & (parse_date("date") < F.lit("2011-01-01").cast("date")) & blank("src_crs"), "georeference"), F.when(cutline().isNull(), "cutline")))


def disposition(action) -> Column:
    """B44. struct<verb, location, start, end, edition> of a report's action text."""
    t = text(action)
    pattern = r"^ADD (.+?) (\d{4}-\d{2}-\d{2})->(\d{4}-\d{2}-\d{2})?(?: ed (\S+))?"
    m = lambda g: F.nullif(F.regexp_extract(t, pattern, g), F.lit(""))
    return F.struct(F.regexp_extract(t, r"^(ADD|SKIP[A-Z-]*|FIX)", 1).alias("verb"), m(1).alias("location"), m(2).try_cast("date").alias("start"), m(3).try_cast("date").alias("end"), m(4).alias("edition"))


def flattened_name(url) -> Column:
    """H8. A URL's path with slashes and spaces as underscores."""
    return F.translate(F.regexp_replace(text(url), r"^[a-z]+://[^/]*/?", ""), "/ ", "__")
