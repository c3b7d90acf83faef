"""Readers: catalogue and donor files, HTML trees, logs, inventories, archive headers, polygons."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataflow.functions import expr as X
from strataflow.sources.byte_ranges import file_heads

# The catalogue's columns in file order; the last two may be absent.
CATALOGUE = [
    "filename", "download_link", "location", "date", "end_date", "edition", "note",
    "gcp1_px", "gcp1_py", "gcp1_lat", "gcp1_lon", "gcp2_px", "gcp2_py", "gcp2_lat", "gcp2_lon",
    "gcp3_px", "gcp3_py", "gcp3_lat", "gcp3_lon", "gcp4_px", "gcp4_py", "gcp4_lat", "gcp4_lon",
    "cutline", "cutline_wkt", "lcc_lat1", "lcc_lat2", "lcc_lat0", "lcc_lon0", "rotation", "src_crs",
]
OPTIONAL = ["rotation", "src_crs"]


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV of texts: byte order mark, quoted line feeds and doubled quotes are understood."""
    df = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', inferSchema=False, encoding="UTF-8")
    return df.toDF(*[c.removeprefix("\ufeff") for c in df.columns])


def numbered(rows: DataFrame, name: str, first: int = 0) -> DataFrame:
    """rows with their number in file order: a place inside a part of the input, and the number of rows in the parts before, of which the driver sees one count each."""
    placed = rows.withColumn("_at", F.monotonically_increasing_id())  # the part in the upper bits, the place in the lower 33
    counts = placed.groupBy(F.expr("shiftright(_at, 33)").alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()
    before, starts = first, {}
    for c in counts:
        starts[c["part"]] = before
        before += c["n"]
    known = rows.sparkSession.createDataFrame(list(starts.items()), "_part long, _start long")
    out = placed.withColumn("_part", F.expr("shiftright(_at, 33)")).join(F.broadcast(known), "_part")
    return out.withColumn(name, F.expr("_start + (_at & 8589934591)")).drop("_at", "_part", "_start")


def catalogue(spark: SparkSession, path: str) -> DataFrame:
    """A1. The catalogue with blanks as '' and `line` (2 for the first data row). A missing column is an error."""
    df = read_csv(spark, path)
    missing = [c for c in CATALOGUE if c not in df.columns and c not in OPTIONAL]
    if missing:
        raise ValueError(f"the catalogue lacks {', '.join(missing)}")
    rows = df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c) for c in CATALOGUE])
    return numbered(rows, "line", 2)


def fixed_width_airports(spark: SparkSession, path: str) -> DataFrame:
    """A2. Airports of 132-byte lines; short lines and those without coordinates go."""
    at = lambda a, b: F.trim(F.substring("value", a + 1, b - a))
    rows = spark.read.text(path, lineSep="\r\n").where(F.length("value") >= 132)
    rows = rows.select(at(0, 11).alias("site"), at(11, 16).alias("ident"), at(16, 81).alias("name"), at(81, 107).alias("city"), at(107, 109).alias("state"), X.dms(at(115, 123)).alias("lat"), X.dms(at(123, 132), 3).alias("lon"), ~F.substring("value", 11, 1).isin("B", "H").alias("name_ok"))
    return rows.where("lat is not null and lon is not null")


# The types of airport that are read, and those whose names are compared.
NAMED_TYPES = ["closed", "small_airport", "medium_airport", "large_airport", "seaplane_base"]
AIRPORT_TYPES = [*NAMED_TYPES, "heliport", "balloonport"]


def csv_airports(spark: SparkSession, path: str) -> DataFrame:
    """A3. (id, idents, names, state, lat, lon, name_ok) of the airports of the US and Puerto Rico with three decimals or more.

    Codes, and keywords that look like codes, are idents in upper case; other keywords are further names. Puerto Rico's state is PR, whatever its region.
    """
    rows = read_csv(spark, path).where(F.col("iso_country").isin("US", "PR") & F.col("type").isin(AIRPORT_TYPES))
    rows = rows.where(~X.blank("latitude_deg") & ~X.blank("longitude_deg") & (X.precision("latitude_deg", "longitude_deg") >= 3))
    words = F.filter(F.transform(F.split(F.coalesce("keywords", F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")
    codes = F.filter(F.array(*[F.upper(X.text(c)) for c in ("ident", "icao_code", "iata_code", "gps_code", "local_code")]), X.ident_like)
    like = lambda w: X.ident_like(F.upper(w))
    return rows.select(
        F.col("ident").alias("id"), F.array_distinct(F.concat(codes, F.transform(F.filter(words, like), F.upper))).alias("idents"), F.concat(F.array("name"), F.filter(words, lambda w: ~like(w))).alias("names"),
        F.when(F.col("iso_country") == "PR", "PR").otherwise(F.regexp_replace("iso_region", "^[^-]*-", "")).alias("state"), X.number("latitude_deg").alias("lat"), X.number("longitude_deg").alias("lon"),
        F.col("type").isin(NAMED_TYPES).alias("name_ok"),
    )


def html_tree(spark: SparkSession, root: str) -> DataFrame:
    """A4. (path, html) of all .htm and .html below root; index.html goes where index.htm stands beside it; odd bytes are replaced."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{htm,html,HTM,HTML}").load(root)
    dirs = files.select(F.regexp_extract("path", r"^(.*)/", 1).alias("dir"), F.lower(X.basename("path")).alias("base"), "path", "content")
    twice = dirs.where("base = 'index.htm'").select("dir", F.lit("index.html").alias("base")).distinct()
    return dirs.join(twice, ["dir", "base"], "left_anti").select("path", F.make_valid_utf8(F.col("content").cast("string")).alias("html"))


def jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A5. Lines of JSON objects in file order (`seq`); blank and malformed lines go."""
    rows = numbered(spark.read.text(path), "seq")
    parsed = F.from_json("value", f"{schema}, _bad string", {"columnNameOfCorruptRecord": "_bad", "mode": "PERMISSIVE"})
    return rows.where(F.trim("value") != "").select(parsed.alias("r"), "seq").where("r is not null and r._bad is null").select("r.*", "seq").drop("_bad")


def timeline_json(spark: SparkSession, path: str) -> DataFrame:
    """A6. (location, ref, start, end, edition) of a nested timeline file: a row for each chart."""
    flat = _timeline(spark, path).select(F.explode("locations").alias("location", "l")).select("location", "l.ref", F.explode("l.charts").alias("c"))
    return flat.select("location", "ref", F.col("c.d").alias("start"), F.col("c.e").alias("end"), F.col("c.ed").alias("edition"))


def timeline_rings(spark: SparkSession, path: str) -> DataFrame:
    """A6. (ref, ring array<struct<lon, lat>>) of a nested timeline file."""
    rings = _timeline(spark, path).select(F.explode("rings").alias("ref", "r"))
    return rings.select("ref", F.transform("r", lambda p: F.struct(p[0].alias("lon"), p[1].alias("lat"))).alias("ring"))


def _timeline(spark: SparkSession, path: str) -> DataFrame:
    schema = "locations MAP<STRING, STRUCT<ref: STRING, charts: ARRAY<STRUCT<d: DATE, e: DATE, ed: STRING>>>>, rings MAP<STRING, ARRAY<ARRAY<DOUBLE>>>"
    return spark.read.text(path, wholetext=True).select(F.from_json("value", schema).alias("r")).select("r.*")


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """A7. Files below root: path, name parts and size. Contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", F.col("length").alias("size"))
    return files.select("path", X.basename("path").alias("base"), X.stem("path").alias("stem"), F.lower(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)).alias("parent"), X.extension("path").alias("ext"), "size", (F.size(F.split("path", "/")) - 1).alias("depth"))


def archive_headers(spark: SparkSession, root: str, glob: str = "*.pmtiles", files: DataFrame | None = None) -> DataFrame:
    """A8. The 127-byte header of each archive as columns (little-endian, by position); other files give nulls. Only these bytes of a file are read, whatever its size.

    files: `file_heads` of some other choice of files, for instance filtered by path.
    """
    files = file_heads(spark, root, glob) if files is None else files
    head = F.hex("head")
    swapped = lambda at, n: F.conv(F.concat(*[F.substring(head, 2 * (at + n - 1 - i) + 1, 2) for i in range(n)]), 16, 10).cast("decimal(20,0)")
    long = lambda at: swapped(at, 8).cast("long")
    signed = lambda at: F.when(swapped(at, 4) >= 2**31, swapped(at, 4) - 2**32).otherwise(swapped(at, 4)).cast("long")
    ok = (F.substring(head, 1, 14) == F.lit("504D54696C6573")) & (F.length(head) == 254)
    names = ["root_offset", "root_length", "metadata_offset", "metadata_length", "leaf_offset", "leaf_length", "tile_offset", "tile_length", "tiles"]
    fields = [F.when(ok, long(8 + 8 * i)).alias(n) for i, n in enumerate(names)] + [F.when(ok, signed(102 + 4 * i)).alias(n) for i, n in enumerate(["min_lon", "min_lat", "max_lon", "max_lat"])]
    return files.select(X.stem("path").alias("key"), F.col("size"), *fields)


def wkt_rings(df: DataFrame, ref: str = "ref", wkt: str = "wkt") -> DataFrame:
    """A9. (ref, ring_no, ring array<struct<lon, lat>>) of the outer rings of POLYGON and MULTIPOLYGON texts; holes are left out. Anything else is an error when it is read."""
    t = X.text(wkt)
    ok = t.rlike(r"(?i)^(MULTI)?POLYGON\s*\(")
    rings = F.regexp_extract_all(F.when(ok, t).otherwise(F.raise_error(F.concat(F.lit("not a polygon: "), t))), F.lit(r"\(\s*\(([^()]+)\)"), 1)
    point = lambda p: F.struct(F.split(F.trim(p), r"\s+")[0].cast("double").alias("lon"), F.split(F.trim(p), r"\s+")[1].cast("double").alias("lat"))
    return df.select(ref, F.posexplode(rings).alias("ring_no", "r")).select(ref, "ring_no", F.transform(F.split("r", ","), point).alias("ring"))


def geojson_rings(df: DataFrame, ref: str = "ref", text: str = "geojson") -> DataFrame:
    """A9. (ref, ring_no, ring array<struct<lon, lat>>) of the outer rings of a text's features, a feature or a bare geometry, of type Polygon or MultiPolygon; holes are left out. A text of another type is an error
    when it is read; null has no rings. Rings of one ref, from several rows too, are united where they become cells (cells.ring_cells)."""
    geometry = "struct<type: string, coordinates: string>"
    parsed = F.from_json(F.col(text), f"struct<type: string, coordinates: string, geometry: {geometry}, features: array<struct<geometry: {geometry}>>>")
    own = F.array(F.struct(F.col("_g.type").alias("type"), F.col("_g.coordinates").alias("coordinates")))
    every = F.when(F.col("_g.type") == "FeatureCollection", F.transform("_g.features", lambda f: f["geometry"])).when(F.col("_g.type") == "Feature", F.array(F.col("_g.geometry"))).otherwise(own)
    one = lambda c: F.array(F.get(F.from_json(c, "array<array<array<double>>>"), F.lit(0)))
    many = lambda c: F.transform(F.from_json(c, "array<array<array<array<double>>>>"), lambda p: p[0])
    other = lambda t: F.raise_error(F.concat(F.lit("not a polygon: "), F.coalesce(t, F.lit("null")))).cast("array<array<array<double>>>")
    rows = df.where(F.col(text).isNotNull()).select(ref, parsed.alias("_g")).select(ref, F.posexplode(every).alias("_k", "_s"))
    kind = F.col("_s.type")
    rings = F.when(kind == "Polygon", one(F.col("_s.coordinates"))).when(kind == "MultiPolygon", many(F.col("_s.coordinates"))).otherwise(other(kind))
    rows = rows.select(ref, "_k", F.posexplode(rings).alias("_i", "_r"))
    point = lambda p: F.struct(p[0].alias("lon"), p[1].alias("lat"))
    return rows.select(ref, (F.row_number().over(Window.partitionBy(ref).orderBy("_k", "_i")) - 1).alias("ring_no"), F.transform("_r", point).alias("ring"))
