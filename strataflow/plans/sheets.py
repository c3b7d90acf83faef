"""Queries on matched points, images, rings and bundles, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataflow.functions import expr as X
from strataflow.functions import geo as G
from strataflow.operators import cells as C
from strataflow.operators import fits, rasters
from strataflow.operators import logs as L
from strataflow.operators import reconcile as R
from strataflow.plans.timeline import table
from strataflow.sources.writers import timeline_records


def _matches(spark, sf_dir):
    """Line items as matched points of their order's pair of sheets; returned ones are wrong by their quantity."""
    li = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber", "l_partkey").agg(*[F.min(c).alias(c) for c in ("l_suppkey", "l_returnflag", "l_quantity")])
    li = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_quantity", (F.col("l_partkey") % 977 * 7.0).alias("x"), (F.col("l_suppkey") * 50.0).alias("y"))
    off = F.when(F.col("l_returnflag") == "R", F.col("l_quantity") * 9).otherwise(F.col("l_linenumber") % 3 * 0.5)
    return li.select("l_orderkey", (F.col("l_partkey") * 8 + F.col("l_linenumber")).alias("k"), "x", "y", (F.col("x") * 1.02 + 40 + off).alias("u"), (F.col("y") * 1.02 - 25 - off).alias("v"))


def consensus_fits(spark, sf_dir):
    """The scale and shift that most of an order's matches agree on, refitted to these."""
    out = fits.similarity_consensus(_matches(spark, sf_dir), "l_orderkey")
    return out.select("l_orderkey", "status", "matches", "inliers", *[F.round(c, 4).alias(c) for c in ("scale", "tx", "ty", "max_residual")])


def affine_consensus_fits(spark, sf_dir):
    """D14, by threes: the same with an affine map."""
    out = fits.affine_consensus(_matches(spark, sf_dir), "l_orderkey")
    return out.select("l_orderkey", "status", "matches", "inliers", F.round("max_residual", 2).alias("max_residual"))


def _scans(spark, sf_dir):
    """Line items as pixels of their supplier's mosaic; returned ones are clear, and so are all of every tenth supplier; every third one is clipped."""
    s = F.col("l_suppkey")
    clip = F.when(s % 3 == 0, F.struct(F.lit(10).alias("x0"), F.lit(5).alias("y0"), F.lit(30).alias("x1"), F.lit(15).alias("y1")))
    return table(spark, sf_dir, "lineitem").select(
        s.alias("sheet"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("layer"), F.col("l_shipdate").alias("day"), (F.col("l_partkey") % 40).cast("int").alias("x"), (F.col("l_quantity").cast("int") % 20).alias("y"),
        F.col("l_extendedprice").alias("v"), F.when((F.col("l_returnflag") == "R") | (s % 10 == 7), 0).otherwise(255).alias("a"), clip.alias("clip"),
    )


def mosaic_pixels(spark, sf_dir):
    """Each supplier's pixels, the last opaque layer by shipping day on top."""
    return rasters.mosaic(_scans(spark, sf_dir), "sheet", ["day", "layer"], ["v", "layer"], "a", "clip")


def empty_mosaics(spark, sf_dir):
    """Suppliers that nothing is left of."""
    scans = _scans(spark, sf_dir)
    return rasters.empty_groups(scans, rasters.mosaic(scans, "sheet", ["day", "layer"], ["v"], "a", "clip"), "sheet")


def _grid(spark, sf_dir):
    """Suppliers' line items as sparse sheets of 16 by 20 pixels."""
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("sheet"), (F.col("l_quantity").cast("int") % 16).alias("y"), (F.col("l_partkey") % 20).cast("int").alias("x")).agg(F.sum("l_linenumber").alias("v"))


def warped_cells(spark, sf_dir):
    """Each supplier's sheet, turned, stretched and shifted onto a target grid; cells without a pixel are clear."""
    s = F.col("s_suppkey")
    fit = table(spark, sf_dir, "supplier").select(
        s.alias("sheet"), (1.5 + s % 3 * 0.25).alias("a"), (s % 5 * 0.25).alias("b"), F.lit(3.3).alias("c"), (s % 4 * -0.2).alias("d"), (1.25 + s % 2 * 0.5).alias("e"), F.lit(2.7).alias("f"), F.lit(20).alias("width"), F.lit(16).alias("height"),
    )
    return rasters.warp(_grid(spark, sf_dir), fit, "sheet")


def _images(spark, sf_dir):
    """(sheet, y, x, v): the sheets with zeros for pixels that lack."""
    all_ = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("sheet"), F.explode(F.sequence(F.lit(0), F.lit(15))).alias("y")).select("sheet", "y", F.explode(F.sequence(F.lit(0), F.lit(19))).alias("x"))
    return all_.join(_grid(spark, sf_dir), ["sheet", "y", "x"], "left").select("sheet", "y", "x", F.coalesce(F.col("v").cast("double"), F.lit(0.0)).alias("v"))


def correlation_best(spark, sf_dir):
    """Where in a supplier's sheet the corner of the sheet before it correlates best; odd suppliers are searched in a window only."""
    images = _images(spark, sf_dir)
    corner = images.where("y < 4 and x < 5").select((F.col("sheet") + 1).alias("template"), "y", "x", "v")
    s = F.col("s_suppkey")
    odd = lambda v: F.when(s % 2 == 1, v).cast("int")
    asked = table(spark, sf_dir, "supplier").select(s.alias("sheet"), s.alias("image"), s.alias("template"), odd(3).alias("x0"), odd(9).alias("x1"), odd(2).alias("y0"), odd(90).alias("y1"))
    out = rasters.correlation_peaks(asked, rasters.image_rows(images.withColumnRenamed("sheet", "image"), "image"), rasters.image_rows(corner, "template"), "sheet")
    return out.select("sheet", "x", "y", F.round("score", 6).alias("score"))


def similar_thumbs(spark, sf_dir):
    """Embeddings as thumbs of 8 by 8; each is held against three others, one of which may lack; those of label 0 are scored already."""
    e = table(spark, sf_dir, "embeddings")
    thumbs = e.select(F.col("vec_id").alias("path"), F.transform("embedding", lambda x: x.cast("double")).alias("vs"))
    k = F.col("vec_id")
    claims = e.select(k.alias("rid"), k.alias("cand"), F.array(k + 1, k * 7 % 401, k + 23).alias("alts"))
    out = rasters.pair_similarity(claims, thumbs, e.where("label = 0").select(k.alias("rid")), side=8)
    return out.select("rid", F.round("similarity", 6).alias("similarity"), "best_alt")


def ring_parts(spark, sf_dir):
    """A box for each customer, some across the antimeridian, as one or two rings."""
    k = F.col("c_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", (k * 37 % 3600 / 10.0 - 180).alias("w"), (k % 300 / 10.0 + 1).alias("wide"), (k % 120 - 60.0).alias("s"))
    e = F.col("w") + F.col("wide")
    c = c.withColumn("e", F.when(e >= 180, e - 360).otherwise(e))
    p = lambda lon, up: F.struct(F.col(lon).alias("lon"), (F.col("s") + up).alias("lat"))
    ring = F.array(p("w", 0.0), p("e", 0.0), p("e", 2.0), p("w", 2.0), p("w", 0.0))
    parts = c.select("c_custkey", F.posexplode(G.split_ring(ring)).alias("part", "r"))
    lons, lats = F.transform("r", lambda q: q["lon"]), F.transform("r", lambda q: q["lat"])
    return parts.select("c_custkey", "part", F.round(F.array_min(lons), 6).alias("west"), F.round(F.array_max(lons), 6).alias("east"), F.array_min(lats).alias("south"), F.array_max(lats).alias("north"), (F.get("r", F.lit(0)) == F.element_at("r", -1)).alias("closed"))


def envelope_reasons(spark, sf_dir):
    """Envelopes of suppliers' rings, whether they span the world, and why some can't meet the first one."""
    s = F.col("s_suppkey")
    p = lambda lon, lat: F.struct(lon.cast("double").alias("lon"), lat.cast("double").alias("lat"))
    w, n = s % 90 - 120, s % 40 - 20
    rings = table(spark, sf_dir, "supplier").select(s.alias("ref"), F.explode(F.array(F.array(p(w, n), p(w + s % 7, n + 3), p(w, n + 3)), F.array(p(w + 1, n - 2), p(w + 2, n + 1), p(w + 1, n + 1)))).alias("ring"))
    box = C.envelopes(rings)
    first = box.where("ref = 1").select(F.struct("west", "south", "east", "north").alias("a"))
    both = box.select("ref", "west", "south", "east", "north", F.struct("west", "south", "east", "north").alias("b")).join(F.broadcast(first))  # one row
    return both.select("ref", "west", "south", "east", "north", G.world_wide(F.col("west") * 111_320, F.col("east") * 111_320, 600_000.0).alias("wide"), G.disjoint_reason("b", "a").alias("reason"))


def sheet_words(spark, sf_dir):
    """Half and edition in a name once its place is cut out."""
    k = F.col("o_orderkey")
    place = F.when(k % 3 == 0, "Key West").when(k % 3 == 1, "North Platte").otherwise("Utah")
    name = F.concat(F.lit("d/"), F.lower(place), F.when(k % 2 == 0, ".").otherwise("+"), F.when(k % 4 == 0, "west").when(k % 4 == 1, "North, Key West").otherwise("x"), F.lit("="), (k % 2000).cast("string"), F.lit("("), (k % 70).cast("string"), F.lit(").tif"))
    out = table(spark, sf_dir, "orders").select("o_orderkey", X.half_and_edition(name, place).alias("h"))
    return out.select("o_orderkey", "h.half", "h.edition")


def tail_lookup(spark, sf_dir):
    """Names of parts as copies with their folders in them, or as archives, against files of suppliers in their own folders."""
    k, n = F.col("p_partkey"), (F.col("p_partkey") % 150).cast("string")
    name = F.when(k % 4 == 0, F.concat(F.lit("x_content_aeronav_sectional_files_Town_"), n, F.lit(".tif"))).when(k % 4 == 1, F.concat(F.lit("q/Sectional_Files/Town_"), n, F.lit(".TIF"))).when(k % 4 == 2, F.concat(F.lit("Pack_"), n, F.lit(".zip"))).otherwise(F.concat(F.lit("own_"), n, F.lit(".pdf")))
    s = F.col("s_suppkey").cast("string")
    paths = F.array(F.concat(F.lit("r/Town_"), s, F.lit(".tif")), F.concat(F.lit("r/Pack_"), s, F.lit("/inner.tif")), F.concat(F.lit("r/z_sectional_files_Town_"), s, F.lit("1.tif")), F.concat(F.lit("r/big_own_"), s, F.lit("_x.jpg")))
    files = table(spark, sf_dir, "supplier").select(F.explode(paths).alias("path"))
    return R.resolve_files(table(spark, sf_dir, "part").select("p_partkey", name.alias("name")), files, "p_partkey", "name").select("p_partkey", "path")


def _bundle(spark, sf_dir):
    """Line items as entries of a bundle with a group for each supplier, in the order of their numbers; the index comes from the order within the supplier."""
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", (((F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 1_000_000 + F.col("l_partkey")) * 1_000 + F.col("l_suppkey") % 1_000).alias("key"), (F.col("l_quantity") + 10).cast("long").alias("len"))
    li = li.groupBy("l_suppkey", "key").agg(F.sum("len").alias("len"))
    from pyspark.sql import Window

    w = Window.partitionBy("l_suppkey").orderBy("key")
    at = F.coalesce(F.sum("len").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return li.select("l_suppkey", "key", "len", (F.row_number().over(w) - 1).cast("long").alias("index"), (at + F.when(F.col("key") % 97 == 0, 1).otherwise(0)).alias("offset"))


def bundle_faults(spark, sf_dir):
    """Entries that don't follow on, whose source lacks, has another size, or begins its tiles too early."""
    e = _bundle(spark, sf_dir)
    k = F.col("key")
    source = e.where(k % 89 > 0).select("key", (F.col("len") + F.when(k % 83 == 0, 1).otherwise(0)).alias("len"), (F.col("len") - F.when(k % 79 == 0, 5).otherwise(0)).alias("tile_data_offset"))
    return L.verify_bundle(e, source, "l_suppkey", "key").select("l_suppkey", "key", "fault")


def group_faults(spark, sf_dir):
    """Groups whose offset, length or entries are wrong."""
    e = _bundle(spark, sf_dir).withColumn("offset", F.col("offset") - F.when(F.col("key") % 97 == 0, 1).otherwise(0))
    s = F.col("l_suppkey")
    groups = e.groupBy("l_suppkey").agg(F.sum("len").alias("len"), F.count("*").alias("i1")).select("l_suppkey", F.when(s % 7 == 0, 3).otherwise(0).cast("long").alias("off"), (F.col("len") + F.when(s % 11 == 0, 2).otherwise(0)).alias("len"), F.lit(0).cast("long").alias("i0"), F.when(s % 13 == 0, 0).otherwise(F.col("i1")).alias("i1"))
    return L.verify_groups(e, groups, "l_suppkey")


def timeline_payload(spark, sf_dir):
    """Orders as charts of their customer's location, with gaps in notes, holes in editions and uploaded keys."""
    k = F.col("o_orderkey")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    note = F.concat(F.when(k % 5 == 0, "latest-in-collection").otherwise("x"), F.when(k % 7 == 0, " BLANK_MAP").otherwise(""), F.when(k % 3 == 0, F.concat(F.lit("; GAP "), (k % 400).cast("string"), F.lit("d before next (1951-02-03)"), F.when(k % 2 == 0, "; typ30d").otherwise(""))).otherwise(""))
    rows = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("L"), F.col("o_custkey").cast("string")).alias("location"), day.alias("date"), F.when(k % 4 == 0, "").otherwise(F.date_format(F.date_add("o_orderdate", 9), "yyyy-MM-dd")).alias("end_date"),
        F.when(k % 9 == 0, "N/A").otherwise((k % 60).cast("string")).alias("edition"), note.alias("note"), k.alias("line"),
    )
    uploads = rows.where("line % 6 = 0").groupBy("location", F.col("date").alias("d"), F.nullif("end_date", F.lit("")).alias("e")).agg(F.sort_array(F.collect_set(F.concat(F.lit("k"), F.col("line").cast("string")))).alias("keys"))
    places = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.concat(F.lit("L"), F.col("c_custkey").cast("string")).alias("location"), F.lit("old").alias("era"), F.col("c_mktsegment").alias("ref"), F.lit(0.5).alias("modern_share"), F.lit("").alias("overlaps"))
    out = timeline_records(rows, places, uploads)
    said = F.transform("charts", lambda c: F.concat_ws(",", c["d"], F.coalesce(c["e"], F.lit("-")), c["ed"], c["f"], F.array_join(F.coalesce(c["pm"], F.array().cast("array<string>")), "+")))
    gaps = F.transform("gaps", lambda g: F.concat_ws(",", g["from"], g["to"], g["days"].cast("string"), F.coalesce(g["est"].cast("string"), F.lit("-"))))
    return out.select("location", "era", "ref", F.array_join(said, "|").alias("charts"), F.array_join(gaps, "|").alias("gaps"), F.array_join(F.transform("missing_eds", lambda n: n.cast("string")), "|").alias("missing"))


QUERIES = {f.__name__: f for f in (
    consensus_fits, affine_consensus_fits, mosaic_pixels, empty_mosaics, warped_cells, correlation_best, similar_thumbs, ring_parts, envelope_reasons, sheet_words, tail_lookup, bundle_faults, group_faults, timeline_payload,
)}

_M = """m AS (SELECT p, k, x, y, 1.02::DOUBLE * x + 40 + o AS u, 1.02::DOUBLE * y - 25 - o AS v FROM (SELECT l_orderkey AS p, l_partkey * 8 + l_linenumber AS k, l_partkey % 977 * 7.0::DOUBLE AS x, l_suppkey * 50.0::DOUBLE AS y,
  CASE WHEN l_returnflag = 'R' THEN l_quantity * 9 ELSE l_linenumber % 3 * 0.5::DOUBLE END AS o FROM (SELECT l_orderkey, l_linenumber, l_partkey, min(l_suppkey) AS l_suppkey, min(l_returnflag) AS l_returnflag, min(l_quantity) AS l_quantity FROM lineitem GROUP BY ALL)))"""
_SCANS = """s AS (SELECT l_suppkey AS sheet, l_orderkey * 8 + l_linenumber AS layer, l_shipdate AS day, CAST(l_partkey % 40 AS INTEGER) AS x, CAST(l_quantity AS INTEGER) % 20 AS y, l_extendedprice AS v, l_returnflag <> 'R' AND l_suppkey % 10 <> 7 AS opaque FROM lineitem),
t AS (SELECT * FROM s WHERE opaque AND (sheet % 3 <> 0 OR (x BETWEEN 10 AND 29 AND y BETWEEN 5 AND 14)))"""
_PX = "g AS (SELECT l_suppkey AS sheet, CAST(l_quantity AS INTEGER) % 16 AS y, CAST(l_partkey % 20 AS INTEGER) AS x, CAST(sum(l_linenumber) AS BIGINT) AS v FROM lineitem GROUP BY ALL)"
_ENTRIES = """b AS (SELECT l_suppkey, ((l_orderkey * 8 + l_linenumber) * 1000000 + l_partkey) * 1000 + l_suppkey % 1000 AS key, CAST(sum(CAST(l_quantity + 10 AS BIGINT)) AS BIGINT) AS len FROM lineitem GROUP BY ALL),
e AS (SELECT *, row_number() OVER w - 1 AS i, coalesce(sum(len) OVER (PARTITION BY l_suppkey ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place FROM b WINDOW w AS (PARTITION BY l_suppkey ORDER BY key))"""

ORACLE = {
    "consensus_fits": f"""WITH {_M}, d AS (SELECT a.p, a.k AS k1, b.k AS k2, sqrt(pow(b.u - a.u, 2) + pow(b.v - a.v, 2)) / sqrt(pow(b.x - a.x, 2) + pow(b.y - a.y, 2)) AS s, a.x, a.y, a.u, a.v FROM m a JOIN m b ON a.p = b.p AND a.k < b.k WHERE pow(b.x - a.x, 2) + pow(b.y - a.y, 2) >= 250000),
h AS (SELECT p, k1, k2, s, u - s * x AS tx, v - s * y AS ty FROM d WHERE s BETWEEN 0.93 AND 1.07),
votes AS (SELECT h.p, k1, k2, s, tx, ty, count(*) FILTER (sqrt(pow(m.u - s * m.x - tx, 2) + pow(m.v - s * m.y - ty, 2)) < 4) AS n FROM h JOIN m USING (p) GROUP BY h.p, k1, k2, s, tx, ty),
best AS (SELECT * FROM votes QUALIFY row_number() OVER (PARTITION BY p ORDER BY n DESC, k1, k2) = 1),
near AS (SELECT m.* FROM best JOIN m USING (p) WHERE sqrt(pow(m.u - s * m.x - tx, 2) + pow(m.v - s * m.y - ty, 2)) < 4),
c AS (SELECT p, avg(x) AS mx, avg(y) AS my, avg(u) AS mu, avg(v) AS mv, count(*) AS inliers FROM near GROUP BY p),
f AS (SELECT p, inliers, sum((u - mu) * (x - mx) + (v - mv) * (y - my)) / sum(pow(x - mx, 2) + pow(y - my, 2)) AS scale, any_value(mx) AS mx, any_value(my) AS my, any_value(mu) AS mu, any_value(mv) AS mv FROM near JOIN c USING (p) GROUP BY p, inliers),
r AS (SELECT p, max(sqrt(pow(u - mu - scale * (x - mx), 2) + pow(v - mv - scale * (y - my), 2))) AS max_residual FROM near JOIN f USING (p) GROUP BY p),
n AS (SELECT p, count(*) AS matches FROM m GROUP BY p), o AS (SELECT *, coalesce(inliers, 0) AS k, matches >= 4 AND inliers >= 4 AS ok FROM n LEFT JOIN f USING (p) LEFT JOIN r USING (p))
SELECT p AS l_orderkey, CASE WHEN matches < 4 THEN 'too few matches' WHEN k < 4 THEN 'no consensus' ELSE 'ok' END AS status, matches, k AS inliers, CASE WHEN ok THEN round(scale, 4) END AS scale, CASE WHEN ok THEN round(mu - scale * mx, 4) END AS tx, CASE WHEN ok THEN round(mv - scale * my, 4) END AS ty, CASE WHEN ok THEN round(max_residual, 4) END AS max_residual FROM o""",
    "affine_consensus_fits": f"""WITH {_M}, d AS (SELECT a.p, a.k AS k1, b.k AS k2, c.k AS k3, b.x - a.x AS x2, b.y - a.y AS y2, c.x - a.x AS x3, c.y - a.y AS y3, b.u - a.u AS u2, c.u - a.u AS u3, b.v - a.v AS v2, c.v - a.v AS v3, a.x, a.y, a.u, a.v
  FROM m a JOIN m b ON a.p = b.p AND a.k < b.k JOIN m c ON a.p = c.p AND b.k < c.k),
h AS (SELECT *, (u2 * y3 - u3 * y2) / (x2 * y3 - x3 * y2) AS ha, (u3 * x2 - u2 * x3) / (x2 * y3 - x3 * y2) AS hb, (v2 * y3 - v3 * y2) / (x2 * y3 - x3 * y2) AS hd, (v3 * x2 - v2 * x3) / (x2 * y3 - x3 * y2) AS he FROM d WHERE abs(x2 * y3 - x3 * y2) >= 100000),
votes AS (SELECT h.p, k1, k2, k3, ha, hb, hd, he, h.u - ha * h.x - hb * h.y AS hc, h.v - hd * h.x - he * h.y AS hf, count(*) FILTER (sqrt(pow(m.u - h.u - ha * (m.x - h.x) - hb * (m.y - h.y), 2) + pow(m.v - h.v - hd * (m.x - h.x) - he * (m.y - h.y), 2)) < 12) AS n
  FROM h JOIN m USING (p) GROUP BY h.p, k1, k2, k3, ha, hb, hd, he, hc, hf),
best AS (SELECT * FROM votes QUALIFY row_number() OVER (PARTITION BY p ORDER BY n DESC, k1, k2, k3) = 1),
near AS (SELECT m.* FROM best JOIN m USING (p) WHERE sqrt(pow(m.u - ha * m.x - hb * m.y - hc, 2) + pow(m.v - hd * m.x - he * m.y - hf, 2)) < 12),
c AS (SELECT p, count(*) AS inliers, avg(x) AS mx, avg(y) AS my, avg(u) AS mu, avg(v) AS mv, covar_pop(x, x) AS xx, covar_pop(x, y) AS xy, covar_pop(y, y) AS yy, covar_pop(x, u) AS xu, covar_pop(y, u) AS yu, covar_pop(x, v) AS xv, covar_pop(y, v) AS yv FROM near GROUP BY p),
f AS (SELECT *, (yy * xu - xy * yu) / (xx * yy - xy * xy) AS a, (xx * yu - xy * xu) / (xx * yy - xy * xy) AS b, (yy * xv - xy * yv) / (xx * yy - xy * xy) AS d, (xx * yv - xy * xv) / (xx * yy - xy * xy) AS e FROM c),
r AS (SELECT p, max(sqrt(pow(u - mu - a * (x - mx) - b * (y - my), 2) + pow(v - mv - d * (x - mx) - e * (y - my), 2))) AS worst FROM near JOIN f USING (p) GROUP BY p), n AS (SELECT p, count(*) AS matches FROM m GROUP BY p)
SELECT p AS l_orderkey, CASE WHEN matches < 4 THEN 'too few matches' WHEN coalesce(inliers, 0) < 4 THEN 'no consensus' ELSE 'ok' END AS status, matches, coalesce(inliers, 0) AS inliers, CASE WHEN matches >= 4 AND inliers >= 4 THEN round(worst, 2) END AS max_residual FROM n LEFT JOIN f USING (p) LEFT JOIN r USING (p)""",
    "mosaic_pixels": f"WITH {_SCANS} SELECT sheet, y, x, v, layer FROM t QUALIFY row_number() OVER (PARTITION BY sheet, y, x ORDER BY day DESC, layer DESC) = 1",
    "empty_mosaics": f"WITH {_SCANS} SELECT sheet, count(DISTINCT layer) AS layers FROM s WHERE sheet NOT IN (SELECT sheet FROM t) GROUP BY sheet",
    "warped_cells": f"""WITH {_PX}, f AS (SELECT s_suppkey AS sheet, 1.5::DOUBLE + s_suppkey % 3 * 0.25::DOUBLE AS a, s_suppkey % 5 * 0.25::DOUBLE AS b, s_suppkey % 4 * -0.2::DOUBLE AS d, 1.25::DOUBLE + s_suppkey % 2 * 0.5::DOUBLE AS e FROM supplier),
c AS (SELECT sheet, CAST(y AS INTEGER) AS y, CAST(x AS INTEGER) AS x, CAST(floor((e * (x + 0.5::DOUBLE - 3.3::DOUBLE) - b * (y + 0.5::DOUBLE - 2.7::DOUBLE)) / (a * e - b * d)) AS INTEGER) AS sx, CAST(floor((a * (y + 0.5::DOUBLE - 2.7::DOUBLE) - d * (x + 0.5::DOUBLE - 3.3::DOUBLE)) / (a * e - b * d)) AS INTEGER) AS sy FROM f, range(-40, 90) r(x), range(-40, 90) q(y))
SELECT c.sheet, c.y, c.x, v, CASE WHEN v IS NULL THEN 0 ELSE 255 END AS alpha FROM c LEFT JOIN g ON g.sheet = c.sheet AND g.y = sy AND g.x = sx WHERE sx BETWEEN 0 AND 19 AND sy BETWEEN 0 AND 15""",
    "correlation_best": f"""WITH {_PX}, i AS (SELECT s_suppkey AS sheet, CAST(a.y AS INTEGER) AS y, CAST(b.x AS INTEGER) AS x, coalesce(v, 0)::DOUBLE AS v FROM supplier CROSS JOIN range(16) a(y) CROSS JOIN range(20) b(x) LEFT JOIN g ON g.sheet = s_suppkey AND g.y = a.y AND g.x = b.x),
t AS (SELECT sheet + 1 AS sheet, y, x, v - avg(v) OVER (PARTITION BY sheet) AS t FROM i WHERE y < 4 AND x < 5), n AS (SELECT sheet, sqrt(sum(t * t)) AS norm FROM t GROUP BY sheet),
o AS (SELECT i.sheet, i.y - t.y AS oy, i.x - t.x AS ox, sum(i.v * t) AS p, sum(i.v) AS s, sum(i.v * i.v) AS q FROM i JOIN t USING (sheet) WHERE i.y - t.y BETWEEN 0 AND 12 AND i.x - t.x BETWEEN 0 AND 15 AND (sheet % 2 = 0 OR (i.x - t.x BETWEEN 3 AND 9 AND i.y - t.y >= 2)) GROUP BY ALL),
c AS (SELECT sheet, ox, oy, p / (sqrt(greatest(q - s * s / 20, 0.04::DOUBLE * norm * norm)) * norm) AS score FROM o JOIN n USING (sheet) WHERE norm >= 1e-6)
SELECT sheet, ox AS x, oy AS y, round(score, 6) AS score FROM c QUALIFY row_number() OVER (PARTITION BY sheet ORDER BY round(score, 12) DESC, oy, ox) = 1""",
    "similar_thumbs": """WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings), u AS (SELECT vec_id, list_transform(v, lambda x: x - list_avg(v)) AS v FROM e),
r AS (SELECT vec_id, unnest([v, list_transform(range(64), lambda i: v[(i % 8) * 8 + 8 - i // 8]), list_reverse(v), list_transform(range(64), lambda i: v[(7 - i % 8) * 8 + i // 8 + 1])]) AS v FROM u),
c AS (SELECT vec_id AS rid, unnest([vec_id + 1, vec_id * 7 % 401, vec_id + 23]) AS other, unnest([0, 1, 2]) AS alt FROM e WHERE label <> 0 OR label IS NULL),
s AS (SELECT rid, alt, max(list_inner_product(r.v, u.v) / sqrt(list_inner_product(r.v, r.v) * list_inner_product(u.v, u.v))) AS s FROM c JOIN r ON r.vec_id = rid JOIN u ON u.vec_id = other GROUP BY ALL),
b AS (SELECT rid, s, alt FROM s QUALIFY row_number() OVER (PARTITION BY rid ORDER BY round(s, 12) DESC, alt) = 1)
SELECT DISTINCT c.rid, coalesce(round(s, 6), -1.0) AS similarity, CAST(coalesce(b.alt, 0) AS INTEGER) AS best_alt FROM c LEFT JOIN b USING (rid)""",
    "ring_parts": """WITH c AS (SELECT c_custkey, c_custkey * 37 % 3600 / 10.0::DOUBLE - 180 AS w, c_custkey % 300 / 10.0::DOUBLE + 1 AS wide, c_custkey % 120 - 60.0::DOUBLE AS s FROM customer)
SELECT c_custkey, 0 AS part, round(w, 6) AS west, round(CASE WHEN w + wide > 180 THEN 180 WHEN w + wide = 180 THEN 180 ELSE w + wide END, 6) AS east, s AS south, s + 2 AS north, true AS closed FROM c
UNION ALL SELECT c_custkey, 1, -180.0, round(w + wide - 360, 6), s, s + 2, true FROM c WHERE w + wide > 180""",
    "envelope_reasons": """WITH e AS (SELECT s_suppkey AS ref, (s_suppkey % 90 - 120)::DOUBLE AS west, (s_suppkey % 40 - 22)::DOUBLE AS south, (s_suppkey % 90 - 120 + greatest(2, s_suppkey % 7))::DOUBLE AS east, (s_suppkey % 40 - 17)::DOUBLE AS north FROM supplier),
a AS (SELECT west AS w, south AS s, east AS x, north AS n FROM e WHERE ref = 1)
SELECT ref, west, south, east, north, (east - west) * 111320 >= 600000 AS wide, CASE WHEN east < w OR x < west OR north < s OR n < south THEN printf('bounds %.4f %.4f %.4f %.4f lie apart from %.4f %.4f %.4f %.4f', west, south, east, north, w, s, x, n) END AS reason FROM e, a""",
    "sheet_words": """SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'west' WHEN o_orderkey % 4 = 1 THEN 'north' END AS half, CAST(CASE WHEN o_orderkey % 2000 < 1000 THEN o_orderkey % 2000 ELSE o_orderkey % 70 END AS INTEGER) AS edition FROM orders""",
    "tail_lookup": """WITH p AS (SELECT p_partkey, p_partkey % 4 AS m, p_partkey % 150 AS n FROM part),
f AS (SELECT s_suppkey AS s, unnest(['r/Town_' || s_suppkey || '.tif', 'r/Pack_' || s_suppkey || '/inner.tif', 'r/z_sectional_files_Town_' || s_suppkey || '1.tif', 'r/big_own_' || s_suppkey || '_x.jpg']) AS path, unnest([0, 1, 2, 3]) AS kind FROM supplier),
k AS (SELECT p_partkey, path, CASE WHEN kind = 0 THEN 'town_' || s = 'town_' || n ELSE false END AS same FROM p JOIN f ON (m < 2 AND kind = 0 AND s = n) OR (m < 2 AND kind = 2 AND s || '1' = n::VARCHAR) OR (m = 2 AND kind = 1 AND s = n)),
b AS (SELECT p_partkey, path FROM (SELECT k.*, m, n FROM k JOIN p USING (p_partkey)) QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY (m = 1 AND same) DESC, (m < 2 AND contains(lower(path), CASE WHEN m = 0 THEN 'x_content_aeronav_sectional_files_town_' || n ELSE 'town_' || n END)) OR (m = 2 AND contains(lower(path), 'pack_' || n)) DESC, length(path), path) = 1),
o AS (SELECT p_partkey, path FROM p JOIN f ON (m = 3 AND kind = 3 AND contains(path, 'own_' || n)) OR (m = 1 AND contains(lower(path), 'town_' || n)) OR (m = 2 AND contains(lower(path), 'pack_' || n)) OR (m = 3 AND kind IN (0, 2) AND contains(lower(path), 'own_' || n)) WHERE p_partkey NOT IN (SELECT p_partkey FROM k)
  QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY CASE WHEN path LIKE '%.tif' THEN 0 ELSE 2 END, length(path), path) = 1)
SELECT p_partkey, coalesce(b.path, o.path) AS path FROM p LEFT JOIN b USING (p_partkey) LEFT JOIN o USING (p_partkey)""",
    "bundle_faults": f"""WITH {_ENTRIES}, o AS (SELECT *, place + CASE WHEN key % 97 = 0 THEN 1 ELSE 0 END AS off FROM e), l AS (SELECT *, lag(off + len) OVER (PARTITION BY l_suppkey ORDER BY off, key) AS done FROM o),
x AS (SELECT l_suppkey, key, CASE WHEN done <> off THEN 'offset' WHEN key % 89 = 0 THEN 'unknown' WHEN key % 83 = 0 THEN 'size' WHEN key % 79 = 0 THEN 'overrun' END AS fault FROM l) SELECT * FROM x WHERE fault IS NOT NULL""",
    "group_faults": "WITH s AS (SELECT DISTINCT l_suppkey FROM lineitem) SELECT l_suppkey, CASE WHEN l_suppkey % 13 = 0 THEN 'empty' WHEN l_suppkey % 7 = 0 THEN 'offset' WHEN l_suppkey % 11 = 0 THEN 'length' END AS fault FROM s WHERE l_suppkey % 13 = 0 OR l_suppkey % 7 = 0 OR l_suppkey % 11 = 0",
    "timeline_payload": """WITH o AS (SELECT 'L' || o_custkey AS location, o_orderkey AS k, strftime(o_orderdate, '%Y-%m-%d') AS d, CASE WHEN o_orderkey % 4 > 0 THEN strftime(o_orderdate + INTERVAL 9 DAYS, '%Y-%m-%d') END AS e, CASE WHEN o_orderkey % 9 = 0 THEN 'N/A' ELSE (o_orderkey % 60)::VARCHAR END AS ed FROM orders),
u AS (SELECT location, d, e, string_agg('k' || k, '+' ORDER BY 'k' || k) AS pm FROM (SELECT DISTINCT location, d, e, k FROM o WHERE k % 6 = 0) GROUP BY ALL),
c AS (SELECT o.*, pm, CASE WHEN k % 5 = 0 THEN 'L' ELSE '' END || CASE WHEN k % 7 = 0 THEN 'B' ELSE '' END AS f FROM o LEFT JOIN u ON u.location = o.location AND u.d = o.d AND u.e IS NOT DISTINCT FROM o.e),
n AS (SELECT location, d, k, ed::INTEGER AS n, lag(ed::INTEGER) OVER (PARTITION BY location ORDER BY d, k) AS before FROM o WHERE ed <> 'N/A'),
m AS (SELECT location, string_agg(x::VARCHAR, '|' ORDER BY x) AS missing FROM (SELECT DISTINCT location, unnest(range(before + 1, n)) AS x FROM n WHERE n - before BETWEEN 2 AND 39) GROUP BY location),
l AS (SELECT location, string_agg(d || ',' || coalesce(e, '-') || ',' || ed || ',' || f || ',' || coalesce(pm, ''), '|' ORDER BY d, k) AS charts,
  coalesce(string_agg(coalesce(e, d) || ',1951-02-03,' || (k % 400) || ',' || CASE WHEN k % 2 = 0 THEN greatest(1, round_even(k % 400 / 30.0::DOUBLE, 0)::INTEGER - 1)::VARCHAR ELSE '-' END, '|' ORDER BY d, k) FILTER (k % 3 = 0), '') AS gaps FROM c GROUP BY location)
SELECT location, CASE WHEN c_acctbal > 0 THEN 'old' END AS era, CASE WHEN c_acctbal > 0 THEN c_mktsegment END AS ref, charts, gaps, coalesce(missing, '') AS missing FROM l LEFT JOIN m USING (location) JOIN customer ON location = 'L' || c_custkey""",
}
