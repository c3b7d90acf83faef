"""Reconciliation, resolution and text queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataflow.functions import expr as X
from strataflow.functions import geo as G
from strataflow.operators import cells as C
from strataflow.operators import pages as P
from strataflow.operators import reconcile as R
from strataflow.operators import resolve as E
from strataflow.plans.timeline import table


def import_plan(spark, sf_dir):
    plan = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.when(F.col("c_acctbal") > 0, "yes").otherwise("no").alias("import"), F.col("c_name").alias("name"))
    have = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("key"), F.lit("").alias("name"))
    return R.import_rows(plan, have, "key")


def key_diff(spark, sf_dir):
    return R.key_diff(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key")), table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key")), "key")


def publish_plan(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), "o_orderstatus")
    items = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("key")).agg(F.count("*").alias("size"), F.count_if(F.col("l_linestatus") == "F").alias("f"))
    return R.publish_plan(orders, items.where("f > 0").select("key", "size"), items.where("size % 2 = 0").select("key", F.col("f").alias("size")), items.where("size > 3").select("key"))


def missing_inputs(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.col("o_orderkey").cast("string"), F.lit(".tif")).alias("name"), "o_orderpriority", "o_orderdate")
    files = table(spark, sf_dir, "lineitem").select("l_orderkey").distinct().select(F.concat(F.lit("scans/"), F.col("l_orderkey").cast("string"), F.lit(".tif")).alias("path"))
    files = files.select("path", X.basename("path").alias("base"), X.stem("path").alias("stem"), F.lit("scans").alias("parent"), X.extension("path").alias("ext"))
    return R.missing_inputs(orders, files, "o_orderkey", "name", "o_orderpriority", "o_orderdate").select("o_orderkey", "name")


def pending_work(spark, sf_dir):
    days = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day"))
    done = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.to_date("l_shipdate").alias("day"))
    return R.pending(days, done, "day")


def decision_upsert(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("rid"), F.col("event_id").alias("seq"), F.when(F.col("event_type") == "error", "").otherwise(F.col("event_type")).alias("decision"))
    return R.upsert_decisions(e.where("seq % 2 = 0"), e.where("seq % 2 = 1"), "rid", "seq", ["click", "view", "purchase"])


def best_capture(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    caps = e.select(F.concat(F.lit("u"), "user_id").alias("url"), F.col("event_id").alias("ts"), F.lit(20).cast("double").alias("declared_length"), (F.col("value") * 1).alias("captured_length"))
    return R.best_captures(caps).select("url", "ts", "captured_length")


def insert_outcomes(spark, sf_dir):
    """Every order as a new row; the least of a customer's two most urgent priorities, where it has one, is the state."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"), F.col("o_orderpriority").alias("source"), F.col("o_orderkey").alias("line"))
    state = o.where("source = '1-URGENT' or source = '2-HIGH'").groupBy("key").agg(F.min("source").alias("source"))
    return R.insert_if_absent(o, state, "key", "source", "line").select("key", "line", "outcome")


def insert_outcomes_all(spark, sf_dir):
    """insert_outcomes over all orders: finished ones are the state, all others are new."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"), F.col("o_orderpriority").alias("source"), F.col("o_orderkey").alias("line"), (F.col("o_orderstatus") == "F").alias("old"))
    state = o.where("old").groupBy("key").agg(F.min("source").alias("source"))
    return R.insert_if_absent(o.where("not old").drop("old"), state, "key", "source", "line").select("key", "line", "outcome")


def work_list(spark, sf_dir):
    items = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("rid"))
    dec = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("rid")).agg(F.min("o_orderstatus").alias("decision"))
    sim = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("rid")).agg((F.count("*") / F.lit(100.0)).alias("similarity"))
    return R.work_list(items, dec, sim, "rid")


def update_first_row(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("filename"), F.col("o_orderkey").alias("line"), F.col("o_orderpriority").alias("edition"), F.lit("").alias("note"))
    results = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("filename"), F.when(F.col("c_acctbal") > 0, "ok").otherwise("bad").alias("status"), F.col("c_mktsegment").alias("edition"), F.lit("patched").alias("note"))
    return R.update_first(rows, results, "filename", "line", ["edition"])


def replace_expand(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderkey").alias("line"), F.col("o_orderpriority").alias("title"))
    li = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").alias("part")).agg(F.min("l_linestatus").alias("title"))
    return R.replace_and_expand(rows, li, "o_orderkey", "line", ["title"]).select("o_orderkey", "part", "title")


def completeness_grid(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.to_date("ts").alias("day"), "event_type", "event_id", F.when(F.col("value") > 10, "done").otherwise("partial").alias("status"))
    return R.completeness_grid(e, "day", "event_type", "status", "event_id")


def file_resolution(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", F.regexp_replace(F.col("url"), r"[?#].*$", "").alias("name"))
    files = pages.select(F.concat(F.lit("mirror/"), F.regexp_replace("name", "^https?://", "")).alias("path")).distinct()
    return R.lookup_two_step(pages, files, "name").select("page_id", "path")


def key_resolution(spark, sf_dir):
    """All pages against the files of those that are read over https."""
    pages = table(spark, sf_dir, "pages").select("page_id", F.regexp_replace(F.col("url"), r"[?#].*$|/$", "").alias("name"))
    files = pages.where(F.col("name").startswith("https:")).select(F.concat(F.lit("m/"), X.basename("name"), F.lit(".tif")).alias("path")).distinct()
    return R.resolve_files(pages, files, "page_id", "name").select("page_id", "path")


def key_resolution_all(spark, sf_dir):
    """key_resolution with the files of all pages."""
    pages = table(spark, sf_dir, "pages").select("page_id", F.regexp_replace(F.col("url"), r"[?#].*$|/$", "").alias("name"))
    files = pages.select(F.concat(F.lit("m/"), X.basename("name"), F.lit(".tif")).alias("path")).distinct()
    return R.resolve_files(pages, files, "page_id", "name").select("page_id", "path")


def backlog_filter(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    none = F.lit(None).cast("string")
    rows = o.select("o_orderkey", none.alias("gcp1_px"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.when(F.col("o_orderstatus") == "P", "EPSG:3857").alias("src_crs"), none.alias("cutline_wkt"), F.when(F.col("o_orderstatus") == "F", "a").alias("cutline"))
    return rows.select("o_orderkey", F.explode(X.backlog()).alias("backlog")).groupBy("backlog").agg(F.count("*").alias("n"))


def catalogue_columns(spark, sf_dir):
    """B13, B16, B17, B5, B12 and B19 on orders as charts."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("d"), F.when(F.col("o_orderstatus") == "F", F.date_format(F.date_add(F.to_date("o_orderdate"), 28), "yyyy-MM-dd")).alias("e"),
        F.concat(F.lit("Area "), F.regexp_replace("o_orderpriority", "^[0-9]-", "")).alias("loc"), F.concat(F.lit("sheet_"), F.col("o_orderkey").cast("string"), F.when(F.col("o_orderkey") % 2 == 0, "_North").otherwise("")).alias("stem_"), ((F.col("o_orderkey") % 5) * 90).cast("string").alias("turn"),
    ).withColumn("file", F.concat("stem_", F.lit(".tif")))
    key = X.validity_key("d", "e")
    return o.select("o_orderkey", key.alias("validity"), X.chart_key("loc", "d", "file").alias("chart"), X.rotation("turn").alias("rotation"), X.half("file").alias("half"), X.key_dates(key)["end"].alias("until"), X.key_dates(key)["decade"].alias("decade"))


def link_set(spark, sf_dir):
    """H7 on all pages, whose links are given the ending of a page and capitals."""
    linked = table(spark, sf_dir, "pages").select("page_id", F.regexp_replace("html", 'href="([^".]*)[^"]*"', 'HREF="$1.HTML"').alias("html"))
    return P.link_set(linked, "page_id").select("link").distinct()


def payload_kinds(spark, sf_dir):
    """B21 on pages, some of which stand behind the first bytes of another format, by what their addresses hold."""
    head = F.when(F.col("url").contains("1"), "%PDF-1.4 ").when(F.col("url").contains("2"), "PK\x03\x04").when(F.col("url").contains("3"), "II*\x00").otherwise("")
    return table(spark, sf_dir, "pages").select(F.col("url").contains("https").alias("secure"), X.payload_kind(F.concat(head, F.coalesce("html", F.lit("")))).alias("kind")).groupBy("secure", "kind").agg(F.count("*").alias("n"))


def points(spark, sf_dir):
    """Customers as places: position and precision from the key."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("row_id"), F.col("c_nationkey").cast("string").alias("state"), (F.lit(30.0) + (F.col("c_custkey") * 7919 % 1000) / 500.0).alias("lat"), (F.lit(-100.0) + (F.col("c_custkey") * 104729 % 1000) / 500.0).alias("lon"),
        (F.col("c_custkey") % 3).cast("int").alias("precision"), F.array(F.concat(F.lit("K"), (F.col("c_custkey") % 50).cast("string"))).alias("idents"),
    )


def donor_points(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("donor_id"), (F.col("p_partkey") % 25).cast("string").alias("state"), (F.lit(30.0) + (F.col("p_partkey") * 6571 % 1000) / 500.0).alias("lat"), (F.lit(-100.0) + (F.col("p_partkey") * 15485 % 1000) / 500.0).alias("lon"),
        F.array(F.concat(F.lit("K"), (F.col("p_partkey") % 50).cast("string"))).alias("idents"),
    )


def ident_match(spark, sf_dir):
    rows = points(spark, sf_dir)
    found = E.match_idents(rows, donor_points(spark, sf_dir)).select("row_id", F.col("donor_id").alias("match_id"), F.col("km").alias("match_km"), F.lit("parts").alias("match_donor"), F.lit("ident").alias("match_via"))
    claims = E.unique_claims(rows.join(found, "row_id").withColumn("own_lat", F.col("lat")).withColumn("own_lon", F.col("lon")))
    return claims.select("row_id", F.col("match_id").alias("donor_id"), F.round("match_km", 3).alias("km"), "reverted")


_HAVERSINE = "2 * 6371.0 * asin(least(1.0, sqrt(pow(sin((radians(d.lat) - radians(r.lat)) / 2), 2) + cos(radians(r.lat)) * cos(radians(d.lat)) * pow(sin((radians(d.lon) - radians(r.lon)) / 2), 2))))"


def mercator_bounds(spark, sf_dir):
    m = points(spark, sf_dir).select("row_id", G.mercator("lon", "lat").alias("m"))
    return m.select("row_id", F.round("m.x", 2).alias("x"), F.round("m.y", 2).alias("y"))


def antimeridian_windows(spark, sf_dir):
    b = table(spark, sf_dir, "customer").select("c_custkey", (-(F.col("c_custkey") * 7 % 180)).cast("double").alias("west"), (F.col("c_custkey") * 11 % 180).cast("double").alias("east"))
    return b.select("c_custkey", F.explode(G.windows("west", "east")).alias("w")).select("c_custkey", "w.west", "w.east")


def ring_cells(spark, sf_dir):
    """J1 on a box for each supplier, whose corners lie between cell centres."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", (F.lit(-120.0) + F.col("s_suppkey") % 50).alias("w"), (F.lit(26.0) + F.col("s_suppkey") % 20).alias("s"))
    p = lambda dx, dy: F.struct((F.col("w") + dx).alias("lon"), (F.col("s") + dy).alias("lat"))
    rings = s.select(F.col("s_suppkey").alias("ref"), F.array(p(0.0, 0.0), p(1.0, 0.0), p(1.0, 0.5), p(0.0, 0.5), p(0.0, 0.0)).alias("ring"))
    return C.ring_cells(rings).groupBy("ref").agg(F.count("*").alias("cells"), F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))


QUERIES = {f.__name__: f for f in (
    import_plan, key_diff, publish_plan, missing_inputs, pending_work, decision_upsert, best_capture, insert_outcomes, insert_outcomes_all, work_list, update_first_row, replace_expand, completeness_grid, file_resolution,
    key_resolution, key_resolution_all, backlog_filter, catalogue_columns, link_set, payload_kinds, ident_match, mercator_bounds, antimeridian_windows, ring_cells,
)}

_POINTS = "r AS (SELECT c_custkey AS row_id, c_nationkey AS state, 30.0::DOUBLE + (c_custkey * 7919 % 1000) / 500.0::DOUBLE AS lat, -100.0::DOUBLE + (c_custkey * 104729 % 1000) / 500.0::DOUBLE AS lon, c_custkey % 3 AS precision, c_custkey % 50 AS ident FROM customer)"
ORACLE = {
    "import_plan": "SELECT c_custkey AS key, c_name AS name FROM customer WHERE c_acctbal > 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')",
    "key_diff": "SELECT coalesce(a.key, b.key) AS key, CASE WHEN b.key IS NULL THEN 'new' ELSE 'stale' END AS side FROM (SELECT DISTINCT o_orderkey AS key FROM orders) a FULL JOIN (SELECT DISTINCT l_orderkey AS key FROM lineitem) b ON a.key = b.key WHERE a.key IS NULL OR b.key IS NULL",
    "publish_plan": """WITH i AS (SELECT l_orderkey AS key, count(*) AS size, count(*) FILTER (l_linestatus = 'F') AS f FROM lineitem GROUP BY 1)
SELECT o_orderkey AS key, CASE WHEN l.size IS NULL THEN 'missing_local' WHEN l.size = r.f THEN CASE WHEN u.key IS NULL THEN 'preexisting' ELSE 'in_sync' END ELSE 'to_upload' END AS status
FROM orders LEFT JOIN (SELECT * FROM i WHERE f > 0) l ON l.key = o_orderkey LEFT JOIN (SELECT * FROM i WHERE size % 2 = 0) r ON r.key = o_orderkey LEFT JOIN (SELECT key FROM i WHERE size > 3) u ON u.key = o_orderkey""",
    "missing_inputs": "SELECT o_orderkey, o_orderkey || '.tif' AS name FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
    "pending_work": "SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders WHERE CAST(o_orderdate AS DATE) NOT IN (SELECT CAST(l_shipdate AS DATE) FROM lineitem WHERE l_returnflag = 'R')",
    "decision_upsert": "SELECT rid, seq, decision FROM (SELECT user_id AS rid, event_id AS seq, CASE WHEN event_type = 'error' THEN '' ELSE event_type END AS decision, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS k FROM events WHERE event_type IN ('error', 'click', 'view', 'purchase')) WHERE k = 1 AND decision <> ''",
    "best_capture": "SELECT url, ts, captured_length FROM (SELECT 'u' || user_id AS url, event_id AS ts, value AS captured_length, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id DESC) AS k FROM events WHERE NOT (value < 20)) WHERE k = 1",
    "insert_outcomes": """WITH s AS (SELECT o_custkey AS key, min(o_orderpriority) AS old FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY 1)
SELECT o_custkey AS key, o_orderkey AS line, CASE WHEN row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) > 1 THEN 'repeated' WHEN old IS NULL THEN 'inserted' WHEN old = o_orderpriority THEN 'kept' ELSE 'conflict' END AS outcome
FROM orders LEFT JOIN s ON s.key = o_custkey""",
    "insert_outcomes_all": """WITH s AS (SELECT o_custkey AS key, min(o_orderpriority) AS old FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT o_custkey AS key, o_orderkey AS line, CASE WHEN row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) > 1 THEN 'repeated' WHEN old IS NULL THEN 'inserted' WHEN old = o_orderpriority THEN 'kept' ELSE 'conflict' END AS outcome
FROM orders LEFT JOIN s ON s.key = o_custkey WHERE o_orderstatus <> 'F'""",
    "work_list": "SELECT c_custkey AS rid, coalesce(d, '') AS decision, coalesce(s, -1.0) AS similarity FROM customer LEFT JOIN (SELECT o_custkey, min(o_orderstatus) AS d, CASE WHEN count(*) FILTER (o_orderstatus = 'F') > 0 THEN count(*) FILTER (o_orderstatus = 'F') / 100.0::DOUBLE END AS s FROM orders GROUP BY 1) ON o_custkey = c_custkey",
    "update_first_row": "SELECT CAST(o_custkey AS VARCHAR) AS filename, o_orderkey AS line, CASE WHEN k = 1 AND c_acctbal > 0 THEN c_mktsegment ELSE o_orderpriority END AS edition, CASE WHEN k = 1 AND c_acctbal > 0 THEN 'patched' ELSE '' END AS note FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k FROM orders) LEFT JOIN customer ON c_custkey = o_custkey",
    "replace_expand": "SELECT o_orderkey, coalesce(part, 0) AS part, coalesce(title, o_orderpriority) AS title FROM orders LEFT JOIN (SELECT l_orderkey, l_linenumber AS part, min(l_linestatus) AS title FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL) ON l_orderkey = o_orderkey",
    "completeness_grid": "WITH l AS (SELECT CAST(ts AS DATE) AS day, event_type, arg_max(CASE WHEN value > 10 THEN 'done' ELSE 'partial' END, event_id) AS status FROM events GROUP BY ALL) SELECT d.day, t.event_type, coalesce(status, 'missing') AS status FROM (SELECT DISTINCT day FROM l) d CROSS JOIN (SELECT DISTINCT event_type FROM l) t LEFT JOIN l ON l.day = d.day AND l.event_type = t.event_type",
    "file_resolution": r"""WITH p AS (SELECT page_id, regexp_replace(url, '[?#].*$', '') AS name FROM pages), f AS (SELECT DISTINCT 'mirror/' || regexp_replace(name, '^https?://', '') AS path FROM p),
b AS (SELECT regexp_extract(path, '([^/]*)$', 1) AS k, min(path) AS path FROM f GROUP BY 1)
SELECT page_id, path FROM p LEFT JOIN b ON regexp_extract(name, '([^/]*)$', 1) = k""",
    "key_resolution": r"""WITH p AS (SELECT page_id, regexp_replace(url, '[?#].*$|/$', '') AS name FROM pages), q AS (SELECT page_id, lower(regexp_replace(regexp_extract(name, '([^/]*)$', 1), '\.html$', '')) AS stem, regexp_extract(name, '([^/]*)$', 1) AS base, name FROM p),
f AS (SELECT DISTINCT 'm/' || base || '.tif' AS path, lower(base) AS fstem FROM q WHERE name LIKE 'https:%'),
c AS (SELECT page_id, path, row_number() OVER (PARTITION BY page_id ORDER BY (stem = fstem) DESC, contains(lower(path), stem) DESC, length(path), path) AS k FROM q JOIN f ON stem = fstem OR lower(base) = fstem),
o AS (SELECT page_id, path, row_number() OVER (PARTITION BY page_id ORDER BY length(path), path) AS k FROM q JOIN f ON stem <> '' AND contains(lower(path), stem) WHERE page_id NOT IN (SELECT page_id FROM c))
SELECT p.page_id, coalesce(c.path, o.path) AS path FROM p LEFT JOIN c ON c.page_id = p.page_id AND c.k = 1 LEFT JOIN o ON o.page_id = p.page_id AND o.k = 1""",
    "key_resolution_all": r"""WITH p AS (SELECT page_id, regexp_replace(url, '[?#].*$|/$', '') AS name FROM pages), q AS (SELECT page_id, lower(regexp_replace(regexp_extract(name, '([^/]*)$', 1), '\.html$', '')) AS stem, regexp_extract(name, '([^/]*)$', 1) AS base FROM p),
f AS (SELECT DISTINCT 'm/' || base || '.tif' AS path, lower(base) AS fstem FROM q),
c AS (SELECT page_id, path, row_number() OVER (PARTITION BY page_id ORDER BY (stem = fstem) DESC, contains(lower(path), stem) DESC, length(path), path) AS k FROM q JOIN f ON stem = fstem OR lower(base) = fstem),
o AS (SELECT page_id, path, row_number() OVER (PARTITION BY page_id ORDER BY length(path), path) AS k FROM q JOIN f ON stem <> '' AND contains(lower(path), stem) WHERE page_id NOT IN (SELECT page_id FROM c))
SELECT p.page_id, coalesce(c.path, o.path) AS path FROM p LEFT JOIN c ON c.page_id = p.page_id AND c.k = 1 LEFT JOIN o ON o.page_id = p.page_id AND o.k = 1""",
    "backlog_filter": "SELECT 'cutline' AS backlog, count(*) AS n FROM orders WHERE o_orderstatus <> 'F' UNION ALL SELECT 'georeference', count(*) FROM orders WHERE o_orderstatus <> 'P' AND o_orderdate < TIMESTAMP '2011-01-01'",
    "catalogue_columns": r"""WITH o AS (SELECT *, strftime(o_orderdate, '%Y-%m-%d') AS d, CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate + INTERVAL 28 DAYS, '%Y-%m-%d') END AS e,
'area_' || replace(replace(lower(regexp_replace(o_orderpriority, '^[0-9]-', '')), ' ', '_'), '-', '_') AS slug, CASE WHEN o_orderkey % 2 = 0 THEN 'north' END AS half FROM orders)
SELECT o_orderkey, CASE WHEN e IS NULL THEN d ELSE d || '_to_' || e END AS validity, 'chart/' || slug || '/' || d || coalesce('-' || half, '') AS chart, CASE WHEN (o_orderkey % 5) * 90 IN (90, 180, 270) THEN CAST((o_orderkey % 5) * 90 AS INTEGER) ELSE 0 END AS rotation, half, CAST(coalesce(e, d) AS DATE) AS until, substring(d, 1, 3) || '0s' AS decade FROM o""",
    "link_set": r"""SELECT DISTINCT lower(regexp_extract(h, '([^/]*)$', 1)) || '.html' AS link FROM (SELECT unnest(regexp_extract_all(coalesce(html, ''), 'href="([^".]*)[^"]*"', 1)) AS h FROM pages) WHERE h <> '' AND h NOT LIKE '%#%'""",
    "payload_kinds": r"""SELECT contains(url, 'https') AS secure, CASE WHEN contains(url, '1') THEN 'pdf' WHEN contains(url, '2') THEN 'zip' ELSE 'other' END AS kind, count(*) AS n FROM pages GROUP BY ALL""",
    "ident_match": f"""WITH {_POINTS}, d AS (SELECT p_partkey AS donor_id, p_partkey % 25 AS state, 30.0::DOUBLE + (p_partkey * 6571 % 1000) / 500.0::DOUBLE AS lat, -100.0::DOUBLE + (p_partkey * 15485 % 1000) / 500.0::DOUBLE AS lon, p_partkey % 50 AS ident FROM part),
m AS (SELECT row_id, donor_id, precision, {_HAVERSINE} AS km FROM r JOIN d ON r.ident = d.ident AND r.state = d.state),
b AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY km, donor_id) AS k FROM m WHERE km <= CASE precision WHEN 0 THEN 60 WHEN 1 THEN 25 ELSE 12 END)
SELECT row_id, donor_id, round(km, 3) AS km, row_number() OVER (PARTITION BY donor_id ORDER BY round(km, 2), row_id) > 1 AS reverted FROM b WHERE k = 1""",
    "mercator_bounds": f"WITH {_POINTS} SELECT row_id, round(radians(lon) * 6378137.0, 2) AS x, round(ln(tan(pi() / 4 + radians(lat) / 2)) * 6378137.0, 2) AS y FROM r",
    "antimeridian_windows": "WITH b AS (SELECT c_custkey, CAST(-(c_custkey * 7 % 180) AS DOUBLE) AS west, CAST(c_custkey * 11 % 180 AS DOUBLE) AS east FROM customer) SELECT c_custkey, west, east FROM b WHERE east - west <= 180 UNION ALL SELECT c_custkey, -180.0, west FROM b WHERE east - west > 180 UNION ALL SELECT c_custkey, east, 180.0 FROM b WHERE east - west > 180",
    "ring_cells": """WITH s AS (SELECT s_suppkey AS ref, -120.0::DOUBLE + s_suppkey % 50 AS w, 26.0::DOUBLE + s_suppkey % 20 AS s FROM supplier), g AS (SELECT ref, x, y FROM s, range(585) a(x), range(250) b(y) WHERE -125 + (x + 0.5::DOUBLE) * 0.1::DOUBLE > w AND -125 + (x + 0.5::DOUBLE) * 0.1::DOUBLE < w + 1 AND 24.5 + (y + 0.5::DOUBLE) * 0.1::DOUBLE > s AND 24.5 + (y + 0.5::DOUBLE) * 0.1::DOUBLE < s + 0.5)
SELECT ref, count(*) AS cells, CAST(min(x) AS INTEGER) AS x0, CAST(max(x) AS INTEGER) AS x1, CAST(min(y) AS INTEGER) AS y0, CAST(max(y) AS INTEGER) AS y1 FROM g GROUP BY ref""",
}
