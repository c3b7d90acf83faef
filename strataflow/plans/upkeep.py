"""Queries on the upkeep of a catalogue and on dated words in running text, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataflow.functions import expr as X
from strataflow.operators import pages as P
from strataflow.operators import reconcile as R
from strataflow.operators import resolve as E
from strataflow.plans.timeline import spread, table


def uploaded_keys(spark, sf_dir):
    """Line items are entries of a day's location, orders with an urgent priority are uploaded."""
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key"), F.col("l_suppkey").alias("location"), F.to_date("l_shipdate").alias("d"), F.col("l_returnflag").alias("e"))
    up = table(spark, sf_dir, "orders").where("o_orderpriority < '3'").select(F.col("o_orderkey").alias("key"))
    out = R.uploaded_keys(li, up)
    return out.select("location", "d", "e", "key", F.array_join(F.transform("keys", lambda k: k.cast("string")), "|").alias("keys"))


def disk_audit(spark, sf_dir):
    """C11: line items as files by flag, orders as rows; which lack the other."""
    files = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("key"), "l_returnflag")
    rows = table(spark, sf_dir, "part").where("p_size < 40").select(F.col("p_partkey").alias("key")).unionByName(table(spark, sf_dir, "customer").select((F.col("c_custkey") + 1_000_000).alias("key")))
    return R.disk_audit(files, rows, "key", F.concat(F.lit("flag "), "l_returnflag"))


def variant_shapes(spark, sf_dir):
    """A shape for each order's location and half, if there is one, else for the location."""
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("New. Town "), (k % 30).cast("string")).alias("place"), F.concat(F.lit("a/Sheet"), F.when(k % 3 == 0, "_North").when(k % 3 == 1, "-south").otherwise(""), F.lit(".tif")).alias("file"))
    n = F.col("n_nationkey")
    shapes = table(spark, sf_dir, "nation").select(F.concat(F.lit("new_town_"), n.cast("string"), F.when(n % 2 == 0, "_north").otherwise("")).alias("key"), F.col("n_name").alias("shape"))
    return R.variant_lookup(rows, shapes, "place", "file").select("o_orderkey", "shape")


def segment_texts(spark, sf_dir):
    """Line items as entries, with the last of the texts that their order and line number have."""
    entries = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("page"), F.col("o_orderpriority").alias("name"), "o_orderkey")
    segments = table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'").select(F.col("o_custkey").alias("page"), F.col("o_orderpriority").alias("name"), F.concat(F.lit("text "), F.col("o_orderkey").cast("string")).alias("text"), F.col("o_orderkey").alias("line"))
    return E.with_segment(entries, segments).select("o_orderkey", "segment")


def year_collisions(spark, sf_dir):
    """Orders of pending state whose customer has a finished one of the same year."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("location"), F.to_date("o_orderdate").alias("start"), "o_orderstatus")
    out = R.same_location_year(o.where("o_orderstatus <> 'F'").drop("o_orderstatus"), o.where("o_orderstatus = 'F'").select("location", "start"))
    return out.select("o_orderkey", "collides")


def largest_siblings(spark, sf_dir):
    """Of each supplier's line items the one of the earliest year, then the largest, then by key."""
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", F.year("l_shipdate").alias("cycle"), (F.col("l_quantity") * F.col("l_linenumber")).alias("area"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("key"))
    return R.largest_sibling(li, "l_suppkey", "cycle", F.col("area"), "key").select("l_suppkey", "cycle", "area", "key")


def fresh_findings(spark, sf_dir):
    """Pages, some as captures or in flat folders, none of whose keys a page before them has."""
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    known = p.where("page_id % 3 = 0").select(F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("http://web/web/20200102030405id_/"), "url")).otherwise(F.col("url")).alias("url"))
    found = p.select("page_id", F.when(F.col("page_id") % 5 == 0, F.concat(F.lit("http://web/web/20210102030405/"), "url")).otherwise(F.col("url")).alias("url"))
    return R.new_findings(found, known).select("page_id")


def row_roles(spark, sf_dir):
    """The role that was decided for a location and year, and an order's ship modes' flags as they first come."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 40).alias("place"), F.year("o_orderdate").alias("y"))
    decided = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("place"), (F.lit(1992) + F.col("n_nationkey") % 7).cast("int").alias("y"), F.when(F.col("n_regionkey") == 1, "inset").otherwise("index").alias("role"))
    flags = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_returnflag"))).alias("l")).select(F.col("l_orderkey").alias("o_orderkey"), F.array_join(X.distinct_in_order(F.transform("l", lambda x: x["l_returnflag"])), "").alias("flags"))
    return R.with_decision(o, decided, ["place", "y"]).join(flags, "o_orderkey", "left").select("o_orderkey", "role", "flags")


# what the words of documents are turned into, one after the other, in `text_evidence`
_TURNED = [(" the ", " no longer shown "), (" of ", " 1957 "), (" and ", " not yet  shown "), (" to ", " 1938 "), (" in ", " still\nlisted "), (" is ", " 3/44 chart "), (" de ", " 1971 "), (" la ", " no longer listed "), (" que ", " 12/5/26 "), (" der ", " still open "), (" die ", " 1950 "), (" le ", " not yet depicted ")]


def text_evidence(spark, sf_dir):
    """D5 on whole documents, whose commonest words are turned into dated ones: the years nearest to what is said to be there not yet, no longer or still."""
    text = F.coalesce(F.col("text"), F.lit(""))
    for a, b in _TURNED:
        text = F.replace(text, F.lit(a), F.lit(b))
    rows = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id").select("doc_id", text.alias("text"), F.array(F.lit("none")).alias("words"))
    return P.with_evidence(rows, "text", "words").select("doc_id", "found.notyet", "found.nolonger", "found.lastseen")


QUERIES = {f.__name__: f for f in (uploaded_keys, disk_audit, variant_shapes, segment_texts, year_collisions, largest_siblings, fresh_findings, row_roles, text_evidence)}


def _turned(c: str) -> str:
    for a, b in _TURNED:
        c = f"replace({c}, '{a}', '{b}')"
    return c


def _places(pattern: str) -> str:
    """SQL for the list of (begin, end, what is said) of a pattern in t."""
    return f"list_transform(range(1, len(regexp_extract_all(t, '{pattern}')) + 1), lambda i: {{'e': list_sum(list_transform(string_split_regex(t, '{pattern}')[1:i], lambda x: length(x))) + list_sum(list_transform(regexp_extract_all(t, '{pattern}')[1:i], lambda x: length(x))), 's': regexp_extract_all(t, '{pattern}')[i]}})"


def _nearest(kind: str, words: str, back: int, ahead: int, pick: str) -> str:
    return f"""{kind} AS (SELECT doc_id, {pick}(year) AS {kind} FROM (SELECT k.doc_id, k.at, arg_min(year, (abs(y.pos - k.at), year)) AS year FROM (SELECT doc_id, CAST(unnest(p).e AS BIGINT) AS at FROM (SELECT doc_id, {_places(words)} AS p FROM t)) k
  JOIN y ON y.doc_id = k.doc_id AND y.pos >= k.at - {back} AND y.pos < k.at + {ahead} GROUP BY ALL) GROUP BY doc_id)"""


ORACLE = {
    "uploaded_keys": """WITH m AS (SELECT DISTINCT l_suppkey AS location, CAST(l_shipdate AS DATE) AS d, l_returnflag AS e, l_orderkey AS key FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority < '3'))
SELECT location, d, e, CASE WHEN count(*) = 1 THEN min(key) END AS key, CASE WHEN count(*) > 1 THEN string_agg(key::VARCHAR, '|' ORDER BY key) END AS keys FROM m GROUP BY ALL""",
    "disk_audit": """WITH r AS (SELECT p_partkey AS key FROM part WHERE p_size < 40 UNION ALL SELECT c_custkey + 1000000 FROM customer)
SELECT 'file' AS side, 'flag ' || l_returnflag AS bucket, count(*) AS n FROM lineitem WHERE l_partkey NOT IN (SELECT key FROM r) GROUP BY ALL UNION ALL SELECT 'row', 'missing', count(*) FROM r WHERE key NOT IN (SELECT l_partkey FROM lineitem) HAVING count(*) > 0""",
    "variant_shapes": """SELECT o_orderkey, coalesce(a.n_name, b.n_name) AS shape FROM orders LEFT JOIN nation a ON o_orderkey % 3 = 0 AND a.n_nationkey % 2 = 0 AND a.n_nationkey = o_orderkey % 30 LEFT JOIN nation b ON b.n_nationkey % 2 = 1 AND b.n_nationkey = o_orderkey % 30""",
    "segment_texts": "WITH s AS (SELECT o_custkey, o_orderpriority, 'text ' || max(o_orderkey) AS segment FROM orders WHERE o_orderstatus <> 'P' GROUP BY ALL) SELECT o_orderkey, segment FROM orders LEFT JOIN s USING (o_custkey, o_orderpriority)",
    "year_collisions": "SELECT o_orderkey, EXISTS (SELECT 1 FROM orders f WHERE f.o_orderstatus = 'F' AND f.o_custkey = o.o_custkey AND year(f.o_orderdate) = year(o.o_orderdate)) AS collides FROM orders o WHERE o_orderstatus <> 'F'",
    "largest_siblings": "SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS cycle, l_quantity * l_linenumber AS area, l_orderkey * 8 + l_linenumber AS key FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY year(l_shipdate), l_quantity * l_linenumber DESC, l_orderkey * 8 + l_linenumber) = 1",
    "fresh_findings": r"""WITH k AS (SELECT DISTINCT url, lower(replace(regexp_extract(url, '([^/]*)$', 1), ' ', '_')) AS base FROM pages WHERE page_id % 3 = 0 AND url IS NOT NULL)
SELECT page_id FROM pages p WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.url = p.url OR (k.base <> '' AND k.base = lower(replace(regexp_extract(p.url, '([^/]*)$', 1), ' ', '_'))))""",
    "row_roles": """WITH f AS (SELECT l_orderkey, string_agg(l_returnflag, '' ORDER BY k) AS flags FROM (SELECT l_orderkey, l_returnflag, min((l_linenumber, l_partkey, l_returnflag)) AS k FROM lineitem GROUP BY ALL) GROUP BY l_orderkey)
SELECT o_orderkey, coalesce(CASE WHEN n_nationkey IS NULL THEN NULL WHEN n_regionkey = 1 THEN 'inset' ELSE 'index' END, 'chart') AS role, flags FROM orders LEFT JOIN nation ON n_nationkey = o_custkey % 40 AND 1992 + n_nationkey % 7 = year(o_orderdate) LEFT JOIN f ON l_orderkey = o_orderkey""",
    "text_evidence": rf"""WITH t AS (SELECT doc_id, regexp_replace({_turned("coalesce(text, '')")}, '\s+', ' ', 'g') AS t FROM documents),
y AS (SELECT doc_id, CAST(p.e - length(p.s) AS BIGINT) AS pos, CASE WHEN length(p.s) = 4 AND p.s NOT LIKE '%/%' THEN p.s::INTEGER ELSE CASE WHEN right(p.s, 2)::INTEGER <= 26 THEN 2000 ELSE 1900 END + right(p.s, 2)::INTEGER END AS year FROM (
  SELECT doc_id, unnest({_places(chr(92) + "b(?:19[0-9][0-9]|20[0-2][0-9])" + chr(92) + "b")}) AS p FROM t UNION ALL SELECT doc_id, unnest({_places(chr(92) + "b[0-9]{1,2}/[0-9]{1,2}/[0-9][0-9]" + chr(92) + "b")}) FROM t
  UNION ALL SELECT doc_id, {{'e': p.e - 6, 's': p.s[1:4]}} FROM (SELECT doc_id, unnest({_places("3/44 chart")}) AS p FROM t))),
{_nearest("notyet", "not yet (?:shown|depicted)", 40, 120, "max")}, {_nearest("nolonger", "no longer (?:shown|listed)", 50, 120, "min")}, {_nearest("lastseen", "still (?:listed|open)", 60, 80, "max")}
SELECT doc_id, notyet, nolonger, lastseen FROM documents LEFT JOIN notyet USING (doc_id) LEFT JOIN nolonger USING (doc_id) LEFT JOIN lastseen USING (doc_id)""",
}
