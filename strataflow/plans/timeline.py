"""Timelines, sequences and states over the order, line item and event tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.operators import cells as C
from strataflow.operators import intervals as I
from strataflow.operators import logs as L
from strataflow.operators import reconcile as R
from strataflow.operators import resolve as E
from strataflow.sources.tables import kept


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame, *by: str) -> DataFrame:
    """rows dealt out to as many tasks as a shuffle has, for work that costs far more than reading: a narrow table is one row group, so one task, up to a million rows."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def intervals(spark, sf_dir):
    """Line items are valid from the order to the shipping day; the supplier is the extent."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("start"))
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", F.to_date("l_shipdate").alias("end"), F.col("l_suppkey").alias("ref"))
    return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select("start", "end", "ref")


_INTERVALS = 'iv AS (SELECT CAST(o_orderdate AS DATE) AS "start", CAST(l_shipdate AS DATE) AS "end", l_suppkey AS ref FROM lineitem JOIN orders ON l_orderkey = o_orderkey)'
_SWEEP = """ev AS (SELECT "start" AS d, CASE WHEN "start" < "end" THEN 1 ELSE 0 END AS v FROM iv UNION ALL SELECT "end", CASE WHEN "start" < "end" THEN -1 ELSE 0 END FROM iv),
days AS (SELECT d, sum(v) AS v FROM ev GROUP BY d),
seg AS (SELECT d AS "start", lead(d) OVER (ORDER BY d) AS "end", CAST(sum(v) OVER (ORDER BY d) AS BIGINT) AS n FROM days)"""


def supplier_cells(spark, sf_dir):
    """Twelve cells for each supplier, side by side on a ring of 997 cells."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("ref"))
    return s.select("ref", F.explode(F.sequence(F.lit(0), F.lit(11))).alias("i")).select("ref", ((F.col("ref") * 37 + F.col("i")) % 997).alias("cell"))


_CELLS = "sc AS (SELECT s_suppkey AS ref, (s_suppkey * 37 + i) % 997 AS cell FROM supplier, range(12) t(i))"


def timeline_segments(spark, sf_dir):
    return I.merged_runs(I.active_counts(intervals(spark, sf_dir)), "n")


def segment_bounds(spark, sf_dir):
    return I.segments(intervals(spark, sf_dir))


def coverage_permille(spark, sf_dir):
    return I.coverage(intervals(spark, sf_dir), supplier_cells(spark, sf_dir))


def overlap_best(spark, sf_dir):
    """Seventy cells for each supplier and twenty for each part, along a line that grows with the tables."""
    old = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("old"), F.explode(F.sequence(F.lit(0), F.lit(69))).alias("i")).select("old", (F.col("old") * 212 + F.col("i")).alias("cell"))
    modern = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("modern"), F.explode(F.sequence(F.lit(0), F.lit(19))).alias("i")).select("modern", (F.col("modern") * 53 + F.col("i")).alias("cell"))
    return C.overlaps(old, modern)


def majority_value(spark, sf_dir):
    return I.majority(table(spark, sf_dir, "orders"), "o_custkey", "o_orderpriority", "o_orderkey")


def sequence_holes(spark, sf_dir):
    return I.sequence_holes(table(spark, sf_dir, "orders"), "o_custkey", "o_orderkey", "o_orderdate", "o_orderkey", below=1_000_000_000, most=400)


def event_gaps(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", F.to_date("ts").alias("day"), F.lit(None).cast("date").alias("until"))
    return I.gaps(e, "user_id", "day", "until", "event_id").select("event_id", "user_id", "next_start", "gap_days")


def order_positions(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")).alias("ended"))
    return I.numbered(o, "o_custkey", "o_orderdate", "ended", "o_orderkey").select("o_orderkey", "position", "start_only")


def line_siblings(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return I.siblings(li, "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "k", "n", "sibling_note")


def latest_state(spark, sf_dir):
    return R.latest(table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value"), ["user_id", "event_type"], "event_id")


def first_state(spark, sf_dir):
    return R.latest(table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value"), ["user_id", "event_type"], "event_id", first=True)


def ranked_winner(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", F.substring("o_orderpriority", 1, 1).cast("int").alias("rank"), "o_orderkey", (F.col("o_orderstatus") == "F").alias("usable"), (F.col("o_orderstatus") == "P").alias("stops"))
    return R.winners(o, "o_custkey", "rank", "o_orderkey", "usable")


def ranked_winner_stops(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", F.substring("o_orderpriority", 1, 1).cast("int").alias("rank"), "o_orderkey", (F.col("o_orderstatus") == "F").alias("usable"), (F.col("o_orderstatus") == "P").alias("stops"))
    return R.winners(o, "o_custkey", "rank", "o_orderkey", "usable", "stops")


def _winner_sql(stops: bool) -> str:
    keep = "WHERE coalesce(ended, 0) = 0" if stops else ""
    return f"""WITH c AS (SELECT o_custkey, o_orderkey, CAST(substring(o_orderpriority, 1, 1) AS INTEGER) AS rank, o_orderstatus FROM orders),
t AS (SELECT *, row_number() OVER w AS k, max(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey ORDER BY rank, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ended FROM c WINDOW w AS (PARTITION BY o_custkey ORDER BY rank, o_orderkey)),
u AS (SELECT * FROM t {keep}),
g AS (SELECT o_custkey, min(k) FILTER (o_orderstatus = 'F') AS win, count(*) AS n FROM u GROUP BY o_custkey)
SELECT g.o_custkey, u.o_orderkey AS winner, coalesce(win, n) AS attempts, CASE WHEN win IS NULL THEN 'exhausted' ELSE 'winner' END AS outcome
FROM g LEFT JOIN u ON u.o_custkey = g.o_custkey AND u.k = g.win"""


def running_offsets(spark, sf_dir):
    return L.running_offsets(table(spark, sf_dir, "documents").select("lang", "doc_id", "n_chars"), "lang", ["doc_id"], "n_chars", kept)


def group_index(spark, sf_dir):
    return L.group_index(table(spark, sf_dir, "documents").select("lang", "n_chars"), "lang", "n_chars")


def weighted_topk(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    last = e.agg(F.max("ts").alias("last"))
    recent = e.crossJoin(F.broadcast(last))
    return L.weighted_top(recent, "user_id", F.lit(20), F.col("last"))


def status_breakdown(spark, sf_dir):
    return L.by_status(table(spark, sf_dir, "events").withColumn("day", F.to_date("ts")), "day", "event_type")


def as_of_match(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    clicks = e.where("event_type = 'click'").select("user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), "event_id")
    others = e.where("event_type <> 'click'").groupBy("user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at")).agg(F.max("event_id").alias("anchor"))
    return E.as_of(clicks, others, "user_id", "at", "anchor").select("event_id", "user_id", "anchor")


def nearest_anchor_year(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.year("o_orderdate").alias("year"))
    at = o.groupBy("o_custkey").agg(F.max("o_orderkey").alias("at"))
    return I.nearest_year(o.join(at, "o_custkey"), "o_custkey", "o_orderkey", "at", 5000, 1)


def pair_fits(spark, sf_dir):
    fits = L.pair_fits(table(spark, sf_dir, "lineitem"), "l_suppkey", x="l_quantity", y="l_extendedprice")
    return fits.select("l_suppkey", "n", F.round("slope", 3).alias("slope"), F.round("intercept", 2).alias("intercept"))


def decade_tally(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("decade", F.concat(F.substring(F.date_format("o_orderdate", "yyyy"), 1, 3), F.lit("0s")))
    return o.groupBy("decade").agg(F.count("*").alias("n"), F.countDistinct("o_custkey").alias("customers"))


def top_gaps(spark, sf_dir):
    return event_gaps(spark, sf_dir).where("gap_days is not null").orderBy(F.desc("gap_days"), "event_id").limit(30)


def flag_tally(spark, sf_dir):
    t = F.coalesce("text", F.lit(""))
    return L.flag_tally(table(spark, sf_dir, "documents"), {"table": t.contains(" | "), "shouting": t.rlike("[A-Z]{4,}!!"), "digits": t.rlike("[0-9]{3}"), "empty": t == "", "licence": t.contains("License")})


def share_with(spark, sf_dir):
    return L.share_with(table(spark, sf_dir, "orders"), "o_custkey", F.col("o_orderstatus") == "F")


def run_summary(spark, sf_dir):
    """D7. One pass over the catalogue."""
    o = table(spark, sf_dir, "orders")
    return o.agg(
        F.count("*").alias("n_rows"), F.countDistinct("o_custkey").alias("locations"), F.min(F.to_date("o_orderdate")).alias("first_day"), F.max(F.to_date("o_orderdate")).alias("last_day"),
        F.count_if(F.col("o_orderstatus") == "O").alias("missing_end"), F.count_if(F.col("o_totalprice") < 1000).alias("issues"),
    )


QUERIES = {f.__name__: f for f in (
    timeline_segments, segment_bounds, coverage_permille, overlap_best, majority_value, sequence_holes, event_gaps, order_positions, line_siblings, latest_state, first_state,
    ranked_winner, ranked_winner_stops, running_offsets, group_index, weighted_topk, status_breakdown, as_of_match, nearest_anchor_year, pair_fits, decade_tally, top_gaps, flag_tally,
    share_with, run_summary,
)}

_GAPS = "SELECT event_id, user_id, lead(d) OVER w AS next_start, CAST(lead(d) OVER w - d AS INTEGER) AS gap_days FROM (SELECT event_id, user_id, CAST(ts AS DATE) AS d FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY d, event_id)"
ORACLE = {
    "timeline_segments": f"""WITH {_INTERVALS}, {_SWEEP}, s AS (SELECT * FROM seg WHERE "end" IS NOT NULL),
m AS (SELECT *, CASE WHEN n = lag(n) OVER (ORDER BY "start") THEN 0 ELSE 1 END AS new FROM s), r AS (SELECT *, sum(new) OVER (ORDER BY "start") AS run FROM m)
SELECT min("start") AS "start", max("end") AS "end", n FROM r GROUP BY run, n""",
    "segment_bounds": f"""WITH {_INTERVALS}, {_SWEEP} SELECT "start", "end" FROM seg WHERE "end" IS NOT NULL""",
    "coverage_permille": f"""WITH {_INTERVALS}, {_CELLS}, {_SWEEP}, s AS (SELECT * FROM seg WHERE "end" IS NOT NULL),
live AS (SELECT DISTINCT "start" AS s, "end" AS e, ref FROM iv WHERE "start" < "end"),
refs AS (SELECT s."start", live.ref FROM s JOIN live ON live.s <= s."start" AND s."end" <= live.e GROUP BY ALL),
c AS (SELECT "start", count(DISTINCT cell) AS covered FROM refs JOIN sc USING (ref) GROUP BY 1), total AS (SELECT count(DISTINCT cell) AS cells FROM sc)
SELECT s."start", s."end", n, CAST(coalesce(covered, 0) AS BIGINT) AS covered, CAST((coalesce(covered, 0) * 2000 + cells) // (2 * cells) AS INTEGER) AS permille FROM s LEFT JOIN c ON c."start" = s."start" CROSS JOIN total""",
    "overlap_best": """WITH z AS (SELECT old, modern, count(*) AS n FROM (SELECT s_suppkey AS old, s_suppkey * 212 + i AS cell FROM supplier, range(70) t(i)) JOIN (SELECT p_partkey AS modern, p_partkey * 53 + i AS cell FROM part, range(20) t(i)) USING (cell) GROUP BY ALL),
r AS (SELECT *, round(n / 70.0::DOUBLE, 3) AS share, n / 70.0::DOUBLE > 0.02 AS above, row_number() OVER (PARTITION BY old ORDER BY n DESC, modern) = 1 AS best FROM z),
k AS (SELECT *, CASE WHEN above THEN row_number() OVER (PARTITION BY old ORDER BY above DESC, share DESC, modern) END AS rank FROM r)
SELECT old, modern, share, CAST(CASE WHEN rank <= 4 THEN rank END AS INTEGER) AS rank, best FROM k WHERE rank <= 4 OR best""",
    "majority_value": "WITH c AS (SELECT o_custkey, o_orderpriority, count(*) AS n, min(o_orderkey) AS f FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY ALL) SELECT o_custkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, f) AS k FROM c) WHERE k = 1",
    "sequence_holes": "WITH s AS (SELECT o_custkey, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS a, o_orderkey AS b FROM orders) SELECT DISTINCT o_custkey, unnest(range(a + 1, b)) AS missing FROM s WHERE a < b - 1 AND b - a < 400",
    "event_gaps": _GAPS,
    "order_positions": "SELECT o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS INTEGER) AS position, o_orderstatus <> 'F' AS start_only FROM orders",
    "line_siblings": "SELECT *, 'sibling ' || k || ' of ' || n AS sibling_note FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS INTEGER) AS k, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem)",
    "latest_state": "SELECT user_id, event_type, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM events GROUP BY ALL",
    "first_state": "SELECT user_id, event_type, min(event_id) AS event_id, arg_min(value, event_id) AS value FROM events GROUP BY ALL",
    "ranked_winner": _winner_sql(False),
    "ranked_winner_stops": _winner_sql(True),
    "running_offsets": """SELECT lang, doc_id, n_chars, row_number() OVER (ORDER BY lang, doc_id) - 1 AS "index", CAST(coalesce(sum(n_chars) OVER (ORDER BY lang, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset" FROM documents""",
    "group_index": "WITH t AS (SELECT lang, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS len FROM documents GROUP BY lang) SELECT lang, CAST(sum(len) OVER w - len AS BIGINT) AS off, len, CAST(sum(n) OVER w - n AS BIGINT) AS i0, CAST(sum(n) OVER w AS BIGINT) AS i1, n FROM t WINDOW w AS (ORDER BY lang)",
    "weighted_topk": "SELECT user_id, count(*) * 20 AS weight FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 7 DAYS GROUP BY user_id ORDER BY weight DESC, user_id LIMIT 50",
    "status_breakdown": "SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY ALL",
    "as_of_match": "WITH o AS (SELECT user_id, ts, max(event_id) AS anchor FROM events WHERE event_type <> 'click' GROUP BY ALL) SELECT c.event_id, c.user_id, o.anchor FROM (SELECT * FROM events WHERE event_type = 'click') c ASOF LEFT JOIN o ON c.user_id = o.user_id AND c.ts >= o.ts",
    "nearest_anchor_year": "WITH m AS (SELECT o_custkey, max(o_orderkey) AS top FROM orders GROUP BY 1), y AS (SELECT o_custkey, o_orderkey, top, year(o_orderdate) AS y FROM orders JOIN m USING (o_custkey) WHERE o_orderkey - top >= -5000 AND o_orderkey <= top) SELECT o_custkey, CAST(y AS INTEGER) AS year FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY abs(o_orderkey - top), y) AS k FROM y) WHERE k = 1",
    "pair_fits": "SELECT l_suppkey, count(*) AS n, round(regr_slope(l_extendedprice, l_quantity), 3) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 2) AS intercept FROM lineitem GROUP BY 1",
    "decade_tally": "SELECT substring(CAST(year(o_orderdate) AS VARCHAR), 1, 3) || '0s' AS decade, count(*) AS n, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY 1",
    "top_gaps": f"SELECT * FROM ({_GAPS}) WHERE gap_days IS NOT NULL ORDER BY gap_days DESC, event_id LIMIT 30",
    "flag_tally": "WITH t AS (SELECT coalesce(text, '') AS t FROM documents), f AS (SELECT unnest([CASE WHEN contains(t, ' | ') THEN 'table' END, CASE WHEN regexp_matches(t, '[A-Z]{4,}!!') THEN 'shouting' END, CASE WHEN regexp_matches(t, '[0-9]{3}') THEN 'digits' END, CASE WHEN t = '' THEN 'empty' END, CASE WHEN contains(t, 'License') THEN 'licence' END]) AS flag FROM t) SELECT flag, count(*) AS n FROM f WHERE flag IS NOT NULL GROUP BY flag",
    "share_with": "SELECT count(*) AS groups, count(*) FILTER (h) AS n_having FROM (SELECT o_custkey, bool_or(o_orderstatus = 'F') AS h FROM orders GROUP BY 1)",
    "run_summary": "SELECT count(*) AS n_rows, count(DISTINCT o_custkey) AS locations, min(CAST(o_orderdate AS DATE)) AS first_day, max(CAST(o_orderdate AS DATE)) AS last_day, count(*) FILTER (o_orderstatus = 'O') AS missing_end, count(*) FILTER (o_totalprice < 1000) AS issues FROM orders",
}
