"""Request logs, tallies and running offsets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def shaped(requests: DataFrame, rate: float = 0.05, header_bytes: int = 1024) -> DataFrame:
    """S1. A sample of `rate` of the requests by a hash of key and time, with size and weight. Works on streams.

    Reads of header_bytes or fewer and open-ended ranges are left out. A request without a range, or with one that isn't understood, is kept and has size 0.
    """
    from strataflow.functions.expr import byte_range, open_range

    rows = requests.withColumn("size", F.coalesce(byte_range("range_header")["size"], F.lit(0).cast("long"))).where(~open_range("range_header"))
    rows = rows.where(byte_range("range_header").isNull() | (F.col("size") > header_bytes))
    kept = F.pmod(F.xxhash64("key", "ts"), F.lit(1_000_000)) < int(rate * 1_000_000)
    return rows.where(kept).withColumn("weight", F.lit(1 / rate))


def weighted_top(events: DataFrame, key: str, weight: Column, until: Column, days: int = 7, k: int = 50, ts: str = "ts") -> DataFrame:
    """D9, F2. The k keys of greatest summed weight in the days before `until`; ties by key."""
    recent = events.where((F.col(ts) > until - F.make_interval(days=F.lit(days))) & (F.col(ts) <= until))
    return recent.groupBy(key).agg(F.sum(weight).alias("weight")).orderBy(F.desc("weight"), key).limit(k)


def by_status(events: DataFrame, *by: str) -> DataFrame:
    """S3. Counts by key, status or country."""
    return events.groupBy(*by).agg(F.count("*").alias("n"))


def running_offsets(rows: DataFrame, group: str, order: list[str], length: str, write) -> DataFrame:
    """E7. rows with index and offset over all rows by (group, order): how many, and how many bytes, stand before; equal rows by a number of their own.

    Rows are range-partitioned by group, order and that number, so that equal ones may be parted too; windows run inside a part and one runs over the parts' totals, so no group, however large, meets in
    one task. write (which puts a table where all executors can read it, and reads it back) is called for rows with their numbers and for rows with their parts, so that a lost executor changes neither.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    told = write(rows.withColumn("_tie", F.monotonically_increasing_id()))
    by = [group, *order, "_tie"]
    along = write(told.repartitionByRange(parts, *by).withColumn("_part", F.spark_partition_id()))
    w = Window.partitionBy("_part").orderBy(*by)
    within = along.withColumn("_i", F.row_number().over(w) - 1).withColumn("_o", F.coalesce(F.sum(length).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    totals = along.groupBy("_part").agg(F.count("*").alias("_n"), F.sum(length).alias("_b"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_i0"), F.coalesce(F.sum("_b").over(before), F.lit(0)).alias("_o0"))
    out = within.join(F.broadcast(starts), "_part")  # a row for each part
    return out.select(*rows.columns, (F.col("_i0") + F.col("_i")).alias("index"), (F.col("_o0") + F.col("_o")).alias("offset"))


def group_index(rows: DataFrame, group: str, length: str) -> DataFrame:
    """D10, E7. (group, off, len, i0, i1, n) of each group in order."""
    totals = rows.groupBy(group).agg(F.count("*").alias("n"), F.sum(length).alias("len"))
    w = Window.orderBy(group).rowsBetween(Window.unboundedPreceding, 0)
    return totals.select(group, (F.sum("len").over(w) - F.col("len")).alias("off"), "len", (F.sum("n").over(w) - F.col("n")).alias("i0"), F.sum("n").over(w).alias("i1"), "n")


def verify_bundle(entries: DataFrame, source: DataFrame, group: str, key: str, bounds: str | None = None) -> DataFrame:
    """C24. Entries with faults: offsets that don't follow on, keys that the source lacks, sizes or (if a column is named) bounds that differ from it, or prefixes that run into the tiles (where source
    says where these begin, tile_data_offset)."""
    w = Window.partitionBy(group).orderBy("offset", key)
    same = F.col(bounds).eqNullSafe(F.col("_bounds")) if bounds else F.lit(True)
    tiles = F.col("tile_data_offset") if "tile_data_offset" in source.columns else F.lit(None).cast("long")
    told = source.select(key, F.col("len").alias("_len"), tiles.alias("_tiles"), *([F.col(bounds).alias("_bounds")] if bounds else []))
    out = entries.withColumn("_end", F.lag(F.col("offset") + F.col("len")).over(w)).join(told, key, "left")
    fault = F.when(F.col("_end").isNotNull() & (F.col("_end") != F.col("offset")), "offset").when(F.col("_len").isNull(), "unknown").when(F.col("_len") != F.col("len"), "size").when(F.col("_tiles") < F.col("len"), "overrun").when(~same, "bounds")
    return out.withColumn("fault", fault).where("fault is not null").select(entries.columns + ["fault"])


def verify_groups(entries: DataFrame, groups: DataFrame, group: str) -> DataFrame:
    """C24. (group, fault) of a bundle's groups that its entries don't bear out: empty (no entries, or i1 not beyond i0), offset (the first entry, by index, begins elsewhere) or length (entries span
    another stretch). entries: group, index, offset, len; groups: group, off, len, i0, i1 (entries i0 to i1 - 1 are its own)."""
    e = entries.select(F.col("index"), F.col("offset").alias("_o"), F.col("len").alias("_l"), F.col(group).alias("_g"))
    own = groups.join(e, F.col(group) == F.col("_g"), "left").groupBy(group, "off", "len", "i0", "i1").agg(
        F.max(F.when(F.col("index") == F.col("i0"), F.col("_o"))).alias("_first"), F.max(F.when(F.col("index") == F.col("i1") - 1, F.col("_o") + F.col("_l"))).alias("_end"),
    )
    fault = F.when((F.col("i1") <= F.col("i0")) | F.col("_first").isNull() | F.col("_end").isNull(), "empty").when(F.col("_first") != F.col("off"), "offset").when(F.col("_end") - F.col("off") != F.col("len"), "length")
    return own.withColumn("fault", fault).where("fault is not null").select(group, "fault")


def flag_tally(rows: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """D11. (flag, n): a row counts for each flag that it has."""
    every = F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in flags.items()]))
    return rows.select(F.explode(every).alias("flag")).groupBy("flag").agg(F.count("*").alias("n"))


def pair_fits(points: DataFrame, *by: str, x: str = "x", y: str = "y") -> DataFrame:
    """D13. (n, slope, intercept) of least-squares lines for each group, from sums; the slope is null where x is constant."""
    s = points.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(*by).agg(F.count("*").alias("n"), F.sum(x).alias("sx"), F.sum(y).alias("sy"), F.sum(F.col(x) * F.col(x)).alias("sxx"), F.sum(F.col(x) * F.col(y)).alias("sxy"))
    d = F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")
    fit = s.withColumn("slope", F.when(d != 0, (F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")) / d))
    return fit.select(*by, "n", "slope", ((F.col("sy") - F.col("slope") * F.col("sx")) / F.col("n")).alias("intercept"))


def share_with(rows: DataFrame, group: str, has: Column) -> DataFrame:
    """D8. (groups, n_having): how many groups there are, and how many with any row for which `has` is true."""
    return rows.groupBy(group).agg(F.bool_or(has).alias("_h")).agg(F.count("*").alias("groups"), F.count_if("_h").alias("n_having"))


def first_n(rows: DataFrame, n: int, *order) -> DataFrame:
    """F4. The first n rows in a total order, for a staged run."""
    return rows.orderBy(*order).limit(n)


def by_location(rows: DataFrame, location: str, date: str, *more) -> DataFrame:
    """F5. rows ordered by location without regard to case, then as written, then by date, nulls last."""
    return rows.orderBy(F.lower(location), location, F.asc_nulls_last(date), *more)


def newest_first(rows: DataFrame, key: str, *more) -> DataFrame:
    """F3. rows ordered by the start of their date key, newest first; keys that are none count as earliest."""
    from strataflow.functions.expr import key_dates

    return rows.orderBy(F.desc(F.coalesce(key_dates(key)["start"], F.lit("0001-01-01").cast("date"))), *more)


# What least squares add up over matched points (x, y) -> (u, v), by name: for a similarity, and for an affine map the means first, then sums about these.
SIMILARITY_SUMS = {"n": "1", "sx": "x", "sy": "y", "su": "u", "sv": "v", "q": "x * x + y * y", "p": "x * u + y * v"}
MEANS = {f"m{n}": n for n in ("x", "y", "u", "v")}
CENTRED_SUMS = {p + q: f"({p} - m{p}) * ({q} - m{q})" for p, q in ("xx", "xy", "yy", "xu", "yu", "xv", "yv")}
SIMILARITY_MAP = ("scale * x + tx", "scale * y + ty")
AFFINE_MAP = ("a * x + b * y + c", "d * x + e * y + f")


def with_affine(sums: DataFrame) -> DataFrame:
    """sums (MEANS and CENTRED_SUMS) with the coefficients a to f; null where the points lie on a line."""
    d = F.col("xx") * F.col("yy") - F.col("xy") * F.col("xy")
    d = F.when(F.abs(d) > 1e-12 * F.col("xx") * F.col("yy"), d)
    fit = sums
    for p, q, w in (("a", "b", "u"), ("d", "e", "v")):
        fit = fit.withColumn(p, (F.col("yy") * F.col(f"x{w}") - F.col("xy") * F.col(f"y{w}")) / d).withColumn(q, (F.col("xx") * F.col(f"y{w}") - F.col("xy") * F.col(f"x{w}")) / d)
    return fit.withColumn("c", F.expr("mu - a * mx - b * my")).withColumn("f", F.expr("mv - d * mx - e * my"))


def with_similarity(sums: DataFrame) -> DataFrame:
    """sums (SIMILARITY_SUMS) with scale, tx and ty; null where all points are one."""
    spread = F.expr("n * q - sx * sx - sy * sy")
    fit = sums.withColumn("scale", F.when(spread > 0, F.expr("n * p - sx * su - sy * sv") / spread))
    return fit.withColumn("tx", F.expr("(su - scale * sx) / n")).withColumn("ty", F.expr("(sv - scale * sy) / n"))


def _good(points: DataFrame, by: tuple) -> DataFrame:
    names = ["x", "y", "u", "v"]
    return points.where(F.greatest(*[F.col(n).isNull().cast("int") for n in names]) == 0).select(*by, *names)


def affine_fits(points: DataFrame, *by: str) -> DataFrame:
    """D13. For each group of point pairs (x, y) -> (u, v): n, the coefficients of u = a x + b y + c and v = d x + e y + f by least squares, and the greatest residual.

    Coefficients come from sums about the means (one partial aggregation and one more for the means); null where the points lie on a line. The residual takes one
    further pass over the points.
    """
    good = _good(points, by)
    means = good.groupBy(*by).agg(*[F.avg(n).alias(m) for m, n in MEANS.items()], F.count("*").alias("n"))
    sums = good.join(means, list(by)).groupBy(*by).agg(*[F.first(m).alias(m) for m in (*MEANS, "n")], *[F.sum(F.expr(e)).alias(n) for n, e in CENTRED_SUMS.items()])
    return _with_residual(good, with_affine(sums).select(*by, "n", "a", "b", "c", "d", "e", "f"), by, *AFFINE_MAP)


def similarity_fits(points: DataFrame, *by: str) -> DataFrame:
    """D13. For each group of point pairs (x, y) -> (u, v): n, scale and shifts of u = scale x + tx and v = scale y + ty by least squares, and the greatest residual."""
    good = _good(points, by)
    sums = good.groupBy(*by).agg(*[F.sum(F.expr(e)).alias(n) for n, e in SIMILARITY_SUMS.items()])
    return _with_residual(good, with_similarity(sums).select(*by, "n", "scale", "tx", "ty"), by, *SIMILARITY_MAP)


def _with_residual(points: DataFrame, fit: DataFrame, by: tuple, u: str, v: str) -> DataFrame:
    off = F.sqrt(F.pow(F.expr(f"u - ({u})"), 2) + F.pow(F.expr(f"v - ({v})"), 2))
    most = points.join(fit, list(by)).groupBy(*by).agg(F.max(off).alias("max_residual"))
    return fit.join(most, list(by))
