"""Validity intervals [start, end): sweeps, gaps, runs and sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running(df: DataFrame, value: Column, order: str, *by: str) -> Column:
    w = Window.partitionBy(*by).orderBy(order) if by else Window.orderBy(order)
    return F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, 0))


def segments(intervals: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """E2. (start, end) between consecutive distinct boundary days. Rows without an end take no part; inverted ones still give boundaries."""
    days = intervals.where(F.col(start).isNotNull() & F.col(end).isNotNull()).select(F.explode(F.array(start, end)).alias("start")).distinct()
    return days.select("start", F.lead("start").over(Window.orderBy("start")).alias("end")).where("end is not null")


def active_counts(intervals: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """C20, D3. (start, end, n): how many intervals are active in each segment.

    A sweep: +1 and -1 at boundaries, summed by day before the running sum; so the only unpartitioned window has a row for each day. An
    interval that ends where or before it starts counts nowhere, but its days part segments.
    """
    full = intervals.where(F.col(start).isNotNull() & F.col(end).isNotNull())
    live = (F.col(start) < F.col(end)).cast("int")
    event = lambda day, by: F.struct(F.col(day).alias("day"), by.alias("by"))
    days = full.select(F.explode(F.array(event(start, live), event(end, -live))).alias("x")).groupBy("x.day").agg(F.sum("x.by").alias("by"))
    w = Window.orderBy("day")
    return days.select(F.col("day").alias("start"), F.lead("day").over(w).alias("end"), F.sum("by").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("n")).where("end is not null")


def islands(intervals: DataFrame, *by: str) -> DataFrame:
    """(by, s, e): the intervals (s, e) of each key, overlapping and touching ones merged. Sorting is inside a key only."""
    order = Window.partitionBy(*by).orderBy("s", "e")
    marked = intervals.withColumn("new", F.when(F.col("s") <= F.max("e").over(order.rowsBetween(Window.unboundedPreceding, -1)), 0).otherwise(1))
    runs = marked.withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(*by, "run").agg(F.min("s").alias("s"), F.max("e").alias("e")).drop("run")


def covered_cells(intervals: DataFrame, cells: DataFrame, start: str = "start", end: str = "end", ref: str = "ref") -> DataFrame:
    """D3. (day, delta): changes of the number of cells that the union of active extents covers.

    Intervals are merged per ref before they meet cells, so that each ref has as few as its days have gaps; then per cell, so that each cell's merged run adds one +1 and one -1.
    """
    live = intervals.where(F.col(start) < F.col(end)).select(F.col(ref).alias("ref"), F.col(start).alias("s"), F.col(end).alias("e")).distinct()
    own = islands(live, "ref").join(cells.select(F.col(ref).alias("ref"), "cell").distinct(), "ref").select("cell", "s", "e").distinct()
    change = lambda day, by: F.struct(F.col(day).alias("day"), F.lit(by).alias("by"))
    return islands(own, "cell").select(F.explode(F.array(change("s", 1), change("e", -1))).alias("x")).groupBy("x.day").agg(F.sum("x.by").alias("delta"))


def coverage(intervals: DataFrame, cells: DataFrame, start: str = "start", end: str = "end", ref: str = "ref") -> DataFrame:
    """D2, D3. (start, end, n, covered, permille): active intervals, and the share of all cells that they cover, in whole thousandths."""
    changes = covered_cells(intervals, cells, start, end, ref)
    all_cells = cells.agg(F.countDistinct("cell").alias("cells"))
    w = Window.orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    counted = active_counts(intervals, start, end).join(changes.withColumnRenamed("day", "start"), "start", "left")
    covered = counted.withColumn("covered", F.sum(F.coalesce("delta", F.lit(0))).over(w)).drop("delta")
    return covered.join(F.broadcast(all_cells)).select("start", "end", "n", "covered", F.expr("int((covered * 2000 + cells) div (2 * cells))").alias("permille"))


def merged_runs(segments_: DataFrame, *values: str) -> DataFrame:
    """E3. Adjacent segments with equal values fused."""
    w = Window.orderBy("start")
    same = (F.lag("end").over(w) == F.col("start")) & F.lit(True)
    for v in values:
        same = same & F.col(v).eqNullSafe(F.lag(v).over(w))
    marked = segments_.withColumn("new", F.when(same, 0).otherwise(1)).withColumn("run", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy("run", *values).agg(F.min("start").alias("start"), F.max("end").alias("end")).select("start", "end", *values)


def majority(df: DataFrame, group: str, value: str, order: str) -> DataFrame:
    """D1. The commonest non-null value of each group; ties: the one seen first by `order`."""
    counts = df.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    return counts.groupBy(group).agg(F.max_by(value, F.struct("n", -F.col("first"))).alias(value))


def sequence_holes(df: DataFrame, group: str, number: str, *order: str, below: int = 1500, most: int = 40) -> DataFrame:
    """E1. (group, missing): numbers skipped between consecutive rows, if fewer than `most` are; distinct."""
    rows = df.where(F.col(number).isNotNull() & (F.col(number) < below))
    step = rows.select(group, F.lag(number).over(Window.partitionBy(group).orderBy(*order)).alias("a"), F.col(number).alias("b"))
    holes = step.where((F.col("a") < F.col("b") - 1) & (F.col("b") - F.col("a") < most))
    return holes.select(group, F.explode(F.sequence(F.col("a") + 1, F.col("b") - 1)).alias("missing")).distinct()


def gaps(df: DataFrame, group: str, start: str, end: str, *order: str) -> DataFrame:
    """E9. df with next_start and gap_days: from the end (or start) to the next start in the group."""
    following = F.lead(start).over(Window.partitionBy(group).orderBy(start, *order))
    return df.withColumn("next_start", following).withColumn("gap_days", F.datediff("next_start", F.coalesce(end, start)))


def numbered(df: DataFrame, group: str, start: str, end: str, *order: str) -> DataFrame:
    """E11. df with position (by date, missing last) and start_only."""
    w = Window.partitionBy(group).orderBy(F.col(start).asc_nulls_last(), *order)
    return df.withColumn("position", F.row_number().over(w)).withColumn("start_only", F.col(end).isNull())


def siblings(df: DataFrame, group: str, *order: str) -> DataFrame:
    """E8. df with k, n and the note `sibling k of n`."""
    w = Window.partitionBy(group)
    out = df.withColumn("k", F.row_number().over(w.orderBy(*order))).withColumn("n", F.count("*").over(w))
    return out.withColumn("sibling_note", F.format_string("sibling %d of %d", "k", "n"))


def nearest_year(years: DataFrame, group: str, position: str, at: str, back: int, forward: int, year: str = "year") -> DataFrame:
    """E10. The year nearest to a position, within [at - back, at + forward)."""
    near = years.where((F.col(position) >= F.col(at) - back) & (F.col(position) < F.col(at) + forward))
    return near.groupBy(group).agg(F.min_by(year, F.struct(F.abs(F.col(position) - F.col(at)), year)).alias(year))
