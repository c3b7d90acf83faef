"""Spatial coverage on a grid: extents are sets of cells, so overlap and union are joins and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The grid's box and step in degrees.
WEST, SOUTH, EAST, NORTH, STEP = -125.0, 24.5, -66.5, 49.5, 0.1


def ring_cells(rings: DataFrame, ref: str = "ref", ring: str = "ring", step: float = STEP) -> DataFrame:
    """J1. Distinct (ref, x, y, cell) whose centre lies inside any of the ref's rings (even-odd), within the grid.

    Candidates are the cells of the ring's box, row by row, so a large ring becomes many small rows before cells are tested.
    """
    nx, ny = round((EAST - WEST) / step), round((NORTH - SOUTH) / step)
    lons, lats = F.transform(ring, lambda p: p["lon"]), F.transform(ring, lambda p: p["lat"])
    held = lambda v, n: F.least(F.greatest(F.floor(v), F.lit(0)), F.lit(n - 1)).cast("int")
    box = rings.select(
        ref, ring, held((F.array_min(lons) - WEST) / step, nx).alias("x0"), held((F.array_max(lons) - WEST) / step, nx).alias("x1"),
        held((F.array_min(lats) - SOUTH) / step, ny).alias("y0"), held((F.array_max(lats) - SOUTH) / step, ny).alias("y1"),
    )
    rows = box.select(ref, ring, "x0", "x1", F.explode(F.sequence("y0", "y1")).alias("y")).withColumn("lat", SOUTH + (F.col("y") + 0.5) * step)
    edges = F.zip_with(F.slice(F.col(ring), 1, F.size(ring) - 1), F.slice(F.col(ring), 2, F.size(ring) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    crossed = F.filter(edges, lambda e: (e["a"]["lat"] > F.col("lat")) != (e["b"]["lat"] > F.col("lat")))
    at = F.transform(crossed, lambda e: e["a"]["lon"] + (F.col("lat") - e["a"]["lat"]) / (e["b"]["lat"] - e["a"]["lat"]) * (e["b"]["lon"] - e["a"]["lon"]))
    cells = rows.withColumn("at", at).where(F.size("at") > 0).select(ref, "y", "at", F.explode(F.sequence("x0", "x1")).alias("x"))
    lon = WEST + (F.col("x") + 0.5) * step
    inside = F.size(F.filter("at", lambda c: c > lon)) % 2 == 1
    return cells.where(inside).select(ref, "x", "y", (F.col("y") * nx + F.col("x")).alias("cell")).distinct()


def envelopes(rings: DataFrame, ref: str = "ref", ring: str = "ring") -> DataFrame:
    """J2. (ref, west, south, east, north)."""
    lons, lats = F.transform(ring, lambda p: p["lon"]), F.transform(ring, lambda p: p["lat"])
    return rings.groupBy(ref).agg(F.min(F.array_min(lons)).alias("west"), F.min(F.array_min(lats)).alias("south"), F.max(F.array_max(lons)).alias("east"), F.max(F.array_max(lats)).alias("north"))


def overlaps(old: DataFrame, modern: DataFrame, least: float = 0.02, most: int = 4) -> DataFrame:
    """C13, F1. (old, modern, share, rank, best): how much of each old extent's cells lie in each modern extent.

    old: (old, cell); modern: (modern, cell). Listed are the `most` greatest shares above `least` (by the share to 3 places, then by name) with their rank, and the modern extent with
    the greatest share, whatever it is (ties: smaller name), as best; its rank is null if it isn't among the former. Leave extents that wrap around the antimeridian out
    before (see `unwrapped`). The joins are by sort: cells that rows were exploded into count for little in Spark's estimates, and a broadcast of them would go through the driver.
    """
    size = old.groupBy("old").agg(F.countDistinct("cell").alias("cells"))
    both = old.distinct().hint("merge").join(modern.distinct(), "cell").groupBy("old", "modern").agg(F.count("*").alias("n")).hint("merge").join(size, "old")
    # counts order shares exactly; a pair's rank counts only among those above `least`
    above, share = F.col("n") / F.col("cells") > least, F.round(F.col("n") / F.col("cells"), 3)
    by = Window.partitionBy("old")
    ranked = both.withColumn("share", share).withColumn("rank", F.when(above, F.row_number().over(by.orderBy(F.desc(above), F.desc("share"), "modern"))))
    ranked = ranked.withColumn("best", F.row_number().over(by.orderBy(F.desc("n"), "modern")) == 1)
    return ranked.where((F.col("rank") <= most) | F.col("best")).select("old", "modern", "share", F.when(F.col("rank") <= most, F.col("rank")).alias("rank"), "best")


def unwrapped(cells: DataFrame, envelopes: DataFrame, ref: str = "ref", most: float = 90.0) -> DataFrame:
    """C13. cells of the refs whose envelope is at most `most` degrees wide; wider ones cross the antimeridian."""
    return cells.join(envelopes.where(F.col("east") - F.col("west") > most).select(ref), ref, "left_anti")


def group_members(locations: DataFrame, best: DataFrame, by_hand: DataFrame, until: str = "1972") -> DataFrame:
    """D12. (group, name, modern, old): locations under the modern extent that they have or that overlaps theirs most; both lists sorted.

    locations: location, ref, last_date, line. One is old if its ref is of extents/, or if it has none and its last date is before `until`. A modern one is under its ref; an old one under its
    ref's best extent (best: old, modern), else under the group that by_hand (location, group) names, else under `__unmatched__`. A group's name is that of its modern
    locations with the least line, else its ref's last part in title case.
    """
    is_old = F.when(F.col("ref").isNotNull(), F.col("ref").startswith("extents/")).otherwise(F.coalesce(F.col("last_date") < until, F.lit(False)))
    put = locations.withColumn("is_old", is_old).join(best.select(F.col("old").alias("ref"), F.col("modern").alias("_m")), "ref", "left").join(by_hand.select("location", F.col("group").alias("_o")), "location", "left")
    group = F.when(~F.col("is_old"), F.col("ref")).otherwise(F.coalesce("_m", "_o", F.lit("__unmatched__")))
    lists = [F.sort_array(F.collect_set(F.when(c, F.col("location")))).alias(n) for n, c in (("modern", ~F.col("is_old")), ("old", F.col("is_old")))]
    first = F.min_by(F.when(~F.col("is_old"), F.col("location")), F.when(~F.col("is_old"), F.col("line"))).alias("first")
    named = put.withColumn("group", group).groupBy("group").agg(*lists, first)
    title = F.initcap(F.translate(F.regexp_extract("group", r"([^/]*)$", 1), "_", " "))
    return named.withColumn("name", F.coalesce("first", title)).select("group", "name", "modern", "old")
