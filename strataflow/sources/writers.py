"""Writers. Each leaves files by Spark's committer; a failed job leaves none."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.functions import expr as X
from strataflow.sources.readers import CATALOGUE


def write_catalogue(df: DataFrame, path: str) -> None:
    """A10. CSV in catalogue column order; an existing folder is an error, so earlier versions stay."""
    df.orderBy("line").select(CATALOGUE).write.csv(path, header=True, quote='"', escape='"', emptyValue="")


def geojson_lines(df: DataFrame, lon: str = "lon", lat: str = "lat", properties: list[str] | None = None) -> DataFrame:
    """A11. A column `feature` of Point features."""
    props = F.struct(*(properties or [c for c in df.columns if c not in (lon, lat)]))
    geometry = F.struct(F.lit("Point").alias("type"), F.array(F.col(lon), F.col(lat)).alias("coordinates"))
    return df.select(F.to_json(F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), props.alias("properties"))).alias("feature"))


def write_geojson(df: DataFrame, path: str, **names) -> None:
    """A11. A feature on each line."""
    geojson_lines(df, **names).write.text(path)


def write_chunks(df: DataFrame, path: str) -> None:
    """A12. JSON lines."""
    df.write.json(path)


def timeline_records(rows: DataFrame, places: DataFrame, uploads: DataFrame | None = None) -> DataFrame:
    """A13. (location, era, ref, charts, gaps, missing_eds, modern_share, overlaps): a record for each location of the timeline.

    rows: location, date, end_date, edition, note (texts) and line. charts are in order of date and line: struct of d, e (null without an end), ed, f (L for latest in collection, B for a blank map) and pm (its uploaded keys, from
    uploads: location, d, e and array keys; null without). gaps come from the notes (from the chart's end, or its date; to, days, est: how many are missing, if the note tells what is typical). missing_eds
    are the numbers between two editions that follow each other and lie less than 40 apart; editions that are no whole numbers, or 1500 or more, are passed over.
    places: location, era, ref, modern_share, overlaps, one row each. Locations without a row in places have nulls there. A record holds all charts of its location, as the format asks.
    """
    keyed = rows.withColumn("_e", F.nullif(F.coalesce(F.col("end_date"), F.lit("")), F.lit(""))).withColumn("_g", X.note_gap("note"))
    if uploads is not None:
        told = uploads.select("location", F.col("d").alias("date"), F.coalesce(F.col("e"), F.lit("")).alias("_k"), F.col("keys").alias("_pm"))
        keyed = keyed.withColumn("_k", F.coalesce("_e", F.lit(""))).join(told, ["location", "date", "_k"], "left")
    else:
        keyed = keyed.withColumn("_pm", F.lit(None).cast("array<string>"))
    flags = F.concat(F.when(F.col("_g.latest"), "L").otherwise(""), F.when(F.col("_g.blank_map"), "B").otherwise(""))
    chart = F.struct("date", "line", F.struct(F.col("date").alias("d"), F.col("_e").alias("e"), F.trim("edition").alias("ed"), flags.alias("f"), F.col("_pm").alias("pm")).alias("c"), F.when(F.col("_g.days").isNotNull(), F.struct(F.coalesce("_e", "date").alias("from"), F.col("_g.next").cast("string").alias("to"), F.col("_g.days").alias("days"), F.col("_g.missing").alias("est"))).alias("g"))
    held = keyed.groupBy("location").agg(F.sort_array(F.collect_list(chart)).alias("_l"))
    held = held.select("location", F.transform("_l", lambda x: x["c"]).alias("charts"), F.filter(F.transform("_l", lambda x: x["g"]), lambda g: g.isNotNull()).alias("gaps"))
    numbers = F.filter(F.transform("charts", lambda c: X.whole(c["ed"])), lambda n: n < 1500)
    held = held.withColumn("_n", numbers)
    holes = F.zip_with(F.slice("_n", 1, F.size("_n") - 1), F.slice("_n", 2, F.size("_n") - 1), lambda a, b: F.when((b - a > 1) & (b - a < 40), F.sequence(a + 1, b - 1)).otherwise(F.array().cast("array<int>")))
    held = held.withColumn("missing_eds", F.when(F.size("_n") > 1, F.sort_array(F.array_distinct(F.flatten(holes)))).otherwise(F.array().cast("array<int>"))).drop("_n")
    return held.join(places.select("location", "era", "ref", "modern_share", "overlaps"), "location", "left").select("location", "era", "ref", "charts", "gaps", "missing_eds", "modern_share", "overlaps")


def write_timeline(records: DataFrame, groups: DataFrame, rings: DataFrame, path: str) -> None:
    """A13. JSON lines of the three parts of the payload, each in a folder of its own below path: locations (`timeline_records`), groups (see cells.group_members) and rings. Use a Publication to change them together."""
    for name, part in (("locations", records), ("groups", groups), ("rings", rings)):
        part.write.json(f"{path}/{name}")


def write_dates(df: DataFrame, path: str) -> None:
    """A14. key and url, newest first."""
    df.select("key", "url").orderBy(F.desc("key")).write.csv(path, header=True)


def review_matrix(df: DataFrame, order: str, date: str = "date", location: str = "location", count: str = "num_files", files: str = "source_files", locations: list | None = None) -> DataFrame:
    """A15. Dates (newest first) by locations; a cell tells of its last row by `order`: the file's name (12 characters at most, longer ones cut to 9 and `...`), how many files, or ---."""
    first = F.trim(F.get(F.split(files, ","), F.lit(0)))
    name, several = F.regexp_extract(first, r"([^/]*)$", 1), F.size(F.split(files, ","))
    cell = F.when(F.coalesce(F.col(count), F.lit(0)) <= 0, "---").when(several > 1, F.concat(F.lit("("), several.cast("string"), F.lit(" files)"))).when(F.length(name) > 12, F.concat(F.substring(name, 1, 9), F.lit("..."))).otherwise(name)
    out = df.groupBy(date).pivot(location, locations).agg(F.max_by(cell, order))
    return out.select(date, *[F.coalesce(F.col(f"`{c}`"), F.lit("---")).alias(c) for c in out.columns if c != date]).orderBy(F.desc(date))
