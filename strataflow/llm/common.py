"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import re
import tempfile
import uuid

import pyarrow as pa

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a side may be broadcast; the count is taken first, and beyond it a shuffle join is used.
BROADCAST_ROWS = 1_000_000
#: A key is hot if it has this share of all rows; so there are at most 1 / HOT_SHARE hot keys.
HOT_SHARE = 1 / 512

_ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, a folder of our own, but only with a local master."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="strataflow-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def table_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/strataflow/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """df written as Parquet to the shared folder and read again: cuts the lineage, and survives lost executors."""
    path = table_path(df.sparkSession, name)
    df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables that `written` or `numbered` returned; nothing that is still to run may read them."""
    for t in tables:
        if hasattr(t, "_table"):
            t.sparkSession.sql(f"DROP TABLE IF EXISTS {t._table}")
        at = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t._written_at)
        at.getFileSystem(t.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def numbered(df: DataFrame, name: str) -> DataFrame:
    """(row, own, part): the rows of df (own) with a number each, written to the shared folder; numbers stay as written.

    The upper bits of a number are the part of the input that the row was in, the lower ones its place there. The table is bucketed by part: each writing task has one part
    and so writes one file, no row moves, and what comes by part (see `picked`) meets the rows where they are.
    """
    spark, path = df.sparkSession, table_path(df.sparkSession, name)
    table = "strataflow_" + path.rpartition("/")[2].replace("-", "_")
    rows = df.select(F.monotonically_increasing_id().alias("row"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("own")).withColumn("part", F.expr("cast(shiftright(row, 33) as int)"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.write.option("compression", "zstd").option("path", path).bucketBy(buckets, "part").saveAsTable(table)
    out = spark.table(table)
    out._written_at, out._table = path, table
    return out


def picked(table: DataFrame, rows: DataFrame, among: bool = True) -> DataFrame:
    """The rows of a `numbered` table whose number is (or, with among=False, is not) in rows.row.

    The numbers travel as one bitmap for each part, to the bucket that the part is in; the table's own rows aren't shuffled, at any size.
    """
    place = "(row & 8589934591)"
    word = F.expr(f"shiftright({place}, 6)")
    marks = rows.select(F.expr("cast(shiftright(row, 33) as int)").alias("part"), word.alias("w"), F.expr(f"shiftleft(1L, cast({place} % 64 as int))").alias("bits"))
    none = table.groupBy("part").agg(F.max("row").alias("row")).select("part", F.explode(F.sequence(F.lit(0).cast("long"), word)).alias("w"), F.lit(0).cast("long").alias("bits"))
    words = none.unionByName(marks).groupBy("part", "w").agg(F.bit_or("bits").alias("bits"))
    bitmaps = words.groupBy("part").agg(F.transform(F.sort_array(F.collect_list(F.struct("w", "bits"))), lambda x: x["bits"]).alias("bitmap"))
    met = table.join(bitmaps.hint("shuffle_hash"), "part")
    bit = F.expr(f"bit_get(element_at(bitmap, cast(shiftright({place}, 6) as int) + 1), cast({place} % 64 as int))")
    return met.where(bit == (1 if among else 0)).select(*table.columns)


def lower_ascii(c):
    """A-Z lower-cased, other letters as they are."""
    return F.translate(c, _ASCII_UPPER, _ASCII_UPPER.lower())


def small_enough(df: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Whether df has at most `limit` rows (counted over limit + 1 rows at most)."""
    return df.limit(limit + 1).count() <= limit


def attach(rows: DataFrame, groups: DataFrame, key: str, size: str) -> DataFrame:
    """Left join of rows to groups, which has one row for each key and the key's row count in `size`.

    Keys with HOT_SHARE of all rows or more are joined by broadcast (at most 1 / HOT_SHARE of them exist, by arithmetic), all others
    by a shuffle in which no key is hot. Both inputs are read twice, so they should be written tables.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    is_hot = F.col(size) >= max(total * HOT_SHARE, 2)
    hot = F.broadcast(groups.where(is_hot))
    apart = rows.join(F.broadcast(groups.where(is_hot).select(key)), key, "left_anti")
    return rows.join(hot, key).unionByName(apart.join(groups.where(~is_hot), key, "left"))


def ddl(schema) -> str:
    """A schema as the text that mapInArrow takes."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def with_columns(batch: pa.RecordBatch, **more) -> pa.RecordBatch:
    """batch with further columns."""
    arrays = [x if isinstance(x, pa.Array) else pa.array(x) for x in more.values()]
    return pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=[*batch.schema.names, *more])
