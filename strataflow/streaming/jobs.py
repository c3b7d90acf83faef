"""Streaming jobs: popularity in sliding windows and the current state of an append-only log."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType


def popularity(requests: DataFrame, key: str, weight: Column, ts: str = "ts", late: str = "1 day", size: str = "7 days", slide: str = "1 day") -> DataFrame:
    """S2. (start, end, key, weight) of sliding windows; rows later than the watermark are dropped. On a batch the watermark does nothing.

    Rows without a time fall in no window; a null key is a key of its own; a null weight adds nothing.
    """
    seen = requests.withWatermark(ts, late).groupBy(F.window(ts, size, slide).alias("w"), key).agg(F.sum(weight).alias("weight"))
    return seen.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), key, "weight")


def latest(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """S4. Of each key the row that is last by `order`, nulls first; rows with a null key go."""
    last = F.max_by(F.struct(*rows.columns), F.struct(*order))
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(last.alias("_r")).select("_r.*")


def keep_state(log: DataFrame, path: str, checkpoint: str, key: str, order: list[str]) -> StreamingQuery:
    """S4. Runs over what the streamed log holds: each batch is written under path as batch=<its number>, one row for each key it has.

    A batch that is run again overwrites its own folder and nothing else, so a restart leaves the same state. current() reads the state, compact() keeps its folders few.
    """

    def upsert(batch: DataFrame, number: int) -> None:
        latest(batch, key, order).write.mode("overwrite").parquet(f"{path}/batch={number}")

    query = log.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def current(batches: DataFrame, key: str, order: list[str]) -> DataFrame:
    """S4. The state from the batches that keep_state wrote: of each key the row last by `order`, and by batch where that ties."""
    return latest(batches, key, [*order, "batch"]).drop("batch")


def compact(spark: SparkSession, path: str, key: str, order: list[str]) -> None:
    """S4. Leaves one batch folder under path, the last, with the current state of all. Run it between runs of keep_state.

    The state is written beside the batches first and then takes the last one's place, so a run that breaks off before leaves all batches as they were; the earlier ones
    go last, and what is left of them then holds nothing newer than the state.
    """
    batches = spark.read.parquet(path)
    last = batches.agg(F.max("batch")).first()[0]
    beside = f"{path}.compacting"
    current(batches, key, order).write.mode("overwrite").parquet(beside)
    jvm = spark._jvm.org.apache.hadoop.fs
    fs = jvm.Path(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    fs.delete(jvm.Path(f"{path}/batch={last}"), True)
    fs.rename(jvm.Path(beside), jvm.Path(f"{path}/batch={last}"))
    for status in fs.listStatus(jvm.Path(path)):
        name = status.getPath().getName()
        if name.startswith("batch=") and int(name.removeprefix("batch=")) < last:
            fs.delete(status.getPath(), True)


def top_keys(requests: DataFrame, key: str, weight: Column, k: int = 50, ts: str = "ts", late: str = "1 day", size: str = "7 days", slide: str = "1 day", salts: int = 16) -> DataFrame:
    """S1 to S3. (start, end, top) of sliding windows: top is an array of struct<weight, key>, the k keys of greatest summed weight, ties by key; one stream from requests (shaped, see logs.shaped) to report.

    Three stateful aggregations in a row under one watermark: sums of a window and key, the k best of each of `salts` parts of a window's keys, and the k best of these. On a stream (append mode) a window comes out once,
    when the watermark has passed it; what is later than that is dropped (see `dropped_rows`). Null keys, and rows without a time, are left out; a null weight adds nothing.
    """
    sums = requests.where(F.col(key).isNotNull()).withWatermark(ts, late).groupBy(F.window(ts, size, slide).alias("w"), F.col(key).alias("key")).agg(F.coalesce(F.sum(weight), F.lit(0.0)).alias("weight"))
    best = lambda items: F.slice(F.array_sort(items), 1, k)
    parts = sums.groupBy("w", F.pmod(F.xxhash64("key"), F.lit(salts)).alias("salt")).agg(best(F.collect_list(F.struct((-F.col("weight")).alias("minus"), "key"))).alias("few"))
    merged = parts.groupBy("w").agg(best(F.flatten(F.collect_list("few"))).alias("few"))
    return merged.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), F.transform("few", lambda x: F.struct((-x["minus"]).alias("weight"), x["key"].alias("key"))).alias("top"))


def dropped_rows(query: StreamingQuery) -> int:
    """How many rows were dropped as too late, in all batches that the query still tells of."""
    return sum(int(s["numRowsDroppedByWatermark"]) for p in query.recentProgress for s in json.loads(p.json if isinstance(p.json, str) else p.json())["stateOperators"])


class _Entries(StatefulProcessor):
    """The current entry of a key; see `entry_state`."""

    def __init__(self, fields: list[str], order: list[str], ttl_ms: int | None):
        self.fields, self.order, self.ttl_ms = fields, order, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.entry = handle.getValueState("entry", "entry string", self.ttl_ms)

    def _place(self, row: dict) -> tuple:
        return tuple((row[c] is not None, row[c]) if row[c] is not None else (False, 0) for c in self.order)

    def _keep(self, row: dict) -> None:
        self.entry.update((json.dumps(row),))
        if self.ttl_ms:
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)

    def _out(self, row: dict, status: str) -> Row:
        return Row(**{c: row[c] for c in self.fields}, status=status)

    def handleInputRows(self, key, rows, timers):
        held = json.loads(self.entry.get()[0]) if self.entry.exists() else None
        last = held
        for r in rows:
            row = r.asDict()
            if last is None or self._place(row) >= self._place(last):
                last = row
        if last is not None and last != held:
            self._keep(last)
            if self.ttl_ms:
                self.handle.registerTimer(timers.getCurrentProcessingTimeInMs() + self.ttl_ms)
            yield self._out(last, "new" if held is None else "changed")

    def handleInitialState(self, key, row, timers) -> None:
        self._keep({c: row[c] for c in self.fields})
        if self.ttl_ms:
            self.handle.registerTimer(timers.getCurrentProcessingTimeInMs() + self.ttl_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield Row(**{c: (key[0] if c == self.fields[0] else None) for c in self.fields}, status="expired")

    def close(self) -> None:
        pass


def entry_state(log: DataFrame, key: str, order: list[str], initial: DataFrame | None = None, ttl_ms: int | None = None) -> DataFrame:
    """S4. A stream of changes of an append-only log's current entries: the row that is now last by `order` (nulls first, ties to the later one) for each key that a batch changes, with status new or changed; rows that come
    late or again change nothing. The state is kept by Spark for each key, not in folders, and a restart goes on from the checkpoint.

    initial: the entries to begin with (log's columns, one row for each key). ttl_ms: how long an entry is held after its last change, by the clock; then the key is told once more, as expired, with nulls, and a later row
    is new again; such a query looks at the clock batch after batch, so it runs until it is stopped (an availableNow trigger doesn't end it). Values must be texts, whole numbers, floats or booleans. Needs spark.sql.streaming.stateStore.providerClass to be the RocksDB provider. Null keys go.
    """
    fields = [key, *[c for c in log.columns if c != key]]
    schema = StructType([*[StructField(f.name, f.dataType, True) for c in fields for f in [log.schema[c]]], StructField("status", StringType())])
    start = initial.select(*fields).groupBy(key) if initial is not None else None
    rows = log.select(*fields).where(F.col(key).isNotNull())
    return rows.groupBy(key).transformWithState(_Entries(fields, order, ttl_ms), schema, "Update", "ProcessingTime" if ttl_ms else "None", start)
