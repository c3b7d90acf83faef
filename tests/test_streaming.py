import datetime
import time

import pytest
from pyspark.sql import functions as F

from strataflow.streaming import jobs


def test_popularity_windows(spark):
    rows = [("2026-01-01 00:00:00", "a", 2.0), ("2026-01-03 00:00:00", "a", 3.0), ("2026-01-03 00:00:00", "b", None), (None, "a", 9.0)]
    df = spark.createDataFrame(rows, "ts string, key string, w double").withColumn("ts", F.to_timestamp("ts"))
    out = {(str(r.start)[:10], r.key): r.weight for r in jobs.popularity(df, "key", F.col("w")).collect()}
    assert out["2026-01-01", "a"] == 5.0 and out["2026-01-02", "a"] == 3.0 and out["2026-01-03", "b"] is None
    assert sum(v for (_, k), v in out.items() if k == "a") == 7 * 5.0


def test_state_survives_a_second_batch(spark, tmp_path):
    schema = "seq long, key string, size long"
    source, path, checkpoint = (str(tmp_path / n) for n in ("log", "state", "checkpoint"))
    for rows in ([(1, "a", 10), (2, "b", 20), (3, "a", 11), (4, None, 1)], [(5, "b", 21), (6, "c", None)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        jobs.keep_state(spark.readStream.schema(schema).parquet(source), path, checkpoint, "key", ["seq"])
    out = jobs.current(spark.read.parquet(path), "key", ["seq"])
    assert sorted(map(tuple, out.collect())) == [(3, "a", 11), (5, "b", 21), (6, "c", None)]
    jobs.compact(spark, path, "key", ["seq"])
    assert [r.batch for r in spark.read.parquet(path).select("batch").distinct().collect()] == [1]
    spark.createDataFrame([(7, "a", 12)], schema).coalesce(1).write.mode("append").parquet(source)
    jobs.keep_state(spark.readStream.schema(schema).parquet(source), path, checkpoint, "key", ["seq"])
    out = jobs.current(spark.read.parquet(path), "key", ["seq"])
    assert sorted(map(tuple, out.collect())) == [(5, "b", 21), (6, "c", None), (7, "a", 12)]


def test_popularity_as_a_stream(spark, tmp_path):
    """Windows come out once, when the watermark has passed them; a row that is late beyond it changes nothing."""
    schema = "ts timestamp, key string, w double"
    source, out, checkpoint = (str(tmp_path / n) for n in ("requests", "windows", "checkpoint"))
    for rows in ([("2026-01-01", "a", 2.0), ("2026-01-02", "a", 3.0)], [("2026-03-01", "b", 1.0)], [("2026-01-01", "a", 50.0), ("2026-06-01", "c", 1.0)], [("2026-06-02", "c", 1.0)]):
        spark.createDataFrame(rows, "ts string, key string, w double").withColumn("ts", F.to_timestamp("ts")).coalesce(1).write.mode("append").parquet(source)
        seen = jobs.popularity(spark.readStream.schema(schema).parquet(source), "key", F.col("w"))
        seen.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(out)
    assert {(str(r.start)[:10]): r.weight for r in got.where("key = 'a'").collect()} == {f"2025-12-{26 + d}": 2.0 for d in range(1)} | {f"2025-12-{27 + d}": 5.0 for d in range(5)} | {"2026-01-01": 5.0, "2026-01-02": 3.0}
    assert got.where("key = 'b'").count() == 7 and got.groupBy("start", "key").count().where("count > 1").count() == 0


def test_latest_of_nothing(spark):
    assert jobs.latest(spark.createDataFrame([], "k string, n int"), "k", ["n"]).count() == 0


def add(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def test_top_keys_in_one_stream(spark, tmp_path):
    """From requests to each window's best keys in one query, equal to a batch over the rows that weren't too late; those that were are counted."""
    schema, out = "ts timestamp, key string, w double", {}
    source, sink, checkpoint = (str(tmp_path / n) for n in ("log", "out", "checkpoint"))
    day = lambda d: datetime.datetime(2026, 1, d)
    batches = [[(day(2), f"k{i:03d}", float(i % 7)) for i in range(100)] + [(day(2), "k001", 100.0), (day(2), None, 9.0)], [(day(20), "a", 1.0), (day(20), "b", 1.0), (day(20), "c", None)], [(day(1), "k001", 500.0), (day(28), "z", 1.0)], [(day(31), "z", 1.0)]]
    dropped = 0
    for rows in batches:
        add(spark, source, rows, schema)
        top = jobs.top_keys(spark.readStream.schema(schema).parquet(source), "key", F.col("w"), k=3, salts=4)
        query = top.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination()
        dropped += jobs.dropped_rows(query)
    got = {str(r.start)[:10]: [(x.weight, x.key) for x in r.top] for r in spark.read.parquet(sink).collect()}
    on_time = spark.createDataFrame([r for b in (0, 1) for r in batches[b]], schema)
    for r in jobs.top_keys(on_time, "key", F.col("w"), k=3, salts=4).collect():
        out[str(r.start)[:10]] = [(x.weight, x.key) for x in r.top]
    assert dropped > 0 and got["2026-01-02"] == [(101.0, "k001"), (6.0, "k006"), (6.0, "k013")]
    assert {k: v for k, v in got.items() if k <= "2026-01-20"} == {k: v for k, v in out.items() if k <= "2026-01-20"}
    assert got["2026-01-20"] == [(1.0, "a"), (1.0, "b"), (0.0, "c")]


@pytest.fixture
def rocks(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield
    spark.conf.unset(name)


ENTRY = "key string, seq long, size long"


def run_entries(spark, tmp_path, name="a", **options):
    changes: list = []
    log = spark.readStream.schema(ENTRY).parquet(str(tmp_path / "log"))
    query = jobs.entry_state(log, "key", ["seq"], **options).writeStream.outputMode("update").foreachBatch(lambda b, _: changes.extend(tuple(r) for r in b.collect())).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
    query.awaitTermination()
    return sorted(changes, key=str)


def test_entry_state(spark, tmp_path, rocks):
    """The state goes on over restarts: later rows change it, rows that come late or again don't, and the initial state counts as seen."""
    log = str(tmp_path / "log")
    initial = spark.createDataFrame([("old", 5, 50), ("kept", 9, 90)], ENTRY)
    add(spark, log, [("a", 1, 10), ("a", 3, 11), ("b", 2, None), (None, 4, 1), ("old", 4, 40), ("kept", 10, 91)], ENTRY)
    assert run_entries(spark, tmp_path, initial=initial) == [("a", 3, 11, "new"), ("b", 2, None, "new"), ("kept", 10, 91, "changed")]
    add(spark, log, [("a", 2, 99), ("b", 2, None), ("b", None, 7), ("c", 1, 1)], ENTRY)
    assert run_entries(spark, tmp_path, initial=initial) == [("c", 1, 1, "new")]
    add(spark, log, [("a", 3, 12), ("old", 6, 60)], ENTRY)
    assert run_entries(spark, tmp_path, initial=initial) == [("a", 3, 12, "changed"), ("old", 6, 60, "changed")]
    assert run_entries(spark, tmp_path, initial=initial) == []


def test_entry_state_expires(spark, tmp_path, rocks):
    """An entry that nothing changes for its time is told once more, as expired; what was older is new after that."""
    log, changes = str(tmp_path / "log"), []
    add(spark, log, [("a", 5, 10)], ENTRY)
    state = jobs.entry_state(spark.readStream.schema(ENTRY).parquet(log), "key", ["seq"], ttl_ms=1500)
    query = state.writeStream.outputMode("update").foreachBatch(lambda b, _: changes.extend(tuple(r) for r in b.collect())).option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="200 milliseconds").start()

    def wait(change):
        until = time.time() + 60
        while change not in changes and time.time() < until and query.isActive:
            time.sleep(0.2)

    try:
        wait(("a", None, None, "expired"))
        add(spark, log, [("a", 1, 2)], ENTRY)
        wait(("a", 1, 2, "new"))
    finally:
        query.stop()
    assert changes[:3] == [("a", 5, 10, "new"), ("a", None, None, "expired"), ("a", 1, 2, "new")]
