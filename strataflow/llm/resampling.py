"""Importance resampling towards a target: hashed n-gram weights from arrays of bucket gains, then an exact weighted median-of-medians cutoff."""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.common import ddl, discard, numbered, picked, with_columns, written
from strataflow.llm.decontamination import words_of

BUCKETS = 10_000
#: What is left of the keys is written anew once it is this share of the table that a round reads, if that table has so many rows.
SHRINK, SHRINK_ROWS = 1 / 8, 1_000_000
_NO_ID = 2**63 - 1


def features(words: list[bytes], grams: int, buckets: int) -> np.ndarray:
    """The bucket of each run of 1 to `grams` consecutive words, joined by one space."""
    runs = words if grams == 1 else [b" ".join(words[i : i + n]) for n in range(1, grams + 1) for i in range(len(words) - n + 1)]
    return np.fromiter(map(crc32, runs), np.int64, len(runs)) % buckets


def bucket_counts(texts: DataFrame, text: str = "text", grams: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts each bucket holds. A task hands on its sums, `buckets` rows at most."""

    def count(batches):
        seen = np.zeros(buckets, np.int64)
        for b in batches:
            for value in b.column(0):
                seen += np.bincount(features(words_of(value.as_py()), grams, buckets), minlength=buckets)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], names=["bucket", "n"])

    sums = texts.select(F.col(f"`{text}`").alias("t")).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(buckets, np.int64)
    out[sums["bucket"].to_numpy(np.int64)] = sums["n"].to_numpy(np.int64)
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of how much likelier each bucket is in the target, both smoothed by one feature a bucket."""
    n = float(len(source))
    ratio = (target + 1.0) * (float(source.sum()) + n) / ((source + 1.0) * (float(target.sum()) + n))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def score_texts(docs: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text: str = "text", grams: int = 1, seed: int = 2024) -> DataFrame:
    """docs without the text, with n_words, n_features, weight (sum of the features' gains) and score (weight plus noise that depends on seed and id alone).

    A task holds the gains' array and adds up what a text's buckets pick from it. The noise is Gumbel's, so the highest scores are a draw without replacement in
    proportion to exp(weight / 1000).
    """
    new = ("n_words", "n_features", "weight", "score")
    kept = [c for c in docs.columns if c not in (*new, text)]
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)], F.col(f"`{text}`").alias("text"))
    plain, n, held = ddl(rows.drop("text").schema), len(kept), docs.sparkSession.sparkContext.broadcast(gains)

    def weigh(batches):
        gain = held.value
        for b in batches:
            found = []
            for value in b.column(n):
                words = words_of(value.as_py())
                at = features(words, grams, len(gain))
                found.append((len(words), len(at), int(gain[at].sum())))
            made = np.array(found, np.int64).reshape(-1, 3)
            yield with_columns(b.select(range(n)), n_words=made[:, 0], n_features=made[:, 1], weight=made[:, 2])

    out = rows.mapInArrow(weigh, f"{plain}, n_words long, n_features long, weight long")
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"c{kept.index(id_col)}").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return out.withColumn("score", (F.col("weight") + noise).cast("long")).toDF(*kept, *new)


def draw(scored: DataFrame, percent: int = 10, least_words: int = 20, id_col: str = "doc_id") -> DataFrame:
    """scored with rank (1, 2, 3... by falling score, ties to the smaller id, null ids last, then by row; null where not drawn).

    Of the N rows with least_words words or more, floor(percent * N / 100) are drawn. Rows that repeat an id are rows of their own. An empty table gives no rows.
    An earlier column named rank is replaced.

    The last key to be drawn is found without a sort: each round, every task tells the medians of the keys that it still has on either side of the pivot and how many they are; the median of
    those on the cutoff's side, weighted by these numbers, is the next pivot. A quarter or more of the remaining keys lie on each side of it, so each round discards at least that
    share, until the pivot is the cutoff itself. The driver sees a row a task. Only winners are then sorted, in ranges, and numbered range by range.
    """
    kept = [c for c in scored.columns if c != "rank"]
    own = scored.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)])
    at = {c: f"c{i}" for i, c in enumerate(kept)}
    key = [F.col(at["score"]).alias("score"), F.coalesce(F.col(at[id_col]).cast("long"), F.lit(_NO_ID)).alias("id"), F.monotonically_increasing_id().alias("row")]
    eligible = F.coalesce(F.col(at["n_words"]) >= least_words, F.lit(False)).alias("eligible")
    rows = written(own.select("*", *key, eligible), "resample-rows")
    n = rows.where("eligible").count()
    cut = _cutoff(rows.where("eligible").select("score", "id", "row"), percent * n // 100, n)
    names = [f"c{i}" for i in range(len(kept))]
    if cut is None:
        return rows.select(*names, F.lit(None).cast("long")).toDF(*kept, "rank")
    s, i, r = cut
    wins = F.col("eligible") & ((F.col("score") > s) | ((F.col("score") == s) & ((F.col("id") < i) | ((F.col("id") == i) & (F.col("row") <= r)))))
    order = [F.desc("score"), "id", "row"]
    won = rows.where(wins).repartitionByRange(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *order).withColumn("part", F.spark_partition_id())
    won = written(won, "resample-winners")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    starts = won.groupBy("part").agg(F.count("*").alias("k")).select("part", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("first"))
    placed = won.withColumn("k", F.row_number().over(Window.partitionBy("part").orderBy(*order))).join(F.broadcast(starts), "part")
    ranked = placed.select(*names, (F.col("first") + F.col("k")).alias("rank"))
    return ranked.unionByName(rows.where(~wins).select(*names, F.lit(None).cast("long").alias("rank"))).toDF(*kept, "rank")


def _cutoff(keys: DataFrame, k: int, n: int) -> tuple[int, int, int] | None:
    """The k-th of n keys (score falling, id, row); None if k is 0."""
    if not k:
        return None
    low, high, pivot, above = None, None, None, 0  # what remains lies between low and high (first and last in order, both left out), after `above` keys
    table, size, own = keys, n, []
    while True:
        told = table.mapInArrow(_medians(low, high, pivot), "side int, n long, score long, id long, row long").collect()
        before = sum(t["n"] for t in told if t["side"] == 0)
        if pivot is not None:
            if above + before + 1 == k:
                break
            if above + before >= k:
                high, side = pivot, 0
            else:
                low, above, side = pivot, above + before + 1, 1
        else:
            side = 0
        left = sorted(((-t["score"], t["id"], t["row"]), t["n"]) for t in told if t["side"] == side and t["n"])
        total, seen = sum(x[1] for x in left), 0
        for (score, i, row), m in left:
            seen += m
            if 2 * seen >= total:
                pivot = (-score, i, row)
                break
        if size > SHRINK_ROWS and total < size * SHRINK:
            table, size = written(table.where(_between(low, high)), "resample-keys"), total
            own.append(table)
    discard(*own)
    return pivot


def _between(low, high):
    """Whether a key stands after low and before high."""
    after = lambda c: (F.col("score") < c[0]) | ((F.col("score") == c[0]) & ((F.col("id") > c[1]) | ((F.col("id") == c[1]) & (F.col("row") > c[2]))))
    out = F.lit(True)
    if low is not None:
        out &= after(low)
    if high is not None:
        out &= ~after(high) & ~((F.col("score") == high[0]) & (F.col("id") == high[1]) & (F.col("row") == high[2]))
    return out


def _medians(low, high, pivot):
    """For each side of the pivot (0: before it), how many of a task's remaining keys stand there, and the middle one."""

    def tell(batches):
        got = [np.stack([-b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy()]) for b in batches if b.num_rows]
        k = np.concatenate(got, axis=1) if got else np.empty((3, 0), np.int64)
        k = k[:, _after(k, low) & ~_after(k, high, True)]
        sides = [np.ones(k.shape[1], bool)] if pivot is None else [~_after(k, pivot, True), _after(k, pivot)]
        out = []
        for side, mask in enumerate(sides):
            part = k[:, mask]
            if part.shape[1]:
                mid = np.lexsort(part[::-1])[(part.shape[1] - 1) // 2]
                out.append((side, part.shape[1], -int(part[0, mid]), int(part[1, mid]), int(part[2, mid])))
        columns = list(zip(*out, strict=True)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int32(), *[pa.int64()] * 4], strict=True)], names=["side", "n", "score", "id", "row"])

    return tell


def _after(k: np.ndarray, c: tuple[int, int, int] | None, same: bool = False) -> np.ndarray:
    """Which keys (columns of negated score, id and row) stand after c (or, with same, at it); without c all do, with same none."""
    if c is None:
        return np.full(k.shape[1], not same)
    s, i, r = k[0], k[1], k[2]
    row = r >= c[2] if same else r > c[2]
    return (s > -c[0]) | ((s == -c[0]) & ((i > c[1]) | ((i == c[1]) & row)))


def importance_ranks(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, grams: int = 1, buckets: int = BUCKETS, seed: int = 2024, id_col: str = "doc_id", text: str = "text", target_text: str = "text") -> DataFrame:
    """docs without the text, with n_words, n_features, weight, score and rank (see `score_texts` and `draw`), for the draw of `percent` of docs that is likest the target texts.

    Features are hashed into `buckets` by crc32; all docs and all target texts are counted. Null and empty texts have no features and weigh 0; whole texts count, however long;
    an empty target, or one without words, makes all buckets' gains depend on docs alone; columns named like new ones are replaced.
    """
    gains = bucket_gains(bucket_counts(docs, text, grams, buckets), bucket_counts(target, target_text, grams, buckets))
    return draw(score_texts(docs, gains, id_col, text, grams, seed), percent, least_words, id_col)


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The drawn rows of docs, whole (texts and all columns), with score and rank; options as in `importance_ranks`. Texts that aren't drawn aren't moved."""
    table = numbered(docs, "resample-docs")
    own = table.select("row", F.col(f"own.`{id_col}`").alias("id"), F.col(f"own.`{text}`").alias("text"))
    ranks = written(importance_ranks(own, target, id_col="id", text="text", **options).where("rank is not null").select("row", "score", "rank"), "resample-ranks")
    rows = picked(table, ranks.select("row")).join(ranks.hint("shuffle_hash"), "row")
    kept = [c for c in docs.columns if c not in ("score", "rank")]
    return rows.select(*[F.col(f"own.`{c}`") for c in kept], "score", "rank").toDF(*kept, "score", "rank")
