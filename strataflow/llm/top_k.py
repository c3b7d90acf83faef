"""Exact top-k inner products: vectors in norm buckets, pruned per bucket by length or by coordinates, then verified in integers."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.common import attach, discard, written

#: Norm buckets, rows of a block of vectors and queries of a group at most, and bytes of either.
BUCKETS, BLOCK_ROWS, QUERY_ROWS, BLOCK_BYTES = 64, 16_384, 4_096, 8_000_000
#: Vectors that give first thresholds: so many of a dimension, for so many dimensions (the commonest), so many bytes in all.
SEEDS, SEED_DIMS, SEED_BYTES = 1_024, 16, 64_000_000
#: Coordinates of the query that are looked at, what looking at one costs for each vector (in multiplications of a product), and the vectors of a block on which it is tried out how many such a look leaves.
FOCUS, LOOK, TRIED = 4, 4, 256
#: Queries whose products with a block are made at a time.
TOGETHER = 64
#: Products that stay below this are exact in doubles, in whatever order they are added up.
EXACT_BELOW = float(2**53)
_HALF = 1 << 62


def quantised(vectors: DataFrame, id_col: str, vector: str, scale: int) -> DataFrame:
    """(id, v, norm, dim, salt): v holds floor(scale * x) as doubles (whole numbers, exact at any size), of vectors without null or non-finite components; null and
    empty ones go. salt tells rows apart that are equal in everything."""
    whole = F.transform(F.col(f"`{vector}`"), lambda x: F.lit(float(scale)) * x.cast("double"))
    whole = F.transform(whole, lambda x: F.when(F.abs(x) < EXACT_BELOW, F.floor(x).cast("double")).otherwise(x))
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), whole.alias("v")).where("id is not null and size(v) > 0")
    rows = rows.where(~F.coalesce(F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(True)))
    return rows.withColumn("norm", _norm("v")).withColumn("dim", F.size("v")).withColumn("salt", F.monotonically_increasing_id())


def _norm(v: str):
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))


def exact_top_k(vectors: DataFrame, k: int = 10, query_every: int = 100, id_col: str = "vec_id", vector: str = "embedding", scale: int = 1024, report: dict | None = None) -> DataFrame:
    """(query_id, rank, id, score): for each row whose id is divisible by query_every, the k rows of other ids with the greatest integer inner product.

    Ties go to the smaller id; a query with fewer than k candidates has them all. Vectors that are null, empty or hold null or non-finite
    components (also after scaling) take no part, nor do null ids. Only vectors of the query's dimension are compared, of any length. Rows that repeat an id are candidates
    each; repeated query ids count once, with the greatest vector. Empty input gives an empty result; other columns, whatever their names, play no part.
    Products are whole numbers and ordered exactly up to 124 bits (beyond, they count as equal); a score that no long holds is the nearest long.

    Vectors go to BUCKETS buckets of near norm (edges by approximate quantiles) and each bucket to blocks of rows (BLOCK_ROWS, fewer if long vectors) by a
    number of the row, so neither a norm nor a row that most vectors share is in one block. A bounded sample of all vectors gives each query a first
    lower bound of its k-th score. Queries that need about the same norms are put in groups; a group and a block meet only if the bucket's greatest norm
    can reach what the group's least demanding query needs, and a task holds one of each. Each group first searches one block of the longest vectors, which raises its queries' bounds; then the other
    blocks that can still reach them. There the bound over both norms is a local cosine threshold: it says how many of the block's vectors are long enough, and, tried out on some of these, how many the
    query's FOCUS largest coordinates would leave. Where that look costs less than it saves, coordinates prune, else the length alone does; what is left is multiplied out. Each block hands on at most k rows of
    a query.

    report: a dict that gets the numbers of pairs there are, that met in a task, that lengths left and that were multiplied out.
    """
    spark = vectors.sparkSession
    rows = written(quantised(vectors, id_col, vector, scale), "top-k-vectors")
    edges = rows.groupBy("dim").agg(F.array_distinct(F.percentile_approx("norm", [i / BUCKETS for i in range(1, BUCKETS)], 10_000)).alias("edges"), F.count("*").alias("n"))
    edges = written(edges, "top-k-edges")
    placed = attach(rows, edges, "dim", "n").withColumn("bucket", F.size(F.filter("edges", lambda e: e < F.col("norm")))).drop("edges", "n")
    sizes = placed.groupBy("dim", "bucket").agg(F.max("norm").alias("top"), F.count("*").alias("n"), F.ceil(F.count("*") / F.least(F.lit(BLOCK_ROWS), F.greatest(F.lit(1), F.floor(BLOCK_BYTES / (8 * F.col("dim")))))).cast("int").alias("parts"))
    sizes = written(sizes.withColumn("key", F.struct("dim", "bucket")), "top-k-buckets")
    placed = placed.withColumn("key", F.struct("dim", "bucket"))
    blocks = attach(placed, sizes.select("key", "n", "parts"), "key", "n").withColumn("part", F.pmod(F.xxhash64("salt"), F.col("parts")).cast("int"))
    blocks = blocks.select("dim", "bucket", "part", "id", "v", "norm")

    held = spark.sparkContext.broadcast(_seeds(rows, sizes, k))

    def bound(batches):
        for q in batches:
            floor = np.full(len(q), -np.inf)
            for dim, at in q.groupby("dim").indices.items():
                if int(dim) in held.value:
                    ids, m, longest = held.value[int(dim)]
                    s = np.stack(q["v"].to_numpy()[at]) @ m.T
                    s[q["id"].to_numpy()[at][:, None] == ids[None, :]] = -np.inf
                    floor[at] = -np.partition(-s, k - 1, axis=1)[:, k - 1] - (dim + 2) * 2.0**-52 * q["q_norm"].to_numpy()[at] * longest
            yield q.assign(floor=floor, need=np.where((q["q_norm"] > 0) & (floor > 0), floor / np.maximum(q["q_norm"], 1e-300), 0.0))

    queries = rows.where(F.col("id") % query_every == 0).groupBy("id").agg(F.max("v").alias("v")).withColumn("dim", F.size("v")).withColumn("q_norm", _norm("v"))
    asked = written(queries.mapInPandas(bound, "id long, v array<double>, dim int, q_norm double, floor double, need double"), "top-k-bounds")
    most = asked.agg(F.count("*").alias("n"), F.max("dim").alias("d")).first()
    groups = max(1, -(-most["n"] // max(1, min(QUERY_ROWS, BLOCK_BYTES // (8 * (most["d"] or 1))))))
    asked = written(asked.repartitionByRange(groups, "dim", "need", "id").withColumn("group", F.spark_partition_id()), "top-k-queries")
    cell = ["dim", "bucket", "part", "group"]

    def cells_of(queries: DataFrame) -> DataFrame:
        least = queries.groupBy("dim", "group").agg(F.min("need").alias("need"))
        met = sizes.join(least, "dim").where(F.col("top") * (1 + 1e-9) >= F.col("need"))  # BUCKETS rows at most for each group and dimension
        return met.select("dim", "bucket", "group", "top", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))

    def search(key, q: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(q) and len(p):
            p = p.sort_values(["norm", "id"], ascending=[False, True])
            ids, m = _matrix(p)
            out = _search_block(q, ids, m, np.maximum(p["norm"].to_numpy(), 1e-300), k)
        return pd.DataFrame(out, columns=["query_id", "id", "high", "low"])

    def searched(queries: DataFrame, cells: DataFrame, name: str) -> DataFrame:
        to, spread = queries.join(cells, ["dim", "group"]), blocks.join(cells, ["dim", "bucket", "part"])
        return written(to.groupBy(*cell).cogroup(spread.groupBy(*cell)).applyInPandas(search, "query_id long, id long, high long, low long"), name)

    one = written(cells_of(asked).groupBy("dim", "group").agg(F.max(F.struct("top", "bucket", (-F.col("part")).alias("p"))).alias("c")).select("dim", "group", "c.bucket", (-F.col("c.p")).alias("part")), "top-k-first-cells")
    first = searched(asked, one, "top-k-first")
    order = Window.partitionBy("query_id").orderBy(F.desc("high"), F.desc("low"), "id")
    kth = first.where("query_id is not null").withColumn("rank", F.row_number().over(order)).where((F.col("rank") == k) & (F.col("high") > -_HALF)).select(F.col("query_id").alias("id"), (F.col("high") * float(_HALF) + F.col("low")).alias("found"))
    # the k-th score found, less what its being a double may have added
    raised = F.greatest("floor", F.coalesce(F.col("found") - F.abs("found") * 2.0**-50, F.col("floor")))
    again = asked.join(kth, "id", "left").withColumn("floor", raised).drop("found")
    again = written(again.withColumn("need", F.when((F.col("q_norm") > 0) & (F.col("floor") > 0), F.col("floor") / F.greatest("q_norm", F.lit(1e-300))).otherwise(0.0)), "top-k-raised")
    cells = written(cells_of(again).drop("top").join(one, cell, "left_anti"), "top-k-cells")
    rest = searched(again, cells, "top-k-rest")
    found = first.unionByName(rest)
    if report is not None:
        n = rows.groupBy("dim").agg(F.count("*").alias("n")).join(asked.groupBy("dim").agg(F.count("*").alias("q")), "dim").agg(F.sum(F.col("n") * F.col("q")).alias("x")).first()["x"] or 0
        told = {r["id"]: r["x"] for r in found.where("query_id is null").groupBy("id").agg(F.sum("high").alias("x")).collect()}
        report.update(pairs=n, met=told.get(0, 0), long_enough=told.get(1, 0), multiplied=told.get(2, 0), by_coordinates=told.get(3, 0))
    found = found.where("query_id is not null")
    score = F.when(F.col("high") > 1, F.lit(2**63 - 1)).when(F.col("high") < -2, F.lit(-(2**63))).otherwise(F.col("high") * _HALF + F.col("low"))
    out = written(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "id", score.alias("score")), "top-k")
    discard(rows, edges, sizes, asked, one, first, again, cells, rest)
    return out


def _seeds(rows: DataFrame, sizes: DataFrame, k: int) -> dict[int, tuple[np.ndarray, np.ndarray, float]]:
    """For the commonest dimensions, ids and vectors of a bounded sample of all rows, and the greatest norm."""
    last = sizes.groupBy("dim").agg(F.sum("n").alias("all"), F.max("top").alias("top")).orderBy(F.desc("all"), "dim").limit(SEED_DIMS).collect()
    out = {}
    for d in last:
        most = min(SEEDS, SEED_BYTES // (8 * d["dim"] * len(last)))
        share = F.pmod(F.xxhash64("salt"), F.lit(max(1, d["all"]))) < most
        ids, m = _matrix(rows.where((F.col("dim") == d["dim"]) & share).select("id", "v").limit(most).toPandas())
        if len(ids) > k:  # one may be the query's own
            out[d["dim"]] = (ids, m, d["top"])
    return out


def _matrix(p: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    return p["id"].to_numpy(np.int64), np.stack(p["v"].to_numpy()).astype(np.float64) if len(p) else np.empty((0, 0))


def _search_block(q: pd.DataFrame, ids: np.ndarray, m: np.ndarray, norms: np.ndarray, k: int) -> list[tuple]:
    """The k best of one block for each query, as (query, id, high and low part of the score), and, without a query, how many pairs met (0), were long enough (1), were multiplied out (2) and were left
    by coordinates (3). norms descend."""
    out, told, rows = [], np.zeros(4, np.int64), []
    unit = None
    for qid, v, q_norm, floor in zip(q["id"], q["v"], q["q_norm"], q["floor"], strict=True):
        v = np.asarray(v, np.float64)
        keep, looked = np.arange(len(ids)), False
        if q_norm > 0 and floor > 0:
            keep = keep[: np.searchsorted(-norms, -floor / q_norm * (1 - 1e-9), side="right")]  # length: only so long a vector can reach the floor
            told[1] += len(keep)
            if FOCUS * LOOK < len(v) and len(keep):
                unit = m / norms[:, None] if unit is None else unit
                tried = keep[:: max(1, len(keep) // TRIED)]
                left = len(_look(v, q_norm, floor, unit, norms, tried)) / len(tried)
                if FOCUS * LOOK + left * len(v) < len(v):
                    keep, looked = _look(v, q_norm, floor, unit, norms, keep), True
                    told[3] += len(keep)
        else:
            told[1] += len(keep)
        told[0] += len(ids)
        told[2] += len(keep)
        rows.append((int(qid), v, float(q_norm), float(floor), keep, looked))
    plain = sorted((r for r in rows if not r[5]), key=lambda r: len(r[4]))
    for i in range(0, len(plain), TOGETHER):  # lengths leave the first vectors of a block: one product for many queries
        part = plain[i : i + TOGETHER]
        products = m[: len(part[-1][4])] @ np.stack([r[1] for r in part]).T
        for j, (qid, v, q_norm, floor, keep, _) in enumerate(part):
            out += _best(qid, v, q_norm, floor, ids, m, norms, keep, products[: len(keep), j], k)
    for qid, v, q_norm, floor, keep, looked in rows:
        if looked:
            out += _best(qid, v, q_norm, floor, ids, m, norms, keep, m[keep] @ v, k)
    return out + [(None, i, int(n), 0) for i, n in enumerate(told)]


def _look(v: np.ndarray, q_norm: float, floor: float, unit: np.ndarray, norms: np.ndarray, keep: np.ndarray) -> np.ndarray:
    """Those of `keep` whose part of the cosine in the query's largest coordinates, with the most that the rest can add (Cauchy-Schwarz), reaches the local threshold."""
    t = np.minimum(floor / (q_norm * norms[keep]), 1.0)
    rest_q, rest_p, reached = 1.0, np.ones(len(keep)), np.zeros(len(keep))
    for f in np.argsort(-np.abs(v))[:FOCUS]:
        c, u = v[f] / q_norm, unit[keep, f]
        reached += c * u
        rest_q -= c * c
        rest_p -= u * u
        ok = reached + np.sqrt(max(rest_q, 0.0) * np.maximum(rest_p, 0.0)) >= t - 1e-9
        keep, t, rest_p, reached = keep[ok], t[ok], rest_p[ok], reached[ok]
    return keep


def _best(qid, v, q_norm, floor, ids, m, norms, keep, score, k) -> list[tuple[int, int, int, int]]:
    """The k best of the rows in keep (ascending places) by their products, exact; rows below `floor` aren't needed."""
    own = ids[keep] == qid
    if own.any():
        keep, score = keep[~own], score[~own]
    if not len(keep):
        return []
    size = q_norm * norms[keep[0]]  # keep ascends, so norms[keep] descends
    if size * (1 + 1e-9) < EXACT_BELOW:
        some = np.arange(len(keep))
        if len(keep) > 8 * k:  # ties at the last place all stay in
            some = np.flatnonzero(score >= -np.partition(-score, k - 1)[k - 1])
        best = some[np.lexsort((ids[keep[some]], -score[some]))[:k]]
        exact = [(int(score[b]), int(ids[keep[b]])) for b in best if score[b] >= floor]
    else:  # doubles only say which may be among the best; these are multiplied out in whole numbers
        off = (len(v) + 2) * 2.0**-52 * size
        least = np.partition(-score, k - 1)[k - 1] * -1 - 2 * off if len(score) > k else -np.inf
        whole = [int(x) for x in v]
        exact = [(sum(a * int(b) for a, b in zip(whole, m[i], strict=True)), int(ids[i])) for i in keep[score >= least].tolist()]
        exact = sorted(exact, key=lambda s: (-s[0], s[1]))[:k]
    return [(qid, i, max(min(s // _HALF, _HALF), -_HALF), s % _HALF if abs(s) < 1 << 124 else 0) for s, i in exact]
