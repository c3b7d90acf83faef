"""Sharding: a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import ddl, with_columns, written


def ring(shards: int, vnodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (signed 64-bit, ascending) of the virtual nodes and the shard of each. A shard's nodes don't depend on the shard count."""
    at = {
        int.from_bytes(hashlib.sha256(f"shard-{s}/node-{v}".encode()).digest()[:8], "big", signed=True): s
        for s in range(shards)
        for v in range(vnodes)
    }
    pos = np.array(sorted(at), np.int64)
    return pos, np.array([at[p] for p in pos.tolist()], np.int64)


def bounded_loads(counts: np.ndarray, owner: np.ndarray, shards: int, epsilon: float = 0.0) -> list[tuple[int, int, int, int, int]]:
    """Where the keys of each arc go: (arc, first rank, end rank, shard, first slot).

    Each shard takes keys of its own arcs until it is full; what is left over continues clockwise to the next node whose shard has
    room. With epsilon 0 the shards' counts differ by one at most; otherwise a shard holds at most (1 + epsilon) times the mean.
    """
    total = int(counts.sum())
    if epsilon:
        room = np.full(shards, int(np.ceil((1 + epsilon) * total / shards)), np.int64)
    else:
        room = total // shards + (np.arange(shards) < total % shards).astype(np.int64)
    used, out, over = np.zeros(shards, np.int64), [], []

    def put(arc: int, first: int, n: int, shard: int) -> int:
        take = int(min(n, room[shard] - used[shard]))
        if take > 0:
            out.append((arc, first, first + take, shard, int(used[shard])))
            used[shard] += take
        return max(take, 0)

    for arc in np.flatnonzero(counts).tolist():
        n = int(counts[arc])
        kept = put(arc, 0, n, int(owner[arc]))
        if kept < n:
            over.append((arc, kept, n))
    for arc, first, n in over:
        step = arc
        while first < n:
            step = (step + 1) % len(owner)
            first += put(arc, first, n - first, int(owner[step]))
    return out


def assign_shards(df: DataFrame, key: str = "doc_id", shards: int = 24, vnodes: int = 128, epsilon: float = 0.0) -> DataFrame:
    """df with shard (int) and slot (long, gapless from 0 in each shard).

    A key's place on the ring is a hash of `key`. Rows are range-partitioned along the ring, so each task holds a short run of arcs;
    the driver sees only row counts by task and arc (tasks + shards * vnodes numbers at most) and plans which ranks overflow where.
    Rows that share a key, or have none, take consecutive ranks of one arc and overflow like others; ties are broken by row number,
    so that even one key with most of the rows is spread over tasks and shards. Empty input gives an empty result. Columns of df
    named shard or slot are replaced.
    """
    spark = df.sparkSession
    names = [c for c in df.columns if c not in ("shard", "slot")]
    pos, owner = ring(shards, vnodes)
    row = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]  # own names, so that no column clashes
    placed = written(df.select(*row, F.xxhash64(F.col(f"`{key}`")).alias("pos"), F.monotonically_increasing_id().alias("tie")), "ring-keys")
    along = placed.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "pos", "tie").sortWithinPartitions("pos", "tie")

    def number(batches):
        part, last, n = TaskContext.get().partitionId(), -1, 0
        for b in batches:
            if not b.num_rows:
                continue
            arc = np.searchsorted(pos, b.column("pos").to_numpy(), side="left")
            new = np.flatnonzero(np.diff(arc, prepend=last))
            start = np.zeros(len(arc), np.int64)
            start[new] = new
            local = np.arange(len(arc)) - np.maximum.accumulate(start)
            local[: new[0] if len(new) else len(arc)] += n
            last, n = int(arc[-1]), int(local[-1]) + 1
            yield with_columns(b.drop_columns(["pos", "tie"]), arc=arc, part=np.full(len(arc), part), local=local)

    kept = placed.drop("pos", "tie").schema
    numbered = written(along.mapInArrow(number, f"{ddl(kept)}, arc long, part long, local long"), "ring-ranks")
    counts = numbered.groupBy("part", "arc").agg(F.count("*").alias("n")).toPandas().sort_values(["arc", "part"])
    counts["base"] = counts.groupby("arc")["n"].cumsum() - counts["n"]
    totals = np.bincount(counts["arc"], weights=counts["n"], minlength=len(pos) + 1).astype(np.int64)
    base = pd.Series(counts["base"].to_numpy(np.int64), index=pd.MultiIndex.from_frame(counts[["part", "arc"]]))
    # past the last node the ring closes: that arc belongs to the first node's shard
    plan = np.array(bounded_loads(totals, np.append(owner, owner[:1]), shards, epsilon), np.int64).reshape(-1, 5)
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
    at = plan[:, 0] * (1 << 40) + plan[:, 1]

    def assign(batches):
        for b in batches:
            if b.num_rows:
                arc, part = b.column("arc").to_numpy(), b.column("part").to_numpy()
                rank = b.column("local").to_numpy() + base.loc[pd.MultiIndex.from_arrays([part, arc])].to_numpy()
                seg = plan[np.searchsorted(at, arc * (1 << 40) + rank, side="right") - 1]
                yield with_columns(b.drop_columns(["arc", "part", "local"]), shard=seg[:, 3].astype(np.int32), slot=seg[:, 4] + rank - seg[:, 1])

    out = numbered.mapInArrow(assign, f"{ddl(kept)}, shard int, slot long")
    return out.toDF(*names, "shard", "slot")
