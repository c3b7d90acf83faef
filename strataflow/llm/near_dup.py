"""MinHash near-duplicates: circulant permutations, banding, exact Jaccard on full shingle sets, connected components."""

from __future__ import annotations

import hashlib
import re
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from strataflow.llm.common import HOT_SHARE, attach, discard, numbered, picked, written

_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
#: Bands of ROWS coordinates each: a pair at similarity 0.8 shares none with a chance of 8e-6; at 0.3 it shares one with a chance of 0.4 %.
BANDS, ROWS = 64, 8
#: Positions that shingles are hashed to; both permutations run over them.
UNIVERSE = 1 << 20
#: One bit of each coordinate estimates similarity (standard deviation at 0.8: 0.027); pairs whose estimate is below 0.8 by SLACK (4.5 deviations) are passed over.
SLACK = 0.12
#: Members of a bucket, and shingles of theirs, that a task holds at a time; members that pass by them in one task.
BLOCK, BLOCK_SHINGLES, STREAM = 4096, 4_000_000, 16_384
#: Pairs that are looked at together.
LOOK = 65_536
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    """Words of a text: A-Z lower-cased, parted by ASCII white space. In UTF-8."""
    return _WORDS.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []


def shingles(words: list[bytes], size: int) -> set[bytes]:
    """Distinct runs of `size` words; of fewer words the whole sequence."""
    if not words:
        return set()
    return {b" ".join(words)} if len(words) < size else set(map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False)))


def _mix(h: np.ndarray) -> np.ndarray:
    h = h * _MULTIPLY
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def hashes(words: list[bytes], size: int) -> np.ndarray:
    """Distinct 64-bit hashes of the shingles, ascending: of each word, BLAKE2b (remembered for common ones), mixed by place."""
    if not words:
        return np.empty(0, np.uint64)
    if len(_KNOWN) > 300_000:
        _KNOWN.clear()
    for w in set(words).difference(_KNOWN):
        _KNOWN[w] = int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little")
    h = np.array(list(map(_KNOWN.__getitem__, words)), np.uint64)
    n = min(size, len(h))
    out = np.full(len(h) - n + 1, n if len(h) < size else 0, np.uint64)
    for i in range(n):
        out = _mix(out ^ h[i : len(h) - n + 1 + i]) + np.uint64(i)
    return np.unique(out)


_KNOWN: dict[bytes, int] = {}


class Circulant:
    """Signatures from two permutations: one spreads positions, the other, shifted by k places, gives coordinate k."""

    def __init__(self, coordinates: int):
        random = np.random.default_rng(20)
        self.first = random.permutation(UNIVERSE).astype(np.uint32)
        second = random.permutation(UNIVERSE).astype(np.uint32)
        # window k of a position holds the second permutation at position - 0, - 1, ...: reversed, so that windows are runs in memory
        self.shifted = np.lib.stride_tricks.sliding_window_view(np.concatenate([second[::-1], second[::-1][:coordinates]]), coordinates)
        self.coordinates = coordinates

    def signature(self, h: np.ndarray) -> np.ndarray:
        out = np.full(self.coordinates, UNIVERSE, np.uint32)
        at = UNIVERSE - 1 - self.first[(h >> np.uint64(44)).astype(np.int64) & (UNIVERSE - 1)].astype(np.int64)
        for i in range(0, len(at), 512):
            np.minimum(out, self.shifted[at[i : i + 512]].min(axis=0), out=out)
        return out


def _features(table: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """(row, id, n, same, bands, sketch) of each row: set size, digest of the word sequence, a hash for each band, one bit for each coordinate."""

    def make(batches):
        circulant, band = Circulant(BANDS * ROWS), np.arange(BANDS, dtype=np.uint64)
        bits = (BANDS * ROWS) // 64
        for b in batches:
            made = []
            for value in b.column(2):
                words = words_of(value.as_py())
                h = hashes(words, size)
                bands = sketch = None
                if len(h):
                    s = circulant.signature(h)
                    mixed = band.copy()
                    for r in s.reshape(BANDS, ROWS).astype(np.uint64).T:
                        mixed = _mix(mixed ^ r)
                    bands = mixed.view(np.int64)
                    odd = _mix(s.astype(np.uint64)) >> np.uint64(63)
                    sketch = np.packbits(odd.astype(np.uint8)).view(">i8").astype(np.int64)[:bits]
                made.append((len(h), hashlib.blake2b(b" ".join(words), digest_size=16).digest() if words else None, bands, sketch))
            kinds = (pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*b.columns[:2], *(pa.array([m[i] for m in made], t) for i, t in enumerate(kinds))], names=["row", "id", "n", "same", "bands", "sketch"])

    rows = table.select("row", F.col(f"own.`{doc_id}`").cast("long").alias("id"), F.col(f"own.`{text}`").alias("text"))
    return rows.mapInArrow(make, "row long, id long, n long, same binary, bands array<long>, sketch array<long>")


def _sets(table: DataFrame, nodes: DataFrame, text: str, size: int) -> DataFrame:
    """(node, set) of the whole texts of the wanted rows; texts stay where they are (see `picked`)."""

    def make(batches):
        for b in batches:
            sets = [hashes(words_of(v.as_py()), size).tobytes() for v in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.binary())], names=["node", "set"])

    return picked(table, nodes.select(F.col("node").alias("row"))).select("row", F.col(f"own.`{text}`")).mapInArrow(make, "node long, set binary")


def _confirm(pairs: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """The pairs (a, b) whose sets have 100 * intersection >= least * union. b has few pairs; an `a` with many is split by AQE, as its set is one row."""

    def check(batches):
        for b in batches:
            keep = [_similar(x, y, least) for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
            yield b.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(sets.select(F.col("node").alias("b"), F.col("set").alias("sb")), "b").join(sets.select(F.col("node").alias("a"), F.col("set").alias("sa")), "a")
    return both.select("a", "b", "sa", "sb").mapInArrow(check, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id of the edges (a, b): the smallest id reachable.

    Alternating large-star and small-star steps (connected components by MapReduce, Kiveris et al. 2014), each written once; after about log of the
    longest path they change nothing. The least neighbour of a star is found by partial aggregation. Where it is joined back to the star's edges it is one row for a
    node, so that AQE splits the partition of a star that many edges meet in.
    """
    now, before = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"), None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small_least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        state = Observation()
        then = written(small.observe(state, F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")), "stars")
        discard(now)
        now = then
        if state.get == before:
            return now.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("id"), "component").unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
        before = state.get


def _buckets(features: DataFrame) -> DataFrame:
    """(bucket, node, n, hub, members) of band buckets with two nodes or more; the hub is the smallest. Buckets with HOT_SHARE of all rows are joined by broadcast."""
    rows = features.select("node", "n", F.explode("bands").alias("bucket"))
    hubs = written(rows.groupBy("bucket").agg(F.min("node").alias("hub"), F.count("*").alias("members")).where("members > 1"), "hubs")
    hot = F.col("members") >= features.count() * BANDS * HOT_SHARE
    apart = rows.join(F.broadcast(hubs.where(hot).select("bucket")), "bucket", "left_anti").join(hubs.where(~hot), "bucket")
    out = written(rows.join(F.broadcast(hubs.where(hot)), "bucket").unionByName(apart).select("bucket", "node", "n", "hub", "members"), "buckets")
    discard(hubs)
    return out


def _mixed(members: DataFrame, labels: DataFrame, features: DataFrame) -> DataFrame:
    """(bucket, members, held, held_n, top, node, component, weight, n, sketch, bands) of the buckets whose members aren't all in one component.

    weight is a component's size, top the bucket's heaviest component, held and held_n the numbers of members outside it and of their shingles.
    """
    sizes = written(labels.groupBy("component").agg(F.count("*").alias("weight")), "sizes")
    of_node = attach(labels, sizes, "component", "weight").withColumnRenamed("id", "node")
    rows = members.select("bucket", "node", "n").join(of_node, "node", "left")
    rows = written(rows.select("bucket", "node", "n", F.coalesce("component", "node").alias("component"), F.coalesce("weight", F.lit(1)).alias("weight")), "members")
    parts = rows.groupBy("bucket", "component", "weight").agg(F.count("*").alias("k"), F.sum("n").alias("n"))
    tops = parts.groupBy("bucket").agg(F.max(F.struct("weight", "component", "k", "n")).alias("top"), F.sum("k").alias("members"), F.sum("n").alias("n"), F.count("*").alias("parts")).where("parts > 1")
    tops = written(tops.select("bucket", "members", (F.col("members") - F.col("top.k")).alias("held"), (F.col("n") - F.col("top.n")).alias("held_n"), F.col("top.component").alias("top")), "tops")
    mixed = attach(rows, tops, "bucket", "members").where("top is not null")
    out = written(mixed.join(features.select("node", "sketch", "bands"), "node"), "mixed")
    discard(sizes, rows, tops)
    return out


def _parts(count: str, most: int):
    """The smallest power of two of parts with about `most` of `count` each."""
    return F.pow(F.lit(2), F.ceil(F.log2(F.greatest(F.col(count) / most, F.lit(1))))).cast("int")


_ROW = ["bucket", "block", "split", "side", "node", "component", "weight", "n", "sketch", "bands"]
_ROW_DDL = "bucket long, block int, split int, side int, node long, component long, weight long, n long, sketch array<long>, bands array<long>"


def _dealt(rows: DataFrame) -> DataFrame:
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "bucket", "block", "split").sortWithinPartitions("bucket", "block", "split", "side")


def _further_links(mixed: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """Links (a, b) between nodes that share a bucket but no component: enough of them that all nodes that are to be in one component get there.

    A pair is looked at by the node whose component is the lighter, so of a bucket only the members outside its heaviest component are held, and all
    pass by them: in a grid of blocks of held and splits of passing nodes, so that no task has all of a large bucket. Of the buckets that a pair
    shares only the first band's counts. First, sizes and sketches say which nodes have a possible partner in a cell of the grid; only these go there again with their
    sets, and their possible pairs are confirmed, the likeliest first, but for those whose components have met in this task.
    """
    blocks, splits = F.greatest(_parts("held", BLOCK), _parts("held_n", BLOCK_SHINGLES)), _parts("members", STREAM)
    dealt_by = F.xxhash64("node")
    held = mixed.where("component <> top").withColumn("side", F.lit(0)).withColumn("block", F.pmod(dealt_by, blocks).cast("int")).withColumn("split", F.explode(F.sequence(F.lit(0), splits - 1)))
    passing = mixed.withColumn("side", F.lit(1)).withColumn("split", F.pmod(dealt_by, splits).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    most = int(BANDS * ROWS * (1 - (least / 100 - SLACK)) / 2)

    def look(batches):
        for _, held, passing in _cells(batches):
            x, wanted = _Nodes(held), np.zeros(sum(b.num_rows for b in held), bool)
            for b in passing:
                asked = np.zeros(b.num_rows, bool)
                for i, j, _ in _possible(x, _Nodes([b]), most, least):
                    wanted[i] = asked[j] = True
                if asked.any():
                    yield b.filter(pa.array(asked))
            if wanted.any():
                yield from pa.Table.from_batches(held).filter(pa.array(wanted)).to_batches()

    def confirm(batches):
        over: dict[int, int] = {}

        def top(c: int) -> int:
            while c in over:
                c = over[c]
            return c

        for _, held, passing in _cells(batches):
            x, links = _Nodes(held), []
            for b in passing:
                y = _Nodes([b])
                for i, j, differ in _possible(x, y, most, least):
                    for k in np.argsort(differ, kind="stable").tolist():
                        p, q = top(int(x.component[i[k]])), top(int(y.component[j[k]]))
                        if p != q and _similar(x.set(i[k]), y.set(j[k]), least):
                            over[max(p, q)] = min(p, q)
                            links.append((int(x.node[i[k]]), int(y.node[j[k]])))
            yield pa.RecordBatch.from_arrays([pa.array([a[k] for a in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

    needed = written(_dealt(held.select(_ROW).unionByName(passing.select(_ROW))).mapInArrow(look, _ROW_DDL), "possible")
    return _dealt(needed.join(sets, "node").select(*_ROW, "set")).mapInArrow(confirm, "a long, b long")


def _cells(batches):
    """(cell, batches of held nodes, iterator of batches of passing nodes) of each cell that has both; what comes in is sorted by cell and side."""
    def runs():
        for b in batches:
            keys = np.stack([b.column(k).to_numpy() for k in range(4)])
            ends = [*(np.flatnonzero((np.diff(keys) != 0).any(axis=0)) + 1).tolist(), b.num_rows]
            for lo, hi in zip([0, *ends[:-1]], ends, strict=True):
                if hi > lo:
                    yield tuple(keys[:3, lo].tolist()), int(keys[3, lo]), b.slice(lo, hi - lo)

    for cell, own in groupby(runs(), key=lambda r: r[0]):
        held: list = []
        for side, rest in groupby(own, key=lambda r: r[1]):
            if side == 0:
                held = [r[2] for r in rest]
            elif held:
                yield cell, held, (r[2] for r in rest)


class _Nodes:
    """Columns of batches of nodes as arrays."""

    def __init__(self, batches: list):
        of = lambda name: np.concatenate([b.column(name).to_numpy(zero_copy_only=False) for b in batches])
        self.bucket, self.node, self.component, self.weight, self.n = (of(name) for name in ("bucket", "node", "component", "weight", "n"))
        self.sketch, self.bands = (np.concatenate([b.column(name).flatten().to_numpy().reshape(b.num_rows, -1) for b in batches]) for name in ("sketch", "bands"))
        self.sketch = self.sketch.view(np.uint64)
        self.sets = [(b.column("set"), k) for b in batches for k in range(b.num_rows)] if "set" in batches[0].schema.names else None

    def set(self, i: int) -> bytes:
        column, k = self.sets[i]
        return column[k].as_py()


def _possible(x: _Nodes, y: _Nodes, most: int, least: int):
    """(i, j, bits that differ) of the pairs of nodes x and y, about LOOK at a time, that may be similar, x in the lighter component, and whose first common band made this bucket."""
    step = max(1, LOOK // len(x.node))
    for lo in range(0, len(y.node), step):
        part = slice(lo, lo + step)
        differ = np.zeros((len(x.node), len(y.node[part])), np.int32)
        for k in range(x.sketch.shape[1]):
            differ += np.bitwise_count(x.sketch[:, k, None] ^ y.sketch[None, part, k])
        ok = (x.weight[:, None] < y.weight[part]) | ((x.weight[:, None] == y.weight[part]) & (x.component[:, None] < y.component[part]))
        ok &= (differ <= most) & (100 * np.minimum(x.n[:, None], y.n[part]) >= least * np.maximum(x.n[:, None], y.n[part]))
        i, j = np.nonzero(ok)
        if len(i):
            first = (x.bands[i] == y.bands[j + lo]).argmax(axis=1)
            here = x.bands[i, first] == x.bucket[0]
            i, j = i[here], j[here]
            if len(i):
                yield i, j + lo, differ[i, j]


def _similar(x: bytes, y: bytes, least: int) -> bool:
    """Whether 100 * intersection >= least * union of two sets of 64-bit hashes (each ascending)."""
    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    both = np.concatenate([x, y])
    both.sort(kind="stable")
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * common >= least * (len(both) - common)


def _classes(table: DataFrame, doc_id: str, text: str, size: int, least: int, by_id: bool) -> tuple[DataFrame, DataFrame]:
    """(row, id, n, same) of each row of a numbered table, and (same, copies, first) of each group of equal word sequences: first is the struct
    (no_id, id, row) of the row of its component with the smallest id (null: last), of several the one with the smallest number.

    by_id: rows without id are linked with nothing, rows that repeat one are linked. Else rows are told apart by number alone.

    1. Rows with equal word sequences are one node from here on (partial aggregation; a group's size doesn't matter). A node is a row's number.
    2. BANDS hashes of ROWS circulant MinHash coordinates each make buckets. Each node is paired with the hub it shares most buckets with,
       and these pairs are confirmed on full sets; so groups of near copies become one component without pairs among themselves.
    3. Of nodes that share a bucket but no component, the pairs that sketches of all coordinates leave possible are confirmed until their components have met.
       No pair is left out for the size of its bucket.
    """
    made = written(_features(table, doc_id, text, size), "features")
    full = made.where("same is not null and id is not null" if by_id else "same is not null")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row")).alias("first")
    groups = full.groupBy("same").agg(F.min(F.struct("row", "n", "bands", "sketch")).alias("f"), first, F.count("*").alias("copies"))
    features = written(groups.select("same", "copies", "first", F.col("f.row").alias("node"), "f.n", "f.bands", "f.sketch"), "distinct-features")

    members = _buckets(features)
    votes = members.where("node <> hub").groupBy("node", "hub").agg(F.count("*").alias("votes"))
    pairs = written(votes.groupBy("node").agg(F.max_by("hub", F.struct("votes", -F.col("hub"))).alias("a")).select("a", F.col("node").alias("b")), "first-pairs")
    # a node that shares a bucket is its hub, or paired with one: these are all sets that are ever asked for
    sets = written(_sets(table, pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), text, size), "sets")
    near = written(_confirm(pairs, sets, least), "first-links")
    labels = written(components(near), "first-components")
    mixed = _mixed(members, labels, features)
    links = near.unionByName(_further_links(mixed, sets, least))
    links = written(links.unionByName(_repeats(full, features)) if by_id else links, "links")
    discard(members, pairs, sets, near, labels, mixed)

    of_node = features.select("same", "copies", "first", "node").join(components(links).withColumnRenamed("id", "node"), "node", "left")
    of_node = written(of_node.select("same", "copies", "first", "component"), "components")
    discard(links, features)
    together = of_node.where("component is not null")
    firsts = written(together.groupBy("component").agg(F.min("first").alias("first"), F.count("*").alias("k")), "firsts")
    joined = attach(together.drop("first"), firsts, "component", "k").select("same", "copies", "first")
    classes = written(of_node.where("component is null").select("same", "copies", "first").unionByName(joined), "classes")
    discard(of_node, firsts)
    return made, classes


def _repeats(full: DataFrame, features: DataFrame) -> DataFrame:
    """Links of the nodes that share an id, to the smallest of them."""
    twice = full.groupBy("id").agg(F.min("same").alias("s0"), F.max("same").alias("s1")).where("s0 <> s1").select("id")
    mine = full.join(twice, "id", "left_semi").select("id", "same").distinct().join(features.select("same", "node"), "same")
    least = mine.groupBy("id").agg(F.min("node").alias("a"))
    return mine.join(least, "id").where("a <> node").select("a", F.col("node").alias("b"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, least: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row of docs.

    Rows are linked if 100 * intersection >= least * union of their sets of `size`-word shingles (of fewer words: the whole sequence). component_id is the
    smallest id reachable, kept says whether it is the row's own. Null, empty and wordless texts have no shingles and are linked with
    nothing; a null id is linked with nothing, has a null component and isn't kept. Rows that repeat an id are one node and have a row each. Texts of any length are
    taken whole. Empty input gives no rows. Other columns of docs, whatever their names, play no part.

    Texts are numbered and written once; they are read where they are (see `picked`) and never shuffled. The one path is the same at all sizes.
    """
    table = numbered(docs.select(doc_id, text), "near-dup-rows")
    made, classes = _classes(table, doc_id, text, size, least, by_id=True)
    discard(table)
    out = attach(made.select("row", "id", "n", "same"), classes, "same", "copies")
    component = F.when(F.col("id").isNotNull(), F.coalesce("first.id", "id"))
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, least: int = 80) -> DataFrame:
    """docs without near copies: of each group of rows that `near_duplicates` would link, the row with the smallest doc_id (null: last) stays, of several the first as numbered.

    Rows are told apart by a number of their own that is written with them, so rows without doc_id, and rows that repeat one, stay unless their text is a near
    copy. Texts without words are copies of nothing and stay. All columns are kept, whatever their names; empty input gives no rows.
    """
    table = numbered(docs, "near-dup-rows")
    made, classes = _classes(table, doc_id, text, size, least, by_id=False)
    gone = written(attach(made.select("row", "same"), classes, "same", "copies").where("row <> first.row").select("row"), "near-dup-gone")
    discard(made, classes)
    return picked(table, gone, among=False).select("own.*")
