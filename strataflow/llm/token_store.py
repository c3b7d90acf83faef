"""Token ids in a content-addressed store: chunks cut by a rolling hash, each stored once, with document recipes and Merkle manifests."""

from __future__ import annotations

import hashlib
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataflow.llm.common import written
from strataflow.llm.tokens import encoder, slices

#: A chunk ends where the low bits of the rolling hash over WINDOW ids are 0, but for its least and greatest length (in ids). Older ids are shifted out of these bits.
WINDOW, CUT_MASK, LEAST, MOST = 10, 1023, 256, 4096
#: A task remembers so many digests that it has handed on with their ids; further copies go as references only.
REMEMBERED = 200_000
_GEAR = np.random.default_rng(7).integers(0, 2**32, 2**16, dtype=np.uint32)

STORE = "part int, row long, doc_id long, seq int, n_chunks int, root binary, digest binary, n_ids int, ids binary"


def cuts(ids: np.ndarray) -> np.ndarray:
    """Ends of the chunks of one document's ids."""
    if len(ids) <= LEAST:
        return np.array([len(ids)] if len(ids) else [], np.int64)
    gear, h = _GEAR[ids & 0xFFFF], np.zeros(len(ids), np.uint32)
    for k in range(min(WINDOW, len(ids))):
        h[k:] += gear[: len(ids) - k] << np.uint32(k)
    wanted = np.flatnonzero((h[WINDOW:] & np.uint32(CUT_MASK)) == 0) + WINDOW + 1
    out, start, n = [], 0, len(ids)
    for w in wanted.tolist():
        while w - start > MOST:
            start += MOST
            out.append(start)
        if w - start >= LEAST and w < n:
            start = w
            out.append(start)
    while n - start > MOST:
        start += MOST
        out.append(start)
    return np.array([*out, n] if not out or out[-1] < n else out, np.int64)


class Merkle:
    """A SHA-256 tree over digests that come in order, built level by level as they come: it holds one digest for each level. An odd one moves up as it is."""

    def __init__(self):
        self.levels: list[bytes | None] = []

    def add(self, digest: bytes) -> None:
        for k, left in enumerate(self.levels):
            if left is None:
                self.levels[k] = digest
                return
            self.levels[k], digest = None, _pair(left, digest)
        self.levels.append(digest)

    def root(self) -> bytes:
        """Of what has come so far; of nothing, the hash of nothing."""
        out = None
        for left in self.levels:
            if left is not None:
                out = left if out is None else _pair(left, out)
        return hashlib.sha256(b"").digest() if out is None else out


def _pair(left: bytes, right: bytes) -> bytes:
    return hashlib.sha256(b"\x01" + left + right).digest()


def merkle_root(digests: list[bytes]) -> bytes:
    tree = Merkle()
    for d in digests:
        tree.add(d)
    return tree.root()


def _digest(raw: bytes) -> bytes:
    return hashlib.sha256(b"\x00" + raw).digest()


def write_store(docs: DataFrame, path: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end_id: int = 2, width: int = 2) -> None:
    """Encodes docs and writes the store below `path`: chunks, recipes in ascending doc_id order and manifest.

    Ids take `width` bytes, little-endian (2 or 4). Null or empty texts are just the end id; texts of any length are cut into many chunks. Null ids come first; rows that repeat an id
    or a text each have a recipe, in the order in which they were read. Empty input gives empty tables. Other columns, whatever their names, aren't written.

    One job encodes and cuts. A chunk travels with its ids once from each task, to the task of its digest, where the first is kept; copies
    travel as references, to the task of their document, so a chunk that most documents share burdens no task. Recipes are then
    range-partitioned by doc_id (by row within one id). A document's Merkle root is over its chunks' digests, a file's over its documents' leaves
    (id, number of ids and root), the store's over those of its files. The manifest has a row for each file, whose number, counts and root are taken as the file's rows
    stream by, and `root` one row for the store; the driver sees a row for each file.
    """
    spark = docs.sparkSession
    dtype = {2: "<u2", 4: "<u4"}[width]

    def encode(batches):
        encode_all, part, row, sent = encoder(tokenizer).encode, TaskContext.get().partitionId(), 0, {}
        for b in batches:
            keys, texts = b.column(0), b.column(1)
            for run in slices(texts):
                rows = []
                for i, raw in zip(run, encode_all([texts[i].as_py() for i in run]), strict=True):
                    ids = np.append(np.frombuffer(raw, "<u4"), np.uint32(end_id))
                    ends = cuts(ids)
                    if width == 2 and ids.max() > 0xFFFF:
                        raise ValueError("an id needs 4 bytes")
                    pieces = [ids[s:e].astype(dtype).tobytes() for s, e in zip([0, *ends[:-1]], ends, strict=True)]
                    digests = [_digest(p) for p in pieces]
                    root, key = merkle_root(digests), keys[i].as_py()
                    for k, (p, d) in enumerate(zip(pieces, digests, strict=True)):
                        rows.append((part, row, key, k, len(pieces), root if k == 0 else None, d, len(p) // width, None if d in sent else p))
                        sent[d] = None
                    row += 1
                while len(sent) > REMEMBERED:
                    del sent[next(iter(sent))]
                yield _batch(rows, STORE_TYPES)

    def once(batches):
        last = None
        for b in batches:
            digests, ids = b.column(6).to_pylist(), b.column(8)
            keep = []
            for d, held in zip(digests, ids.is_valid().to_pylist(), strict=True):
                keep.append(held and d != last)
                last = d if held else last
            yield b.set_column(8, "ids", pc.if_else(pa.array(keep, pa.bool_()), ids, pa.scalar(None, pa.binary())))

    cut = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(encode, STORE)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    to = F.when(F.col("ids").isNotNull(), F.xxhash64("digest")).otherwise(F.xxhash64("part", "row", "seq"))
    dealt = cut.withColumn("to", to).repartition(n, "to").drop("to").sortWithinPartitions(F.col("ids").isNull(), "digest", "part", "row", "seq")
    dealt.mapInArrow(once, STORE).write.option("compression", "zstd").parquet(f"{path}/chunks")

    refs = spark.read.schema(STORE).parquet(f"{path}/chunks").drop("ids")
    recipes = refs.groupBy("part", "row").agg(F.max("doc_id").alias("doc_id"), F.max("root").alias("root"), F.max("n_chunks").alias("n_chunks"), F.sum("n_ids").cast("long").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("seq", "digest", "n_ids"))).alias("chunks"))
    ordered = recipes.repartitionByRange(n, "doc_id", "part", "row").sortWithinPartitions("doc_id", "part", "row").withColumn("file", F.spark_partition_id())
    kinds = {f.name: f.dataType.simpleString() for f in ordered.schema}

    def close(batches):
        """The recipes as they come; the last one of a file carries what the manifest says about the file."""
        tree, docs_, tokens, last = Merkle(), 0, 0, None
        for b in batches:
            if not b.num_rows:
                continue
            if last is not None:
                yield _ended(last, None)
            for key, count, root in zip(*(b.column(c).to_pylist() for c in ("doc_id", "n_tokens", "root")), strict=True):
                tree.add(_leaf(key, count, root))
                tokens += count
            docs_, last = docs_ + b.num_rows, b
        if last is not None:
            yield _ended(last, (docs_, tokens, tree.root()))

    closed = ordered.mapInArrow(close, ", ".join(f"{k} {v}" for k, v in kinds.items()) + ", file_docs long, file_tokens long, file_root binary")
    closed.write.option("compression", "zstd").parquet(f"{path}/recipes")
    files = spark.read.parquet(f"{path}/recipes").where("file_root is not null").select("file", "file_docs", "file_tokens", "file_root")
    files = files.withColumn("start", F.coalesce(F.sum("file_tokens").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    files.write.parquet(f"{path}/manifest")
    spark.createDataFrame([_whole(spark.read.schema(MANIFEST).parquet(f"{path}/manifest"))], WHOLE).write.parquet(f"{path}/root")


MANIFEST = "file int, file_docs long, file_tokens long, file_root binary, start long"
WHOLE = "n_files long, n_docs long, n_tokens long, root binary"


def _whole(manifest: DataFrame) -> tuple[int, int, int, bytes]:
    """The row of `root` that a manifest gives: a row for each file is read."""
    files = manifest.orderBy("file").select("file_docs", "file_tokens", "file_root").collect()
    return len(files), sum(f[0] for f in files), sum(f[1] for f in files), merkle_root([bytes(f[2]) for f in files])


def _leaf(doc_id: int | None, n_tokens: int, root: bytes) -> bytes:
    return hashlib.sha256(b"\x02" + f"{doc_id}/{n_tokens}/".encode() + root).digest()


def _ended(b: pa.RecordBatch, said: tuple | None) -> pa.RecordBatch:
    more = [pa.array([None] * (b.num_rows - 1) + [said and said[k]], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.binary()))]
    return pa.RecordBatch.from_arrays([*b.columns, *more], names=[*b.schema.names, "file_docs", "file_tokens", "file_root"])


STORE_TYPES = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.binary()]


def _batch(rows: list[tuple], types: list) -> pa.RecordBatch:
    names = [x.split()[0] for x in STORE.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)


_POLY = 0xEDB88320


def _times(a: int, b: int) -> int:
    """Product of two CRC-32 polynomials (bit-reflected) modulo the CRC's."""
    out = 0
    for k in range(32):
        if a >> (31 - k) & 1:
            out ^= b
        b = b >> 1 ^ (_POLY if b & 1 else 0)
    return out


@lru_cache(8192)
def _zeros(n: int) -> int:
    """x to the power of 8 n: what n zero bytes do to a CRC-32."""
    out, power = 1 << 31, 1 << 23
    while n:
        if n & 1:
            out = _times(out, power)
        power, n = _times(power, power), n >> 1
    return out


def joined_crc32(parts: list[tuple[int, int]]) -> int:
    """CRC-32 of joined byte strings, from the CRC-32 and length of each."""
    out = 0
    for crc, n in parts:
        out = _times(_zeros(n), out) ^ crc
    return out


def read_store(spark: SparkSession, path: str, width: int = 2) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, n_chunks, root) of each document, read back from the store and verified.

    Every stored chunk is read once: its digest must be that of its ids, and it yields the CRC-32 of its ids as 32-bit integers. A
    document's CRC is joined from those of its recipe's chunks, its Merkle root must come from their digests; its start is the
    manifest's for its file and the sum of those before it there. Then each file's recipes stream by in order, and their number, their ids and their Merkle root must
    be the manifest's, and the manifest's files must give the store's root. So a chunk, a recipe or a file that is missing or changed is an error when the result is computed.
    """
    manifest = written(spark.read.schema(MANIFEST).parquet(f"{path}/manifest"), "manifest")
    if [tuple(r) for r in spark.read.schema(WHOLE).parquet(f"{path}/root").collect()] != [_whole(manifest)]:
        raise ValueError("the manifest doesn't give the store's root")
    dtype = {2: "<u2", 4: "<u4"}[width]
    table = spark.read.schema(STORE).parquet(f"{path}/chunks")

    def check(batches):
        for b in batches:
            out = []
            for d, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if _digest(raw) != d:
                    raise ValueError(f"chunk {d.hex()} has other bytes")
                ids = np.frombuffer(raw, dtype)
                out.append((d, zlib.crc32(ids.astype("<u4").tobytes()), len(ids)))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate((pa.binary(), pa.int64(), pa.int32()))], names=["digest", "crc", "n"])

    found = table.where("ids is not null").select("digest", "ids").mapInArrow(check, "digest binary, crc long, n int")
    recipes = spark.read.schema(RECIPES).parquet(f"{path}/recipes")
    refs = recipes.select("file", "part", "row", "doc_id", "n_tokens", "root", F.explode("chunks").alias("c")).select("file", "part", "row", "doc_id", "n_tokens", "root", "c.seq", "c.digest")
    whole = (
        refs.join(found, "digest", "left").groupBy("file", "part", "row")
        .agg(F.max("doc_id").alias("doc_id"), F.max("n_tokens").alias("n_tokens"), F.max("root").alias("root"), F.sort_array(F.collect_list(F.struct("seq", "digest", "crc", "n"))).alias("chunks"))
    )

    def join(batches):
        for b in batches:
            crcs = []
            for n, root, chunks in zip(b.column(4).to_pylist(), b.column(5).to_pylist(), b.column(6).to_pylist(), strict=True):
                if any(c["crc"] is None for c in chunks) or sum(c["n"] for c in chunks) != n or merkle_root([c["digest"] for c in chunks]) != root:
                    raise ValueError("a recipe doesn't match its chunks")
                crcs.append(joined_crc32([(c["crc"], 4 * c["n"]) for c in chunks]))
            sizes = pc.list_value_length(b.column(6)).cast(pa.int32())
            yield pa.RecordBatch.from_arrays([*b.columns[:6], pa.array(crcs, pa.int64()), sizes], names=["file", "part", "row", "doc_id", "n_tokens", "root", "ids_crc32", "n_chunks"])

    docs = whole.mapInArrow(join, "file int, part int, row long, doc_id long, n_tokens long, root binary, ids_crc32 long, n_chunks int")
    told = manifest.select("file", "file_docs", "file_tokens", "file_root", F.col("start").alias("file_start"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = told.join(docs, "file", "full_outer").repartition(n, "file").sortWithinPartitions("file", "doc_id", "part", "row")

    def verify(batches):
        file, told, tree, count, at = None, None, Merkle(), 0, 0

        def end():
            if file is not None and (count, at, tree.root()) != told[:3]:
                raise ValueError(f"the recipes of file {file} aren't those that the manifest tells of")

        for b in batches:
            starts = []
            for f, key, row, n_tokens, root, *says in zip(*(b.column(c).to_pylist() for c in ("file", "doc_id", "row", "n_tokens", "root", "file_docs", "file_tokens", "file_root", "file_start")), strict=True):
                if f != file:
                    end()
                    file, told, tree, count, at = f, tuple(says), Merkle(), 0, 0
                if row is None:
                    raise ValueError(f"file {f} has no recipes")
                starts.append((told[3] or 0) + at)
                tree.add(_leaf(key, n_tokens, root))
                count, at = count + 1, at + n_tokens
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(starts, pa.int64()), *(b.column(c) for c in ("n_tokens", "ids_crc32", "n_chunks", "root"))], names=["doc_id", "start", "n_tokens", "ids_crc32", "n_chunks", "root"])
        end()

    out = placed.mapInArrow(verify, "doc_id long, start long, n_tokens long, ids_crc32 long, n_chunks int, root binary")
    return out.withColumn("root", F.hex("root"))


RECIPES = "part int, row long, doc_id long, root binary, n_chunks int, n_tokens long, chunks array<struct<seq:int,digest:binary,n_ids:int>>, file int"
