"""WARC archives as tables of record chunks: no payload is held whole outside its source row, and each chunk carries the digest so far."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm.common import attach, discard, numbered, picked, table_path, written

#: Bytes of payload in a chunk row.
CHUNK_BYTES = 64 * 1024
#: Payloads below this size are never replaced by a reference.
REVISIT_BYTES = 100
#: An archive's columns: its number, the record's number in it, the chunk's number (0: headers; last: the empty lines that end a record),
#: its bytes, and the hex SHA-256 of the payload up to its end. Bytes in the order of the first three columns are a WARC file.
ARCHIVE = "archive int, record long, chunk int, last boolean, data binary, digest_so_far string"


def find_revisits(facts: DataFrame) -> DataFrame:
    """facts (id, digest, size and others) with refers_to, of rows whose payload equals that of a row with a smaller id; payloads under REVISIT_BYTES have none. facts is read several times.

    Digests that many rows share are counted with partial aggregation and joined by broadcast.
    """
    rows = facts.where(F.col("size") >= REVISIT_BYTES)
    groups = written(rows.groupBy("digest").agg(F.min("id").alias("refers_to"), F.count("*").alias("n")).where("n > 1"), "warc-groups")
    return attach(rows, groups, "digest", "n").where("id > refers_to").drop("n")


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url: str = "url", payload: str = "html") -> None:
    """Writes one record for each row of pages to the archive table at `path`.

    Null payloads are empty, null urls an empty target. Rows with equal payloads of REVISIT_BYTES or more become revisits of the one with the smallest id; rows
    that repeat an id and its payload are all responses (or all revisits). A null id is written as `null`, is never referred to and
    refers to nothing. Payloads of any size go through in chunks. Empty input gives an archive without records. Other columns, whatever their names, aren't written.
    Record ids come from page ids, so where these repeat, record ids do; records are told apart by their place in the archive.

    Rows are numbered and written once; ids, targets, sizes and digests of all of them are what moves. Revisits have no payload, so they come from these alone; the others' payloads are picked where they lie,
    by one bitmap for each part of the table, at any number of revisits. No payload is shuffled.
    """
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    table = numbered(pages.select(F.col(id_col).alias("id"), F.coalesce(F.col(url), F.lit("")).alias("url"), body.alias("body")), "warc-pages")
    facts = written(table.select("row", "own.id", "own.url", F.sha2("own.body", 256).alias("digest"), F.octet_length("own.body").cast("long").alias("size")), "warc-facts")
    revisits = written(find_revisits(facts), "warc-revisits")
    rest = picked(table, revisits.select("row"), among=False).select("own.id", "own.url", "own.body", F.sha2("own.body", 256).alias("digest"))
    pieces = F.ceil(F.octet_length("body") / CHUNK_BYTES).cast("int")
    cut = rest.select("id", "url", "digest", F.lit(None).cast(revisits.schema["refers_to"].dataType).alias("refers_to"), F.octet_length("body").cast("long").alias("size"), "body", F.explode(F.sequence(F.lit(0), pieces)).alias("k"), pieces.alias("n"))
    data = F.when(F.col("k") > 0, F.substring(F.col("body"), (F.col("k") - 1) * CHUNK_BYTES + 1, F.lit(CHUNK_BYTES)))
    heads = revisits.select("id", "url", "digest", "refers_to", "size", F.lit(0).alias("k"), F.lit(0).alias("n"), F.lit(None).cast("binary").alias("data"))
    every = cut.select("id", "url", "digest", "refers_to", "size", "k", "n", data.alias("data")).unionByName(heads)
    every.mapInArrow(_records, ARCHIVE).write.option("compression", "zstd").parquet(path)
    discard(table, facts, revisits)


def _records(batches):
    """Chunk rows of the archive; a record's rows stand together and in order in the input."""
    archive, record, digest = TaskContext.get().partitionId(), -1, None
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            if r["k"] == 0:
                record += 1
                digest = hashlib.sha256()
                rows.append((archive, record, 0, False, _head(r), digest.hexdigest()))
            else:
                digest.update(r["data"])
                rows.append((archive, record, r["k"], False, r["data"], digest.hexdigest()))
            if r["k"] == r["n"]:
                rows.append((archive, record, r["k"] + 1, True, b"\r\n\r\n", digest.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)] if rows else [pa.array([], t) for t in _TYPES], names=_NAMES)


_NAMES = ["archive", "record", "chunk", "last", "data", "digest_so_far"]
_TYPES = [pa.int32(), pa.int64(), pa.int32(), pa.bool_(), pa.binary(), pa.string()]


def _head(r: dict) -> bytes:
    """WARC and HTTP headers of a record. The HTTP length is that of the full payload in revisits too."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {r['size']}\r\n\r\n".encode()
    revisit = r["refers_to"] is not None
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'null' if r['id'] is None else r['id']}>",
        "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Target-URI: {r['url'].translate(_NO_BREAKS)}", f"WARC-Payload-Digest: sha256:{r['digest']}",
        *([f"WARC-Refers-To: <urn:page:{r['refers_to']}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"] if revisit else []),
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + (0 if revisit else r['size'])}",
    ]
    return ("\r\n".join(lines) + "\r\n\r\n").encode("utf-8", "surrogatepass") + http


_NO_BREAKS = {10: "%0A", 13: "%0D"}


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row for each record: id (string; null as written), url, record_type, payload_bytes, payload_digest, refers_to (string).

    Chunks are dealt by record and sorted; each task streams them, digesting as it goes, so it holds one Arrow batch at a time. A record
    whose chunks are missing, or whose bytes don't give its digests and length, is an error.
    """
    rows = spark.read.schema(ARCHIVE).parquet(path)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(n, "archive", "record").sortWithinPartitions("archive", "record", "chunk")
    return dealt.mapInArrow(_check, "id string, url string, record_type string, payload_bytes long, payload_digest string, refers_to string")


def _check(batches):
    at = head = digest = None
    size = 0
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            key = (r["archive"], r["record"])
            if r["chunk"] == 0:
                if head is not None:
                    raise ValueError(f"record {at} has no end")
                at, head, digest, size = (*key, 0), _parse(r["data"]), hashlib.sha256(), 0
            else:
                if at != (*key, r["chunk"] - 1):
                    raise ValueError(f"record {key} has no chunk before {r['chunk']}")
                at = (*key, r["chunk"])
                if not r["last"]:
                    digest.update(r["data"])
                    size += len(r["data"])
            if digest.hexdigest() != r["digest_so_far"]:
                raise ValueError(f"chunk {r['chunk']} of record {key} doesn't give its digest")
            if r["last"]:
                revisit = head["warc-type"] == "revisit"
                if size != head["block"] or not revisit and (digest.hexdigest() != head["digest"] or size != head["bytes"]):
                    raise ValueError(f"record {key} isn't what its headers say")
                out.append((head["id"], head["warc-target-uri"], head["warc-type"], head["bytes"], head["digest"], head["refers_to"]))
                head = None
        yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.int64() if i == 3 else pa.string()) for i in range(6)], names=["id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to"])
    if head is not None:
        raise ValueError(f"record {at} has no end")


def _parse(data: bytes) -> dict:
    warc, _, http = data.partition(b"\r\n\r\n")
    named = lambda block: {k.lower(): v for line in block.decode("utf-8", "surrogatepass").split("\r\n")[1:] if ": " in line or line.endswith(":") for k, _, v in [line.partition(": ")]}
    out, inner = named(warc), named(http)
    of = lambda v: None if v in (None, "<urn:page:null>") else v[len("<urn:page:") : -1]
    return out | {
        "id": of(out["warc-record-id"]), "refers_to": of(out.get("warc-refers-to")), "digest": out["warc-payload-digest"].removeprefix("sha256:"),
        "bytes": int(inner["content-length"]), "block": int(out["content-length"]) - len(http),
    }


def round_trip(pages: DataFrame) -> DataFrame:
    """pages written as an archive in the shared folder and read back."""
    path = table_path(pages.sparkSession, "warc")
    write_archive(pages, path)
    return read_archive(pages.sparkSession, path)
