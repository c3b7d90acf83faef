"""Each stage of the pipeline against brute force on its own input: sf0.001 with further rows."""

import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from strataflow.llm import language, near_dup

SF = "/root/testdata/sf0.001"
STAGE = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def docs(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    long_text = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    more = [(9001, None, "en", "s", 0), (9002, "", None, "s", 0), (9003, "123 !!", "en", None, 6), (None, "The ther in and of that.", "en", "s", 9), (9004, "The in and. " + long_text, "en", "s", 9), (9004, "The in and. " + long_text, "en", "s", 9)]
    return d.unionByName(spark.createDataFrame(more, d.schema)).cache()


def test_language(spark, docs):
    kept = STAGE["language"](spark, docs, SF)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert not ids & {9001, 9002, 9003} and len(ids) >= 0.97 * docs.where("doc_id < 9000").count()


def test_near_dup(spark, docs):
    kept = STAGE["near_dup"](spark, docs, SF)
    assert kept.columns == docs.columns
    found = sorted(docs.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))  # rows with and without ids, by place in this order
    rows = [(k, near_dup.shingles(near_dup.words_of(r.text), 5)) for k, r in enumerate(found)]
    of = {d: d for d, _ in rows}

    def top(x):
        while of[x] != x:
            x = of[x]
        return x

    for i, (a, x) in enumerate(rows):
        for b, y in rows[:i]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                p, q = top(a), top(b)
                of[max(p, q)] = min(p, q)
    assert sorted(str((r.doc_id, r.text)) for r in kept.collect()) == sorted(str((found[k].doc_id, found[k].text)) for k in of if top(k) == k)


def test_near_dup_with_clashing_columns(spark, docs):
    more = docs.select("*", F.lit(1).alias("n"), F.lit("x").alias("row"), F.lit(2).alias("part"), F.lit(3).alias("own"), F.lit(4).alias("component"))
    kept = STAGE["near_dup"](spark, more, SF)
    assert kept.columns == more.columns and kept.count() == STAGE["near_dup"](spark, docs, SF).count()


def test_decontamination(spark, docs):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    wins = [w[k : k + 10] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() for w in [words(r.text)] if w for k in range(max(1, len(w) - 9))]
    wins = {tuple(w) for w in wins}
    sizes = {len(w) for w in wins}
    clean = [r.doc_id for r in docs.collect() for w in [words(r.text)] if not any(tuple(w[k : k + n]) in wins for n in sizes for k in range(len(w) - n + 1))]
    kept = STAGE["decontamination"](spark, docs, SF)
    assert kept.columns == docs.columns and sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(map(str, clean))


def test_packing(spark, docs):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text for r in docs.where("doc_id < 9004").collect()}
    out = STAGE["packing"](spark, docs.where("doc_id < 9004"), SF).toPandas()
    for d, g in out.groupby("doc_id"):
        ids = np.array(t.encode(texts[d] or "", add_special_tokens=False).ids + [2], "<u4")
        assert all(zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in g.itertuples()) and g.length.sum() == len(ids)
    assert set(out.doc_id) == set(texts) and (out.groupby("sequence_id").length.sum() <= 1024).all()


@pytest.mark.parametrize("stage", ["language", "decontamination"])
def test_columns_of_any_name_stay(spark, docs, stage):
    more = docs.select("*", *[F.concat(F.lit(n), F.col("doc_id").cast("string")).alias(n) for n in ("score", "lang_pred", "lang_rejected", "items", "spans", "n_words", "n_hit", "c0", "c1")])
    kept = STAGE[stage](spark, more, SF)
    assert kept.columns == more.columns and kept.count() == STAGE[stage](spark, docs, SF).count()
    assert kept.where("score <> concat('score', doc_id) or n_hit <> concat('n_hit', doc_id) or c1 <> concat('c1', doc_id)").count() == 0


def test_run_on_nothing(spark, docs):
    none = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, SF)
    assert none.count() == 0


def test_language_rejects_narrow_margins(spark, docs):
    """The stage's rows are those of a plain reimplementation; texts half in one language and half in another, or in a language without a dictionary, go."""
    own = [r for r in docs.where("doc_id < 9000").collect() if r.text and r.lang]
    held = lambda r: zlib.crc32(str(r.doc_id).encode()) % 3 == 1
    words = {lang: [w for r in own if r.lang == lang and held(r) for w in r.text.split()] for lang in ("en", "fr", "de")}
    halves = [(a, b) for a in words for b in words if a < b]
    odd = [" ".join(x for i in range(k, k + 150) for x in (words[a][i], words[b][i])) for k in (0, 50, 100) for a, b in halves]
    odd += ["ja se se mi koja ovaj grad velik zato imamo vodu " * 20, "qzx vkj wqp zzk xjq kkv pqw jxz " * 30]
    odd = [(i, t, None, "s", len(t)) for i, t in enumerate(odd, 7_000_000_000)]
    kept = {r.doc_id for r in STAGE["language"](spark, docs.unionByName(spark.createDataFrame(odd, docs.schema)), SF).where("doc_id is not null").collect()}

    seen = {}
    for r in docs.collect():
        if r.text is not None and r.lang is not None and zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 3 != 1:
            seen.setdefault(r.lang, []).append(set(language.normalised(r.text).split()))
    made = []
    for texts in seen.values():
        count, among = Counter(w for t in texts for w in t), {}
        for t in texts:
            among |= {w: min(among.get(w, len(t)), len(t)) for w in t}
        raw = zstandard.ZstdCompressionDict(language._content(sorted(count, key=lambda w: (-count[w], among[w], w))), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        made.append(zstandard.ZstdCompressor(level=5, dict_data=raw, write_content_size=False, write_dict_id=False))
    want = set()
    for d, t in [(r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None] + [(x[0], x[1]) for x in odd]:
        if t and any(map(str.isalpha, t)):
            b = language.normalised(t).encode()
            best, second = sorted(sum(len(z.compress(b[i : i + 512])) for i in range(0, len(b), 512)) for z in made)[:2]
            if second - best > 0.05 * second:
                want.add(d)
    assert kept == want
    assert sum(x[0] in kept for x in odd) < len(odd) / 2 and len({r.doc_id for r in own} - kept) <= 0.03 * len(own)


def test_near_dup_keeps_unlike_rows_of_one_id(spark, docs):
    """Null and repeated ids with distinct texts stay, also where one text is a copy of a smaller id; near copies leave the smallest id, null being the largest."""
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(60))
    rows = [(None, text(1)), (None, text(2)), (7, text(3)), (7, text(4)), (5, text(4)), (8, text(5)), (None, text(5)), (9, text(6)), (9, text(6)), (None, text(7)), (None, text(7) + " end"), (6, None), (6, ""), (None, " ")]
    some = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], docs.schema).repartition(5)
    kept = STAGE["near_dup"](spark, some, SF)
    got = sorted(((r.doc_id, (r.text or "")[:4]) for r in kept.collect()), key=str)
    want = [(None, "w1x0"), (None, "w2x0"), (7, "w3x0"), (5, "w4x0"), (8, "w5x0"), (9, "w6x0"), (None, "w7x0"), (6, ""), (6, ""), (None, " ")]
    assert got == sorted(want, key=str) and kept.columns == docs.columns


def test_run(spark):
    """run() is its stages in their order, each on all rows of the one before (here dealt anew): its pieces are those of the documents that all earlier stages keep, whole, in sequences without gaps."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs.repartition(3), SF).collect(), docs.schema)
    tokens = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {r.doc_id: len(tokens.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in docs.collect()}
    got, sequences = Counter(), {}
    for r in corpus_pipeline.run(spark, SF).collect():
        got[r.doc_id] += r.length
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert got == want and 0 < len(want) < spark.read.parquet(f"{SF}/documents.parquet").count()
    for s in sequences.values():
        s.sort()
        assert [o for o, _ in s] == [sum(n for _, n in s[:i]) for i in range(len(s))] and sum(n for _, n in s) <= 1024
