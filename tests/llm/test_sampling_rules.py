"""Resampling, spelling variants and quality rules against brute force, and on nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataflow.llm import quality, resampling, spelling

DOCS = "doc_id long, text string"
LOWER = {c: c + 32 for c in range(65, 91)}


@pytest.fixture(scope="module")
def texts():
    r = random.Random(11)
    words = ["".join(r.choices("abcde", k=r.randint(2, 9))) for _ in range(300)] + ["été", "naïveté", "Über", "x1"]
    made = [" ".join(r.choices(words, weights=[1 / (i + 1) for i in range(len(words))], k=r.randint(1, 120))) for _ in range(80)]
    long = " ".join(r.choices(words, k=30_000))
    line = "same words stand here again and again today"
    return [None, "", " \n\t", "one", *made, made[0], made[0], long, f"{line}\n{line}\n{line}\n \n \nother line here", "### && 12 $$$ " * 15, "AB!! " * 40, " ".join(map(str, range(25))) + " " + " ".join(map(str, range(25)))]


def words_of(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))


def drawn(rows, target, percent, least, grams=1, buckets=10_000, seed=2024):
    """The contract by plain Python: {place in rows: (n_features, weight, score, rank)}."""
    runs = lambda w: [" ".join(w[i : i + n]) for n in range(1, grams + 1) for i in range(len(w) - n + 1)]
    of = [[zlib.crc32(x.encode()) % buckets for x in runs(words_of(t))] for _, t in rows]
    s, t = Counter(b for f in of for b in f), Counter(zlib.crc32(x.encode()) % buckets for y in target for x in runs(words_of(y)))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets))))
    out = []
    for (i, _), f in zip(rows, of, strict=True):
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(map(gain, f))
        out.append([len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = [k for k, (_, x) in enumerate(rows) if len(words_of(x)) >= least]
    able.sort(key=lambda k: (-out[k][2], math.inf if rows[k][0] is None else rows[k][0], k))
    for rank, k in enumerate(able[: percent * len(able) // 100], 1):
        out[k][3] = rank
    return out


@pytest.mark.parametrize("grams,percent", [(1, 10), (2, 37), (1, 0), (1, 100)])
def test_resampling_is_brute_force(spark, texts, grams, percent):
    rows = [(i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    target = [texts[6], "one two", None, ""]
    got = resampling.importance_ranks(docs, spark.createDataFrame([(t,) for t in target], "text string"), percent=percent, least_words=20, grams=grams)
    got = {r.doc_id: [r.n_features, r.weight, r.score, r["rank"]] for r in got.collect()}
    assert [got[i] for i, _ in rows] == drawn(rows, target, percent, 20, grams)


def test_resampling_ties_repeats_and_names(spark, texts):
    """Rows that repeat an id tie in all but their place: as many are drawn as should be, ranks have no gap; columns named like new ones give way."""
    rows = [(None if i % 7 == 0 else i % 3, texts[5 + i % 4], -1, "x") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rank long, `row` string")
    target = spark.createDataFrame([(texts[5],)], "text string")
    got = resampling.importance_ranks(docs, target, percent=50, least_words=1)
    assert got.columns == ["doc_id", "row", "n_words", "n_features", "weight", "score", "rank"]
    ranked = sorted((r["rank"], r.score) for r in got.collect() if r["rank"])
    assert [k for k, _ in ranked] == list(range(1, 31)) and [s for _, s in ranked] == sorted((s for _, s in ranked), reverse=True)
    whole = resampling.resample(docs, target, percent=50, least_words=1)
    assert whole.columns == ["doc_id", "text", "row", "score", "rank"]
    assert sorted((r["rank"], r.score) for r in whole.collect()) == ranked and whole.where("text is null").count() == 0


def test_resampling_of_nothing(spark):
    none = spark.createDataFrame([], DOCS)
    assert resampling.importance_ranks(none, none.select("text")).count() == 0
    one = spark.createDataFrame([(1, "a b")], DOCS)
    assert [r["rank"] for r in resampling.importance_ranks(one, none.select("text"), least_words=1, percent=100).collect()] == [1]


def test_cutoff_discards_a_share_each_round(spark, monkeypatch):
    """The k-th key for every k, with few different scores, and the same when the rest is written anew on the way."""
    r = random.Random(3)
    keys = [(r.randint(0, 5), r.randint(0, 9), i) for i in range(200)]
    table = spark.createDataFrame(keys, "score long, id long, row long").repartition(6)
    order = sorted(keys, key=lambda k: (-k[0], k[1], k[2]))
    for k in (1, 2, 77, 199, 200):
        assert resampling._cutoff(table, k, 200) == order[k - 1]
    monkeypatch.setattr(resampling, "SHRINK_ROWS", 10)
    assert resampling._cutoff(table, 50, 200) == order[49] and resampling._cutoff(table, 0, 200) is None


def edits(a, b):
    """Whether exactly one code point is inserted, deleted or replaced."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def grouped(counts, times):
    out = {}
    for w, n in counts.items():
        near = sorted((-m, x) for x, m in counts.items() if edits(w, x))
        form = near[0][1] if near and -near[0][0] >= times * n else None
        out[w] = [n, len(near), form, counts[form] if form else None]
    for w in out:
        root = w
        while out[root][2]:
            root = out[root][2]
        out[w].append(root)
    return out


@pytest.mark.parametrize("block", [2_048, 3])
def test_spelling_is_brute_force(spark, monkeypatch, block):
    """Also with blocks so small that most places are tiled."""
    monkeypatch.setattr(spelling, "BLOCK_ROWS", block)
    r = random.Random(4)
    words = sorted({"".join(r.choices("abé", k=r.randint(1, 9))) for _ in range(500)} | {"a" * 40, "a" * 41, "a" * 20 + "b" + "a" * 20, "b" + "a" * 40, "a" * 42})
    counts = {w: r.choice((2, 3, 20, 30, 300, 4000)) for w in words}
    got = spelling.group_variants(spark.createDataFrame(list(counts.items()), "word string, n long"))
    assert {x.word: [x.n, x.n_near, x.form, x.form_n, x.root] for x in got.collect()} == grouped(counts, 10)


def test_vocabulary(spark, texts):
    rows = [(i, t) for i, t in enumerate([*texts, "É" + "Ab" * 9000 + " xyzXYZ×÷ÿ " * 50])] + [(None, "abcdefgh abcdefgh"), (5, texts[5])]
    want = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            want[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    got = spelling.vocabulary(spark.createDataFrame(rows, DOCS).withColumn("word", F.lit(1)).withColumn("n", F.lit(2)), least_length=7)
    assert {r.word: r.n for r in got.collect()} == {w: n for w, n in want.items() if len(w) >= 7 and n >= 2}


def test_spelling_of_nothing(spark):
    assert spelling.spelling_variants(spark.createDataFrame([], DOCS)).count() == 0
    assert spelling.spelling_variants(spark.createDataFrame([(1, None), (2, ""), (3, "12 34")], DOCS)).count() == 0


def counted(t):
    """The base statistics of a text by plain Python: words, their code points, symbols, repeated lines and words in repeated windows."""
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    hit = {p for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for p in range(i, i + 8)}
    return [len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit)]


def test_statistics_are_brute_force(spark, texts):
    r = random.Random(8)
    odd = ["a\x0bb\x0cc\rd\x1ce f \U0001f600x", *[" ".join(r.choices("abc", k=r.randint(0, 40))) for _ in range(60)], "\n".join(r.choices(["a b", " a b", "c", " ", ""], k=30)), "x " * 9, "w " * 5000]
    rows = list(enumerate([*texts, *odd]))
    df = spark.createDataFrame([(i, t, "mine", 7) for i, t in rows], "doc_id long, text string, t string, n_words long")
    got = quality.statistics(df)
    assert got.columns == ["doc_id", "t", *quality.STATISTICS] and {k for _, k in got.dtypes[2:]} == {"bigint"}
    found = {x.doc_id: [x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words] for x in got.collect()}
    assert found == {i: counted(t) for i, t in rows}


def labelled(spark, n=600):
    r = random.Random(2)
    words = ["".join(r.choices("abcdefgh", k=r.randint(2, 8))) for _ in range(500)]
    rows, labels = [], []
    for i in range(n):
        text = " ".join(r.choices(words, k=r.randint(30, 90)))
        bad = i % 5 == 0
        if bad:
            text = text.replace(" ", "## ") if i % 2 else text.upper()
        rows.append((i, text))
        labels.append((i, 0 if bad else 1))
    return rows, labels, spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int")


def test_rules_tell_bad_from_good(spark):
    """Two kinds of bad texts make two rules or more; on texts that weren't labelled they drop all bad ones and keep all good ones."""
    _, labels, docs, told = labelled(spark)
    out, rules = quality.quality_rules(docs, told.where("doc_id < 300"))
    assert len(rules) >= 2 and all(0 < len(x) <= quality.CONDITIONS for x in rules)
    rest = {r.doc_id: r for r in out.where("doc_id >= 300").collect()}
    assert all(rest[i].kept == (q == 1) and (rest[i]["rule"] is None) == (q == 1) for i, q in labels[300:])
    # the list as an expression, in its order: the first rule that holds
    shown = {r.doc_id: [k for k, rule in enumerate(rules, 1) if all(r[f"f_{name}"] <= at if sign == "<=" else r[f"f_{name}"] >= at for name, sign, at in rule)]
             for r in out.select("doc_id", *[F.expr(f).alias(f"f_{n}") for n, f in quality.FEATURES.items()]).collect()}
    assert {r.doc_id: r["rule"] for r in out.collect()} == {i: k[0] if k else None for i, k in shown.items()}


def test_rules_without_use(spark):
    """Labels that say nothing give no rules; neither do none, nor null ones; base failures are dropped all the same."""
    r = random.Random(1)
    _, _, docs, told = labelled(spark, 200)
    noise = spark.createDataFrame([(i, r.randint(0, 1)) for i in range(200)], "doc_id long, quality int")
    assert quality.quality_rules(docs.withColumn("text", F.lit("word " * 3 + " ".join(map(str, range(30))))), noise)[1] == []
    short = spark.createDataFrame([(1, "too few"), (2, None), (2, " ".join(map(str, range(30)))), (None, "a " * 30)], DOCS)
    for labels in (told.limit(0), spark.createDataFrame([(None, 0), (2, None)], "doc_id long, quality int")):
        out, rules = quality.quality_rules(short, labels)
        assert rules == [] and sorted((r.n_words, r.base_failed, r.kept) for r in out.collect()) == [(0, True, False), (2, True, False), (30, False, True), (30, True, False)]
    assert quality.quality_rules(docs.limit(0), told)[0].count() == 0


def test_rules_on_given_labels(spark):
    """Held out: rules from two thirds of the labels drop most labelled junk of the other third that passes the base rules, and almost no good text."""
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{sf}/labels.parquet")
    out, _ = quality.quality_rules(docs, labels.where("doc_id % 3 > 0"))
    got = out.join(labels.where("doc_id % 3 = 0"), "doc_id").where("not base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("double")).alias("kept")).collect()
    kept = {r.quality: r.kept for r in got}
    assert kept[0] < 0.1 and kept[1] > 0.998


def test_gains_are_floors():
    got = resampling.bucket_gains(np.array([3, 0, 5]), np.array([0, 0, 9]))
    assert got.tolist() == [math.floor(1000 * math.log((t + 1) * 11 / ((s + 1) * 12))) for s, t in ((3, 0), (0, 0), (5, 9))]
