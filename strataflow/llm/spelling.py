"""Spelling variants: words one edit apart, found in dense tiles of code-point matrices by common prefix plus common suffix, and grouped under their commonest forms."""

from __future__ import annotations

import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import discard, written

_RUN = re.compile(r"[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(65, 91)}
#: A word is cut into so many windows; two words one edit apart agree in all but one of them.
WINDOWS = 4
#: Rows of a block (a tile compares two), bytes of a block's code points, code points of the pairs compared at a time, and words whose counts a task holds.
BLOCK_ROWS, BLOCK_BYTES, PAIR_POINTS, COUNTED = 2_048, 4_000_000, 2_000_000, 200_000


def typed_words(doc_id, text: str | None, every: int):
    """(word, how often) of a text: its runs of letters with A-Z lower-cased; where crc32 of `<doc_id>:<run>` is a multiple of `every`, the run lacks the code point at crc32 % length."""
    runs: Counter = Counter()
    for run, n in Counter(_RUN.findall(text or "")).items():
        runs[run.translate(_LOWER)] += n
    for run, n in runs.items():
        if every:
            h = crc32(f"{doc_id}:{run}".encode())
            if h % every == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
        yield run, n


def vocabulary(docs: DataFrame, every: int = 31, least_length: int = 7, least_n: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of all words of least_length code points and least_n occurrences in docs, counted over whole texts (null: none).

    every: where slips of the keyboard are put in, see `typed_words` (0: nowhere); a null id counts as the empty text. Rows that repeat an id are counted each. Tasks hand on partial
    counts, of COUNTED words at a time.
    """

    def count(batches):
        seen: Counter = Counter()
        for b in batches:
            for key, value in zip(b.column(0), b.column(1), strict=True):
                for word, n in typed_words(key.as_py(), value.as_py(), every):
                    if len(word) >= least_length:
                        seen[word] += n
                if len(seen) > COUNTED:
                    yield _counts(seen)
                    seen.clear()
        yield _counts(seen)

    rows = docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")), F.col(f"`{text}`"))
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_n)


def _counts(seen: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], names=["word", "n"])


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, form_n, form): for each word that has any, how many words of `words` (word, n; each word once) differ from it by exactly one inserted, deleted or replaced code point, and
    the one with the largest n (ties: smallest in code-point order) with that n.

    Let m be the length of the shorter of two words, cut into WINDOWS windows. If one edit parts them, there is a window outside which they agree: before it counted from the front, after it
    from the back. So each word is put by what it has outside each window, for m its own length and one less, and words are only compared with those of the same place. A
    place that many words share is cut into blocks, and tiles of two blocks go to tasks of their own. A tile's words are padded code-point matrices, aligned in front and at the end; the columns in
    which a pair first differs are its common prefix and suffix, and one edit parts it if both together reach the longer length less one. It counts in the first
    window in which it meets. Each tile hands on one row for a word, not its pairs.
    """
    of, m, j = F.length("word"), F.col("m"), F.col("j")
    placed = words.select("word", "n", F.explode(F.sequence(F.lit(0), F.lit(2 * WINDOWS - 1))).alias("x")).select("word", "n", (of - F.expr(f"cast(x div {WINDOWS} as int)")).alias("m"), (F.col("x") % WINDOWS).alias("j")).where("m > 0")
    edge = lambda k: F.floor(k * m / WINDOWS).cast("int")
    rest = m - edge(j + 1)
    outside = F.xxhash64(F.expr("left(word, cast(floor(j * m / %d) as int))" % WINDOWS), F.substring(F.col("word"), of - rest + 1, rest))
    placed = placed.select("word", "n", "m", "j", outside.alias("place"))
    place = ["m", "j", "place"]
    room = F.least(F.lit(BLOCK_ROWS), F.greatest(F.lit(1), F.floor(BLOCK_BYTES / (4 * (m + 1))))).cast("int")
    crowds = written(placed.groupBy(*place).agg(F.count("*").alias("k")).where(F.col("k") > room).select(*place, F.ceil(F.col("k") / room).cast("int").alias("parts")), "spelling-crowds")
    cut = placed.join(crowds, place, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    cut = cut.withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    tile = [*place, "a", "b"]
    cut = cut.select("word", "n", *place, F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"), "part")
    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = cut.repartition(tasks, *tile).sortWithinPartitions(*tile).mapInArrow(_compare, "word string, n_near long, form_n long, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("k"), F.col("form").alias("form"))).alias("best")
    return met.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", (-F.col("best.k")).alias("form_n"), "best.form")


def _compare(batches):
    """Rows of whole tiles, in tile order, are compared as soon as enough of them have come."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        held.append(b)
        if sum(x.num_rows for x in held) >= 4 * BLOCK_ROWS or sum(x.nbytes for x in held) >= 4 * BLOCK_BYTES:
            rows = pa.Table.from_batches(held).combine_chunks()
            starts = _tiles(rows)
            if len(starts) > 1:
                yield from _all_pairs(rows.slice(0, starts[-1]), starts[:-1])
                held = rows.slice(starts[-1]).to_batches()
    if held:
        rows = pa.Table.from_batches(held).combine_chunks()
        if rows.num_rows:
            yield from _all_pairs(rows, _tiles(rows))


def _tiles(rows: pa.Table) -> np.ndarray:
    """Where each tile begins."""
    new = np.zeros(rows.num_rows, bool)
    new[:1] = True
    for c in ("m", "j", "place", "a", "b"):
        v = rows.column(c).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)


def _all_pairs(rows: pa.Table, starts: np.ndarray):
    size = np.diff(np.append(starts, rows.num_rows))
    alone = np.repeat(size == 1, size)
    if alone.all():
        return
    keep = np.flatnonzero(~alone)
    tile = np.repeat(np.arange(len(starts)), size)[keep]
    m, j = (rows.column(c).to_numpy()[keep].astype(np.int64) for c in ("m", "j"))
    part, other = (rows.column(c).to_numpy()[keep] for c in ("part", "b"))
    n, words = rows.column("n").to_numpy()[keep], np.array(rows.column("word").take(pa.array(keep)).to_pylist(), object)
    end = np.searchsorted(tile, tile, side="right")
    one_block = part == rows.column("a").to_numpy()[keep]
    one_block &= part == other
    for lo in np.flatnonzero(np.diff(m, prepend=-1)):  # each length class has matrices of its own width
        hi = np.searchsorted(m, m[lo], side="right")
        yield from _class_pairs(words[lo:hi], n[lo:hi], int(m[lo]), j[lo:hi], end[lo:hi] - lo, part[lo:hi], one_block[lo:hi])


def _class_pairs(words: np.ndarray, n: np.ndarray, m: int, j: np.ndarray, end: np.ndarray, part: np.ndarray, one_block: np.ndarray):
    width = m + 1
    front = np.array(list(words), f"U{width}").view(np.uint32).reshape(-1, width)
    back = np.array([w[::-1] for w in words], f"U{width}").view(np.uint32).reshape(-1, width)
    length = np.fromiter(map(len, words), np.int64, len(words))
    order = np.array(sorted(range(len(words)), key=lambda i: (-n[i], words[i])))
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    near, best = np.zeros(len(words), np.int64), np.full(len(words), len(words))
    partners = end - np.arange(len(words)) - 1
    done = np.concatenate([[0], np.cumsum(partners)])
    room, lo = max(1, PAIR_POINTS // width), 0
    while lo < len(words):
        hi = max(lo + 1, int(np.searchsorted(done, done[lo] + room, side="right")) - 1)
        count = partners[lo:hi]
        x = np.repeat(np.arange(lo, hi), count)
        y = np.arange(len(x)) - np.repeat(done[lo:hi] - done[lo], count) + x + 1
        use = (length[x] + length[y] <= 2 * m + 1) & (one_block[x] | (part[x] != part[y]))
        x, y = x[use], y[use]
        prefix, suffix = (front[x] == front[y]).argmin(axis=1), (back[x] == back[y]).argmin(axis=1)
        at = j[x] * m // WINDOWS
        hit = (prefix + suffix >= np.maximum(length[x], length[y]) - 1) & ((j[x] == 0) | (suffix < m - at))
        x, y = x[hit], y[hit]
        for a, b in ((x, y), (y, x)):
            near += np.bincount(a, minlength=len(words))
            np.minimum.at(best, a, rank[b])
        lo = hi
    got = np.flatnonzero(near)
    if len(got):
        form = order[best[got]]
        yield pa.RecordBatch.from_arrays([pa.array(words[got], pa.string()), pa.array(near[got]), pa.array(n[form]), pa.array(words[form], pa.string())], names=["word", "n_near", "form_n", "form"])


def group_variants(words: DataFrame, times: int = 10) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of each of `words` (word, n; each word once).

    form is the near word with the largest n (see `near_words`), if that is `times` the word's own n or more, else null; form_n its n. root is where forms lead in the end, the word
    itself without a form. n_near is 0 for words without near ones. No words give no rows. n grows by `times` with each form, so chains are short; each round of
    joins doubles how far they are followed.
    """
    words = written(words.select("word", "n"), "spelling-words")
    found = words.join(near_words(words), "word", "left")
    is_form = F.col("form_n") >= times * F.col("n")
    found = written(found.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("form")).alias("form"), F.when(is_form, F.col("form_n")).alias("form_n")), "spelling-near")
    roots = written(found.where("form is not null").select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "spelling-roots")
    while roots.where("moved").limit(1).count():
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = written(roots.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        discard(roots)
        roots = after
    return found.join(roots.select("word", "root"), "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs: DataFrame, every: int = 31, least_length: int = 7, least_n: int = 2, times: int = 10, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`group_variants` of the `vocabulary` of docs. Null, empty and letterless texts have no words; other columns, whatever their names, play no part; an empty table gives no rows."""
    return group_variants(vocabulary(docs, every, least_length, least_n, doc_id, text), times)
