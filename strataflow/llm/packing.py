"""Best-fit packing: length patterns fitted to the histogram by non-negative least squares; what rounding leaves is packed best-fit."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.common import written
from strataflow.llm.tokens import encoder, slices

#: Patterns that enter the fit in a round, and the gain (as a share of the mean count of a length) at which it has converged.
ENTER, CONVERGED = 96, 3e-3
#: Fractions of a repeat from which rounding goes up, while pieces last; the one with the fewest sequences in all is taken.
ROUND_UP = (0.5, 0.7, 0.9, 1.0)


def patterns(lengths: np.ndarray, size: int) -> np.ndarray:
    """All sums of two or three of the lengths that fill `size`, as rows of three (0: none), ascending; whole-size ones apart."""
    has = np.zeros(size + 1, bool)
    has[lengths] = True
    a, b = np.meshgrid(lengths, lengths, indexing="ij")
    a, b = a[a <= b], b[a <= b]
    c = size - a - b
    pairs = c == 0
    triples = (c >= b) & has[np.clip(c, 0, size)]
    return np.concatenate([np.stack([np.zeros_like(a[pairs]), a[pairs], b[pairs]], 1), np.stack([a[triples], b[triples], c[triples]], 1)])


def fit_repeats(pats: np.ndarray, hist: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Repeat counts x >= 0 of the patterns that bring their lengths nearest the histogram: non-negative least squares over an active set, to convergence.

    Each round lets in the ENTER patterns along the steepest part of the gradient, no length twice, solves for all that are in, and drops those
    that turn negative until none does. A round that doesn't bring the histogram nearer is taken back, and fewer enter; with one at a time at the
    latest the residual falls until no pattern outside has a gain. A basic solution has no more patterns than lengths, so that rounding loses little.
    """
    want, inside, x = weight * hist, np.empty(0, np.int64), np.zeros(len(pats))
    columns, gram, y, rest = np.zeros((len(hist), 0)), np.zeros((0, 0)), np.empty(0), weight * hist
    least, error, enter = CONVERGED * max(1.0, hist.mean()), float((weight * hist) @ (weight * hist)), ENTER
    while len(pats):
        gain = (weight * rest)[pats].sum(1)
        gain[inside] = -np.inf
        used, new = np.zeros(len(hist), bool), []
        for i in np.argsort(-gain, kind="stable")[: 40 * enter].tolist():
            if gain[i] <= least or len(new) == enter:
                break
            own = pats[i][pats[i] > 0]
            if not used[own].any():
                used[own] = True
                new.append(i)
        if not new:
            break
        more = np.zeros((len(hist), len(new)))
        for k in range(pats.shape[1]):
            np.add.at(more, (pats[new, k], np.arange(len(new))), weight[pats[new, k]])
        more[0] = 0  # no piece
        cross = columns.T @ more
        all_columns, all_gram, ids = np.hstack([columns, more]), np.block([[gram, cross], [cross.T, more.T @ more]]), np.append(inside, new)
        stay, aim = np.arange(len(ids)), all_columns.T @ want
        while True:
            z = np.linalg.solve(all_gram[np.ix_(stay, stay)] + 1e-9 * np.eye(len(stay)), aim[stay])
            if (z > 0).all():
                break
            stay = stay[z > 0]
        left = want - all_columns[:, stay] @ z
        if left @ left < error * (1 - 1e-9):
            error, rest, inside, y, columns, gram = float(left @ left), left, ids[stay], z, all_columns[:, stay], all_gram[np.ix_(stay, stay)]
        elif enter == 1:
            break
        else:
            enter = max(1, enter // 4)
    x[inside] = y
    return x


def best_fit(hist: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """(contents, how many such sequences): the lengths, longest first, each into the fullest sequences that still hold it.

    Equal sequences are handled together, so the work depends on the number of different lengths, not on the number of pieces.
    """
    open_: dict[int, list[list]] = {}  # by room left
    done: list[tuple[tuple[int, ...], int]] = []

    def put(contents: tuple[int, ...], n: int, room: int) -> None:
        if n:
            open_.setdefault(room, []).append([contents, n]) if room else done.append((contents, n))

    for length in range(size, 0, -1):
        n = int(hist[length])
        while n:
            room = min((r for r in open_ if r >= length), default=None)
            if room is None:
                each = size // length
                put((length,) * each, n // each, size - each * length)
                if n % each:
                    put((length,) * (n % each), 1, size - n % each * length)
                break
            contents, held = open_[room][-1]
            each = min(room // length, n)  # fill one kind of sequence as far as it goes
            take = min(held, n // each)
            open_[room][-1][1] -= take
            if held == take:
                open_[room].pop()
                if not open_[room]:
                    del open_[room]
            put(contents + (length,) * each, take, room - each * length)
            n -= take * each
    return done + [(tuple(c), n) for kinds in open_.values() for c, n in kinds]


def choose(hist: np.ndarray, size: int) -> tuple[list[tuple[tuple[int, ...], int]], int]:
    """(contents, how many such sequences) for all pieces below `size`, and how many of the sequences are patterns.

    The fit counts all lengths alike; only if that needs more sequences than the tokens would fill, a second fit counts long pieces for more, as what is left
    over of them costs more than short ones. Of the roundings the one with the fewest sequences is taken, of these the one with the most patterns.
    """
    pats = patterns(np.flatnonzero(hist), size)
    lengths, found = np.arange(size + 1), []
    bound = -(-int((hist * lengths).sum()) // size)
    for weight in (np.ones(size + 1), lengths / size):
        x = fit_repeats(pats, hist, weight)
        for up in ROUND_UP:
            made, left = _rounded(pats, x, hist, up)
            kinds = made + best_fit(left, size)
            found.append((sum(n for _, n in kinds), -sum(n for _, n in made), len(found), kinds))
        if min(found)[0] == bound:
            break
    _, made, _, kinds = min(found)
    return kinds, -made


def plan(hist: np.ndarray, size: int) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset, count): which pieces of a length go where. hist[n]: pieces of length n."""
    below = hist.astype(np.int64).copy()
    below[size] = 0
    kinds, _ = choose(below, size)
    if hist[size]:
        kinds.append(((size,), int(hist[size])))
    rows, rank, sequence = [], np.zeros(size + 1, np.int64), 0
    for contents, n in kinds:
        offset = 0
        for v in contents:
            rows.append((v, int(rank[v]), sequence, offset, n))
            rank[v] += n
            offset += v
        sequence += n
    return np.array(rows, np.int64).reshape(-1, 5)


def _rounded(pats: np.ndarray, x: np.ndarray, hist: np.ndarray, up: float) -> tuple[list[tuple[tuple[int, ...], int]], np.ndarray]:
    """Patterns repeated as often as x says, rounded down and then, from a fraction of `up` on, up, as far as pieces are there; and the pieces that are left."""
    left, kinds = hist.copy(), []

    def take(i: int, most: int) -> None:
        own = [v for v in pats[i].tolist() if v]
        n = min([most, *(int(left[v]) // own.count(v) for v in own)])
        if n > 0:
            for v in own:
                left[v] -= n
            kinds.append((tuple(sorted(own, reverse=True)), n))

    whole = np.floor(x + 1e-6)
    for i in np.argsort(-whole, kind="stable")[: np.count_nonzero(whole)].tolist():
        take(i, int(whole[i]))
    for i in np.argsort(whole - x, kind="stable").tolist():
        if x[i] - whole[i] < up:
            break
        take(i, 1)
    return kinds, left


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, local long"


def cut_pieces(docs: DataFrame, tokenizer: str, size: int, doc_id: str, text: str, end_id: int) -> DataFrame:
    """A row for each piece of each document, numbered in its task among the pieces of its length (part, local)."""

    def cut(batches):
        encode, part, seen = encoder(tokenizer).encode, TaskContext.get().partitionId(), [0] * (size + 1)
        for b in batches:
            keys, texts = b.column(0), b.column(1)
            for run in slices(texts):
                rows = []
                for i, raw in zip(run, encode([texts[i].as_py() for i in run]), strict=True):
                    raw += end_id.to_bytes(4, "little")
                    key, n = keys[i].as_py(), len(raw) // 4
                    ends = list(range(n % size or size, n + 1, size))
                    for k, e in enumerate(ends):
                        s = ends[k - 1] if k else 0
                        rows.append((key, k, s, e - s, zlib.crc32(raw[4 * s : 4 * e]), part, seen[e - s]))
                        seen[e - s] += 1
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=[c.split()[0] for c in PIECES.split(", ")])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(cut, PIECES)


def pack(docs: DataFrame, tokenizer: str, size: int = 1024, doc_id: str = "doc_id", text: str = "text", end_id: int = 2) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of each piece of each document.

    A document is its ids and the end id (null or empty text: only that). Longer ones than `size`, however long, are cut into pieces of `size`, of which the first takes the
    odd rest. Rows that repeat an id or a text are packed each; null ids stay null; empty input gives no rows. Sequences are numbered from 0.
    Other columns of docs, whatever their names, play no part.

    The driver sees the histogram of lengths (`size` numbers) and plans ranks of each length; a piece's rank is its number in its task and
    the count of that length in earlier tasks, so no length, however common, meets in one task.
    """
    pieces = written(cut_pieces(docs, tokenizer, size, doc_id, text, end_id), "pieces")
    counts = written(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    hist = np.zeros(size + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():
        hist[r["length"]] = r["n"]
    rows = plan(hist, size)
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    at = rows[:, 0] * (1 << 40) + rows[:, 1]
    held = docs.sparkSession.sparkContext.broadcast((rows, at))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")

    def place(batches):
        rows, at = held.value
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            run = rows[np.searchsorted(at, length * (1 << 40) + rank, side="right") - 1] if b.num_rows else np.empty((0, 5), np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(run[:, 2] + rank - run[:, 1]), pa.array(run[:, 3])], names=[*b.schema.names[:5], "sequence_id", "offset"])

    ranked = pieces.join(base, ["part", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("local") + F.col("base")).alias("rank"))
    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
