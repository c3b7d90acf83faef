"""Benchmark decontamination: one Aho-Corasick automaton over the word windows of all test items, run once over each text."""

from __future__ import annotations

import hashlib
import pickle
import re
from zlib import compress, decompress

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import ddl, with_columns

#: Bytes 0x00-0x2F, 0x3A-0x60 and 0x7B-0x7F separate words, once A-Z are lower-cased; all bytes of non-ASCII letters belong to words.
_WORD_BYTES = bytes(b if (0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80) else 0x20 for b in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_UNKNOWN = "\x00"
#: Test items are broadcast in blocks of at most so many bytes of words; each block makes one automaton. A block has a million different words at most, as automata have letters for.
BLOCK_BYTES = 3_000_000
#: With several blocks, a task holds so many bytes of texts while one automaton after the other goes over them.
HELD_BYTES = 32_000_000


def words_of(text: str | None) -> list[bytes]:
    """The normalised words of a text, in UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().translate(_WORD_BYTES).split() if text else []


class Windows:
    """The automaton. A word is one letter of its alphabet, so a pattern has as many letters as its window has words."""

    def __init__(self, items: list[tuple[int | None, str]], window: int):
        self.letters: dict[bytes, str] = {}
        owners: dict[str, set] = {}
        for item, text in items:
            code = "".join(self._letter(w) for w in words_of(text))
            for i in range(max(1, len(code) - window + 1)) if code else ():
                owners.setdefault(code[i : i + window], set()).add(item)
        self.automaton = ahocorasick.Automaton()
        for pattern, of in owners.items():
            self.automaton.add_word(pattern, (len(pattern), frozenset(of)))
        self.automaton.make_automaton()
        self.empty = not owners

    def _letter(self, word: bytes) -> str:
        n = len(self.letters) + 1
        return self.letters.setdefault(word, chr(n if n < 0xD800 else n + 0x800))

    def scan(self, words: list[bytes]) -> tuple[list[list[int]], set]:
        """Hit runs of words as [start, end), merged and ascending, and the items whose windows occur."""
        if self.empty or not words:
            return [], set()
        get = self.letters.get
        text = "".join([get(w, _UNKNOWN) for w in words])
        runs: list[list[int]] = []
        items: set = set()
        for end, (n, of) in self.automaton.iter(text):
            items |= of
            start = end + 1 - n
            while runs and runs[-1][0] >= start:
                runs.pop()
            if runs and runs[-1][1] >= start:
                runs[-1][1] = end + 1
            else:
                runs.append([start, end + 1])
        return runs, items


def merged(runs: list) -> list[list[int]]:
    """Overlapping or touching runs joined."""
    out: list[list[int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def find_contamination(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 10) -> DataFrame:
    """docs with n_words, n_hit, items (sorted ids as strings) and spans ([start, end) character offsets in the original text).

    A word is hit if an occurrence of `window` consecutive item words covers it; an item with fewer words is one window. Null or empty
    texts have no words; items without text or words match nothing; items whose id is null mark words but aren't listed. Repeated
    items count once, repeated documents each give a row. Texts and items of any length are taken whole. Other columns are kept, but for earlier ones named like the four new. Empty
    documents give no rows, an empty benchmark marks nothing.

    The items go to the tasks in blocks of BLOCK_BYTES at most (a longer item is cut, with as much overlap as windows need), packed; a task has one automaton, that of one block, at a time. All texts
    are scanned in one pass, at any number of blocks: some are held (HELD_BYTES), each block's automaton goes over them, and the last one stays for the next ones. So documents are
    neither written nor moved, and what a task holds is an automaton, some texts and the packed words of the benchmark.
    """
    new = ("n_words", "n_hit", "items", "spans")
    kept = [c for c in docs.columns if c not in new]
    out = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)])  # own names, so that no column clashes
    rows = items.where(F.col(item_text).isNotNull()).select(item_id, item_text).distinct().toLocalIterator()
    blocks = [docs.sparkSession.sparkContext.broadcast(compress(pickle.dumps(b))) for b in _blocks(rows, window)]
    return _scan(out, blocks, window, kept.index(text), ddl(out.schema)).toDF(*kept, *new)


def _blocks(rows, window: int):
    """Lists of (item id, its normalised words as one text) of BLOCK_BYTES at most; at least one list."""
    block, size = [], 0
    for item, text in rows:
        for part in _parts(words_of(text), window):
            if block and size + len(part) > BLOCK_BYTES:
                yield block
                block, size = [], 0
            block.append((item, part.decode("utf-8", "surrogatepass")))
            size += len(part)
    yield block


def _parts(words: list[bytes], window: int):
    """An item's words joined, in parts of about BLOCK_BYTES / 2 that share window - 1 words, so that each window is in one."""
    start = 0
    while start < len(words):
        end, size = start, 0
        while end < len(words) and (size <= BLOCK_BYTES // 2 or end - start < window):
            size += len(words[end]) + 1
            end += 1
        yield b" ".join(words[start:end])
        if end == len(words):
            return
        start = end - window + 1


def _scan(df: DataFrame, blocks: list, window: int, at: int, plain: str) -> DataFrame:
    """One pass over the texts with all automata: word runs and items of each, as counts and offsets."""

    def scan(batches):
        machine, of = None, -1
        for held in _held(batches, HELD_BYTES if len(blocks) > 1 else 0):
            n_words, hits = {}, {}
            turn = sorted(range(len(blocks)), key=lambda k: k != of)  # the automaton that is there goes first
            for k in turn:
                if k != of:
                    machine, of = None, k  # one at a time
                    machine = Windows(pickle.loads(decompress(blocks[k].value)), window)
                for b, batch in enumerate(held):
                    for i, value in enumerate(batch.column(at)):
                        words = words_of(value.as_py())
                        n_words[b, i] = len(words)
                        runs, items = machine.scan(words)
                        if runs:
                            old, ids = hits.get((b, i), ([], set()))
                            hits[b, i] = (merged(old + runs), ids | items)
            for b, batch in enumerate(held):
                found = [hits.get((b, i), ([], set())) for i in range(batch.num_rows)]
                spans = []
                for value, (runs, _) in zip(batch.column(at), found, strict=True):
                    place = [m.span() for m in _WORD.finditer(value.as_py().translate(_LOWER))] if runs else []
                    spans.append([{"start": place[x][0], "end": place[y - 1][1]} for x, y in runs])
                yield with_columns(
                    batch, n_words=pa.array([n_words[b, i] for i in range(batch.num_rows)], pa.int64()), n_hit=pa.array([sum(y - x for x, y in runs) for runs, _ in found], pa.int64()),
                    items=pa.array([sorted({str(i) for i in ids if i is not None}) for _, ids in found], pa.list_(pa.string())), spans=pa.array(spans, _SPANS),
                )

    return df.mapInArrow(scan, f"{plain}, n_words long, n_hit long, items array<string>, spans array<struct<start:bigint,end:bigint>>")


def _held(batches, least: int):
    """Lists of batches of `least` bytes or more each, but for the last one."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        held.append(b)
        if sum(x.nbytes for x in held) >= least:
            yield held
            held = []
    if held:
        yield held


_LOWER = {c: c + 32 for c in range(65, 91)}
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def brute_force(docs: list[tuple], items: list[tuple], window: int = 10) -> dict:
    """The same counts by plain comparison of word lists, for tests: {doc: (n_words, n_hit, sorted item ids)}."""
    out = {}
    norm = lambda t: _WORD.findall((t or "").translate(_LOWER))
    wins = [(i, tuple(w[k : k + window])) for i, t in items for w in [norm(t)] if w for k in range(max(1, len(w) - window + 1))]
    for d, t in docs:
        w = norm(t)
        hit, found = set(), set()
        for i, x in wins:
            for k in range(len(w) - len(x) + 1):
                if tuple(w[k : k + len(x)]) == x:
                    hit.update(range(k, k + len(x)))
                    found.add(str(i))
        out[d] = (len(w), len(hit), sorted(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest())
    return out
