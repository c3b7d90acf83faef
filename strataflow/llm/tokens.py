"""Token ids of whole texts by a tokenizers file: words are parted and counted by Arrow, and their ids kept in a bounded cache."""

from __future__ import annotations

import json
import os
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of words and ids that are kept, and letters of a word that is kept; longer ones are worked out each time.
CACHED_BYTES, CACHED_LETTERS = 32_000_000, 32
#: Texts of these characters alone take the short way: ASCII but for control characters, line feeds, and Latin-1 letters.
_PLAIN = re.compile(r"[\n -~À-ÖØ-öø-ÿ]*")
#: How the two files part texts before BPE, for that alphabet. With spaces kept, and without (lower case).
_KEEP_SPACES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[!-/:-@\[-`{-~]+|\s+(?!\S)|\s+")
_NO_SPACES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[!-/:-@\[-`{-~]+")


#: What marks a text's first word; no text that is parted here holds it.
_FIRST = "\x00"


def _byte_letters() -> list[str]:
    """The printable letter that byte-level BPE writes for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


#: How tokenizers files describe the two ways of parting texts that are known here, as (normalizer, pre_tokenizer, end_of_word_suffix).
_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True}
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_KNOWN = {
    True: (None, _BYTE_LEVEL | {"use_regex": True}, None),
    False: (
        {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
        {"type": "Sequence", "pretokenizers": [{"type": "Split", "pattern": {"Regex": _SPLIT}, "behavior": "Removed", "invert": True}, _BYTE_LEVEL | {"use_regex": False}]},
        "</w>",
    ),
}


#: White space that doesn't simply part two words: where it stands, spaces belong to one another.
_SPACED = re.compile(r"  | \n|\n ")


class Encoder:
    """encode(texts) gives each text's ids, as tokenizers' encode(text, add_special_tokens=False) does.

    BPE works on one piece (a run of letters, of digits, of marks) at a time and no piece goes beyond a word, so texts are parted at white space, each different word of a batch is looked
    up once, and the ids of known words are kept. That holds for
    files that part texts in one of two known ways (with spaces: byte-level BPE whose pieces hold the space before them; without: word BPE that lower-cases and drops
    white space), which is looked up in the file. Texts with other characters, or with a special token's string, and all texts of other files go through the
    library's whole encode.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        spec = json.loads(self.whole.to_str())
        ways = (spec["normalizer"], spec["pre_tokenizer"], spec["model"].get("end_of_word_suffix"))
        plain = spec["model"]["type"] == "BPE" and not spec["model"]["dropout"] and not spec["truncation"] and not spec["padding"]
        self.spaces = next((k for k, v in _KNOWN.items() if plain and v == ways), None)
        self.special = re.compile("|".join(re.escape(t.content) for t in self.whole.get_added_tokens_decoder().values()) or r"(?!)")
        self.known = Known(self._ids)
        self.letters = dict(enumerate(_byte_letters()))

    def _ids(self, word: str) -> bytes:
        """Ids of a word; where spaces count, of the word with a space before it, or of the rest of it after a first _FIRST."""
        if not self.spaces:
            pieces = _NO_SPACES.findall(word)
        else:
            pieces = _KEEP_SPACES.findall(word[1:] if word[:1] == _FIRST else f" {word}")
        mapped = (p if p.isascii() and p.isalnum() else p.encode().decode("latin-1").translate(self.letters) for p in pieces)
        return array("I", [t.id for p in mapped for t in self.whole.model.tokenize(p)]).tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        out, short = [b""] * len(texts), []
        for i, t in enumerate(texts):
            if not t:
                continue
            if self.spaces is None or not _PLAIN.fullmatch(t) or self.special.search(t) or (self.spaces and _SPACED.search(t)):
                out[i] = np.array(self.whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
            else:
                short.append(i)
        if short:
            for i, ids in zip(short, self._short([texts[i] if self.spaces else texts[i].lower() for i in short]), strict=True):
                out[i] = ids
        return out

    def _short(self, texts: list[str]) -> list[bytes]:
        column = pa.array(texts, pa.large_string())
        parted = pc.split_pattern(column, " ") if self.spaces else pc.utf8_split_whitespace(column)
        offsets, words = parted.offsets.to_numpy(), parted.flatten()
        if self.spaces:  # a text's first word has no space before it
            first = np.zeros(len(words), bool)
            first[offsets[:-1]] = True
            words = pc.if_else(pa.array(first), pc.binary_join_element_wise(pa.scalar(_FIRST, pa.large_string()), words, pa.scalar("", pa.large_string())), words)
        codes, ids, begins, lengths = self.known.look_up(words)
        each = lengths[codes]
        ends = np.concatenate([[0], np.cumsum(each)])
        # the ids of word after word: where a word's ids begin in the joined ones, and how far each id is from there
        at = np.repeat(begins[codes] - ends[:-1], each) + np.arange(ends[-1])
        every, cut = ids[at], ends[offsets]
        return [every[a:b].tobytes() for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]


@lru_cache(4)
def encoder(path: str) -> Encoder:
    """The Encoder of a file, one for each worker process: its tasks share the cache."""
    return Encoder(path)


class Known:
    """Words and their ids. When they outgrow CACHED_BYTES, those of the last batch alone are kept."""

    def __init__(self, make):
        self.make = make
        self.words, self.ids, self.ends = pa.array([], pa.large_string()), np.empty(0, "<u4"), np.zeros(1, np.int64)

    def look_up(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(code of each word, ids of all codes, where a code's ids begin there, how many they are)."""
        found = pc.index_in(words, value_set=self.words)
        codes, long = found.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), False
        if found.null_count:
            lacking = found.is_null()
            new = words.filter(lacking).dictionary_encode()
            long = pc.max(pc.utf8_length(new.dictionary)).as_py() > CACHED_LETTERS
            made = list(map(self.make, new.dictionary.to_pylist()))
            codes[lacking.to_numpy(zero_copy_only=False)] = len(self.words) + new.indices.to_numpy()
            self.words = pa.concat_arrays([self.words, new.dictionary])
            self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(made), "<u4")])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(np.fromiter(map(len, made), np.int64, len(made))) // 4])
        out = codes, self.ids, self.ends[:-1], np.diff(self.ends)
        full = self._bytes() > CACHED_BYTES
        if long or full:
            kept = np.zeros(len(self.words), bool)
            kept[codes if full else slice(None)] = True
            kept &= ~pc.greater(pc.utf8_length(self.words), CACHED_LETTERS).to_numpy(zero_copy_only=False)
            lengths = np.diff(self.ends)
            self.ids, self.words = self.ids[np.repeat(kept, lengths)], self.words.filter(pa.array(kept))
            self.ends = np.concatenate([[0], np.cumsum(lengths[kept])])
            if self._bytes() > CACHED_BYTES:
                self.__init__(self.make)
        return out

    def _bytes(self) -> int:
        return self.words.nbytes + self.ids.nbytes + self.ends.nbytes


def slices(values, most_chars: int = 4_000_000):
    """Positions of an Arrow column in runs of about most_chars characters, so that long texts don't add up."""
    start = size = 0
    for i, v in enumerate(values):
        size += len(v.as_py() or "") if v.is_valid else 0
        if size >= most_chars:
            yield range(start, i + 1)
            start, size = i + 1, 0
    if start < len(values):
        yield range(start, len(values))
