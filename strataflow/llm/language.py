"""Language ID by compression: the language whose dictionary makes a text smallest."""

from __future__ import annotations

import re

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.common import attach, ddl, with_columns, written

#: The sample that a dictionary is made of: so many training texts of a language at most, whole; and the dictionary's size.
SAMPLE_TEXTS, DICTIONARY_BYTES = 400, 48_000
#: Texts are encoded in frames of so many bytes, all of them, so that the dictionary and not a long text's own past decides.
FRAME_BYTES = 512
#: Languages whose dictionaries a task holds at a time; further ones take a further pass over the texts.
LANGUAGES = 64
LEVEL = 5
#: The margin is narrow if the second-best size is larger by this share of it or less: the greatest hundredth that rejects under 1 % (0.68 %) of 3,338 rightly told held-out texts (sf0.1).
MIN_MARGIN = 0.05
UNKNOWN = "und"
_NO_LETTERS = re.compile(r"[\W\d_]+")


def fit_dictionaries(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> dict[str, bytes]:
    """A raw-content dictionary for each language, from a bounded sample of the labelled rows.

    The sample: the SAMPLE_TEXTS texts of a language with the smallest hash of `key` and text (rows equal in both are one), whole. Languages are counted first,
    so that all but about twice that many texts of a language are passed over before texts move. Words are counted by Spark, once a text; of words that equally many texts have, those go first that
    stand in a text of fewer different words, so that one long text doesn't fill the dictionary. The
    driver gets as many of a language's as may fit the dictionary. Rows without text or language are left out; no rows give no dictionaries.
    """
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(key), F.col(text)).alias("at"))
    counts = written(rows.groupBy("lang").agg(F.count("*").alias("rows")), "languages")
    share = 1e9 * F.least(F.lit(1.0), (2 * SAMPLE_TEXTS + 200) / F.col("rows"))
    few = attach(rows, counts, "lang", "rows").where(F.pmod("at", F.lit(1_000_000_000)) <= share)
    few = few.groupBy("lang", "at").agg(F.min("text").alias("text"))
    by = Window.partitionBy("lang").orderBy(F.pmod("at", F.lit(1_000_000_000)), "at")
    sample = few.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= SAMPLE_TEXTS).select("lang", "text")

    def split(batches):
        for b in batches:
            for name, value in zip(b.column(0), b.column(1), strict=True):
                words = sorted(set(normalised(value.as_py()).encode("utf-8", "replace").decode().split()))
                columns = [pa.array([name.as_py()] * len(words), pa.string()), pa.array(words, pa.string()), pa.array([len(words)] * len(words), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "word", "among"])

    seen = sample.mapInArrow(split, "lang string, word string, among long").groupBy("lang", "word").agg(F.count("*").alias("texts"), F.min("among").alias("among"))
    top = Window.partitionBy("lang").orderBy(F.desc("texts"), "among", "word")
    first = seen.withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= DICTIONARY_BYTES // 2)
    words: dict[str, list] = {}
    for r in first.select("lang", "word", "rank").collect():
        words.setdefault(r["lang"], []).append((r["rank"], r["word"]))
    return {k: _content([w for _, w in sorted(v)]) for k, v in sorted(words.items())}


def normalised(text: str) -> str:
    """Lower case, with everything but letters as single spaces."""
    return f" {_NO_LETTERS.sub(' ', text.lower()).strip()} "


def _content(words: list[str]) -> bytes:
    """The first words of a list, first ones last (where matches are cheapest). Words and not running text, as a passage that
    strays into another language's sample would otherwise pull all texts with that passage there."""
    out, size = [], 0
    for w in words:
        size += len(w.encode("utf-8", "replace")) + 1
        if size > DICTIONARY_BYTES:
            break
        out.append(w)
    return f" {' '.join(reversed(out))} ".encode("utf-8", "replace")


def identify(docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text") -> DataFrame:
    """docs with lang_pred (und for null or letterless texts, or without dictionaries), score and lang_rejected.

    A text's size in each language is that of its zstandard frames (FRAME_BYTES of normalised text each, all of the text, however long) with the language's
    dictionary. The smallest wins, ties by name. score is the margin: how much larger the second-best size is, as a share of it (1 with a
    single language; 0 for und).
    lang_rejected: und, or a margin of MIN_MARGIN or less between two languages. Each row is told by its text alone, so repeated rows get the same; an empty table
    stays empty. Earlier columns of the three names are replaced. More than LANGUAGES dictionaries are tried in blocks, each a pass over the texts.
    """
    new = ("lang_pred", "score", "lang_rejected")
    kept = [c for c in docs.columns if c not in new]
    out = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)])
    at, names, plain = kept.index(text), list(dictionaries), ddl(out.schema)
    for k in range(0, max(1, len(names)), LANGUAGES):
        block = {n: dictionaries[n] for n in names[k : k + LANGUAGES]}
        out = _sizes(out, docs.sparkSession.sparkContext.broadcast(block), at, plain, len(kept), k == 0)
    best, second = F.get("sizes", F.lit(0)), F.get("sizes", F.lit(1))["size"]
    score = F.when(F.size("sizes") == 0, 0.0).when(second.isNull(), 1.0).otherwise(1 - best["size"] / second)
    out = out.withColumn("score", score).withColumn("pred", F.coalesce(best["lang"], F.lit(UNKNOWN)))
    return out.select(*[f"c{i}" for i in range(len(kept))], "pred", "score", (F.size("sizes") == 0) | (F.col("score") <= MIN_MARGIN)).toDF(*kept, *new)


_SIZES = "array<struct<size:bigint,lang:string>>"


def _sizes(df: DataFrame, held, at: int, plain: str, n: int, first: bool) -> DataFrame:
    """df with sizes: of the languages so far, the two with the smallest sizes (none for a text that has none)."""

    def measure(batches):
        made = []
        for name, d in held.value.items():
            raw = zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(level=LEVEL)
            made.append((name, zstandard.ZstdCompressor(level=LEVEL, dict_data=raw, write_content_size=False, write_dict_id=False).compress))
        kind = pa.list_(pa.struct([("size", pa.int64()), ("lang", pa.string())]))
        for batch in batches:
            found = []
            for k, value in enumerate(batch.column(at)):
                t = value.as_py()
                if not made or not t or not any(map(str.isalpha, t)):
                    found.append([])
                    continue
                b = normalised(t).encode("utf-8", "surrogatepass")
                frames = [b[i : i + FRAME_BYTES] for i in range(0, len(b), FRAME_BYTES)]
                had = [] if first else [(x["size"], x["lang"]) for x in batch.column(n)[k].as_py()]
                found.append([{"size": s, "lang": name} for s, name in sorted(had + [(sum(map(len, map(f, frames))), name) for name, f in made])[:2]])
            yield with_columns(batch.select(range(n)), sizes=pa.array(found, kind))

    return df.mapInArrow(measure, f"{plain}, sizes {_SIZES}")


def training_rows(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows whose crc32(key as text) mod 3 is not 1; a null key counts as the empty text."""
    return docs.where(~held_out(key))


def held_out(key: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 3 == 1
