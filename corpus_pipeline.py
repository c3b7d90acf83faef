"""A corpus pipeline over `documents`: language ID, near-dedup, decontamination, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm import decontamination, language, near_dup, packing
from strataflow.llm.common import discard, written


def _plain(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with columns named by place, so that none clashes with what operators add, and the text's name there."""
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]), f"c{docs.columns.index('text')}"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language the compression classifier tells: und and narrow margins between two languages go.

    Dictionaries are fitted on the stage's own labelled documents but a held-out third. Columns are those of docs, whatever their names; null and letterless texts go; repeated rows stay or go each.
    """
    own, text = _plain(docs)
    found = language.identify(own, language.fit_dictionaries(language.training_rows(docs)), text=text)
    return found.where(~F.col("lang_rejected")).select(own.columns).toDF(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near copies (five-word shingles, similarity 0.8 or more) the row with the smallest doc_id (null: last), one row if several have it.

    Texts without words are no copies of anything and stay, and so do rows without doc_id and rows that repeat one, unless their text is a near copy.
    """
    return near_dup.keep_first(docs, size=5, least=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in which no ten-word window of a benchmark item occurs. Null and empty texts have no words and stay; repeated rows stay or go each; columns of any name are kept."""
    own, text = _plain(docs)
    found = decontamination.find_contamination(own, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), text=text)
    return found.where("n_hit = 0").select(own.columns).toDF(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is kept into sequences of 1024 tokens: a row for each piece of each document. Null and empty texts are a piece of the end id alone; repeated rows are packed each;
    an empty table gives no rows; other columns play no part."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language", identify_language), ("near_dup", drop_near_duplicates), ("decontamination", decontaminate), ("packing", pack)]
#: Compression, signatures and tokens aren't SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, one after the other, over the documents of sf_dir; a stage's table goes as soon as the next one's is written."""
    docs, spent = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
        discard(*spent)
        spent = [docs]
    return docs
