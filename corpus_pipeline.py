"""The corpus pipeline: documents in, packed training sequences out.

``STAGES`` are (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents.

1. language_id: documents whose language is not recognised go.
2. line_dedup: later repeats of a run of lines are deleted; documents nothing
   is left of go.
3. ngram_jaccard: of near copies (five-word shingles, Jaccard 0.8) one stays.
4. decontaminate: documents that cover most of a benchmark item go.
5. pack: pieces of at most 1024 tokens, placed in sequences.

Empty tables pass through every stage; null texts go with stage 1 (no language).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from prefweave.llm import decontaminate, language, linededup, ngram_join, packing
from prefweave.llm.tables import read, stored


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linededup.without_repeats(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("decontaminate", decontamination),
    ("pack", pack),
]

# Tokenisation, training and components are not plain SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
