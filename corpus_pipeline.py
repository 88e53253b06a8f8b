"""The corpus pipeline: documents to token ids in five stages.

1. language: texts whose language is not identified go.
2. lines: later repeated runs of lines are cut; documents that lose all their lines go.
3. similar: of documents with similar sets of 5-word shingles (Jaccard 0.8 or more) one stays.
4. mix: documents are repeated, or left out, so that sources come near their target weights.
5. tokens: every document as token ids, and the text they decode to.

Each stage works on all its predecessor kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from relayout.llm import bpe, jaccard, language, lines, mixing
from relayout.llm.common import stage


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_identified(docs, language.learn(docs))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.unpacked(lines.dedup_lines(docs))


def drop_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs, words=5, similar=(80, 100))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeated(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs, bpe.read_spec())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("lines", dedup_lines),
    ("similar", drop_similar),
    ("mix", mix_sources),
    ("tokens", tokenize),
]

#: SQL expresses neither the compression classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
