"""A training-data pipeline over ``documents``; each stage is one operator of ``tillwork.llm``.

Each stage works on what its predecessor kept, written as Parquet and reread. The first four
return the columns of ``documents``, the last one the pieces of packed sequences. Stages handle
nulls, empty and long texts, repeated rows and empty tables as their operators say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillwork.llm import (
    curve_packing,
    positional_index,
    quality_rules,
    template_tree,
    vertical_join,
)
from tillwork.llm.shipping import ship
from tillwork.session import fresh_dir


def keep_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that the threshold table rejects go."""
    return quality_rules.filter_documents(docs)


def drop_template_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: lines of templates that recur in three documents or more go, but for the
    first. Documents stay, also without a line left; ``n_chars`` is that of the source."""
    return template_tree.replace_text(docs)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of documents that links connect, the smallest id stays."""
    return vertical_join.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents with a twentieth of their words in benchmark
    windows go."""
    return positional_index.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: pieces of sequences of 4096 ids in the order of the curve."""
    return curve_packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", keep_by_rules),
    ("line_dedup", drop_template_lines),
    ("ngram_jaccard_join", keep_one_of_each),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

# Tokenizing is not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        folder = fresh_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
