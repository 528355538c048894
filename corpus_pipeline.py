"""A training corpus from raw documents, stage by stage.

Each stage takes what the one before kept and is one of the operators of
``cairn.llm``; its result is written as Parquet and read again for the next.
The last returns a row per sequence slot of the training order.

Edge cases, as in the operators: documents with NULL or empty text break the
first rule and go, whatever their other columns; with only such documents, or
none, all stages run on empty tables and the result is empty. NULL sources are a
source of their own. Rows that repeat are one group of copies, of which one
stays; among copies with and without id one with the smallest id does. Texts of
any length are read whole. Extra columns are kept up to the last stage and may
have any name. The table a stage has read is deleted when the next is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cairn.llm import decontaminate, mixing, ngram_join, quality_rules, training_order
from cairn.llm.scratch import discard, stored
from cairn.session import tune


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break no quality rule."""
    tune(spark)
    return quality_rules.keep_good(docs, lang="lang")


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    tune(spark)
    return ngram_join.keep_one(docs)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage of weight."""
    tune(spark)
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    tune(spark)
    return mixing.mixed_rows(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences in training order, written as shards; a row per slot."""
    tune(spark)
    return training_order.materialise(docs, training_order.shard_folder(docs)).drop("file")


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", deduplicate),
    ("benchmark decontamination", clean_of_benchmark),
    ("mixing sources to target weights", mix),
    ("token-ID / binary output", sequences),
]

# Permutation, tokens and components are beyond SQL; tests compare with a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder."""
    docs, read = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        before, docs = read, stored(stage(spark, docs, sf_dir), f"stage-{name.split()[0]}")
        if before is not None:
            discard(before)
        read = docs
    manifest = STAGES[-1][1](spark, docs, sf_dir)
    discard(docs)
    return manifest
