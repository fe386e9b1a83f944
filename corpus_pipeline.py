"""From raw documents to packed training sequences, stage by stage.

Each stage takes what the one before it kept, stored as parquet.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from commitlens.llm.language import keep_identified, learn_dictionaries
from commitlens.llm.mixing import take_mixed
from commitlens.llm.packing import pack
from commitlens.llm.quality import keep_good, rules_of
from commitlens.llm.queries import mixture_levels
from commitlens.llm.simhash import keep_one_of_each
from commitlens.llm.tokens import default_tokenizer
from commitlens.scratch import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the rules learned from `labels` reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return keep_good(docs, rules_of(docs, labels))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear."""
    return keep_identified(docs, learn_dictionaries(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id."""
    return keep_one_of_each(docs, shingle=4, distance=4)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's share of four fifths of all tokens takes them."""
    return take_mixed(docs, mixture_levels(), percent=80, max_epochs=3, seed=17)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, each with its place in a sequence of 2048 tokens."""
    return pack(docs, default_tokenizer(), end_id=0, capacity=2048)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("mixture", mixture),
    ("packing", packing),
]

# Learned rules, compression and tokens have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the whole table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
