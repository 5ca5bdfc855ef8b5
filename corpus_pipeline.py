"""A corpus from raw documents: rules, near and substring dedup, a source mix, token ids.

Every stage is written as Parquet to the shared folder and read again by the
next, so a lost executor costs one stage's tasks at most. All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickloom.llm import mixing, near, pieces, quality, repeats
from tickloom.llm.common import materialise, table
from tickloom.llm.paths import vocabulary

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

SHINGLE_WORDS = 5
SIMILARITY = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the threshold table."""
    return quality.judge(docs).where("kept").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8."""
    return near.one_of_each(docs, SHINGLE_WORDS, SIMILARITY)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that earlier documents hold."""
    return repeats.without_repeats(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, a row per copy taken."""
    return mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source and the piece ids of each document of the mix."""
    return pieces.encode(docs.select("doc_id", "source", "text"), vocabulary("piece_bpe_32k.model"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("source_mix", source_mix),
    ("token_ids", token_ids),
]

#: SQL expresses neither the similarity groups nor the piece encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
