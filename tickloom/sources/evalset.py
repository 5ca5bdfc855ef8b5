"""Labelled question sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

QUESTIONS = "id string, question string, expected string"


def read_eval_set(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Questions with the source each should retrieve."""
    return spark.read.schema(QUESTIONS).format(fmt).load(path)
