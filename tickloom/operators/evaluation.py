"""Retrieval scores and checks of a labelled question set."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions import columns as C
from tickloom.operators.lookups import not_in


def label_rank(questions: DataFrame, ranking: DataFrame) -> DataFrame:
    """(id, expected, rank): the first rank whose source is the expected one, null when it is missing.

    ``questions`` has (id, expected), ``ranking`` (query_id, rank, source).
    """
    hits = ranking.groupBy(F.col("query_id").alias("id"), F.col("source").alias("expected")).agg(
        F.min("rank").alias("rank")
    )
    return questions.select("id", "expected").join(hits, ["id", "expected"], "left")


def retrieval_scores(ranks: DataFrame) -> DataFrame:
    """Hits, rates and mean reciprocal rank over all questions, as one row."""
    first, three = (F.count(F.when(F.col("rank") <= n, 1)) for n in (1, 3))
    total = F.count(F.lit(1))

    def share(part):
        return F.round(F.coalesce(F.try_divide(part, total), F.lit(0.0)), 4)

    reciprocal = F.avg(C.reciprocal_rank(F.col("rank")))
    return ranks.agg(
        total.alias("questions"),
        first.alias("hit_at_1"),
        three.alias("hit_at_3"),
        share(first).alias("precision_at_1"),
        share(three).alias("hit_rate_at_3"),
        F.round(F.coalesce(reciprocal, F.lit(0.0)), 4).alias("mrr"),
    )


def hit_at_k(ranks: DataFrame, ks: Sequence[int]) -> DataFrame:
    """The hit rate at each ``k``, from one pass over the ranks."""
    rates = ranks.agg(*[F.avg((F.coalesce("rank", F.lit(0)).between(1, k)).cast("double")).alias(f"_{k}") for k in ks])
    rows = F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"_{k}").alias("hit_rate")) for k in ks])
    return rates.select(F.inline(rows))


def context_size(passages: DataFrame) -> DataFrame:
    """Mean characters and passages retrieved per query."""
    per_query = passages.groupBy("query_id").agg(
        F.sum(F.length("text")).alias("characters"), F.count(F.lit(1)).alias("passages")
    )
    return per_query.agg(
        F.count(F.lit(1)).alias("queries"),
        F.avg("characters").alias("mean_characters"),
        F.avg("passages").alias("mean_passages"),
    )


def missing_labels(questions: DataFrame, corpus: DataFrame) -> DataFrame:
    """Questions whose expected source is not in the corpus."""
    return not_in(questions, corpus, "expected", "source")


def unasked_documents(corpus: DataFrame, questions: DataFrame) -> DataFrame:
    """Sources no question expects."""
    return not_in(corpus.select("source"), questions, "source", "expected")


def index_summary(collection: DataFrame) -> DataFrame:
    return collection.agg(
        F.count(F.lit(1)).alias("collection_count"), F.max(F.size("embedding")).alias("embedding_dim")
    )
