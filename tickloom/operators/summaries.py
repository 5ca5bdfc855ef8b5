"""Counts and run summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators.lookups import not_in


def row_counts(rows_in: DataFrame, rows_out: DataFrame) -> DataFrame:
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(step).alias("step"), "rows")
        for step, df in (("rows_in", rows_in), ("rows_out", rows_out))
    ]
    return counts[0].unionByName(counts[1])


def ingest_summary(portfolio: DataFrame, batch: DataFrame) -> DataFrame:
    """Rows ingested, tickers that arrived and tickers that did not, as one row.

    ``failed_tickers`` in the lookups gives the missing names as rows.
    """
    per_ticker = batch.groupBy("Ticker").agg(F.count(F.lit(1)).alias("n"))
    arrived = per_ticker.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_ingested"), F.count(F.lit(1)).alias("tickers_ok")
    )
    failed = not_in(portfolio, batch, "Ticker").agg(F.count(F.lit(1)).alias("tickers_failed"))
    return beside([arrived, failed])


def counts_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def duplicate_ids(df: DataFrame, key: str = "id") -> DataFrame:
    return counts_by(df, key).filter("count > 1")


def label_balance(questions: DataFrame, minimum: int) -> DataFrame:
    """Questions per expected document, flagged when there are fewer than ``minimum``."""
    return counts_by(questions, "expected").withColumn("too_few", F.col("count") < minimum)


def publish_summary(events: DataFrame, time: str, key: str) -> DataFrame:
    """Events, duration, rate and number of tickers of a published set."""
    per_key = events.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.min(time).alias("lo"), F.max(time).alias("hi")
    )
    whole = per_key.agg(
        F.sum("n").alias("events_published"),
        ((F.max(F.unix_micros("hi")) - F.min(F.unix_micros("lo"))) / F.lit(1e6)).alias("seconds"),
        F.count(F.lit(1)).alias("tickers"),
    )
    rate = F.when(F.col("seconds") > 0, F.col("events_published") / F.col("seconds")).otherwise(F.lit(0.0))
    return whole.select(
        "events_published",
        F.round("seconds", 2).alias("duration_seconds"),
        F.round(rate, 2).alias("events_per_second"),
        "tickers",
    )


def loss_check(published: DataFrame, landed: DataFrame, key: str) -> DataFrame:
    """Published, landed and lost rows per key."""
    sides = union_all(
        [
            published.select(key, F.lit(1).alias("published"), F.lit(0).alias("landed")),
            landed.select(key, F.lit(0).alias("published"), F.lit(1).alias("landed")),
        ]
    )
    both = sides.groupBy(key).agg(F.sum("published").alias("published"), F.sum("landed").alias("landed"))
    return both.withColumn("lost", F.col("published") - F.col("landed"))


def beside(single_rows: Sequence[DataFrame]) -> DataFrame:
    """The columns of several one-row frames as one row."""
    stacked = union_all(single_rows)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by column name; a column missing on one side is null there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
