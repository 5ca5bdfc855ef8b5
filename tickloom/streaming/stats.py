"""Latency, throughput and lag of a landed stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions import times as TM
from tickloom.operators import ordering, summaries


def with_latency(landed: DataFrame) -> DataFrame:
    """Microseconds from each event's own time to the commit of its batch."""
    event = TM.parse_event_time(F.col("event_time"))
    return landed.withColumn("latency_micros", TM.micros(F.col("committed_at")) - TM.micros(event))


def batch_latency(landed: DataFrame) -> DataFrame:
    """Rows, mean and largest write latency per batch."""
    seconds = F.col("latency_micros") / F.lit(1e6)
    return (
        with_latency(landed)
        .groupBy("batch_id")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.avg(seconds).alias("latency_avg_seconds"),
            F.max(seconds).alias("latency_max_seconds"),
        )
    )


def stream_summary(landed: DataFrame) -> DataFrame:
    """One row: rows, batches, duration, rate, and mean, upper-median and largest latency.

    The duration runs from the first event to the last commit.
    """
    timed = with_latency(landed)
    per_batch = timed.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("latency_micros").alias("timed"),
        F.sum("latency_micros").alias("waited"),
        F.max("latency_micros").alias("longest"),
        F.max(F.unix_micros("committed_at")).alias("end"),
        F.min(F.unix_micros("committed_at") - F.col("latency_micros")).alias("start"),
    )
    totals = per_batch.agg(
        F.sum("n").alias("rows"),
        F.count(F.lit(1)).alias("batches"),
        ((F.max("end") - F.min("start")) / F.lit(1e6)).alias("seconds"),
        F.round(F.try_divide(F.sum("waited"), F.sum("timed")) / F.lit(1e6), 2).alias("write_latency_avg_seconds"),
        F.round(F.max("longest") / F.lit(1e6), 2).alias("write_latency_max_seconds"),
    )
    median = ordering.upper_median(timed, "latency_micros").select(
        F.round(F.col("upper_median") / F.lit(1e6), 2).alias("write_latency_p50_seconds")
    )
    rate = F.when(F.col("seconds") > 0, F.col("rows") / F.col("seconds")).otherwise(F.lit(0.0))
    whole = totals.select(
        "rows",
        "batches",
        F.round("seconds", 2).alias("duration_seconds"),
        F.round(rate, 2).alias("events_per_second"),
        "write_latency_avg_seconds",
        "write_latency_max_seconds",
    )
    return summaries.beside([whole, median])


def lag_samples(end_offsets: DataFrame, batches: DataFrame) -> DataFrame:
    """Lag at each sample: the topic's end offsets then, minus the rows landed by then, at least 0.

    ``end_offsets`` (app, sampled_at, end_offset) has a row per sample and topic
    partition, taken at times of their own; ``batches`` (app, committed_at, rows) one
    per batch. A sample sees the batches committed at or before its time: both lie in
    one order of time, cut into ranges, and every range starts from the rows that
    landed before it. No app is brought together in one task.
    """
    ends = end_offsets.groupBy("app", F.col("sampled_at").alias("at")).agg(F.sum("end_offset").alias("end_offset"))
    none = F.lit(None).cast("long")
    both = batches.select("app", F.col("committed_at").alias("at"), F.lit(0).alias("kind"), "rows", none.alias("end_offset"))
    both = both.unionByName(ends.withColumns({"kind": F.lit(1), "rows": F.lit(0).cast("long")}))
    placed = ordering.number_rows(both, ["app"], ["at", "kind"], weight="rows").where("kind = 1")
    lag = F.greatest(F.lit(0), F.col("end_offset") - F.col("_pos"))
    return placed.select("app", F.col("at").alias("sampled_at"), lag.cast("long").alias("lag"))


def consumer_lag(samples: DataFrame) -> DataFrame:
    """Largest and last lag per run."""
    return samples.groupBy("app").agg(
        F.max("lag").alias("consumer_lag_max"), F.max_by("lag", "sampled_at").alias("consumer_lag_final")
    )
