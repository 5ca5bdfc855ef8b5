"""Counters, histograms, gauges, rates and quantiles over logged samples."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.functions import columns as C

GAUGES = "ts timestamp, job string, name string, value string"
INFINITY = float("inf")
DAY_MICROS = 86_400_000_000


def record_metrics(spark: SparkSession, path: str | None, job: str, values: dict) -> bool:
    """Append a job's values to the metrics table. Never raises: reporting must not fail the job."""
    if not path:
        return False
    try:
        now = F.lit(datetime.now(timezone.utc))
        entries = [
            F.struct(
                now.alias("ts"),
                F.lit(job).alias("job"),
                F.lit(name).alias("name"),
                F.lit(None if value is None else str(value)).cast("string").alias("value"),
            )
            for name, value in values.items()
        ]
        rows = spark.range(0, 1, 1, 1).select(F.inline(F.array(*entries)))
        rows.write.mode("append").parquet(path)
    except Exception as error:
        print(f"[metrics] {job} not recorded: {error}")
        return False
    return True


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(GAUGES).parquet(path)


def run_gauges(metrics: DataFrame) -> DataFrame:
    """The newest numeric value of each gauge per job."""
    numeric = C.numeric_metrics(metrics)
    return numeric.groupBy("job", "name").agg(F.max_by("value", F.struct("ts", "value")).alias("value"))


def latency_histogram(
    samples: DataFrame, value: str, boundaries: Sequence[float], labels: Sequence[str] = ()
) -> DataFrame:
    """Cumulative ``le`` buckets per label set, with the sum and count beside them.

    One aggregate with a counter per boundary; the samples are not multiplied.
    """
    uppers = [*map(float, boundaries), INFINITY]
    counters = [F.count(F.when(F.col(value) <= F.lit(u), 1)).alias(f"_b{i}") for i, u in enumerate(uppers)]
    totals = samples.groupBy(*labels).agg(
        *counters, F.sum(value).alias("sum"), F.count(F.col(value)).alias("count")
    )
    rows = F.array(
        *[F.struct(F.lit(u).alias("le"), F.col(f"_b{i}").alias("bucket")) for i, u in enumerate(uppers)]
    )
    return totals.select(*labels, "sum", "count", F.explode(rows).alias("_row")).select(
        *labels, F.col("_row.le").alias("le"), F.col("_row.bucket").alias("bucket"), "sum", "count"
    )


def counter_rate(
    samples: DataFrame,
    range_seconds: float,
    labels: Sequence[str],
    ts: str = "ts",
    value: str = "value",
    step_seconds: float | None = None,
) -> DataFrame:
    """Per-second rate of a counter at each sample, over the trailing range ending there.

    With ``step_seconds`` the rate is taken at whole multiples of that step instead, the
    same instants for every series, and (labels, ts, rate) comes back for each instant
    whose range holds a sample. Sum rates of several series in that form only.

    The increase is the sum of the steps between neighbouring samples inside
    (t - range, t]; a drop means the counter restarted, so the step is the new
    value. Null with fewer than two samples in the range. Nothing is
    extrapolated to the ends of the range.

    Each series is cut into time blocks; the samples within one range of a
    block's end are also sent to the next block, so a long series spans many
    tasks. There must be one sample per series and instant.
    """
    span = int(range_seconds * 1_000_000)
    width = max(DAY_MICROS, span)
    block = F.floor(F.col("_at") / width)
    own = F.struct(block.alias("block"), F.lit(False).alias("carried"))
    carried = F.struct((block + 1).alias("block"), F.lit(True).alias("carried"))
    near_end = F.pmod(F.col("_at"), F.lit(width)) >= width - span
    blocks = (
        samples.withColumn("_at", F.unix_micros(F.col(ts).cast("timestamp")))
        .withColumn("_in", F.explode(F.when(near_end, F.array(own, carried)).otherwise(F.array(own))))
        .withColumns({"_block": F.col("_in.block"), "_carried": F.col("_in.carried")})
    )
    series = Window.partitionBy(*labels, "_block").orderBy("_at")
    frame = series.rangeBetween(1 - span, 0)
    previous = F.lag(value).over(series)
    step = F.when(F.col(value) < previous, F.col(value)).otherwise(F.col(value) - previous)
    stepped = blocks.withColumn("_step", F.coalesce(step.cast("double"), F.lit(0.0)))
    increase = F.sum("_step").over(frame) - F.first("_step").over(frame)
    if step_seconds is not None:
        return _rates_at_steps(stepped, labels, ts, span, width, int(step_seconds * 1_000_000))
    rate = F.when(F.count(F.lit(1)).over(frame) >= 2, increase / F.lit(float(range_seconds)))
    return stepped.withColumn("rate", rate).filter(~F.col("_carried")).select(*samples.columns, "rate")


def _rates_at_steps(
    stepped: DataFrame, labels: Sequence[str], ts: str, span: int, width: int, step: int
) -> DataFrame:
    """Each sample goes to the instants of its block whose range covers it; they add up its steps."""
    first = F.ceil(F.col("_at") / step) * step
    first = F.greatest(first, F.ceil(F.col("_block") * width / step) * step)
    last = F.least(F.col("_at") + span, (F.col("_block") + 1) * width) - 1
    instants = F.when(first <= last, F.sequence(first, last, F.lit(step).cast("long")))
    spread = stepped.withColumn("_instant", F.explode(instants))
    summed = spread.groupBy(*labels, "_instant").agg(
        F.count(F.lit(1)).alias("_n"), (F.sum("_step") - F.min_by("_step", "_at")).alias("_increase")
    )
    rate = F.when(F.col("_n") >= 2, F.col("_increase") / F.lit(span / 1_000_000))
    return summed.select(*labels, F.timestamp_micros("_instant").alias(ts), rate.alias("rate"))


def rate_by_label(rates: DataFrame, label: Sequence[str], ts: str = "ts") -> DataFrame:
    """Sum of the rates sharing a label at an instant; take them at common steps before."""
    return rates.filter(F.col("rate").isNotNull()).groupBy(*label, ts).agg(F.sum("rate").alias("rate"))


def histogram_quantile(
    buckets: DataFrame, quantile: float, labels: Sequence[str], le: str = "le", count: str = "bucket"
) -> DataFrame:
    """Quantile per label set from cumulative buckets, linear inside the bucket it falls in.

    A quantile in the last, unbounded bucket gives the highest finite boundary; no
    observations, or no unbounded bucket, give null. A group is one histogram, so
    its size is the number of boundaries.
    """
    by_le = Window.partitionBy(*labels).orderBy(le)
    whole = by_le.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = buckets.withColumns(
        {
            "_total": F.last(count).over(whole),
            "_top": F.last(le).over(whole),
            "_below": F.lag(count, 1, 0).over(by_le),
            "_lower": F.lag(le).over(by_le),
        }
    ).withColumn("_rank", F.col("_total") * F.lit(quantile))
    lower = F.coalesce("_lower", F.when(F.col(le) > 0, F.lit(0.0)).otherwise(F.col(le)))
    inside = lower + (F.col(le) - lower) * F.try_divide(
        F.col("_rank") - F.col("_below"), F.col(count) - F.col("_below")
    )
    usable = (F.col("_total") > 0) & (F.col("_top") == F.lit(INFINITY))
    at = F.when(F.col(le) == F.lit(INFINITY), F.col("_lower")).otherwise(F.coalesce(inside, lower))
    hit = F.when(usable & (F.col(count) >= F.col("_rank")), F.struct(le, at.alias("at")))
    return placed.groupBy(*labels).agg(F.min(hit)["at"].alias("quantile"))


def quantile_of_rates(
    bucket_counters: DataFrame,
    range_seconds: float,
    quantile: float,
    labels: Sequence[str],
    by: Sequence[str],
    step_seconds: float,
    ts: str = "ts",
) -> DataFrame:
    """Quantile at each step from the rates of cumulative bucket counters.

    ``bucket_counters`` has one counter per (labels, le); the rates are summed
    over the labels not in ``by`` before the quantile is taken.
    """
    rates = counter_rate(bucket_counters, range_seconds, [*labels, "le"], ts, step_seconds=step_seconds)
    summed = rate_by_label(rates, [*by, "le"], ts)
    return histogram_quantile(summed, quantile, [*by, ts], count="rate")
