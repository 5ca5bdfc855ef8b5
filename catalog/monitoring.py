"""Request logs, job metrics, rates and quantiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.derive import table
from catalog.registry import query, rounded
from tickloom.functions import columns as C
from tickloom.operators import monitor, summaries
from tickloom.schemas import BRIEFING_BUCKETS, REQUEST_BUCKETS, RETRIEVAL_BUCKETS

TEMPLATES = ["/api/v1/tickers", "/api/v1/prices/{ticker}", "/api/v1/ticks/{ticker}", "/health"]


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per event: raw path by event type, seconds from its value, status from its id."""
    kind, event = F.col("event_type"), F.col("event_id")
    path = (
        F.when(kind == "click", F.concat(F.lit("/api/v1/prices/T"), F.col("user_id").cast("string")))
        .when(kind == "view", F.concat(F.lit("/api/v1/ticks/T"), F.col("user_id").cast("string")))
        .when(kind == "signup", F.lit("/api/v1/tickers"))
        .when(kind == "purchase", F.lit("/health"))
        .otherwise(F.concat(F.lit("/unknown/"), F.col("user_id").cast("string")))
    )
    status = (
        F.when(kind == "error", F.lit("404")).when(event % 50 == 0, F.lit("503")).otherwise(F.lit("200"))
    )
    return table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        F.lit("GET").alias("method"),
        path.alias("path"),
        C.route_template(path, TEMPLATES).alias("endpoint"),
        status.alias("status"),
        (F.col("value") / 1000).alias("seconds"),
    )


REQUESTS = """requests AS (
  SELECT event_id, ts, 'GET' AS method,
    CASE event_type WHEN 'click' THEN '/api/v1/prices/T' || user_id WHEN 'view' THEN '/api/v1/ticks/T' || user_id
      WHEN 'signup' THEN '/api/v1/tickers' WHEN 'purchase' THEN '/health' ELSE '/unknown/' || user_id END AS path,
    CASE event_type WHEN 'click' THEN '/api/v1/prices/{ticker}' WHEN 'view' THEN '/api/v1/ticks/{ticker}'
      WHEN 'signup' THEN '/api/v1/tickers' WHEN 'purchase' THEN '/health' ELSE 'unmatched' END AS endpoint,
    CASE WHEN event_type = 'error' THEN '404' WHEN event_id % 50 = 0 THEN '503' ELSE '200' END AS status,
    value / 1000 AS seconds
  FROM events)"""


@query(f"WITH {REQUESTS} SELECT event_id, path, endpoint FROM requests")
def route_template(spark, sf_dir):
    return request_log(spark, sf_dir).select("event_id", "path", "endpoint")


@query(f"WITH {REQUESTS} SELECT event_id, status FROM requests WHERE status LIKE '4__' OR status LIKE '5__'")
def status_filter(spark, sf_dir):
    return C.status_filter(request_log(spark, sf_dir)).select("event_id", "status")


@query(f'WITH {REQUESTS} SELECT method, endpoint, status, count(*) AS "count" FROM requests GROUP BY 1, 2, 3')
def request_counts(spark, sf_dir):
    return summaries.counts_by(request_log(spark, sf_dir), "method", "endpoint", "status")


@query("""SELECT CASE WHEN value > 100 THEN 'error' ELSE 'success' END AS outcome, count(*) AS "count"
FROM events GROUP BY 1""")
def briefings_by_outcome(spark, sf_dir):
    outcome = F.when(F.col("value") > 100, F.lit("error")).otherwise(F.lit("success"))
    return summaries.counts_by(table(spark, sf_dir, "events").select(outcome.alias("outcome")), "outcome")


def bucket_rows(bounds) -> str:
    return ", ".join(f"({b!r}::DOUBLE)" for b in bounds) + ", ('inf'::DOUBLE)"


def histogram_sql(value: str, bounds, labels: str, source: str) -> str:
    """Buckets as a join to the boundaries, the plain way to say it in SQL."""
    return f"""SELECT {labels}, b.le,
    CAST(sum(CASE WHEN {value} <= b.le THEN 1 ELSE 0 END) AS BIGINT) AS bucket,
    sum({value}) AS "sum", count({value}) AS "count"
  FROM {source}, (VALUES {bucket_rows(bounds)}) b(le) GROUP BY ALL"""


@query(
    f"""WITH {REQUESTS}, h AS ({histogram_sql("seconds", REQUEST_BUCKETS, "method, endpoint", "requests")})
SELECT method, endpoint, CAST(le AS VARCHAR) AS le, bucket, round("sum", 6) AS "sum", "count" FROM h"""
)
def latency_histogram(spark, sf_dir):
    log = request_log(spark, sf_dir)
    rows = monitor.latency_histogram(log, "seconds", REQUEST_BUCKETS, ["method", "endpoint"])
    return rounded(le_text(rows), 6, "sum")


def le_text(df: DataFrame) -> DataFrame:
    text = F.when(F.col("le") == F.lit(float("inf")), F.lit("inf")).otherwise(F.col("le").cast("string"))
    return df.withColumn("le", text)


@query(
    f"""WITH h AS ({histogram_sql("value / 10", RETRIEVAL_BUCKETS, "event_type", "events")})
SELECT event_type, CAST(le AS VARCHAR) AS le, bucket, round("sum", 6) AS "sum", "count" FROM h"""
)
def retrieval_histogram(spark, sf_dir):
    log = table(spark, sf_dir, "events").select("event_type", (F.col("value") / 10).alias("seconds"))
    return rounded(le_text(monitor.latency_histogram(log, "seconds", RETRIEVAL_BUCKETS, ["event_type"])), 6, "sum")


@query(
    f"""WITH h AS ({histogram_sql("value * 3", BRIEFING_BUCKETS, "event_type", "events")})
SELECT event_type, CAST(le AS VARCHAR) AS le, bucket, round("sum", 6) AS "sum", "count" FROM h"""
)
def briefing_histogram(spark, sf_dir):
    log = table(spark, sf_dir, "events").select("event_type", (F.col("value") * 3).alias("seconds"))
    return rounded(le_text(monitor.latency_histogram(log, "seconds", BRIEFING_BUCKETS, ["event_type"])), 6, "sum")


def quantile_sql(histogram: str, labels: str, q: float) -> str:
    """First bucket whose count reaches the rank, then linear inside it."""
    return f"""h AS ({histogram}), placed AS (
  SELECT *, lag(bucket, 1, 0) OVER w AS below, lag(le) OVER w AS lower_le,
    max(bucket) OVER (PARTITION BY {labels}) * {q} AS target
  FROM h WINDOW w AS (PARTITION BY {labels} ORDER BY le)),
hits AS (
  SELECT *, row_number() OVER (PARTITION BY {labels} ORDER BY le) AS rn FROM placed WHERE bucket >= target)
SELECT {labels}, round(CASE WHEN le = 'inf'::DOUBLE THEN lower_le
    ELSE coalesce(lower_le, 0) + (le - coalesce(lower_le, 0)) * (target - below) / (bucket - below) END, 8) AS quantile
FROM hits WHERE rn = 1"""


@query(
    f"""WITH {REQUESTS}, {quantile_sql(histogram_sql("seconds", REQUEST_BUCKETS, "method, endpoint", "requests"),
    "method, endpoint", 0.95)}"""
)
def histogram_quantile(spark, sf_dir):
    labels = ["method", "endpoint"]
    buckets = monitor.latency_histogram(request_log(spark, sf_dir), "seconds", REQUEST_BUCKETS, labels)
    return rounded(monitor.histogram_quantile(buckets, 0.95, labels), 8, "quantile")


@query(
    f"""WITH {quantile_sql(histogram_sql("value / 10", RETRIEVAL_BUCKETS, "event_type", "events"), "event_type", 0.5)}"""
)
def histogram_quantile_median(spark, sf_dir):
    log = table(spark, sf_dir, "events").select("event_type", (F.col("value") / 10).alias("seconds"))
    buckets = monitor.latency_histogram(log, "seconds", RETRIEVAL_BUCKETS, ["event_type"])
    return rounded(monitor.histogram_quantile(buckets, 0.5, ["event_type"]), 8, "quantile")


def request_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The request counter read once a minute in which something arrived; it restarts each day.

    A running count needs one ordered pass per (label set, day); a day has at
    most 1440 minutes, so that bounds the window.
    """
    from pyspark.sql import Window

    minute = F.date_trunc("minute", F.col("ts"))
    counted = (
        request_log(spark, sf_dir).groupBy("endpoint", "status", minute.alias("ts")).agg(F.count(F.lit(1)).alias("n"))
    )
    day = Window.partitionBy("endpoint", "status", F.to_date("ts")).orderBy("ts")
    running = F.sum("n").over(day.rowsBetween(Window.unboundedPreceding, 0))
    return counted.select("endpoint", "status", "ts", running.alias("value"))


COUNTER = REQUESTS + """, per_minute AS (
  SELECT endpoint, status, date_trunc('minute', ts) AS ts, count(*) AS n FROM requests GROUP BY 1, 2, 3),
counter AS (
  SELECT endpoint, status, ts, CAST(sum(n) OVER (
    PARTITION BY endpoint, status, CAST(ts AS DATE) ORDER BY ts ROWS UNBOUNDED PRECEDING) AS BIGINT) AS value
  FROM per_minute)"""


def rate_sql(seconds: int, condition: str = "true") -> str:
    """Each sample beside every later sample within the range; steps inside it are summed."""
    return COUNTER + f""", stepped AS (
  SELECT *, lag(ts) OVER s AS prior_ts,
    CASE WHEN value < lag(value) OVER s THEN value ELSE value - lag(value) OVER s END AS step
  FROM counter WHERE {condition} WINDOW s AS (PARTITION BY endpoint, status ORDER BY ts)),
rates AS (
  SELECT a.endpoint, a.status, a.ts, a.value,
    CASE WHEN count(*) >= 2 THEN
      coalesce(sum(b.step) FILTER (WHERE b.prior_ts > a.ts - INTERVAL {seconds} SECOND), 0) / {seconds}.0 END AS rate
  FROM stepped a JOIN stepped b ON a.endpoint = b.endpoint AND a.status = b.status
    AND b.ts <= a.ts AND b.ts > a.ts - INTERVAL {seconds} SECOND
  GROUP BY ALL)"""


def step_rate_sql(seconds: int, step: int, condition: str = "true") -> str:
    """Every series at every instant of a grid of its own, beside the samples in the range that ends there."""
    return rate_sql(seconds, condition) + f""", grid AS (
  SELECT make_timestamp(unnest(generate_series(epoch_us(min(ts)) // {step}000000 * {step}000000,
    epoch_us(max(ts)) + {seconds}000000, {step}000000))) AS t FROM counter),
step_rates AS (
  SELECT b.endpoint, b.status, g.t AS ts, CASE WHEN count(*) >= 2 THEN
    coalesce(sum(b.step) FILTER (WHERE b.prior_ts > g.t - INTERVAL {seconds} SECOND), 0) / {seconds}.0 END AS rate
  FROM grid g JOIN stepped b ON b.ts <= g.t AND b.ts > g.t - INTERVAL {seconds} SECOND GROUP BY ALL)"""


SAMPLE = "endpoint, status, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts"


def sample_text(df: DataFrame) -> DataFrame:
    return df.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))


@query(f"WITH {rate_sql(3600)} SELECT {SAMPLE}, value, round(rate, 10) AS rate FROM rates")
def counter_rate(spark, sf_dir):
    rates = monitor.counter_rate(request_counter(spark, sf_dir), 3600, ["endpoint", "status"])
    return rounded(sample_text(rates), 10, "rate")


@query(
    f"""WITH {step_rate_sql(3600, 900)}
SELECT endpoint, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, round(sum(rate), 10) AS rate
FROM step_rates WHERE rate IS NOT NULL GROUP BY 1, 2"""
)
def rate_by_endpoint(spark, sf_dir):
    rates = monitor.counter_rate(request_counter(spark, sf_dir), 3600, ["endpoint", "status"], step_seconds=900)
    return rounded(sample_text(monitor.rate_by_label(rates, ["endpoint"])), 10, "rate")


@query(
    f"""WITH {step_rate_sql(7200, 1800, "status LIKE '4__' OR status LIKE '5__'")}
SELECT status, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, round(sum(rate), 10) AS rate
FROM step_rates WHERE rate IS NOT NULL GROUP BY 1, 2"""
)
def rate_by_label(spark, sf_dir):
    """Failing requests by status: the label filter comes before the rate, as on the panel."""
    failing = C.status_filter(request_counter(spark, sf_dir))
    rates = monitor.counter_rate(failing, 7200, ["endpoint", "status"], step_seconds=1800)
    return rounded(sample_text(monitor.rate_by_label(rates, ["status"])), 10, "rate")


def bucket_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latency buckets read every hour in which something arrived, as counters that restart each day."""
    from pyspark.sql import Window

    log = request_log(spark, sf_dir).withColumn("ts", F.date_trunc("hour", F.col("ts")))
    hourly = monitor.latency_histogram(log, "seconds", REQUEST_BUCKETS, ["method", "endpoint", "ts"])
    day = Window.partitionBy("method", "endpoint", "le", F.to_date("ts")).orderBy("ts")
    running = F.sum("bucket").over(day.rowsBetween(Window.unboundedPreceding, 0))
    return hourly.select("method", "endpoint", "le", "ts", running.cast("double").alias("value"))


QUANTILE_OF_RATES = f"""WITH {REQUESTS}, hourly_log AS (
  SELECT method, endpoint, date_trunc('hour', ts) AS ts, seconds FROM requests),
hourly AS ({histogram_sql("seconds", REQUEST_BUCKETS, "method, endpoint, ts", "hourly_log")}),
counter AS (
  SELECT method, endpoint, le, ts, sum(bucket) OVER (
    PARTITION BY method, endpoint, le, CAST(ts AS DATE) ORDER BY ts ROWS UNBOUNDED PRECEDING) AS value FROM hourly),
stepped AS (
  SELECT *, lag(ts) OVER s AS prior_ts,
    CASE WHEN value < lag(value) OVER s THEN value ELSE value - lag(value) OVER s END AS step
  FROM counter WINDOW s AS (PARTITION BY method, endpoint, le ORDER BY ts)),
grid AS (
  SELECT make_timestamp(unnest(generate_series(epoch_us(min(ts)), epoch_us(max(ts)) + 21600000000, 3600000000))) AS t
  FROM counter),
series_rates AS (
  SELECT b.method, b.endpoint, b.le, g.t AS ts, CASE WHEN count(*) >= 2 THEN
    coalesce(sum(b.step) FILTER (WHERE b.prior_ts > g.t - INTERVAL 21600 SECOND), 0) / 21600.0 END AS rate
  FROM grid g JOIN stepped b ON b.ts <= g.t AND b.ts > g.t - INTERVAL 21600 SECOND GROUP BY ALL),
rates AS (
  SELECT endpoint, le, ts, sum(rate) AS rate FROM series_rates WHERE rate IS NOT NULL GROUP BY ALL),
placed AS (
  SELECT *, lag(rate, 1, 0) OVER w AS below, lag(le) OVER w AS lower_le,
    max(rate) OVER (PARTITION BY endpoint, ts) * 0.5 AS target
  FROM rates WHERE rate IS NOT NULL WINDOW w AS (PARTITION BY endpoint, ts ORDER BY le)),
hits AS (
  SELECT *, row_number() OVER (PARTITION BY endpoint, ts ORDER BY le) AS rn FROM placed WHERE rate >= target)
SELECT endpoint, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts,
  round(CASE WHEN le = 'inf'::DOUBLE THEN lower_le
    ELSE coalesce(lower_le, 0) + (le - coalesce(lower_le, 0)) * (target - below) / (rate - below) END, 8) AS quantile
FROM hits WHERE rn = 1"""


@query(QUANTILE_OF_RATES)
def quantile_of_rates(spark, sf_dir):
    counters = bucket_counter(spark, sf_dir)
    medians = monitor.quantile_of_rates(counters, 21600, 0.5, ["method", "endpoint"], ["endpoint"], 3600)
    return rounded(sample_text(medians), 8, "quantile")


PUSHED = """WITH pushed AS (
  SELECT event_id, ts, event_type AS job, 'gauge_' || user_id AS name,
    CASE WHEN user_id % 3 = 0 THEN 'text' ELSE CAST(value AS VARCHAR) END AS value FROM events)"""


def pushed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pushed job metrics: some values are numbers, some are text."""
    text = F.when(F.col("user_id") % 3 == 0, F.lit("text")).otherwise(F.col("value").cast("string"))
    return table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_type").alias("job"),
        F.concat(F.lit("gauge_"), F.col("user_id").cast("string")).alias("name"),
        text.alias("value"),
        "event_id",
    )


@query(
    PUSHED + """ SELECT event_id, job, name, TRY_CAST(value AS DOUBLE) AS value FROM pushed
WHERE TRY_CAST(value AS DOUBLE) IS NOT NULL"""
)
def numeric_metrics(spark, sf_dir):
    return C.numeric_metrics(pushed(spark, sf_dir)).select("event_id", "job", "name", "value")


@query(
    PUSHED + """ SELECT job, name, arg_max(TRY_CAST(value AS DOUBLE), row(ts, TRY_CAST(value AS DOUBLE))) AS value
FROM pushed WHERE TRY_CAST(value AS DOUBLE) IS NOT NULL GROUP BY 1, 2"""
)
def run_gauges(spark, sf_dir):
    return monitor.run_gauges(pushed(spark, sf_dir).drop("event_id"))
