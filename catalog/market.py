"""Bars, indicators, serving reads and row checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.derive import CURATED, LATEST_BARS, RAW_BARS, TICKS, raw_bars, ticks
from catalog.registry import query, rounded
from tickloom.functions import columns as C
from tickloom.operators import checks, indicators as I, lookups, ordering, summaries
from tickloom.plans import serving
from tickloom.schemas import DEFAULT_BARS

OHLCV = '"Date", "Ticker", "Open", "High", "Low", "Close", "Volume"'
ROUNDED = (
    'round("SMA_20", 8) AS "SMA_20", round("SMA_50", 8) AS "SMA_50", '
    "round(daily_return, 8) AS daily_return, round(volatility_20d, 8) AS volatility_20d"
)


def curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.indicators(raw_bars(spark, sf_dir))


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.latest_bars(raw_bars(spark, sf_dir))


def tidy(df: DataFrame) -> DataFrame:
    return rounded(df, 8, *[c for c in ("SMA_20", "SMA_50", "daily_return", "volatility_20d") if c in df.columns])


@query(f"WITH {CURATED} SELECT {OHLCV}, ingested_at_utc, {ROUNDED} FROM curated")
def indicators(spark, sf_dir):
    return tidy(curated(spark, sf_dir))


@query(
    f"""WITH {RAW_BARS}, lagged AS (
  SELECT *, lag("Close") OVER (PARTITION BY "Ticker" ORDER BY "Date", ingested_at_utc) AS prev_close FROM raw_bars),
returns AS (SELECT *, ("Close" - prev_close) / nullif(prev_close, 0) AS daily_return FROM lagged),
curated AS (SELECT *,
    avg("Close") OVER (PARTITION BY "Ticker" ORDER BY "Date", ingested_at_utc ROWS 19 PRECEDING) AS "SMA_20",
    avg("Close") OVER (PARTITION BY "Ticker" ORDER BY "Date", ingested_at_utc ROWS 49 PRECEDING) AS "SMA_50",
    stddev_samp(daily_return) OVER (PARTITION BY "Ticker" ORDER BY "Date", ingested_at_utc ROWS 19 PRECEDING)
      AS volatility_20d FROM returns)
SELECT {OHLCV}, ingested_at_utc, {ROUNDED} FROM curated"""
)
def indicators_every_run(spark, sf_dir):
    return tidy(I.indicators(raw_bars(spark, sf_dir), dedupe=False))


@query(f"WITH {LATEST_BARS} SELECT * FROM bars")
def latest_bars(spark, sf_dir):
    return bars(spark, sf_dir)


@query(f'WITH {CURATED} SELECT "Ticker", "Date", round("SMA_20", 8) AS "SMA_20" FROM curated')
def sma_20(spark, sf_dir):
    return tidy(I.sma(bars(spark, sf_dir), "SMA_20", 20).select("Ticker", "Date", "SMA_20"))


@query(f'WITH {CURATED} SELECT "Ticker", "Date", round("SMA_50", 8) AS "SMA_50" FROM curated')
def sma_50(spark, sf_dir):
    return tidy(I.sma(bars(spark, sf_dir), "SMA_50", 50).select("Ticker", "Date", "SMA_50"))


@query(f'WITH {CURATED} SELECT "Ticker", "Date", prev_close FROM curated')
def prev_close(spark, sf_dir):
    return I.prev_close(bars(spark, sf_dir)).select("Ticker", "Date", "prev_close")


@query(f'WITH {CURATED} SELECT "Ticker", "Date", round(daily_return, 8) AS daily_return FROM curated')
def daily_return(spark, sf_dir):
    return tidy(I.with_daily_return(bars(spark, sf_dir)).select("Ticker", "Date", "daily_return"))


@query(f'WITH {CURATED} SELECT "Ticker", "Date", round(volatility_20d, 8) AS volatility_20d FROM curated')
def volatility_20d(spark, sf_dir):
    moved = I.with_volatility(I.with_daily_return(bars(spark, sf_dir)))
    return tidy(moved.select("Ticker", "Date", "volatility_20d"))


@query(
    f"""WITH {CURATED} SELECT "Ticker", "Date", CASE
  WHEN "Close" > "SMA_20" AND "Close" > "SMA_50" AND "SMA_20" > "SMA_50" THEN 'bullish'
  WHEN "Close" < "SMA_20" AND "Close" < "SMA_50" AND "SMA_20" < "SMA_50" THEN 'bearish'
  ELSE 'neutral' END AS trend_setup FROM curated"""
)
def trend_setup(spark, sf_dir):
    return I.trend(curated(spark, sf_dir)).select("Ticker", "Date", "trend_setup")


LATEST_TEN = f"""WITH {CURATED}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY "Ticker" ORDER BY "Date" DESC) AS rn FROM curated)
SELECT {OHLCV}, {ROUNDED} FROM ranked WHERE rn <= {{n}}"""


@query(LATEST_TEN.format(n=10))
def latest_n(spark, sf_dir):
    kept = ordering.latest_n(curated(spark, sf_dir), ["Ticker"], ["Date"], 10)
    return tidy(serving.bar_view(kept))


@query(LATEST_TEN.format(n=5))
def tail_n(spark, sf_dir):
    """The recent bars a briefing starts from."""
    return tidy(serving.bar_view(ordering.latest_n(curated(spark, sf_dir), ["Ticker"], ["Date"], DEFAULT_BARS)))


@query(LATEST_TEN.format(n=100))
def prices(spark, sf_dir):
    return tidy(serving.prices(curated(spark, sf_dir)))


TICK_TAIL = f"""WITH {TICKS}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY event_time DESC, event_id DESC) AS rn FROM ticks)
SELECT ticker, price, size, event_time, strftime(kafka_timestamp, '%Y-%m-%d %H:%M:%S.%f') AS kafka_timestamp
FROM ranked WHERE rn <= 100"""


def stamped(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "kafka_timestamp", F.date_format("kafka_timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    )


@query(TICK_TAIL)
def served_ticks(spark, sf_dir):
    return stamped(serving.ticks(ticks(spark, sf_dir).drop("ts"), as_text=False))


@query(TICK_TAIL + " AND ticker = 'CLICK'")
def for_ticker(spark, sf_dir):
    return stamped(serving.ticks(ticks(spark, sf_dir).drop("ts"), "click", as_text=False))


@query(
    f"""WITH {CURATED} SELECT {OHLCV}, {ROUNDED} FROM curated"""
)
def bar_view(spark, sf_dir):
    return tidy(serving.bar_view(curated(spark, sf_dir)))


@query(f"""WITH {TICKS} SELECT ticker, price, size, event_time,
  strftime(kafka_timestamp, '%Y-%m-%d %H:%M:%S.%f') AS kafka_timestamp FROM ticks""")
def tick_view(spark, sf_dir):
    stamp = F.date_format("kafka_timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return serving.tick_view(ticks(spark, sf_dir)).withColumn("kafka_timestamp", stamp)


@query(
    f"""WITH {LATEST_BARS} SELECT {OHLCV.replace('"Close"', 'CASE WHEN "Close" < 20000 THEN NULL ELSE "Close" END AS "Close"')},
  ingested_at_utc FROM bars"""
)
def json_safe(spark, sf_dir):
    missing = F.when(F.col("Close") < 20000, F.lit(float("nan"))).otherwise(F.col("Close"))
    return C.json_safe(bars(spark, sf_dir).withColumn("Close", missing))


@query(f"WITH {LATEST_BARS} SELECT {OHLCV} FROM bars")
def drop_if_exists(spark, sf_dir):
    return C.drop_if_exists(bars(spark, sf_dir), "ingested_at_utc", "no_such_column")


@query(f"""WITH {TICKS} SELECT event_id, strftime(ts, '%Y-%m-%d') AS "Date" FROM ticks""")
def as_text(spark, sf_dir):
    days = ticks(spark, sf_dir).select("event_id", F.to_date("ts").alias("Date"))
    return C.as_text(days, "Date", "no_such_column")


@query(
    f"""WITH {RAW_BARS} SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
  PARTITION BY "Ticker" ORDER BY "Date", ingested_at_utc) AS rn FROM raw_bars) WHERE rn = 1"""
)
def first_bar(spark, sf_dir):
    return checks.first_bar(raw_bars(spark, sf_dir))


@query(
    f"""WITH {CURATED}, prior AS (
  SELECT "Ticker", "Date", round("SMA_20", 8) AS "SMA_20",
    lag(round("SMA_20", 8)) OVER (PARTITION BY "Ticker" ORDER BY "Date") AS previous FROM curated)
SELECT * FROM prior WHERE "SMA_20" < previous"""
)
def monotonic_violations(spark, sf_dir):
    averaged = tidy(I.sma(bars(spark, sf_dir), "SMA_20", 20).select("Ticker", "Date", "SMA_20"))
    return checks.monotonic_violations(averaged, ["Ticker"], ["Date"], "SMA_20", bounded=True)


@query(
    f"""WITH {TICKS}, prior AS (
  SELECT ticker, event_id, price, lag(price) OVER (PARTITION BY ticker ORDER BY event_time, event_id) AS previous
  FROM ticks)
SELECT * FROM prior WHERE abs(price - previous) > previous * 0.003 + 1e-9"""
)
def move_violations(spark, sf_dir):
    rows = ticks(spark, sf_dir).select("ticker", "event_id", "event_time", "price")
    return checks.move_violations(rows, order=["event_time", "event_id"]).drop("event_time")


@query(f"WITH {CURATED} SELECT {OHLCV}, ingested_at_utc, {ROUNDED} FROM curated ORDER BY \"Ticker\", \"Date\"")
def order_curated(spark, sf_dir):
    return I.order_curated(tidy(curated(spark, sf_dir)))


@query(
    f"""WITH {RAW_BARS} SELECT "Ticker", arg_max("Close", row("Date", ingested_at_utc, "Close")) AS last_close
FROM raw_bars GROUP BY 1"""
)
def last_close(spark, sf_dir):
    return lookups.last_close(raw_bars(spark, sf_dir))


def portfolio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each supplier as a ticker, and each nation as a ticker that never has bars."""
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    nations = spark.read.parquet(f"{sf_dir}/nation.parquet")
    return suppliers.select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("Ticker")).unionByName(
        nations.select(F.upper("n_name").alias("Ticker"))
    )


PORTFOLIO = """portfolio AS (
  SELECT 'S' || s_suppkey AS "Ticker" FROM supplier UNION ALL SELECT upper(n_name) FROM nation)"""


@query(
    f"""WITH {RAW_BARS}, {PORTFOLIO}, closes AS (
  SELECT "Ticker", arg_max("Close", row("Date", ingested_at_utc, "Close")) AS last_close FROM raw_bars GROUP BY 1)
SELECT "Ticker", coalesce(last_close, 100.0) AS seed_price FROM portfolio LEFT JOIN closes USING ("Ticker")"""
)
def seed_prices(spark, sf_dir):
    return lookups.seed_prices(portfolio(spark, sf_dir), raw_bars(spark, sf_dir))


@query(
    """SELECT event_type, event_id, coalesce(CASE WHEN value < 10 THEN NULL ELSE value END, 100.0) AS price FROM events"""
)
def with_default(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    known = F.when(F.col("value") < 10, F.lit(None)).otherwise(F.col("value"))
    return events.select("event_type", "event_id", C.with_default(known, 100.0).alias("price"))


@query(
    f"""WITH {RAW_BARS}, {PORTFOLIO} SELECT "Ticker" FROM portfolio
WHERE "Ticker" NOT IN (SELECT "Ticker" FROM raw_bars)"""
)
def failed_tickers(spark, sf_dir):
    return lookups.failed_tickers(portfolio(spark, sf_dir), raw_bars(spark, sf_dir))


@query(
    f"""WITH {RAW_BARS}, {PORTFOLIO} SELECT count(*) AS rows_ingested, count(DISTINCT "Ticker") AS tickers_ok,
  (SELECT count(*) FROM portfolio WHERE "Ticker" NOT IN (SELECT "Ticker" FROM raw_bars)) AS tickers_failed
FROM raw_bars"""
)
def ingest_summary(spark, sf_dir):
    return summaries.ingest_summary(portfolio(spark, sf_dir), raw_bars(spark, sf_dir))


@query(
    f"""WITH {LATEST_BARS} SELECT 'rows_in' AS step, count(*) AS rows FROM raw_bars
UNION ALL SELECT 'rows_out', count(*) FROM bars"""
)
def row_counts(spark, sf_dir):
    raw = raw_bars(spark, sf_dir)
    return summaries.row_counts(raw, I.latest_bars(raw))


@query(f'WITH {RAW_BARS}, {PORTFOLIO} SELECT "Ticker" FROM portfolio')
def tickers(spark, sf_dir):
    return serving.tickers(portfolio(spark, sf_dir))
