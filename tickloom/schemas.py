"""Published column sets, types and limits."""

from __future__ import annotations

from pyspark.sql import types as T

# Published schemas, portfolio, limits and retrieval settings.
PORTFOLIO = [
    "MSFT", "CRWD", "AVGO", "GLE.PA", "NVDA", "AMZN", "AXON", "PANW", "INTC",
    "NOW", "IREN", "GOOG", "MU", "SOFI", "PLTR", "RDW", "DRAM",
]

RAW_BARS = T.StructType(
    [
        T.StructField("Date", T.StringType()),
        T.StructField("Ticker", T.StringType()),
        T.StructField("Open", T.DoubleType()),
        T.StructField("High", T.DoubleType()),
        T.StructField("Low", T.DoubleType()),
        T.StructField("Close", T.DoubleType()),
        T.StructField("Volume", T.LongType()),
        T.StructField("ingested_at_utc", T.StringType()),
    ]
)
PROVIDER_COLUMNS = ["Date", "Open", "High", "Low", "Close", "Volume"]
INDICATORS = ["SMA_20", "SMA_50", "daily_return", "volatility_20d"]
BAR_VIEW = ["Date", "Ticker", "Open", "High", "Low", "Close", "Volume", *INDICATORS]

TICK_EVENT = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("size", T.LongType()),
        T.StructField("event_time", T.StringType()),
    ]
)
TICK_VIEW = ["ticker", "price", "size", "event_time", "kafka_timestamp"]

LIMIT_RANGE = (1, 1000)
DEFAULT_LIMIT = 100
BARS_RANGE = (1, 60)
DEFAULT_BARS = 5
DEFAULT_PRICE = 100.0
MAX_TICK_MOVE = 0.003
TOP_K = 6
EVALUATION_K = 5
MIN_QUESTIONS_PER_DOCUMENT = 3
MIN_CHUNK_CHARS = 80
MIN_BULLETS_TO_SPLIT = 4
REQUEST_BUCKETS = (0.0025, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0)
RETRIEVAL_BUCKETS = (0.5, 1.0, 2.5, 5.0, 7.5, 10.0, 15.0, 30.0)
BRIEFING_BUCKETS = (30.0, 60.0, 90.0, 120.0, 300.0, 600.0, 900.0)


def within(value, allowed: tuple[int, int]):
    """Whether ``value``, a number or a column of them, lies in ``allowed``."""
    low, high = allowed
    return (value >= low) & (value <= high)


def bounded_arg(name: str, value: int, allowed: tuple[int, int]) -> int:
    """``value`` when it lies in ``allowed``, else ``ValueError`` before any plan is built."""
    if not within(value, allowed):
        raise ValueError(f"{name} must be between {allowed[0]} and {allowed[1]}, got {value}")
    return value
