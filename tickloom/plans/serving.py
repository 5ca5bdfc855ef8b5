"""Read-side functions: latest bars and ticks per ticker, ticker list, table status."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import columns as C
from tickloom.operators import ordering
from tickloom.schemas import BAR_VIEW, DEFAULT_LIMIT, LIMIT_RANGE, PORTFOLIO, TICK_VIEW, bounded_arg
from tickloom.sources import tables


def bar_view(curated: DataFrame) -> DataFrame:
    return C.keep_present(curated, BAR_VIEW)


def tick_view(ticks: DataFrame) -> DataFrame:
    return C.keep_present(ticks, TICK_VIEW)


def tickers(portfolio: DataFrame) -> DataFrame:
    return portfolio.select("Ticker")


def default_portfolio(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(t,) for t in PORTFOLIO], "Ticker string")


def prices(
    curated: DataFrame,
    tickers: str | Sequence[str] | None = None,
    limit: int = DEFAULT_LIMIT,
    normalised: bool = True,
) -> DataFrame:
    """The latest ``limit`` bars per ticker, oldest first, for the named tickers or for all."""
    bounded_arg("limit", limit, LIMIT_RANGE)
    rows = curated if tickers is None else C.for_ticker(curated, "Ticker", tickers, normalised)
    kept = ordering.latest_n(bar_view(C.as_text(rows, "Date")), ["Ticker"], ["Date"], limit)
    return C.json_safe(kept)


def ticks(
    ticks: DataFrame,
    tickers: str | Sequence[str] | None = None,
    limit: int = DEFAULT_LIMIT,
    normalised: bool = True,
    as_text: bool = True,
) -> DataFrame:
    """The latest ``limit`` ticks per ticker by event time, oldest first.

    Columns beyond the published ones only break ties between equal event times.
    """
    bounded_arg("limit", limit, LIMIT_RANGE)
    rows = ticks if tickers is None else C.for_ticker(ticks, "ticker", tickers, normalised)
    ties = [c for c in rows.columns if c not in ("ticker", "event_time")]
    kept = ordering.latest_n(rows, ["ticker"], ["event_time", *sorted(ties)], limit)
    view = C.json_safe(tick_view(kept))
    return C.as_text(view, "event_time", "kafka_timestamp") if as_text else view


def table_prices(spark: SparkSession, path: str, **read: object) -> tuple[DataFrame, int]:
    """``prices`` over a stored table, with the version served."""
    stored = tables.read_table(spark, path)
    return prices(stored.rows, **read), stored.version


def table_ticks(spark: SparkSession, path: str, **read: object) -> tuple[DataFrame, int]:
    stored = tables.read_table(spark, path)
    return ticks(stored.rows, **read), stored.version


def table_stats(spark: SparkSession, named: dict[str, str]) -> DataFrame:
    """One status row per table; a missing table is reported, not raised."""
    rows = []
    for name, path in named.items():
        try:
            head = tables.read_head(spark, path)
        except tables.TableUnavailable as missing:
            rows.append((name, path, False, None, None, str(missing)))
        else:
            rows.append((name, path, True, head.rows, head.version, None))
    return spark.createDataFrame(
        rows, "name string, path string, available boolean, rows long, version long, detail string"
    )
