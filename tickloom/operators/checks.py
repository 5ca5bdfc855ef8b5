"""Row checks over ordered groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import functions as F

from tickloom.operators import ordering
from tickloom.schemas import MAX_TICK_MOVE


def _with_previous(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, **blocks: int | bool):
    def compute(rows: DataFrame, window: WindowSpec) -> DataFrame:
        return rows.withColumn("previous", F.lag(value).over(window))

    return ordering.over_history(df, keys, order, 1, compute, **blocks)


def first_bar(bars: DataFrame) -> DataFrame:
    """The bar of the first day per ticker, the first ingested where a day has several."""
    stamp = [c for c in ("ingested_at_utc",) if c in bars.columns]
    return ordering.first_row(bars, ["Ticker"], ["Date", *stamp])


def monotonic_violations(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, **blocks: int | bool
) -> DataFrame:
    """Rows whose value is below the one before it in their group."""
    lagged = _with_previous(df, keys, order, value, **blocks)
    return lagged.filter(F.col(value) < F.col("previous"))


def move_violations(
    ticks: DataFrame,
    keys: Sequence[str] = ("ticker",),
    order: Sequence[str] = ("event_time",),
    max_move: float = MAX_TICK_MOVE,
    **blocks: int | bool,
) -> DataFrame:
    """Ticks that moved further from the prior price than ``max_move`` of it."""
    lagged = _with_previous(ticks, keys, order, "price", **blocks)
    gap = F.abs(F.col("price") - F.col("previous"))
    return lagged.filter(gap > F.col("previous") * F.lit(max_move) + F.lit(1e-9))
