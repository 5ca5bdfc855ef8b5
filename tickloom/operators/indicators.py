"""Moving averages, returns and volatility per ticker."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickloom.functions import columns as C
from tickloom.operators import ordering
from tickloom.schemas import INDICATORS

# Frame lengths in rows.
SHORT_ROWS = 20
LONG_ROWS = 50
VOLATILITY_ROWS = 20


def latest_bars(bars: DataFrame) -> DataFrame:
    """One row per (Ticker, Date): the one ingested last."""
    return ordering.newest_row(bars, ["Ticker", "Date"], ["ingested_at_utc"])


def moving_average(name: str, rows: int):
    def compute(df: DataFrame, window: WindowSpec) -> DataFrame:
        return df.withColumn(name, F.avg("Close").over(window.rowsBetween(1 - rows, 0)))

    return compute


def _all_indicators(df: DataFrame, window: WindowSpec) -> DataFrame:
    return (
        df.withColumns(
            {
                "SMA_20": F.avg("Close").over(window.rowsBetween(1 - SHORT_ROWS, 0)),
                "SMA_50": F.avg("Close").over(window.rowsBetween(1 - LONG_ROWS, 0)),
                "_prev": F.lag("Close").over(window),
            }
        )
        .withColumn("daily_return", C.daily_return(F.col("Close"), F.col("_prev")))
        .withColumn(
            "volatility_20d",
            F.stddev_samp("daily_return").over(window.rowsBetween(1 - VOLATILITY_ROWS, 0)),
        )
        .drop("_prev")
    )


def indicators(bars: DataFrame, dedupe: bool = True, **blocks: int) -> DataFrame:
    """The four indicator columns beside every bar.

    Frames are partial: they start at a ticker's first bar. With ``dedupe`` a
    ticker has at most one bar per calendar day, which bounds its window; without
    it, repeated days stay and tickers are cut into blocks.
    """
    if dedupe:
        unique = latest_bars(bars)
        return _all_indicators(unique, Window.partitionBy("Ticker").orderBy("Date"))
    order = ["Date", "ingested_at_utc", "Close"]
    return ordering.over_history(bars, ["Ticker"], order, LONG_ROWS - 1, _all_indicators, **blocks)


def ranged_indicators(bars: DataFrame) -> DataFrame:
    """``indicators`` in the layout to store: ranges of tickers, each in the order of (ticker, day).

    The ranges that the windows need are those that are stored, so bars are not shuffled
    again. A ticker with more bars than a block keeps repeated ones out of its range first.
    """
    sizes = bars.groupBy("Ticker").agg(F.count(F.lit(1)).alias("n"))
    crowded = not sizes.filter(F.col("n") > ordering.BLOCK_ROWS).isEmpty()
    ranged = (latest_bars(bars) if crowded else bars).repartitionByRange("Ticker")
    unique = ranged if crowded else latest_bars(ranged)
    return _all_indicators(unique, day_window()).sortWithinPartitions("Ticker", "Date")


def beside_stored(fresh: DataFrame, stored: DataFrame) -> DataFrame:
    """New bars and the rows stored of their buckets, told apart by ``_new``.

    Stored rows are shuffled without their indicators, which come out of their bars again.
    Only a bar without a day, which sorts before all others whenever it lands, may change
    them; where there is one they go along in ``_stored``.
    """
    undated = F.col("Date").isNull()
    bare = fresh.filter(undated).select("Date").union(stored.filter(undated).select("Date")).isEmpty()
    carried = F.struct(*INDICATORS)
    columns = [*fresh.columns, F.lit(False).alias("_new"), *([] if bare else [carried.alias("_stored")])]
    return stored.select(*columns).unionByName(fresh.withColumn("_new", F.lit(True)), allowMissingColumns=True)


def brought_up(bars: DataFrame, place: Sequence[str] = ()) -> DataFrame:
    """The indicators of bars, or of ``beside_stored`` rows.

    Stored rows of a ticker before the first day of its new bars stay as they are; its other
    rows are computed after them, the one ingested last of each day. ``place`` are columns
    that follow from the ticker and by which rows are dealt already; one sort serves all windows.
    """
    marks = ("_new", "_stored")
    names = [c for c in bars.columns if c not in (*place, *marks, "Date", "Ticker", "ingested_at_utc")]
    newest = [F.col(c).desc() for c in ("ingested_at_utc", *names)]
    keys = [*place, "Ticker"]
    whole = Window.partitionBy(*keys)
    rows, kept = bars.sortWithinPartitions(*keys, "Date", *newest), F.lit(False)
    if "_new" in bars.columns:
        first = F.min(F.when(F.col("_new"), F.col("Date"))).over(whole)
        rows = rows.withColumns({"_first": first, "_hit": F.max("_new").over(whole)})
        before = F.coalesce(F.col("Date") < F.col("_first"), F.lit(True))
        kept = ~F.col("_new") & (~F.col("_hit") | before)
    rows = rows.withColumn("_kept", kept).drop("_first", "_hit", "_new")
    day = Window.partitionBy(*keys, "Date").orderBy(*newest).rowsBetween(Window.unboundedPreceding, 0)
    number = F.sum(F.when(F.col("_kept"), 0).otherwise(1)).over(day)
    rows = rows.withColumn("_number", number).filter((F.col("_number") == 1) | F.col("_kept")).drop("_number")
    done = _all_indicators(rows, whole.orderBy("Date"))
    if "_stored" in bars.columns:
        done = done.withColumns({c: F.when(F.col("_kept"), F.col("_stored")[c]).otherwise(F.col(c)) for c in INDICATORS})
    return done.drop("_kept", "_stored")


def day_window() -> WindowSpec:
    """Per ticker by day; bounded by the calendar once bars are unique per day."""
    return Window.partitionBy("Ticker").orderBy("Date")


def sma(bars: DataFrame, name: str, rows: int) -> DataFrame:
    return moving_average(name, rows)(bars, day_window())


def prev_close(bars: DataFrame) -> DataFrame:
    return bars.withColumn("prev_close", F.lag("Close").over(day_window()))


def with_daily_return(bars: DataFrame) -> DataFrame:
    lagged = prev_close(bars)
    close, previous = F.col("Close"), F.col("prev_close")
    return lagged.withColumn("daily_return", C.daily_return(close, previous)).drop("prev_close")


def with_volatility(returns: DataFrame) -> DataFrame:
    frame = day_window().rowsBetween(1 - VOLATILITY_ROWS, 0)
    return returns.withColumn("volatility_20d", F.stddev_samp("daily_return").over(frame))


def trend(curated: DataFrame) -> DataFrame:
    setup = C.trend_setup(F.col("Close"), F.col("SMA_20"), F.col("SMA_50"))
    return curated.withColumn("trend_setup", setup)


def order_curated(curated: DataFrame) -> DataFrame:
    return curated.orderBy("Ticker", "Date")


def clustered(curated: DataFrame, by: Sequence[str] = ("Ticker", "Date")) -> DataFrame:
    """The layout to store: ranges over (ticker, day), so a big ticker spans several files."""
    keys = [F.col(c) for c in by]
    return curated.repartitionByRange(*keys).sortWithinPartitions(*keys)
