"""Landed daily bars: reading, tidying and exporting them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import columns as C
from tickloom.functions import times as TM
from tickloom.operators.summaries import union_all
from tickloom.schemas import PROVIDER_COLUMNS, RAW_BARS
from tickloom.sources import files

LANDED = "Date string, Open double, High double, Low double, Close double, Volume double, Ticker string"


def tidy_bars(landed: DataFrame, ticker: str | None = None) -> DataFrame:
    """Provider history as bars: ISO dates, the required columns that exist, the ticker in upper case.

    ``ticker`` tags history that does not carry its own ticker column.
    """
    day = F.col("Date")
    if landed.schema["Date"].dataType.typeName() == "string":
        day = F.substring(day, 1, 10)
    else:
        day = TM.iso_date(day)
    tagged = landed.withColumns(
        {"Date": day, "Ticker": F.upper(F.lit(ticker) if ticker else F.col("Ticker"))}
    )
    return C.keep_present(tagged, [PROVIDER_COLUMNS[0], "Ticker", *PROVIDER_COLUMNS[1:]])


def read_landed_bars(spark: SparkSession, path: str, fmt: str = "csv", schema: str = LANDED) -> DataFrame:
    """Bars landed under ``path`` in ``Ticker=...`` folders (or with a ticker column)."""
    reader = spark.read.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    return tidy_bars(reader.load(path))


def union_batches(frames: Sequence[DataFrame]) -> DataFrame:
    return union_all(frames)


def ingest_batch(frames: Sequence[DataFrame], run_time: str) -> DataFrame:
    """The batch to append: stacked, stamped and cast to the published schema."""
    return C.enforce_schema(C.stamp_ingest(union_batches(frames), run_time), RAW_BARS)


def export_csv_by_ticker(bars: DataFrame, path: str) -> None:
    """CSV with a header under one ``Ticker=...`` folder per ticker, without the ticker column.

    Ranged over (ticker, day): a small ticker lands in one file, a big one in several.
    """
    view = C.keep_present(bars, ["Ticker", *PROVIDER_COLUMNS])
    ranged = view.repartitionByRange("Ticker", "Date").sortWithinPartitions("Ticker", "Date")
    if files.local_path(bars.sparkSession, path):
        names = [c for c in view.columns if c != "Ticker"]
        line = F.to_csv(F.struct(*names))
        files.write_lines(ranged, path, "Ticker", line, ".csv", f"{','.join(names)}\n")
        return
    ranged.write.partitionBy("Ticker").option("header", True).mode("overwrite").csv(path)
