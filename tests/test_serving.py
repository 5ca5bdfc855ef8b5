import pytest
from conftest import rows
from pyspark.sql import functions as F

from tickloom.functions import columns as C
from tickloom.plans import serving
from tickloom.session import scratch_path
from tickloom.sources import tables

CURATED = (
    "Date string, Ticker string, Open double, High double, Low double, Close double, Volume long, "
    "ingested_at_utc string, SMA_20 double, SMA_50 double, daily_return double, volatility_20d double"
)


@pytest.fixture(scope="module")
def curated(spark):
    nan = float("nan")
    data = []
    for ticker, base in (("MSFT", 505.0), ("NVDA", 105.0)):
        for i in range(3):
            close = base + i
            change = nan if i == 0 else round(1 / (close - 1), 5)
            data.append(
                (f"2026-09-0{i + 1}", ticker, close, close, close, close, 10, "x", close, close, change, nan)
            )
    return spark.createDataFrame(data, CURATED)


def test_prices_are_oldest_first_and_nan_is_null(curated):
    got = rows(serving.prices(curated, "MSFT"))
    assert [r["Close"] for r in got] == [505.0, 506.0, 507.0]
    assert got[0]["daily_return"] is None
    assert got[1]["daily_return"] == pytest.approx(0.00198)
    assert "ingested_at_utc" not in got[0]


def test_limit_keeps_the_newest_and_case_is_ignored(curated):
    got = rows(serving.prices(curated, "msft", limit=2))
    assert [r["Date"] for r in got] == ["2026-09-02", "2026-09-03"]


def test_unknown_ticker_is_empty_not_an_error(curated):
    assert serving.prices(curated, "NOPE").count() == 0


@pytest.mark.parametrize("limit", [0, 99999])
def test_limit_out_of_range(curated, limit):
    with pytest.raises(ValueError):
        serving.prices(curated, "MSFT", limit=limit)


def test_mixed_case_tables(spark):
    df = spark.createDataFrame([("Msft", 1.0), ("nvda", 2.0)], "Ticker string, Close double")
    assert C.for_ticker(df, "Ticker", "MSFT", normalised=False).count() == 1


def test_ticks(spark):
    data = [
        ("MSFT", 505.1, 100, "2026-09-01T10:00:00+00:00", "2026-09-01 10:00:00"),
        ("MSFT", 505.2, 200, "2026-09-01T10:00:01+00:00", "2026-09-01 10:00:01"),
        ("NVDA", 105.1, 300, "2026-09-01T10:00:02+00:00", "2026-09-01 10:00:02"),
    ]
    schema = "ticker string, price double, size long, event_time string, kafka_timestamp string"
    got = rows(serving.ticks(spark.createDataFrame(data, schema), "msft"))
    assert len(got) == 2 and got[0]["price"] == 505.1


def test_missing_time_counts_as_latest(spark):
    data = [("A", 1.0, 1, None, None), ("A", 2.0, 1, "2026-01-01T00:00:00+00:00", None)]
    schema = "ticker string, price double, size long, event_time string, kafka_timestamp string"
    got = rows(serving.ticks(spark.createDataFrame(data, schema), "A", limit=1))
    assert got[0]["price"] == 1.0


def test_stats_report_missing_tables(spark, curated):
    path = scratch_path(spark, "curated")
    tables.overwrite_version(curated, path)
    missing = scratch_path(spark, "missing")
    got = {r["name"]: r for r in rows(serving.table_stats(spark, {"curated": path, "ticks": missing}))}
    assert got["curated"]["available"] and got["curated"]["rows"] == 6 and got["curated"]["version"] == 0
    assert not got["ticks"]["available"] and got["ticks"]["detail"]


def test_stored_reads_carry_their_version(spark, curated):
    path = scratch_path(spark, "served")
    tables.overwrite_version(curated, path)
    tables.overwrite_version(curated, path)
    got, version = serving.table_prices(spark, path, tickers="nvda", limit=1)
    assert version == 1 and rows(got)[0]["Close"] == 107.0
    with pytest.raises(tables.TableUnavailable):
        serving.table_prices(spark, scratch_path(spark, "none"))


def test_portfolio(spark):
    got = serving.tickers(serving.default_portfolio(spark))
    assert got.count() == 17 and got.filter(F.col("Ticker") == "GLE.PA").count() == 1


def test_ticker_filter_reaches_the_scan(spark, curated):
    path = scratch_path(spark, "pushed")
    tables.overwrite_version(curated, path)
    df = C.for_ticker(tables.read_table(spark, path).rows, "Ticker", "msft").select("Close")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(Ticker,MSFT)" in plan
    assert "Volume" not in plan.split("ReadSchema")[1]
