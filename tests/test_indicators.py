from datetime import date, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tickloom.operators import checks, indicators, ordering
from tickloom.schemas import RAW_BARS


def business_days(start: date, count: int):
    day, out = start, []
    while len(out) < count:
        if day.weekday() < 5:
            out.append(day.isoformat())
        day += timedelta(days=1)
    return out


@pytest.fixture(scope="module")
def bars(spark):
    data = [
        (day, ticker, 100.0, 101.0, 99.0, 100.0 + 0.5 * i, 1_000_000, "2026-01-01T00:00:00+00:00")
        for ticker in ("AAA", "BBB")
        for i, day in enumerate(business_days(date(2026, 1, 1), 25))
    ]
    return spark.createDataFrame(data, RAW_BARS)


def by_ticker(df, ticker="AAA"):
    return rows(df.filter(F.col("Ticker") == ticker).orderBy("Date"))


def test_all_rows_and_columns_come_out(bars):
    curated = indicators.indicators(bars)
    assert curated.count() == 50
    assert {"SMA_20", "SMA_50", "daily_return", "volatility_20d"} <= set(curated.columns)
    assert "prev_close" not in curated.columns and "_prev" not in curated.columns


def test_partial_frames(bars):
    got = by_ticker(indicators.indicators(bars))
    assert got[0]["SMA_20"] == 100.0
    assert got[19]["SMA_20"] == pytest.approx(104.75)
    assert got[24]["SMA_50"] == pytest.approx(106.0)


def test_returns_and_volatility(bars):
    got = by_ticker(indicators.indicators(bars))
    assert got[0]["daily_return"] is None
    assert got[1]["daily_return"] == pytest.approx(0.005)
    assert [r["volatility_20d"] is None for r in got[:4]] == [True, True, False, False]


def test_rising_closes_give_rising_averages(bars):
    curated = indicators.indicators(bars)
    assert checks.monotonic_violations(curated, ["Ticker"], ["Date"], "SMA_20").count() == 0


def test_zero_close_gives_null_return(spark):
    data = [(f"2026-01-0{i}", "AAA", 1.0, 1.0, 1.0, close, 1, "x") for i, close in ((1, 0.0), (2, 5.0))]
    got = by_ticker(indicators.indicators(spark.createDataFrame(data, RAW_BARS)))
    assert got[1]["daily_return"] is None


def test_newest_ingest_of_a_day_wins(spark):
    data = [
        ("2026-01-01", "AAA", 1.0, 1.0, 1.0, close, 1, stamp)
        for close, stamp in ((1.0, "2026-01-02T00:00:00"), (2.0, "2026-01-03T00:00:00"))
    ]
    got = rows(indicators.latest_bars(spark.createDataFrame(data, RAW_BARS)))
    assert len(got) == 1 and got[0]["Close"] == 2.0


def test_blocks_give_the_same_as_one_window(spark):
    """A hot ticker cut into small blocks, against the plain window."""
    data = [
        (f"2026-01-{i % 28 + 1:02d}", ticker, 1.0, 1.0, 1.0, float((i * 37) % 101 + 1), 1, f"run-{i:04d}")
        for ticker, n in (("HOT", 700), ("B", 90), ("C", 1))
        for i in range(n)
    ]
    raw = spark.createDataFrame(data, RAW_BARS)
    plain = indicators.indicators(raw, dedupe=False, bounded=True)
    cut = indicators.indicators(raw, dedupe=False, block_rows=64)
    assert cut.columns == plain.columns

    def tidy(df):
        floats = ("SMA_20", "SMA_50", "daily_return", "volatility_20d")
        return sorted(map(repr, (df.withColumns({c: F.round(c, 9) for c in floats})).collect()))

    assert tidy(cut) == tidy(plain)


def test_latest_n_against_sorting(spark):
    data = [(k, i, (i * 7919) % 1000) for k, n in (("a", 500), ("b", 3), ("c", 50)) for i in range(n)]
    df = spark.createDataFrame(data, "k string, i int, v int").repartition(13)
    got = [(r.k, r.v, r.i) for r in ordering.latest_n(df, ["k"], ["v", "i"], 5).collect()]
    want = []
    for key in ("a", "b", "c"):
        want += [(k, v, i) for k, v, i in sorted((k, v, i) for k, i, v in data if k == key)[-5:]]
    assert got == want


def test_number_rows_counts_every_row_of_every_key(spark):
    data = [(k, (i * 31) % 17, i) for k, n in (("a", 400), (None, 30), ("b", 1)) for i in range(n)]
    df = spark.createDataFrame(data, "k string, v int, i int").repartition(9)
    got = ordering.number_rows(df, ["k"], ["v", "i"]).collect()
    assert len(got) == len(data)
    for key in ("a", None, "b"):
        own = sorted((r["_pos"], r["v"], r["i"]) for r in got if r["k"] == key)
        assert [p for p, _, _ in own] == list(range(len(own)))
        assert [(v, i) for _, v, i in own] == sorted((v, i) for _, v, i in own)


@pytest.mark.parametrize("n", [1, 2, 4, 5, 6, 101])
@pytest.mark.parametrize("fold_rows", [4096, 2])
def test_upper_median(spark, n, fold_rows):
    values = [float((i * 37) % 11) for i in range(n)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = ordering.upper_median(df, "v", fold_rows=fold_rows).collect()
    assert [r["upper_median"] for r in got] == [sorted(values)[n // 2]]


def test_move_violations(spark):
    data = [("A", 100.0, 1), ("A", 100.3, 2), ("A", 101.0, 3), ("B", 50.0, 1), ("B", 49.8, 2)]
    ticks = spark.createDataFrame(data, "ticker string, price double, event_time int")
    for blocks in ({}, {"block_rows": 2}, {"bounded": True}):
        got = rows(checks.move_violations(ticks, **blocks))
        assert {(r["ticker"], r["event_time"]) for r in got} == {("A", 3), ("B", 2)}


def test_trend(spark):
    data = [("A", 3.0, 2.0, 1.0), ("B", 1.0, 2.0, 3.0), ("C", 2.0, 2.0, 1.0), ("D", 2.0, None, None)]
    df = spark.createDataFrame(data, "Ticker string, Close double, SMA_20 double, SMA_50 double")
    got = {r["Ticker"]: r["trend_setup"] for r in indicators.trend(df).collect()}
    assert got == {"A": "bullish", "B": "bearish", "C": "neutral", "D": "neutral"}


def test_upper_median_per_key(spark):
    """Ties, null keys, negative and far values, nulls, and more rows than one fold takes."""
    data = [("a", i * i % 7919) for i in range(4000)] + [(None, -i) for i in range(31)] + [("b", 5)] * 50 + [("c", None)]
    data += [("d", 10**15 * (-1) ** i + i) for i in range(1001)]
    df = spark.createDataFrame(data, "k string, v long").repartition(5)
    want = {k: sorted(v for q, v in data if q == k and v is not None) for k in ("a", None, "b", "d")}
    for fold_rows in (4096, 40):
        got = {r.k: r.upper_median for r in ordering.upper_median(df, "v", ["k"], fold_rows).collect()}
        assert got == {k: v[len(v) // 2] for k, v in want.items()}
    assert ordering.upper_median(df.where("false"), "v").collect() == []


def _history(spark):
    """A ticker of 400 bars, a null one of 30 and five of 12; two bars share a day now and then."""
    made = [(t, n) for t, n in [("HOT", 400), (None, 30), *[(f"T{i}", 12) for i in range(5)]]]
    data = [
        (f"2026-{1 + d // 28 % 12:02d}-{1 + d % 28:02d}", t, float(100 + d * 7 % 13), f"run-{i:04d}")
        for t, n in made
        for i in range(n)
        for d in [i * 3 // 4]
    ]
    return spark.createDataFrame(data, '"Date" string, Ticker string, Close double, ingested_at_utc string'.replace('"', "")).repartition(5)


def _told(df):
    return sorted((str(r.Ticker), r.Date, r.ingested_at_utc, r.SMA_20, r.SMA_50, r.daily_return, r.volatility_20d) for r in df.collect())


def test_only_keys_of_several_blocks_are_numbered(spark, monkeypatch):
    """Other keys are one block anyway; their rows are not written and shuffled again to find that out."""
    bars, numbered, write = _history(spark), {}, ordering.materialise
    monkeypatch.setattr(ordering, "materialise", lambda df, name: numbered.setdefault(name, write(df, name)))
    plain = _told(indicators.indicators(bars, dedupe=False))
    assert "numbered" not in numbered
    numbered.clear()
    assert _told(indicators.indicators(bars, dedupe=False, block_rows=60)) == plain
    assert {r.Ticker for r in numbered["numbered"].select("Ticker").distinct().collect()} == {"HOT"}


def test_bars_to_store_are_shuffled_once(spark, monkeypatch):
    bars = _history(spark).localCheckpoint()
    plain = _told(indicators.indicators(bars))
    ranged = indicators.ranged_indicators(bars)
    plan = ranged._jdf.queryExecution().sparkPlan().toString() + ranged._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" in plan
    assert _told(ranged) == plain
    monkeypatch.setattr(ordering, "BLOCK_ROWS", 50)
    assert _told(indicators.ranged_indicators(bars)) == plain
