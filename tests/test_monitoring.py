import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tickloom.functions import columns as C
from tickloom.operators import monitor
from tickloom.session import scratch_path


def test_only_numeric_metrics_count_and_recording_never_raises(spark):
    path = scratch_path(spark, "metrics")
    assert monitor.record_metrics(spark, path, "job", {"rows": 10, "path": "data/x", "names": ["a"], "none": None})
    assert rows(monitor.run_gauges(monitor.read_metrics(spark, path))) == [{"job": "job", "name": "rows", "value": 10.0}]
    assert not monitor.record_metrics(spark, None, "job", {"rows": 1})
    assert not monitor.record_metrics(spark, "nosuchscheme://x/y", "job", {"rows": 1})


def test_newest_gauge_wins(spark):
    data = [("2026-01-01T00:00:00Z", "j", "g", "1"), ("2026-01-02T00:00:00Z", "j", "g", "2"), ("2026-01-03T00:00:00Z", "j", "g", "x")]
    df = spark.createDataFrame(data, "ts string, job string, name string, value string").withColumn("ts", F.col("ts").cast("timestamp"))
    assert rows(monitor.run_gauges(df))[0]["value"] == 2.0


def test_routes(spark):
    paths = ["/api/v1/prices/MSFT", "/api/v1/prices/A/B", "/health", "/healthx", "/nope"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    got = [r["r"] for r in rows(df.select(C.route_template(F.col("p"), ["/health", "/api/v1/prices/{ticker}"]).alias("r")))]
    assert got == ["/api/v1/prices/{ticker}", "unmatched", "/health", "unmatched", "unmatched"]


def samples(spark, data):
    df = spark.createDataFrame(data, "s string, t double, value double")
    return df.withColumn("ts", F.timestamp_micros((F.col("t") * 1_000_000).cast("long"))).drop("t")


def test_rate_with_a_reset(spark):
    df = samples(spark, [("a", 0.0, 10.0), ("a", 15.0, 40.0), ("a", 30.0, 5.0), ("a", 600.0, 7.0)])
    got = [r["rate"] for r in rows(monitor.counter_rate(df, 60, ["s"]).orderBy("ts"))]
    assert got == [None, 0.5, pytest.approx(35 / 60), None]


def brute_rate(points, span):
    out = []
    for t, _ in points:
        inside = [(u, v) for u, v in points if t - span < u <= t]
        steps = [(v2 if v2 < v1 else v2 - v1) for (_, v1), (_, v2) in zip(inside, inside[1:])]
        out.append(None if len(inside) < 2 else sum(steps) / span)
    return out


@pytest.mark.parametrize("span", [300, 100_000])
def test_rate_across_block_ends(spark, span):
    rng = random.Random(5)
    points, t, v = [], 0, 0
    for _ in range(400):
        t += rng.randint(1, 2500)
        v = 0 if rng.random() < 0.05 else v + rng.randint(0, 9)
        points.append((float(t), float(v)))
    got = [r["rate"] for r in rows(monitor.counter_rate(samples(spark, [("a", t, v) for t, v in points]), span, ["s"]).orderBy("ts"))]
    want = brute_rate(points, span)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert (g is None) == (w is None) and (w is None or g == pytest.approx(w))


def test_histogram_and_quantile(spark):
    df = spark.createDataFrame([("a", v) for v in (0.1, 0.4, 0.6, 0.9, 1.5)] + [("b", 99.0)], "l string, v double")
    buckets = monitor.latency_histogram(df, "v", [0.5, 1.0, 2.0], ["l"])
    got = {(r["l"], r["le"]): r["bucket"] for r in rows(buckets)}
    assert [got["a", le] for le in (0.5, 1.0, 2.0, float("inf"))] == [2, 4, 5, 5]
    q = {r["l"]: r["quantile"] for r in rows(monitor.histogram_quantile(buckets, 0.5, ["l"]))}
    assert q["a"] == pytest.approx(0.5 + 0.5 * (2.5 - 2) / 2) and q["b"] == 2.0


def test_quantile_of_nothing_is_null(spark):
    df = spark.createDataFrame([("a", 1.0, 0), ("a", float("inf"), 0), ("b", 1.0, 3)], "l string, le double, bucket long")
    q = {r["l"]: r["quantile"] for r in rows(monitor.histogram_quantile(df, 0.5, ["l"]))}
    assert q == {"a": None, "b": None}


def test_rates_of_series_sampled_at_different_seconds_add_up(spark):
    """Two counters, read 7 seconds apart, rising 0.5 and 1.0 a second."""
    data = [("/a", "200", 1_000 + 30 * i, 15.0 * i) for i in range(80)] + [("/a", "500", 1_007 + 30 * i, 30.0 * i) for i in range(80)]
    df = spark.createDataFrame(data, "endpoint string, status string, at long, value double").withColumn("ts", F.timestamp_seconds("at")).drop("at")
    rates = monitor.counter_rate(df, 600, ["endpoint", "status"], step_seconds=60)
    found = sorted((r.ts.timestamp(), r.rate) for r in monitor.rate_by_label(rates, ["endpoint"]).collect())
    assert [t % 60 for t, _ in found] == [0] * len(found)
    steady = [rate for t, rate in found if 1_700 <= t <= 3_300]
    assert len(steady) > 20 and all(abs(r - 1.5 * 570 / 600) < 1e-9 for r in steady)
