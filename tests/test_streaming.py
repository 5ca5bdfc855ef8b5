import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tickloom.session import scratch_path
from tickloom.sources import tables
from tickloom.operators import monitor
from tickloom.streaming import stats
from tickloom.streaming import ticks as S

ONE = [("AAA", 101.5, 10, "2026-09-01T10:00:00+00:00")]
TICK = "ticker string, price double, size long, event_time string"


def test_writer_appends_and_reports(spark):
    root = scratch_path(spark, "writer")
    write = S.batch_writer(f"{root}/t", "run", f"{root}/m")
    write(spark.createDataFrame(ONE, TICK), 0)
    write(spark.createDataFrame([], TICK), 1)
    write(spark.createDataFrame(ONE, TICK), 0)
    assert tables.read_table(spark, f"{root}/t").rows.count() == 1
    gauges = {r.name: r.value for r in monitor.run_gauges(monitor.read_metrics(spark, f"{root}/m")).collect()}
    assert gauges["rows_total"] == 1 and gauges["batches_total"] == 1 and gauges["last_batch_rows"] == 1
    latencies = rows(stats.batch_latency(S.landed(spark, f"{root}/t")))
    assert len(latencies) == 1 and latencies[0]["rows"] == 1


def messages(spark, values):
    data = [(f"k{i}", v, "2026-01-01T00:00:00Z") for i, v in enumerate(values)]
    return spark.createDataFrame(data, "key string, value string, t string").select(
        "key", "value", F.col("t").cast("timestamp").alias("timestamp")
    )


GOOD = json.dumps({"ticker": "A", "price": 1.5, "size": 3, "event_time": "2026-01-01T00:00:00+00:00"})


def test_bad_payloads_are_kept_as_nulls(spark):
    values = [GOOD, "not json", '{"ticker":"B","price":"x"}', '{"ticker":"C","extra":1}', None]
    got = rows(S.expand_event(messages(spark, values)))
    assert len(got) == 5
    assert sorted(r["ticker"] or "" for r in got) == ["", "", "A", "B", "C"]
    good, rejected = S.quarantine(messages(spark, values))
    assert {r["ticker"] for r in rows(good)} == {"A", "C"} and rejected.count() == 3


def test_published_messages(spark):
    got = rows(S.as_messages(spark.createDataFrame(ONE, TICK)))
    assert got[0]["key"] == "AAA"
    assert set(json.loads(got[0]["value"])) == {"ticker", "price", "size", "event_time"}


def stream(spark, root, app, checkpoint):
    events = S.expand_event(S.read_tick_files(spark, f"{root}/topic", 1))
    S.append_stream(events, f"{root}/t", app, checkpoint, available_now=True).awaitTermination()
    return tables.read_table(spark, f"{root}/t").rows.count()


def test_restart_and_replay(spark):
    root = scratch_path(spark, "stream")
    for part in range(3):
        S.publish_to_files(messages(spark, [GOOD] * 4).coalesce(1), f"{root}/topic")
    assert stream(spark, root, "app", f"{root}/c1") == 12
    assert stream(spark, root, "app", f"{root}/c1") == 12
    S.publish_to_files(messages(spark, [GOOD] * 2).coalesce(1), f"{root}/topic")
    assert stream(spark, root, "app", f"{root}/c1") == 14
    assert stream(spark, root, "other", f"{root}/c2") == 28


def test_bounded_run(spark):
    root = scratch_path(spark, "bounded")
    S.publish_to_files(messages(spark, [GOOD]), f"{root}/topic")
    events = S.expand_event(S.read_tick_files(spark, f"{root}/topic"))
    run = S.run_stream(events, f"{root}/t", "app", f"{root}/c", timeout_seconds=8, interval="1 second")
    assert run["duration_seconds"] >= 1 and (run["rows"], run["batches"]) == (1, 1)
    assert run["events_per_second"] == round(1 / run["duration_seconds"], 2)
    assert run["write_latency_p50_seconds"] == run["write_latency_max_seconds"] == run["write_latency_avg_seconds"] > 0
    assert "consumer_lag_max" not in run and not spark.streams.active
    assert tables.read_table(spark, f"{root}/t").rows.count() == 1


def test_run_without_rows_and_run_that_fails(spark):
    root = scratch_path(spark, "quiet")
    S.publish_to_files(messages(spark, [GOOD]).where("false"), f"{root}/topic")
    events = S.expand_event(S.read_tick_files(spark, f"{root}/topic"))
    run = S.run_stream(events, f"{root}/t", "app", f"{root}/c", None, available_now=True)
    assert (run["rows"], run["batches"], run["events_per_second"]) == (0, 0, 0.0)
    S.publish_to_files(messages(spark, [GOOD]), f"{root}/topic")
    broken = S.expand_event(S.read_tick_files(spark, f"{root}/topic")).withColumn("price", F.raise_error(F.lit("no")))
    with pytest.raises(Exception, match="no"):
        S.run_stream(broken, f"{root}/u", "app", f"{root}/d", None, available_now=True)
    assert not spark.streams.active


def test_lag_of_a_real_query_and_of_a_recorded_report(spark):
    root = scratch_path(spark, "progress")
    S.publish_to_files(messages(spark, [GOOD]), f"{root}/topic")
    events = S.expand_event(S.read_tick_files(spark, f"{root}/topic"))
    running = S.append_stream(events, f"{root}/t", "app", f"{root}/c", interval="1 second")
    try:
        running.processAllAvailable()
        assert running.lastProgress is not None and S.live_lag(running) is None
    finally:
        running.stop()
    parts = {str(p): 30 for p in range(4)}
    report = {"sources": [{"latestOffset": {"t": parts}, "endOffset": {"t": {str(p): 20 for p in range(3)}}}]}
    assert S.reported_lag(json.dumps(report)) == 60
    as_text = {"sources": [{k: json.dumps(v) for k, v in report["sources"][0].items()}, {"latestOffset": "None"}]}
    assert S.reported_lag(json.dumps(as_text)) == 60


def test_lag_gauge_after_each_batch(spark):
    root = scratch_path(spark, "gauge")

    class Event:
        class progress:
            id, batchId, numInputRows = "q", 7, 5
            json = json.dumps({"sources": [{"latestOffset": {"t": {"0": 9}}, "endOffset": {"t": {"0": 4}}}]})

    reports = S.LagReports(spark, f"{root}/m")
    reports.onQueryProgress(Event)
    assert reports.samples == {}
    reports.query_id = "q"
    reports.onQueryProgress(Event)
    assert reports.samples == {7: 5}
    assert [(r.name, r.value) for r in monitor.run_gauges(monitor.read_metrics(spark, f"{root}/m")).collect()] == [("consumer_lag", 5.0)]


def test_facts_come_with_the_write(spark):
    root = scratch_path(spark, "facts")
    write = S.batch_writer(f"{root}/t", "run")
    write(spark.createDataFrame(ONE * 3 + [("B", 1.0, 1, None)], TICK), 0)
    report = S.batch_reports(spark, f"{root}/t").first()
    latency = rows(stats.batch_latency(S.landed(spark, f"{root}/t")))[0]
    assert (report["rows"], report["timed"]) == (4, 3)
    assert abs(report["latency_avg_seconds"] - latency["latency_avg_seconds"]) < 1e-3
    assert abs(report["latency_max_seconds"] - latency["latency_max_seconds"]) < 1e-3


def test_summary(spark):
    data = [(0, f"2026-01-01T00:00:0{i}+00:00", "2026-01-01T00:00:10Z") for i in range(4)]
    landed = spark.createDataFrame(data, "batch_id long, event_time string, c string").select(
        "batch_id", "event_time", F.col("c").cast("timestamp").alias("committed_at")
    )
    got = rows(stats.stream_summary(landed))[0]
    assert got["rows"] == 4 and got["batches"] == 1
    assert got["write_latency_p50_seconds"] == 9.0 and got["write_latency_max_seconds"] == 10.0
    assert got["write_latency_avg_seconds"] == 8.5 and got["duration_seconds"] == 10.0


def test_lag(spark):
    ends = spark.createDataFrame([("a", 5, 0, 5), ("a", 5, 1, 4), ("a", 11, 0, 6), ("a", 11, 1, 4), ("a", 30, 0, 14), ("b", 11, 0, 3)],
                                 "app string, sampled_at int, part int, end_offset long")
    batches = spark.createDataFrame([("a", 10, 3), ("a", 11, 4), ("a", 20, 9)], "app string, committed_at int, rows long")
    samples = stats.lag_samples(ends, batches)
    assert sorted((r.app, r.sampled_at, r.lag) for r in samples.collect()) == [("a", 5, 9), ("a", 11, 3), ("a", 30, 0), ("b", 11, 3)]
    assert sorted(map(repr, rows(stats.consumer_lag(samples)))) == sorted(map(repr, [
        {"app": "a", "consumer_lag_max": 9, "consumer_lag_final": 0}, {"app": "b", "consumer_lag_max": 3, "consumer_lag_final": 3}]))


def test_kafka_source_asks_for_its_connector(spark):
    with pytest.raises(Exception, match="[Kk]afka"):
        S.read_tick_topic(spark, "localhost:1", "t")


def test_loss_per_key(spark):
    from tickloom.operators import summaries

    sent = spark.createDataFrame([("A",), ("A",), ("B",)], "ticker string")
    kept = spark.createDataFrame([("A",), (None,)], "ticker string")
    got = {r["ticker"]: (r["published"], r["landed"], r["lost"]) for r in rows(summaries.loss_check(sent, kept, "ticker"))}
    assert got == {"A": (2, 1, 1), "B": (1, 0, 1), None: (0, 1, -1)}
