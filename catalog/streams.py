"""The tick stream and its summaries, over the events table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.derive import LANDED, PARSED, TICKS, landed_ticks, table, ticks, wire
from catalog.registry import query, rounded
from tickloom.functions import text as X
from tickloom.functions import times as TM
from tickloom.operators import ordering, summaries
from tickloom.schemas import LIMIT_RANGE, within
from tickloom.session import scratch_path
from tickloom.sources import tables
from tickloom.streaming import stats
from tickloom.streaming import ticks as S

STAMP = "strftime(kafka_timestamp, '%Y-%m-%d %H:%M:%S.%f') AS kafka_timestamp"


def stamped(df: DataFrame) -> DataFrame:
    return df.withColumn("kafka_timestamp", F.date_format("kafka_timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def run_once(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Publish the messages as files and stream all of them into a new tick table."""
    root = scratch_path(spark, "ticks")
    S.publish_to_files(wire(spark, sf_dir).repartition(4), f"{root}/topic")
    events = S.expand_event(S.read_tick_files(spark, f"{root}/topic", files_per_batch=1))
    running = S.append_stream(
        events, f"{root}/table", "ticks", f"{root}/offsets", f"{root}/metrics", available_now=True
    )
    running.awaitTermination()
    return f"{root}/table", f"{root}/metrics"


@query(f"WITH {PARSED} SELECT ticker, price, size, event_time, {STAMP} FROM parsed")
def tick_stream(spark, sf_dir):
    path, _ = run_once(spark, sf_dir)
    return stamped(tables.read_table(spark, path).rows)


@query(f"""WITH {PARSED}, quarters AS (SELECT *, CAST(floor(epoch(kafka_timestamp)) AS BIGINT) % 4 AS part FROM parsed),
last AS (SELECT * FROM quarters WHERE part = (SELECT max(part) FROM quarters))
SELECT 'rows_total' AS name, CAST(count(*) AS DOUBLE) AS value FROM parsed
UNION ALL SELECT 'batches_total', CAST(count(DISTINCT part) AS DOUBLE) FROM quarters
UNION ALL SELECT 'last_batch_rows', CAST(count(*) AS DOUBLE) FROM last
UNION ALL SELECT 'last_batch_mean_event_time',
  round(avg(epoch_us(CAST(replace(event_time, '+00:00', '') AS TIMESTAMP))) / 1e6, 3) FROM last""")
def batch_metrics(spark, sf_dir):
    """The stream's own gauges after its last batch; the latency gauge as the mean event time it implies."""
    from tickloom.operators import monitor

    root = scratch_path(spark, "batches")
    # Four parts by the second a message was sent in, streamed one after another.
    quarter = F.pmod(F.unix_seconds("timestamp"), F.lit(4))
    for part in range(4):
        S.publish_to_files(wire(spark, sf_dir).filter(quarter == part), f"{root}/topic")
        events = S.expand_event(S.read_tick_files(spark, f"{root}/topic"))
        S.append_stream(
            events, f"{root}/table", "ticks", f"{root}/offsets", f"{root}/metrics", available_now=True
        ).awaitTermination()
    gauges = monitor.run_gauges(monitor.read_metrics(spark, f"{root}/metrics")).select("name", "value")
    ended = tables.commits(spark, f"{root}/table").agg(F.max(F.unix_micros("committed_at")) / 1e6).first()[0]
    late = F.col("name") == "write_latency_avg_seconds"
    return gauges.select(
        F.when(late, F.lit("last_batch_mean_event_time")).otherwise(F.col("name")).alias("name"),
        F.when(late, F.round(F.lit(ended) - F.col("value"), 3)).otherwise(F.col("value")).alias("value"),
    )


@query("SELECT count(*) AS rows, 4::BIGINT AS batches, true AS latencies_in_order, true AS rate_fits FROM events")
def run_summary(spark, sf_dir):
    """The report of a bounded run, with what the clock decides reduced to its rules."""
    root = scratch_path(spark, "bounded")
    S.publish_to_files(wire(spark, sf_dir).repartition(4), f"{root}/topic")
    events = S.expand_event(S.read_tick_files(spark, f"{root}/topic", files_per_batch=1))
    run = S.run_stream(events, f"{root}/table", "ticks", f"{root}/offsets", None, available_now=True)
    waits = [run[f"write_latency_{k}_seconds"] for k in ("p50", "max")]
    fits = abs(run["events_per_second"] * run["duration_seconds"] - run["rows"]) <= 0.01 * run["rows"] + 1
    return spark.range(1).select(
        F.lit(run["rows"]).cast("long").alias("rows"),
        F.lit(run["batches"]).cast("long").alias("batches"),
        F.lit(waits == sorted(waits) and waits[-1] >= run["write_latency_avg_seconds"]).alias("latencies_in_order"),
        F.lit(fits).alias("rate_fits"),
    )


@query(f"WITH {PARSED} SELECT ticker, price, size, event_time, {STAMP} FROM parsed")
def trigger(spark, sf_dir):
    """A query on a clock instead of one pass: it lands all there is and goes on waiting until stopped."""
    root = scratch_path(spark, "clock")
    S.publish_to_files(wire(spark, sf_dir), f"{root}/topic")
    events = S.expand_event(S.read_tick_files(spark, f"{root}/topic"))
    running = S.append_stream(events, f"{root}/table", "ticks", f"{root}/offsets", interval="1 second")
    try:
        running.processAllAvailable()
        if not running.isActive:
            raise RuntimeError("the query ended by itself")
    finally:
        running.stop()
    return stamped(tables.read_table(spark, f"{root}/table").rows)


@query("""SELECT "limit", count(*) AS asked, "limit" BETWEEN 1 AND 1000 AS accepted
FROM (SELECT event_id % 1200 - 100 AS "limit" FROM events) GROUP BY 1""")
def bounded_arg(spark, sf_dir):
    """Which of the limits that requests ask for are let through."""
    asked = table(spark, sf_dir, "events").groupBy((F.col("event_id") % 1200 - 100).alias("limit"))
    return asked.agg(F.count(F.lit(1)).alias("asked")).withColumn("accepted", within(F.col("limit"), LIMIT_RANGE))


@query(f"WITH {PARSED} SELECT ticker, price, size, event_time, {STAMP} FROM parsed")
def read_tick_stream(spark, sf_dir):
    """The file source alone, appended through a sink that keeps rows as they come."""
    root = scratch_path(spark, "source")
    S.publish_to_files(wire(spark, sf_dir), f"{root}/topic")
    events = S.expand_event(S.read_tick_files(spark, f"{root}/topic"))
    writer = events.writeStream.format("parquet").option("checkpointLocation", f"{root}/offsets")
    writer.trigger(availableNow=True).start(f"{root}/rows").awaitTermination()
    return stamped(spark.read.schema(events.schema).parquet(f"{root}/rows"))


@query(f"WITH {PARSED} SELECT ticker, price, size, event_time, {STAMP} FROM parsed")
def replayed_stream(spark, sf_dir):
    """Every batch delivered twice under the same app: the second delivery adds nothing."""
    path = scratch_path(spark, "replayed")
    write = S.batch_writer(path, "ticks")
    batch = S.expand_event(wire(spark, sf_dir))
    for batch_id in (0, 0):
        write(batch, batch_id)
    return stamped(tables.read_table(spark, path).rows)


@query(f"WITH {PARSED} SELECT ticker, price, size, event_time, {STAMP} FROM parsed")
def restarted_stream(spark, sf_dir):
    """Two halves published apart; the restarted query goes on from its checkpoint."""
    root = scratch_path(spark, "restarted")
    halves = wire(spark, sf_dir).withColumn("early", F.col("timestamp") < F.lit("2024-01-16"))
    for early in (True, False):
        S.publish_to_files(halves.filter(F.col("early") == early).drop("early"), f"{root}/topic")
        events = S.expand_event(S.read_tick_files(spark, f"{root}/topic"))
        S.append_stream(events, f"{root}/table", "ticks", f"{root}/offsets", available_now=True).awaitTermination()
    return stamped(tables.read_table(spark, f"{root}/table").rows)


@query("SELECT 1::BIGINT AS versions, count(*) AS rows FROM events")
def skip_empty(spark, sf_dir):
    """An empty batch before and after the full one leaves no version."""
    path = scratch_path(spark, "skipped")
    write = S.batch_writer(path, "ticks")
    batch = S.expand_event(wire(spark, sf_dir))
    for batch_id, rows in enumerate((batch.filter("false"), batch, batch.filter("false"))):
        write(rows, batch_id)
    return tables.commits(spark, path).agg(F.count(F.lit(1)).alias("versions"), F.sum("rows").alias("rows"))


@query(f"WITH {PARSED} SELECT ticker, price, size, event_time, {STAMP} FROM parsed")
def expand_event(spark, sf_dir):
    return stamped(S.expand_event(wire(spark, sf_dir)))


@query(f"WITH {TICKS} SELECT event_id, ticker, price, size, event_time FROM ticks")
def parse_tick(spark, sf_dir):
    """JSON text and back."""
    rows = ticks(spark, sf_dir)
    value = X.render_tick(F.col("ticker"), F.col("price"), F.col("size"), F.col("event_time"))
    return rows.select("event_id", X.parse_tick(value).alias("event")).select("event_id", "event.*")


MESSAGES = f"""WITH {TICKS} SELECT ticker AS key, '{{"ticker":"' || ticker || '","price":' || price || ',"size":' || size
  || ',"event_time":"' || event_time || '"}}' AS value FROM ticks"""


@query(MESSAGES)
def render_tick(spark, sf_dir):
    return S.as_messages(ticks(spark, sf_dir))


@query(MESSAGES)
def publish_events(spark, sf_dir):
    path = scratch_path(spark, "published")
    S.publish_to_files(S.as_messages(ticks(spark, sf_dir)), path)
    return spark.read.schema(S.MESSAGE).json(path).drop("timestamp")


@query(f"""WITH {PARSED} SELECT 'good' AS kind, count(*) AS "count" FROM parsed WHERE event_time IS NOT NULL
UNION ALL SELECT 'rejected', count(*) FROM parsed WHERE event_time IS NULL""")
def quarantine(spark, sf_dir):
    good, rejected = S.quarantine(wire(spark, sf_dir))
    kinds = [df.agg(F.count(F.lit(1)).alias("count")).select(F.lit(kind).alias("kind"), "count")
             for kind, df in (("good", good), ("rejected", rejected))]
    return summaries.union_all(kinds)


@query(f"WITH {TICKS} SELECT event_id, epoch_us(ts) AS micros FROM ticks")
def parse_event_time(spark, sf_dir):
    at = TM.micros(TM.parse_event_time(F.col("event_time")))
    return ticks(spark, sf_dir).select("event_id", at.alias("micros"))


@query(f"WITH {LANDED} SELECT event_id, (epoch_us(committed_at) - epoch_us(ts)) / 1e6 AS seconds FROM landed")
def seconds_between(spark, sf_dir):
    waited = TM.seconds_between(F.col("committed_at"), TM.parse_event_time(F.col("event_time")))
    return landed_ticks(spark, sf_dir).select("event_id", waited.alias("seconds"))


@query(f"""WITH {TICKS} SELECT event_id, strftime(ts, '%Y-%m-%d') AS iso_date, event_time AS iso_time,
  strftime(ts, '%Y%m%dT%H%M%S') AS file_stamp FROM ticks""")
def iso_date(spark, sf_dir):
    ts = F.col("ts")
    return ticks(spark, sf_dir).select(
        "event_id", TM.iso_date(ts).alias("iso_date"), TM.iso_time(ts).alias("iso_time"),
        TM.file_stamp(ts).alias("file_stamp"),
    )


@query("SELECT event_id, round(value / 7, 4) AS price, round(value / 7, 2) AS short FROM events")
def round_n(spark, sf_dir):
    seventh = F.col("value") / 7
    return table(spark, sf_dir, "events").select(
        "event_id", F.round(seventh, 4).alias("price"), F.round(seventh, 2).alias("short")
    )


@query(f"""WITH {LANDED} SELECT batch_id, count(*) AS rows,
  round(avg((epoch_us(committed_at) - epoch_us(ts)) / 1e6), 6) AS latency_avg_seconds,
  max((epoch_us(committed_at) - epoch_us(ts)) / 1e6) AS latency_max_seconds FROM landed GROUP BY 1""")
def batch_latency(spark, sf_dir):
    return rounded(stats.batch_latency(landed_ticks(spark, sf_dir)), 6, "latency_avg_seconds")


SUMMARY = f"""WITH {LANDED}, timed AS (
  SELECT *, epoch_us(committed_at) - epoch_us(ts) AS waited FROM landed)
SELECT count(*) AS rows, count(DISTINCT batch_id) AS batches,
  round((max(epoch_us(committed_at)) - min(epoch_us(ts))) / 1e6, 2) AS duration_seconds,
  round(count(*) / ((max(epoch_us(committed_at)) - min(epoch_us(ts))) / 1e6), 2) AS events_per_second,
  round(avg(waited) / 1e6, 2) AS write_latency_avg_seconds,
  round(max(waited) / 1e6, 2) AS write_latency_max_seconds,
  round((SELECT list(waited ORDER BY waited) FROM timed)[CAST(count(*) // 2 + 1 AS INTEGER)] / 1e6, 2)
    AS write_latency_p50_seconds
FROM timed"""


@query(SUMMARY)
def stream_summary(spark, sf_dir):
    return stats.stream_summary(landed_ticks(spark, sf_dir))


@query(f"""WITH {TICKS}, placed AS (
  SELECT ticker, price, row_number() OVER (PARTITION BY ticker ORDER BY price) - 1 AS pos,
    count(*) OVER (PARTITION BY ticker) AS n FROM ticks)
SELECT ticker, price AS upper_median FROM placed WHERE pos = n // 2""")
def upper_median(spark, sf_dir):
    return ordering.upper_median(ticks(spark, sf_dir), "price", ["ticker"])


def offsets(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The topic's end offset at the time of every message, over two partitions, and the batches."""
    rows = landed_ticks(spark, sf_dir).withColumn("app", F.lit("ticks"))
    ends = rows.groupBy("app", F.col("kafka_timestamp").alias("sampled_at")).agg(F.max("event_id").alias("last"))
    first = F.floor((F.col("last") + 1) / 2)
    ends = ends.select("app", "sampled_at", F.explode(F.array(first, F.col("last") + 1 - first)).alias("end_offset"))
    return ends, rows.groupBy("app", "batch_id", "committed_at").agg(F.count(F.lit(1)).alias("rows"))


LAG = f"""WITH {LANDED}, ends AS (
  SELECT kafka_timestamp AS sampled_at, max(event_id) + 1 AS end_offset FROM ticks GROUP BY 1),
done AS (SELECT DISTINCT committed_at, sum(n) OVER (ORDER BY committed_at) AS so_far FROM (
  SELECT committed_at, count(*) AS n FROM landed GROUP BY batch_id, committed_at)),
samples AS (SELECT 'ticks' AS app, e.sampled_at, CAST(greatest(0, end_offset - coalesce(so_far, 0)) AS BIGINT) AS lag
  FROM ends e ASOF LEFT JOIN done d ON e.sampled_at >= d.committed_at)"""


@query(f"{LAG} SELECT app, strftime(sampled_at, '%Y-%m-%d %H:%M:%S.%f') AS sampled_at, lag FROM samples")
def lag_samples(spark, sf_dir):
    """Samples fall between batches: each sees the rows of the batches committed before it."""
    samples = stats.lag_samples(*offsets(spark, sf_dir))
    return samples.withColumn("sampled_at", F.date_format("sampled_at", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query(f"{LAG} SELECT app, max(lag) AS consumer_lag_max, arg_max(lag, sampled_at) AS consumer_lag_final FROM samples GROUP BY 1")
def consumer_lag(spark, sf_dir):
    return stats.consumer_lag(stats.lag_samples(*offsets(spark, sf_dir)))


@query("""SELECT count(*) AS events_published,
  round((max(epoch_us(ts)) - min(epoch_us(ts))) / 1e6, 2) AS duration_seconds,
  round(count(*) / ((max(epoch_us(ts)) - min(epoch_us(ts))) / 1e6), 2) AS events_per_second,
  count(DISTINCT event_type) AS tickers FROM events""")
def publish_summary(spark, sf_dir):
    rows = ticks(spark, sf_dir).withColumn("at", F.col("ts").cast("timestamp"))
    return summaries.publish_summary(rows, "at", "ticker")


@query(f"""WITH {PARSED}, sent AS (SELECT ticker, count(*) AS published FROM ticks GROUP BY 1),
kept AS (SELECT ticker, count(*) AS landed FROM parsed GROUP BY 1)
SELECT coalesce(s.ticker, k.ticker) AS ticker, coalesce(published, 0) AS published, coalesce(landed, 0) AS landed,
  coalesce(published, 0) - coalesce(landed, 0) AS lost
FROM sent s FULL JOIN kept k ON s.ticker IS NOT DISTINCT FROM k.ticker""")
def loss_check(spark, sf_dir):
    """Broken payloads land without their ticker, so they show as lost there and extra under null."""
    return summaries.loss_check(ticks(spark, sf_dir), S.expand_event(wire(spark, sf_dir)), "ticker")
