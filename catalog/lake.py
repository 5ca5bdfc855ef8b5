"""Landing, versioned tables and the daily batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.derive import CURATED, LATEST_BARS, RAW_BARS, raw_bars, table
from catalog.market import OHLCV, PORTFOLIO, ROUNDED, bars, curated, portfolio, tidy
from catalog.registry import query
from tickloom.functions import columns as C
from tickloom.operators import lookups
from tickloom.plans import batch, serving
from tickloom.schemas import RAW_BARS as RAW_SCHEMA
from tickloom.session import scratch_path
from tickloom.sources import buckets, evalset, landing, tables

STAMP = "2026-02-01T00:00:00+00:00"


@query(f"WITH {LATEST_BARS} SELECT {OHLCV} FROM bars")
def read_landed_bars(spark, sf_dir):
    """Through one CSV folder per ticker and back."""
    path = scratch_path(spark, "landed")
    landing.export_csv_by_ticker(bars(spark, sf_dir), path)
    return landing.read_landed_bars(spark, path).withColumn("Volume", F.col("Volume").cast("long"))


@query(f"""WITH {LATEST_BARS} SELECT "Ticker", count(*) AS rows, sum("Volume")::BIGINT AS volume FROM bars GROUP BY 1""")
def export_csv_by_ticker(spark, sf_dir):
    path = scratch_path(spark, "export")
    landing.export_csv_by_ticker(bars(spark, sf_dir), path)
    files = spark.read.schema(landing.LANDED).option("header", True).csv(path)
    return files.groupBy("Ticker").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("Volume").cast("long").alias("volume")
    )


@query(f"""WITH {LATEST_BARS} SELECT {OHLCV}, '{STAMP}' AS ingested_at_utc FROM bars""")
def enforce_schema(spark, sf_dir):
    """Every column arrives as text, in another order, and leaves typed and ordered."""
    text = bars(spark, sf_dir).select(
        *[F.col(c).cast("string").alias(c) for c in ("Volume", "Close", "Ticker", "Open", "High", "Low", "Date")]
    )
    return C.enforce_schema(C.stamp_ingest(text, STAMP), RAW_SCHEMA)


@query(f"""WITH {LATEST_BARS} SELECT "Date", "Ticker", 'Volume' AS rejected_columns FROM bars WHERE "Close" < 20000""")
def schema_rejects(spark, sf_dir):
    drifted = F.when(F.col("Close") < 20000, F.lit("n/a")).otherwise(F.col("Volume").cast("string"))
    rows = bars(spark, sf_dir).withColumn("Volume", drifted)
    return C.schema_rejects(rows, RAW_SCHEMA).select("Date", "Ticker", "rejected_columns")


@query(f"""WITH {LATEST_BARS} SELECT "Date", "Ticker", '{STAMP}' AS ingested_at_utc FROM bars""")
def stamp_ingest(spark, sf_dir):
    return C.stamp_ingest(bars(spark, sf_dir).select("Date", "Ticker"), STAMP)


@query(f"""WITH {LATEST_BARS} SELECT "Date", "Ticker", "Close" FROM bars""")
def keep_present(spark, sf_dir):
    return C.keep_present(bars(spark, sf_dir), ["Date", "Ticker", "Close", "no_such_column"])


@query(f"WITH {LATEST_BARS} SELECT {OHLCV}, ingested_at_utc FROM bars UNION ALL SELECT * FROM raw_bars")
def union_batches(spark, sf_dir):
    return landing.union_batches([bars(spark, sf_dir), raw_bars(spark, sf_dir)])


def two_appends(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "bars")
    tables.append_version(bars(spark, sf_dir), path)
    tables.append_version(raw_bars(spark, sf_dir), path)
    return path


@query(f"WITH {LATEST_BARS} SELECT {OHLCV}, ingested_at_utc FROM bars UNION ALL SELECT * FROM raw_bars")
def append_version(spark, sf_dir):
    return tables.read_table(spark, two_appends(spark, sf_dir)).rows


@query(f"WITH {RAW_BARS} SELECT * FROM raw_bars")
def overwrite_version(spark, sf_dir):
    path = scratch_path(spark, "replaced")
    tables.append_version(bars(spark, sf_dir), path)
    tables.overwrite_version(raw_bars(spark, sf_dir), path)
    return tables.read_table(spark, path).rows


@query(f"WITH {LATEST_BARS} SELECT {OHLCV}, ingested_at_utc, CAST(0 AS BIGINT) AS table_version FROM bars")
def read_table(spark, sf_dir):
    """The table as it was before its second append, with the version served."""
    stored = tables.read_table(spark, two_appends(spark, sf_dir), version=0)
    return stored.rows.withColumn("table_version", F.lit(stored.version).cast("long"))


STATUS = f"""WITH {LATEST_BARS}, n AS (SELECT (SELECT count(*) FROM bars) AS kept, (SELECT count(*) FROM raw_bars) AS raw)
SELECT 'bars' AS name, true AS available, kept + raw AS rows, CAST(1 AS BIGINT) AS version FROM n
UNION ALL SELECT 'ticks', false, NULL, NULL"""


@query(STATUS)
def table_stats(spark, sf_dir):
    named = {"bars": two_appends(spark, sf_dir), "ticks": scratch_path(spark, "never-written")}
    return serving.table_stats(spark, named).select("name", "available", "rows", "version")


@query(f"WITH {RAW_BARS} SELECT count(*) AS new_rows FROM raw_bars")
def new_rows(spark, sf_dir):
    path = scratch_path(spark, "growing")
    baseline = tables.append_version(bars(spark, sf_dir), path)
    tables.append_version(raw_bars(spark, sf_dir), path)
    return spark.range(1).select(F.lit(tables.new_rows(spark, path, baseline)).cast("long").alias("new_rows"))


@query(f"WITH {CURATED} SELECT {OHLCV}, ingested_at_utc, {ROUNDED} FROM curated")
def daily_batch(spark, sf_dir):
    """Raw bars appended, transformed and read back from the curated table."""
    root = scratch_path(spark, "batch")
    tables.append_version(raw_bars(spark, sf_dir), f"{root}/raw")
    batch.run_transform(spark, f"{root}/raw", f"{root}/curated", metrics_path=f"{root}/metrics")
    return tidy(tables.read_table(spark, f"{root}/curated").rows)


@query(f"WITH {CURATED} SELECT {OHLCV}, ingested_at_utc, {ROUNDED} FROM curated")
def incremental_indicators(spark, sf_dir):
    """Old days, then newer days, then late bars of any day: three increments equal one rebuild."""
    root = scratch_path(spark, "increments")
    rows = raw_bars(spark, sf_dir)
    late, old = F.col("Volume") % 10 == 0, F.col("Date") < "1997-01-01"
    for part in (~late & old, ~late & ~old, late):
        tables.append_version(rows.filter(part), f"{root}/raw")
        batch.run_increment(spark, f"{root}/raw", f"{root}/curated")
    return tidy(buckets.read(spark, f"{root}/curated"))


@query(f"""WITH {RAW_BARS} SELECT "Date"[1:4] AS run_id, count(*) AS rows_in,
  count(DISTINCT ("Ticker", "Date")) AS rows_out, count(*) AS upstream_rows_ingested FROM raw_bars GROUP BY 1""")
def batch_reconcile(spark, sf_dir):
    """One ingest and one transform run per year of bars."""
    raw = raw_bars(spark, sf_dir).withColumn("run_id", F.substring("Date", 1, 4))
    ingest = raw.groupBy("run_id").agg(F.count(F.lit(1)).alias("rows_ingested"))
    per_bar = raw.groupBy("run_id", "Ticker", "Date").agg(F.count(F.lit(1)).alias("n"))
    transform = per_bar.groupBy("run_id").agg(F.sum("n").alias("rows_in"), F.count(F.lit(1)).alias("rows_out"))
    return lookups.reconcile(ingest, transform)


@query("""SELECT 'q' || item_id AS id, text AS question, 'd' || item_id || '.md' AS expected FROM benchmark""")
def read_eval_set(spark, sf_dir):
    path = scratch_path(spark, "questions")
    questions = table(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("q"), F.col("item_id").cast("string")).alias("id"),
        F.col("text").alias("question"),
        F.concat(F.lit("d"), F.col("item_id").cast("string"), F.lit(".md")).alias("expected"),
    )
    questions.write.json(path)
    return evalset.read_eval_set(spark, path)
