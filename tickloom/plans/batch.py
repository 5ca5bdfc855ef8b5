"""The daily batch: landed bars to the raw table, raw bars to the curated table."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import times as TM
from tickloom.operators import indicators as I
from tickloom.operators import summaries
from tickloom.operators.monitor import record_metrics
from tickloom.sources import buckets, landing, tables


def run_ingest(
    frames: Sequence[DataFrame],
    portfolio: DataFrame,
    raw_path: str,
    run_id: str | None = None,
    metrics_path: str | None = None,
) -> dict:
    """Append one batch of tidy bars as a new version; an empty batch is an error."""
    started = time.perf_counter()
    spark = portfolio.sparkSession
    batch = landing.ingest_batch(frames, TM.iso_now())
    version = tables.append_version(batch, raw_path)
    if version is None:
        raise RuntimeError("ingest produced no rows for any ticker; nothing was appended")
    landed = tables.read_table(spark, raw_path, keep_version=True).rows
    landed = landed.filter(landed[tables.VERSION] == version)
    summary = summaries.ingest_summary(portfolio, landed).first().asDict()
    run = {
        "run_id": run_id or uuid.uuid4().hex,
        **summary,
        "duration_seconds": round(time.perf_counter() - started, 2),
        "table_path": raw_path,
        "table_version": version,
    }
    record_metrics(spark, metrics_path, "batch_ingest", run)
    return run


def run_transform(
    spark: SparkSession,
    raw_path: str,
    curated_path: str,
    run_id: str | None = None,
    dedupe: bool = True,
    metrics_path: str | None = None,
) -> dict:
    """Replace the curated table by the indicators over the raw table; an empty raw table is an error."""
    started = time.perf_counter()
    head = tables.read_head(spark, raw_path)
    if head.rows == 0:
        raise RuntimeError(f"raw table {raw_path} is empty; nothing to transform")
    raw = tables.read_table(spark, raw_path, head.version).rows
    curated = I.ranged_indicators(raw) if dedupe else I.clustered(I.indicators(raw, dedupe=False))
    version = tables.overwrite_version(curated, curated_path)
    run = {
        "run_id": run_id or uuid.uuid4().hex,
        "rows_in": head.rows,
        "rows_out": tables.read_head(spark, curated_path).rows,
        "duration_seconds": round(time.perf_counter() - started, 2),
        "table_path": curated_path,
        "table_version": version,
    }
    record_metrics(spark, metrics_path, "batch_transform", run)
    return run


def run_increment(
    spark: SparkSession, raw_path: str, curated_path: str, run_id: str | None = None, metrics_path: str | None = None
) -> dict:
    """Bring a curated table in ticker buckets up to the raw table, from the versions that came since.

    Only these versions are read. Of a ticker with new bars, the rows from its first new
    day on are computed again, after the bars before that day, which the curated table
    holds; only the buckets of such tickers are stored. Bars are shuffled once, to the task
    that computes and stores their ticker. The first run, and one after the
    raw table was replaced, computes everything. Same rows as ``run_transform`` with ``dedupe``.
    """
    started = time.perf_counter()
    head = tables.read_head(spark, raw_path)
    if head.rows == 0:
        raise RuntimeError(f"raw table {raw_path} is empty; nothing to transform")
    notes = {"raw_version": str(head.version)}
    done = buckets.find_state(spark, curated_path)
    since = int(done.notes["raw_version"]) if done else None
    rows_in = 0
    if done is None or head.base > since:
        raw = tables.read_table(spark, raw_path, head.version).rows
        placed = buckets.place(raw, curated_path, "Ticker", whole_keys=True)
        buckets.publish(I.brought_up(placed, buckets.PLACE), curated_path, "Ticker", notes=notes)
        rows_in = head.rows
    elif head.version > since:
        raw = tables.read_table(spark, raw_path, head.version, keep_version=True).rows
        fresh = raw.filter(F.col(tables.VERSION) > since).drop(tables.VERSION)
        rows_in = tables.new_rows(spark, raw_path, since)
        hit = buckets.touched(fresh, done)
        both = I.beside_stored(fresh, buckets.read(spark, curated_path, hit))
        placed = buckets.place(both, curated_path, "Ticker", whole_keys=True)
        buckets.replace(I.brought_up(placed, buckets.PLACE), curated_path, hit, notes)
    state = buckets.read_state(spark, curated_path)
    run = {
        "run_id": run_id or uuid.uuid4().hex,
        "rows_in": rows_in,
        "rows_out": state.rows,
        "duration_seconds": round(time.perf_counter() - started, 2),
        "table_path": curated_path,
        "table_version": state.version,
    }
    record_metrics(spark, metrics_path, "batch_increment", run)
    return run


def daily_run(
    frames: Sequence[DataFrame],
    portfolio: DataFrame,
    raw_path: str,
    curated_path: str,
    metrics_path: str | None = None,
) -> dict:
    """Ingest, then transform, with the rows ingested beside the rows transformed."""
    ingest = run_ingest(frames, portfolio, raw_path, metrics_path=metrics_path)
    spark = portfolio.sparkSession
    done = run_transform(spark, raw_path, curated_path, ingest["run_id"], metrics_path=metrics_path)
    return {**done, "upstream_rows_ingested": ingest["rows_ingested"]}
