"""Versioned Parquet tables: each write is one new version.

Layout under a table's path: ``data/_version=n`` holds the rows of write ``n``
and a folder of its own below ``commits`` one row that describes it, written last
and under a fresh name each time. A version without a readable commit row is
invisible and is replaced by the next write, so a job that dies at any point
leaves nothing behind that stops the next. One writer per table.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMMITS = (
    "version long, mode string, rows long, base long, total_rows long, committed_at timestamp, "
    "app string, batch_id long, schema string, facts map<string,double>, batches map<string,bigint>"
)
VERSION = "_version"


class TableUnavailable(RuntimeError):
    """The table has no committed version yet."""


@dataclass(frozen=True)
class Head:
    """The newest version: the oldest write still part of it, its rows and its schema."""

    version: int
    base: int
    rows: int
    schema: T.StructType


@dataclass(frozen=True)
class Snapshot:
    rows: DataFrame
    version: int


def commits(spark: SparkSession, path: str) -> DataFrame:
    """One row per committed write."""
    try:
        return spark.read.schema(COMMITS).parquet(f"{path}/commits")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        raise TableUnavailable(f"table {path} is not available yet: nothing was written to it") from missing


def numbered_folders(spark: SparkSession, folder: str, prefix: str) -> list[tuple[int, str]]:
    """(number, path) of the folders below ``folder`` named ``prefix`` and a number, newest first."""
    base = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = base.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(base):
        return []
    found = [str(f.getPath().toString()) for f in files.listStatus(base) if f.getPath().getName().startswith(prefix)]
    numbers = [(int(re.match(r"\d+", name.rsplit("/", 1)[1][len(prefix) :])[0]), name) for name in found]
    return sorted(numbers, reverse=True)


def _newest(spark: SparkSession, path: str, version: int | None = None) -> Row | None:
    """The commit row of the newest version, or of the newest up to ``version``.

    Folder names tell the versions, so one row is read, however long the log is.
    """
    for number, folder in numbered_folders(spark, f"{path}/commits", "commit="):
        if version is None or number <= version:
            row = spark.read.schema(COMMITS).parquet(folder).first()
            if row is not None:
                return row
    return None


def _read_back(spark: SparkSession, path: str, head: Head) -> DataFrame:
    """The rows of the live versions; folders that a replacing write left behind are not opened."""
    stored = T.StructType([*head.schema.fields, T.StructField(VERSION, T.LongType())])
    reader = spark.read.schema(stored).option("basePath", f"{path}/data")
    if head.base:
        live = [f for n, f in numbered_folders(spark, f"{path}/data", f"{VERSION}=") if head.base <= n <= head.version]
        data = reader.parquet(*live)
    else:
        data = reader.parquet(f"{path}/data")
    return data.filter((F.col(VERSION) >= head.base) & (F.col(VERSION) <= head.version))


def read_head(spark: SparkSession, path: str, version: int | None = None) -> Head:
    """The newest version, or the table as it was at ``version``."""
    last = _newest(spark, path, version)
    if last is None:
        raise TableUnavailable(
            f"table {path} is not available yet: nothing was written to it"
            if version is None
            else f"table {path} has no version at or before {version}"
        )
    schema = T.StructType.fromJson(json.loads(last["schema"]))
    return Head(last["version"], last["base"], last["total_rows"], schema)


def read_table(spark: SparkSession, path: str, version: int | None = None, keep_version: bool = False) -> Snapshot:
    """The rows of the newest (or given) version, and which version that is."""
    head = read_head(spark, path, version)
    rows = _read_back(spark, path, head)
    return Snapshot(rows if keep_version else rows.drop(VERSION), head.version)


def data_path(path: str, version: int) -> str:
    """Where the rows of one write lie."""
    return f"{path}/data/{VERSION}={version}"


def _same_columns(new: T.StructType, old: T.StructType) -> None:
    """Raise unless both have the same names and types, in any order."""
    mine, theirs = ({f.name: f.dataType.simpleString() for f in s.fields} for s in (new, old))
    if mine != theirs:
        differ = sorted(n for n in mine.keys() | theirs.keys() if mine.get(n) != theirs.get(n))
        raise ValueError(f"rows to append differ from the table in {', '.join(differ)}")


def _write(
    df: DataFrame, path: str, mode: str, app: str | None, batch_id: int | None, facts: dict[str, Column]
) -> int | None:
    spark = df.sparkSession
    last = _newest(spark, path)
    number, base, before, batches = 0, 0, 0, {}
    if last is not None:
        number, base, before, batches = last["version"] + 1, last["base"], last["total_rows"], dict(last["batches"] or {})
        if batch_id is not None and batch_id <= batches.get(app, -1):
            return None
        if mode == "append":
            _same_columns(df.schema, T.StructType.fromJson(json.loads(last["schema"])))
    if mode == "overwrite":
        base, before = number, 0
    if batch_id is not None:
        batches[app] = batch_id
    # The write's own pass counts the rows and takes the facts; nothing is read again.
    taken = Observation(f"write-{uuid.uuid4().hex}")
    measured = [F.count(F.lit(1)).alias("rows"), *(c.cast("double").alias(name) for name, c in facts.items())]
    df.observe(taken, *measured).write.mode("overwrite").option("compression", "zstd").parquet(data_path(path, number))
    found = dict(taken.get)
    rows = found.pop("rows")
    if rows == 0 and mode == "append":
        return None
    entry = {
        "version": number,
        "mode": mode,
        "rows": rows,
        "base": base,
        "total_rows": before + rows,
        "committed_at": datetime.now(timezone.utc),
        "app": app,
        "batch_id": batch_id,
        "schema": df.schema.json(),
        "facts": _as_map(found),
        "batches": _as_map(batches),
    }
    kinds = T.StructType.fromDDL(COMMITS)
    cells = [
        (v if isinstance(v, Column) else F.lit(v)).cast(k.dataType).alias(k.name)
        for k, v in ((k, entry[k.name]) for k in kinds)
    ]
    one = spark.range(0, 1, 1, 1).select(*cells)
    one.write.mode("errorifexists").parquet(f"{path}/commits/commit={number}-{uuid.uuid4().hex[:12]}")
    return number


def _as_map(values: dict) -> Column:
    return F.create_map(*(F.lit(x) for pair in values.items() for x in pair)) if values else F.lit(None)


def append_version(
    df: DataFrame,
    path: str,
    app: str | None = None,
    batch_id: int | None = None,
    facts: dict[str, Column] | None = None,
) -> int | None:
    """Append ``df`` as one version and return it; ``None`` when nothing was added.

    Nothing is added when ``df`` is empty, or when this ``app`` already
    committed ``batch_id`` or a later one (a replayed micro-batch). ``facts``
    are aggregates of the rows, taken by the write itself into the commit row.
    """
    return _write(df, path, "append", app, batch_id, facts or {})


def overwrite_version(df: DataFrame, path: str) -> int:
    """Replace the table's rows by ``df`` as one new version and return it."""
    return _write(df, path, "overwrite", None, None, {})


def new_rows(spark: SparkSession, path: str, baseline: int | None) -> int:
    """Rows that landed in versions after ``baseline``; refuses to run without one."""
    if baseline is None:
        raise ValueError("new_rows needs a baseline version; without one the count means nothing")
    later = commits(spark, path).filter((F.col("version") > baseline) & (F.col("mode") == "append"))
    return later.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).first()["rows"]
