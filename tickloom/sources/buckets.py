"""Parquet tables in hash buckets of a key: a write stores anew only the buckets that change.

Layout under a table's path: ``data/_version=n/_bucket=b`` holds bucket ``b`` as write
``n`` left it, and a folder below ``commits`` one row, written last, that names the
write which holds each bucket now. So a version is published whole or not at all, and
a bucket that a write does not touch keeps its files. One writer per table. The number
of buckets is set by the first write; choose it so that a bucket is some hundred MB.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators.lookups import not_in
from tickloom.session import materialise
from tickloom.sources.tables import TableUnavailable, numbered_folders

COMMITS = (
    "version long, committed_at timestamp, key string, count int, live map<int,bigint>, sizes map<int,bigint>, "
    "prints map<int,string>, schema string, notes map<string,string>"
)
BUCKET = "_bucket"
SLICE = "_slice"
PLACE = [BUCKET, SLICE]
VERSION = "_version"
BUCKETS = 32
#: Tasks that write a bucket, so that one key of many rows is not one task.
SLICES = 4


@dataclass(frozen=True)
class State:
    """The newest version: which write holds each bucket, rows and checksum by bucket, and the writer's notes."""

    version: int
    key: str
    count: int
    live: dict[int, int]
    sizes: dict[int, int]
    prints: dict[int, str]
    schema: T.StructType
    notes: dict[str, str] = field(default_factory=dict)

    @property
    def rows(self) -> int:
        return sum(self.sizes.values())


@dataclass(frozen=True)
class Written:
    """The version a write made, the buckets it stored and those that kept their files."""

    version: int
    stored: int
    kept: int


def bucket_of(key: str, count: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(count)).cast("int")


def find_state(spark: SparkSession, path: str) -> State | None:
    for _, folder in numbered_folders(spark, f"{path}/commits", "commit="):
        row = spark.read.schema(COMMITS).parquet(folder).first()
        if row is not None:
            return State(
                row["version"], row["key"], row["count"], dict(row["live"] or {}), dict(row["sizes"] or {}),
                dict(row["prints"] or {}), T.StructType.fromJson(json.loads(row["schema"])), dict(row["notes"] or {}),
            )
    return None


def read_state(spark: SparkSession, path: str) -> State:
    state = find_state(spark, path)
    if state is None:
        raise TableUnavailable(f"table {path} is not available yet: nothing was written to it")
    return state


def read(spark: SparkSession, path: str, only: Sequence[int] | None = None) -> DataFrame:
    """The rows of the newest version, or of some of its buckets; other folders are not opened."""
    state = read_state(spark, path)
    folders = [
        f"{path}/data/{VERSION}={v}/{BUCKET}={b}" for b, v in sorted(state.live.items()) if only is None or b in only
    ]
    if not folders:
        return spark.createDataFrame([], state.schema)
    parts = [T.StructField(VERSION, T.LongType()), T.StructField(BUCKET, T.IntegerType())]
    stored = T.StructType([*state.schema.fields, *parts])
    return spark.read.schema(stored).option("basePath", f"{path}/data").parquet(*folders).drop(VERSION, BUCKET)


def _as_map(values: dict, kind: str) -> Column:
    pairs = F.create_map(*(F.lit(x) for pair in values.items() for x in pair)) if values else F.lit(None)
    return pairs.cast(kind)


def _checked(rows: DataFrame) -> dict[int, tuple[int, str]]:
    """Rows and checksum of every bucket; the checksum does not depend on the order of rows."""
    cells = [
        F.array_sort(F.map_entries(f.name)) if isinstance(f.dataType, T.MapType) else F.col(f.name)
        for f in rows.schema
        if f.name != BUCKET
    ]
    sums = rows.groupBy(BUCKET).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*cells).cast("decimal(38,0)")).cast("string").alias("print")
    )
    return {r[BUCKET]: (r["n"], r["print"]) for r in sums.collect()}


def _slice(columns: Sequence[str]) -> Column:
    """A number below ``SLICES``; other bits of the hash than the bucket's, so that both may come from one key."""
    return F.pmod(F.shiftright(F.xxhash64(*columns), 24), F.lit(SLICES)).cast("int")


def _removed(spark: SparkSession, folder: str) -> None:
    named = spark._jvm.org.apache.hadoop.fs.Path(folder)
    named.getFileSystem(spark._jsc.hadoopConfiguration()).delete(named, True)


def place(df: DataFrame, path: str, key: str, count: int = BUCKETS, whole_keys: bool = False) -> DataFrame:
    """``df`` with the bucket of every row, dealt so that a task holds all of few slices of buckets.

    Row-local work between this and the write is not shuffled again. With ``whole_keys`` a key
    lies in one task, and windows over ``PLACE`` and the key stay there.
    """
    old = find_state(df.sparkSession, path)
    return _dealt(df.withColumn(BUCKET, bucket_of(key, old.count if old else count)), old.count if old else count, key if whole_keys else None)


def _dealt(rows: DataFrame, count: int, key: str | None = None) -> DataFrame:
    short = [f.name for f in rows.schema if not isinstance(f.dataType, (T.MapType, T.ArrayType, T.UserDefinedType)) and f.name != BUCKET]
    sliced = rows.withColumn(SLICE, _slice([key] if key else short))
    dealt = sliced.repartition(count * SLICES, *PLACE)
    return dealt if key else dealt.sortWithinPartitions(BUCKET)


def _store(rows: DataFrame, path: str, old: State | None, key: str, count: int, replaced: set[int] | None, notes) -> Written:
    """Publish ``rows`` (with ``PLACE``) as all there is in the ``replaced`` buckets (None: in all).

    The rows go where they will stay. What was written is then read for its checksums,
    and the buckets that turn out the same as before are dropped again.
    """
    spark = rows.sparkSession
    rows = rows.drop(SLICE)
    number = old.version + 1 if old else 0
    folder = f"{path}/data/{VERSION}={number}"
    schema = T.StructType([f for f in rows.schema.fields if f.name != BUCKET])
    replaced = set(range(count)) if replaced is None else replaced
    other = bool(old) and {f.name: f.dataType for f in old.schema} != {f.name: f.dataType for f in schema}
    if other and replaced != set(range(count)):
        raise ValueError("rows to store differ from the table in their columns")
    rows.write.mode("overwrite").option("compression", "zstd").partitionBy(BUCKET).parquet(folder)
    found = _checked(spark.read.schema(T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(folder))
    before = old.prints if old else {}
    changed = {b for b, (n, seal) in found.items() if other or before.get(b) != f"{n}:{seal}"}
    gone = {b for b in replaced if b not in found and b in before}
    for same in sorted(found.keys() - changed):
        _removed(spark, f"{folder}/{BUCKET}={same}")
    live = {b: v for b, v in (old.live if old else {}).items() if b not in gone} | dict.fromkeys(changed, number)
    sizes = {b: n for b, n in (old.sizes if old else {}).items() if b not in gone} | {b: n for b, (n, _) in found.items()}
    prints = {b: p for b, p in before.items() if b not in gone} | {b: f"{n}:{p}" for b, (n, p) in found.items()}
    commit = {
        "version": F.lit(number),
        "committed_at": F.lit(datetime.now(timezone.utc)),
        "key": F.lit(key),
        "count": F.lit(count),
        "live": _as_map(live, "map<int,bigint>"),
        "sizes": _as_map(sizes, "map<int,bigint>"),
        "prints": _as_map(prints, "map<int,string>"),
        "schema": F.lit(schema.json()),
        "notes": _as_map({**(old.notes if old else {}), **(notes or {})}, "map<string,string>"),
    }
    one = spark.range(0, 1, 1, 1).select(*(commit[f.name].cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(COMMITS)))
    one.write.mode("errorifexists").parquet(f"{path}/commits/commit={number}-{uuid.uuid4().hex[:12]}")
    return Written(number, len(changed), len(live) - len(changed))


def publish(df: DataFrame, path: str, key: str, count: int = BUCKETS, notes: dict[str, str] | None = None) -> Written:
    """Make ``df``, which ``place`` may have dealt, the table's rows; buckets whose rows are the same as before keep their files."""
    old = find_state(df.sparkSession, path)
    count = old.count if old else count
    rows = df if BUCKET in df.columns else _dealt(df.withColumn(BUCKET, bucket_of(key, count)), count)
    return _store(rows, path, old, key, count, None, notes)


def replace(
    df: DataFrame, path: str, buckets: Sequence[int], notes: dict[str, str] | None = None
) -> Written:
    """Make ``df``, which ``place`` may have dealt, the rows of ``buckets``; the other buckets are not read."""
    old = read_state(df.sparkSession, path)
    rows = df if BUCKET in df.columns else _dealt(df.withColumn(BUCKET, bucket_of(old.key, old.count)), old.count)
    return _store(rows, path, old, old.key, old.count, set(buckets), notes)


def touched(df: DataFrame, state: State) -> list[int]:
    """The buckets that keys of ``df`` fall into; at most as many as the table has."""
    return sorted(r[0] for r in df.select(bucket_of(state.key, state.count)).distinct().collect())


def upsert(df: DataFrame, path: str, key: str, count: int = BUCKETS, notes: dict[str, str] | None = None) -> Written:
    """Insert ``df`` or replace the rows of its keys, in the buckets these fall into."""
    spark = df.sparkSession
    old = find_state(spark, path)
    if old is None:
        return publish(df, path, key, count, notes)
    new = materialise(df, "upsert")
    buckets = touched(new, old)
    stored = read(spark, path, buckets)
    return replace(not_in(stored, new, key).unionByName(new), path, buckets, notes)
