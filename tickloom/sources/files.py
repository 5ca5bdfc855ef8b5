"""Small text files, one folder per key, written by the tasks that hold the keys and read whole by tasks."""

from __future__ import annotations

import os
import re
import uuid
import zlib
from urllib.parse import quote

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What Spark's own writers put in the name of a folder for a null key, and the characters they escape there.
NO_KEY = "__HIVE_DEFAULT_PARTITION__"
#: Characters below 128 that stay as they are in the ``file_path`` Spark tells of a file.
PLAIN = "/,;:$&+=@_-!.~'()*"
#: Tasks per core that share the files of a listing, and bytes of files that a task holds at a time.
SHARES = 4
HELD_BYTES = 16 * 1024 * 1024
ESCAPES = {c: f"%{c:02X}" for c in (*range(1, 32), *b"\"#%'*/:=?\\{[]^", 127)}


def local_path(spark: SparkSession, path: str) -> str | None:
    """The path of a folder on a mounted disk that all executors share; None for any other store."""
    named = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = named.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.makeQualified(named).toUri().getPath() if files.getUri().getScheme() == "file" else None


def folder_name(key: str, value: str | None) -> str:
    return f"{key}={value.translate(ESCAPES) if value else NO_KEY}"


def write_lines(rows: DataFrame, path: str, key: str, line: Column, suffix: str, header: str = "") -> None:
    """A file per ``key=...`` folder and partition: ``header``, then ``line`` of every row, in the order of ``rows``.

    For folders on a mounted disk (``local_path``), where Hadoop's client starts a process
    per file to set its mode; elsewhere Spark's own writers do. ``rows`` must be sorted by
    ``key`` within partitions. ``path`` appears, in place of what it held, when all its
    files are there; a task that runs again replaces its files.
    """
    spark = rows.sparkSession
    files = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    target, staged = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}.writing-{uuid.uuid4().hex}"))
    files.mkdirs(staged)
    top = local_path(spark, staged.toString())

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        task = TaskContext.get()
        name, own = f"part-{task.partitionId():05d}{suffix}", f".{task.taskAttemptId()}"
        folder = out = None
        made = 0

        def close():
            out.close()
            os.replace(f"{folder}/{own}", f"{folder}/{name}")

        for batch in batches:
            if not batch.num_rows:
                continue
            keys, data = batch.column(0), batch.column(1).cast(pa.binary()).cast(pa.large_binary())
            runs = pc.run_end_encode(keys)
            ends, places = runs.run_ends.to_pylist(), data.buffers()[1]
            at = memoryview(places).cast("q")[data.offset : data.offset + len(data) + 1]
            letters, begin = memoryview(data.buffers()[2] or b""), 0
            for value, end in zip(runs.values.to_pylist(), ends, strict=True):
                here = f"{top}/{folder_name(key, value)}"
                if here != folder:
                    if out is not None:
                        close()
                    folder = here
                    os.makedirs(folder, exist_ok=True)
                    out = open(f"{folder}/{own}", "wb")
                    out.write(header.encode())
                    made += 1
                out.write(letters[at[begin] : at[end]])
                begin = end
        if out is not None:
            close()
        yield pa.RecordBatch.from_pydict({"files": [made]})

    ended = F.concat(F.coalesce(line, F.lit("")), F.lit("\n"))
    rows.select(F.col(key).cast("string"), ended.alias("line")).mapInArrow(run, "files long").agg(F.sum("files")).collect()
    files.delete(target, True)
    if not files.rename(staged, target):
        raise OSError(f"{staged} could not be renamed to {target}")


def _hidden(name: str) -> bool:
    """Whether Spark's readers pass over a file of this name."""
    return name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)


def _listed(top: str, below: bool, share: int, shares: int, suffix: str):
    """The paths of a share of the files of a folder, or (``below``) of all folders in it."""
    with os.scandir(top) as entries:
        for entry in entries:
            if zlib.crc32(os.fsencode(entry.name)) % shares != share:
                continue
            if below and entry.is_dir():
                with os.scandir(entry.path) as inner:
                    yield from (e.path for e in inner if e.name.endswith(suffix) and not _hidden(e.name) and e.is_file())
            elif entry.name.endswith(suffix) and not _hidden(entry.name) and entry.is_file():
                yield entry.path


def read_whole(spark: SparkSession, path: str, glob: str) -> DataFrame | None:
    """(value, _metadata) of the files of a folder, or of all folders in it (``folder/*``), like Spark's own reader.

    For folders on a mounted disk, where Hadoop's client takes milliseconds to list and open
    each small file: every task reads the names in the folder and opens its share of them, so
    no list of files passes through the driver. None for other stores and patterns.
    """
    top, below = (path[:-2], True) if path.endswith("/*") else (path, False)
    if re.search(r"[\[\]{}*?\\]", top) or not re.fullmatch(r"\*\.(txt|md)", glob):
        return None
    folder, suffix = local_path(spark, top), glob[1:]
    if not folder or not os.path.isdir(folder):
        return None
    if not below:
        with os.scandir(folder) as entries:
            if any("=" in e.name and e.is_dir() for e in entries):  # a partitioned table, not a folder of files
                return None
    shares = SHARES * spark.sparkContext.defaultParallelism

    def run(batches):
        import pyarrow as pa

        def batch():
            paths = ["file:" + "".join(c if ord(c) > 127 else quote(c, PLAIN) for c in p) for p in kept]
            names = [p.rpartition("/")[2] for p in paths]
            named = pa.StructArray.from_arrays([pa.array(paths), pa.array(names)], names=["file_path", "file_name"])
            return pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()), named], names=["value", "_metadata"])

        for share in (i for b in batches for i in b.column(0).to_pylist()):
            kept, texts, held = [], [], 0
            for name in _listed(folder, below, share, shares, suffix):
                with open(name, "rb") as file:
                    text = file.read()
                if not text:  # Spark's reader gives no row for an empty file
                    continue
                texts.append(text)
                kept.append(name)
                held += len(text)
                if held > HELD_BYTES:
                    yield batch()
                    kept, texts, held = [], [], 0
            if kept:
                yield batch()

    found = spark.range(0, shares, 1, shares).mapInArrow(run, "value binary, _metadata struct<file_path:string,file_name:string>")
    return found.withColumn("value", F.col("value").cast("string"))
