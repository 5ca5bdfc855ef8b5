"""What the operators share: tables, words, shared files and small Arrow loops."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.session import materialise, scratch_path

#: Characters between words. bytes.split() without arguments splits on just these.
BLANK = r"\x20\x09-\x0D"
BLANK_CHARS = "' \\t\\n\\u000B\\u000C\\r'"
U64 = np.uint64
#: Rows of a batch that are turned into Python objects at a time.
SLICE = 256
#: Bits of the map that keeps rows without a partner out of a shuffle (8 MB).
FILTER_BITS = 1 << 26
#: Characters of text that are split into words at a time.
BATCH_CHARS = 2 << 20

__all__ = ["materialise", "scratch_path"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Words of a text as a long; null has none."""
    bare = F.trim(F.coalesce(text, F.lit("")), F.expr(BLANK_CHARS))
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, f"[{BLANK}]+"))).cast("long")


def rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Rows as tuples, a slice at a time, so that long texts are not all Python objects at once."""
    for at in range(0, batch.num_rows, SLICE):
        part = batch.slice(at, SLICE)
        yield from zip(*(c.to_pylist() for c in part.columns), strict=True)


def arrow_map(
    df: DataFrame, fn: Callable[[Iterator[tuple]], Iterable[tuple]], schema: str, rows: int = 1024
) -> DataFrame:
    """Run ``fn`` over the row tuples of each partition; it yields tuples of ``schema``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    def run(batches):
        out_schema = to_arrow_schema(struct)
        held = []
        for row in fn(row for b in batches for row in rows_of(b)):
            held.append(row)
            if len(held) >= rows:
                yield to_batch(held, out_schema)
                held = []
        if held:
            yield to_batch(held, out_schema)

    struct = _parse_datatype_string(schema)
    return df.mapInArrow(run, struct)


def likely(rows: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """``rows`` whose ``key`` is in the one column of ``ids``, and a few others.

    A map of ``FILTER_BITS`` bits, one per hash value, goes to all tasks, so that rows
    ahead of an exact join need not be shuffled to find out that they have no partner.
    Its size is fixed. With more ids than bits it lets more rows through; it never
    loses one, so the join after it gives the same rows. Null keys are in no ``ids``.
    """
    slot = f"pmod(xxhash64(cast({{}} AS BIGINT)), {FILTER_BITS}L)"
    words = (
        ids.select(F.expr(slot.format(f"`{ids.columns[0]}`")).alias("slot"))
        .groupBy(F.shiftright("slot", 6).alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 AS INT)))").alias("bits"))
        .toArrow()
    )
    bits = np.zeros(FILTER_BITS // 64, dtype=U64)
    bits[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(U64)
    shared = rows.sparkSession.sparkContext.broadcast(bits)

    def kept(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in found:
            slots = batch.column(batch.num_columns - 1).to_numpy().astype(U64)
            hit = (held[slots >> U64(6)] >> (slots & U64(63))) & U64(1)
            part = batch.filter(pa.array(hit.astype(bool))).select(range(batch.num_columns - 1))
            if part.num_rows:
                yield part

    placed = rows.where(F.col(key).isNotNull()).withColumn("_slot", F.expr(slot.format(f"`{key}`")))
    return placed.mapInArrow(kept, rows.schema)


def to_batch(held: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*held, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type, from_pandas=False) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound on the words held."""

    HELD = 1 << 18

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.HELD:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=U64, count=len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a finaliser of xor-shifts and odd multipliers)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def run_hashes(words: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """64-bit hashes of all runs of ``size`` consecutive word hashes, in O(words).

    Doubling: hashes of runs of 1, 2, 4, ... words are joined to the wanted size.
    """
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, dtype=U64)
    done, out, level, width = 0, None, mixed(words + U64(seed)), 1
    while True:
        if size & width:
            part = level[done : done + n]
            out = part if out is None else mixed(out * U64(0x9E3779B97F4A7C15) + part)
            done += width
        if done == size:
            return out
        level = mixed(level[:-width] * U64(0xD6E8FEB86659FD93) + level[width:])
        width *= 2


def batches(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Rows (any, text) in groups of about ``BATCH_CHARS`` characters, a longer text alone."""
    group, size = [], 0
    for row in rows:
        n = len(row[1] or "")
        if group and size + n > BATCH_CHARS:
            yield group
            group, size = [], 0
        group.append(row)
        size += n
    if group:
        yield group


def clear_of(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns that an operator is about to add under the same names."""
    lower = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in lower])
