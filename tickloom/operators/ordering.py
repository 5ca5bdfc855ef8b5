"""Ordered work that stays whole when one key holds much of the data.

A window with ``PARTITION BY key`` sends every row of a key to one task. The
helpers here keep the exact result without that:

* ``latest_n`` / ``first_n`` rank inside salted sub-groups first, so only N rows
  per sub-group meet in the final rank;
* ``over_history`` cuts each key into blocks of rows, each block carrying the few
  rows before it that a bounded frame can see;
* ``upper_median`` narrows a range around the middle by counting.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickloom.session import materialise

SALTS = 256
BLOCK_ROWS = 500_000
#: Steps of the quantile grid and accuracy of the sketch behind it.
GRID = 512
SKETCH = 20_000
FOLD_ROWS = 4096


def _ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """Rows ranked 1..n per key as ``_rank``, in two steps so that no key meets whole in one task."""
    salted = df.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    partial = Window.partitionBy(*keys, "_salt").orderBy(*order)
    final = Window.partitionBy(*keys).orderBy(*order)
    return (
        salted.withColumn("_rank", F.row_number().over(partial))
        .filter(F.col("_rank") <= n)
        .drop("_salt")
        .withColumn("_rank", F.row_number().over(final))
        .filter(F.col("_rank") <= n)
    )


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str) -> DataFrame:
    """The first ``n`` rows per key in the given order, with their 1-based rank."""
    return _ranked(df, keys, order, n).withColumnRenamed("_rank", rank)


def latest_n(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, presort: bool = True
) -> DataFrame:
    """The last ``n`` rows per key; oldest first when ``presort``. Nulls count as latest."""
    newest = [F.col(c).desc_nulls_first() for c in order]
    kept = _ranked(df, keys, newest, n)
    if presort:
        kept = kept.orderBy(*keys, F.col("_rank").desc())
    return kept.drop("_rank")


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The leading row per key. Only a map task's own leader per key is shuffled."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def _all_columns(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> list[str]:
    return [*order, *[c for c in df.columns if c not in keys and c not in order]]


def first_row(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row per key by ``order``, then by the remaining columns."""
    return _one_per_key(df, keys, [F.col(c).asc() for c in _all_columns(df, keys, order)])


def newest_row(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key by ``order``, then by the remaining columns."""
    return _one_per_key(df, keys, [F.col(c).desc() for c in _all_columns(df, keys, order)])


def join_by_key(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys match each other; the right side's key columns are dropped."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    on = F.lit(True)
    for key in keys:
        on = on & F.col(key).eqNullSafe(F.col(f"_right_{key}"))
    return left.join(renamed, on, how).drop(*[f"_right_{k}" for k in keys])


def number_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], weight: str | None = None
) -> DataFrame:
    """Add ``_pos``: how many rows of the same key come before this one.

    The rows are range-partitioned over (key, order), so a big key spans many
    tasks; the size of each partition's share of a key then gives the offsets.
    With ``weight`` the position counts that column instead of rows.
    """
    by = [F.col(c) for c in (*keys, *order)]
    ranged = df.repartitionByRange(*by).sortWithinPartitions(*by)
    saved = materialise(
        ranged.withColumns({"_pid": F.spark_partition_id(), "_seq": F.monotonically_increasing_id()}),
        "numbered",
    )
    share = F.count(F.lit(1)) if weight is None else F.sum(weight)
    spans = saved.groupBy(*keys, "_pid").agg(share.alias("_n"), F.min("_seq").alias("_first"))
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = spans.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    if weight is None:
        local = F.col("_seq") - F.col("_first")
        rows = saved
    else:
        running = (
            Window.partitionBy(*keys, "_pid").orderBy("_seq").rowsBetween(Window.unboundedPreceding, -1)
        )
        rows = saved.withColumn("_local", F.coalesce(F.sum(weight).over(running), F.lit(0)))
        local = F.col("_local")
    joined = join_by_key(rows, offsets, [*keys, "_pid"], "left")
    return joined.withColumn("_pos", F.col("_base") + local).drop(
        "_pid", "_seq", "_first", "_base", "_local"
    )


def over_history(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    lookback: int,
    compute: Callable[[DataFrame, WindowSpec], DataFrame],
    bounded: bool = False,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Apply ``compute(df, window)`` whose frames reach at most ``lookback`` rows back.

    A key of more than ``block_rows`` is cut into blocks of that many by exact position;
    the last ``lookback`` rows of a block are also sent to the next one, and dropped
    after ``compute``. Any other key is one block already, so its rows are shuffled
    just once, to a window per key. With ``bounded`` the caller vouches that a key has few
    rows by its nature (one per ticker and day, say), and they are not counted.
    """
    whole = Window.partitionBy(*keys).orderBy(*order)
    if bounded:
        return compute(df, whole)
    block_rows = max(block_rows, lookback + 1)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > block_rows)
    hot = materialise(sizes.select(*keys, F.lit(True).alias("_hot")), "hot_keys")
    if hot.isEmpty():
        return compute(df, whole)
    marked = join_by_key(df, hot, keys, "left")
    few = compute(marked.filter(F.col("_hot").isNull()).drop("_hot"), whole)
    many = marked.filter("_hot").drop("_hot")
    return few.unionByName(_in_blocks(many, keys, order, lookback, compute, block_rows))


def _in_blocks(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    lookback: int,
    compute: Callable[[DataFrame, WindowSpec], DataFrame],
    block_rows: int,
) -> DataFrame:
    """``over_history`` of keys of more than a block."""
    numbered = number_rows(df, keys, order)
    block = F.floor(F.col("_pos") / block_rows)
    own = F.struct(block.alias("block"), F.lit(False).alias("carried"))
    carried = F.struct((block + 1).alias("block"), F.lit(True).alias("carried"))
    tail = F.pmod(F.col("_pos"), F.lit(block_rows)) >= block_rows - lookback
    blocks = (
        numbered.withColumn("_in", F.explode(F.when(tail, F.array(own, carried)).otherwise(F.array(own))))
        .withColumns({"_block": F.col("_in.block"), "_carried": F.col("_in.carried")})
        .drop("_in")
    )
    window = Window.partitionBy(*keys, "_block").orderBy("_pos")
    done = compute(blocks, window).filter(~F.col("_carried"))
    return done.drop("_pos", "_block", "_carried")


def count_before(df: DataFrame, keys: Sequence[str], order: str, weight: str) -> DataFrame:
    """Add ``_pos``: the sum of ``weight`` over the earlier rows of the key, by range partitions."""
    return number_rows(df, keys, [order], weight=weight)


def upper_median(df: DataFrame, value: str, keys: Sequence[str] = (), fold_rows: int = FOLD_ROWS) -> DataFrame:
    """The value at index n // 2 of the sorted values, per key (or overall), as ``upper_median``.

    Selection by narrowing ranges: a sketch of quantiles per key names two values that
    surely enclose the middle. A pass counts the rows below, at and between them; the
    middle is one of the two, or strictly between, where at most a few grid steps of the
    rows are left, which the same pass sketched again. At ``fold_rows`` rows the rest is
    counted by value. Hash aggregates throughout; no key is sorted or brought together.
    """
    rows = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_value"))
    shares = F.array(*(F.lit(i / GRID) for i in range(GRID + 1)))

    def grid(values: Column) -> Column:
        return F.percentile_approx(values, shares, SKETCH).alias("_grid")

    def narrowed(found: DataFrame, place: Column) -> DataFrame:
        """The grid values two steps around the middle; the sketch errs by a small part of a step."""
        at = place / F.col("_inside") * GRID
        low = F.greatest(F.floor(at).cast("int") - 2, F.lit(0))
        high = F.least(F.ceil(at).cast("int") + 2, F.lit(GRID))
        return found.select(*keys, "_rank", F.get("_grid", low).alias("_low"), F.get("_grid", high).alias("_high"))

    def beside(state: DataFrame) -> DataFrame:
        if keys:
            return join_by_key(rows, state, keys)
        only = state.first()
        cells = {f.name: F.lit(only[f.name] if only else None).cast(f.dataType) for f in state.schema}
        return rows.withColumns(cells).filter(F.lit(only is not None))

    v, low, high, rank = (F.col(c) for c in ("_value", "_low", "_high", "_rank"))
    between = (v > low) & (v < high)
    start = F.col("_below") + F.col("_at_low")
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_inside"), grid(v)).filter("_inside > 0")
    state = narrowed(sizes.withColumn("_rank", F.floor(F.col("_inside") / 2)), rank)
    settled = []
    while True:
        counted = beside(materialise(state, "middle")).groupBy(*keys, "_rank", "_low", "_high").agg(
            F.count_if(v < low).alias("_below"),
            F.count_if(v == low).alias("_at_low"),
            F.count_if(between).alias("_inside"),
            grid(F.when(between, v)),
        )
        counted = materialise(counted, "counted")
        ends = F.when(rank < start, low).when(rank >= start + F.col("_inside"), high)
        settled.append(counted.select(*keys, ends.alias("upper_median")).filter("upper_median IS NOT NULL"))
        left = counted.filter(ends.isNull())
        if (left.agg(F.max("_inside").alias("n")).first()["n"] or 0) <= fold_rows:
            break
        state = narrowed(left, rank - start)
    place = left.select(*keys, (rank - start).alias("_rank"), "_low", "_high")
    values = beside(place).filter(between).groupBy(*keys, "_rank", "_value").agg(F.count(F.lit(1)).alias("_count"))
    folded = values.groupBy(*keys, "_rank").agg(F.sort_array(F.collect_list(F.struct("_value", "_count"))).alias("_all"))
    # The first value whose running count passes the rank.
    kind = rows.schema["_value"].dataType
    hit = F.aggregate(
        "_all",
        F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast(kind).alias("value")),
        lambda acc, x: F.struct(
            (acc["seen"] + x["_count"]).alias("seen"),
            F.when(acc["seen"] <= F.col("_rank"), x["_value"]).otherwise(acc["value"]).alias("value"),
        ),
        lambda acc: acc["value"],
    )
    return reduce(DataFrame.unionByName, settled, folded.select(*keys, hit.alias("upper_median")))
