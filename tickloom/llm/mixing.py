"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in shuffled order, served as often as
its target needs. A document's virtual finish time is the running total of its
source's words, itself included, divided by the source's target. All copies are
ranged and sorted by finish time and the mix is cut where the total budget ends,
so each source is left within about one document of its target.

Running totals never run over a whole source: its rows are cut into buckets by
the leading digits of the shuffle key, bucket totals are added up first, and a
window runs inside one bucket only. The number of digits follows the row count.

Defined cases: a null text has size 0 and is never taken; null sources form one
source, ordered last; null ids are shuffled like any other. Repeated rows are
queued one by one. An empty table gives an empty mix. Columns of the input that
share a name with a result column are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tickloom.llm.common import clear_of, materialise, word_count

WEIGHTS = (3, 1, 2)
BUDGET_SHARE = 1.5
MAX_REPEATS = 2
SEED = "mix"
#: Rows of one bucket, about; a window holds one bucket.
BUCKET_ROWS = 20_000


def source_targets(sized: DataFrame) -> DataFrame:
    """Per source: size, rows, weight and target.

    The budget is shared by weight; what a source cannot take beyond its repeats
    is shared among the others. Ordered by how early they fill up, the filled
    sources come first, so running sums over the sources give the level at once.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    weights = F.array(*map(F.lit, WEIGHTS))
    ranked = per.withColumn(
        "weight", F.get(weights, (F.row_number().over(by_name) - 1) % len(WEIGHTS))
    ).withColumn("cap", MAX_REPEATS * F.col("source_size"))
    filling = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    after = filling.rowsBetween(0, Window.unboundedFollowing)
    everywhere = filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (
        BUDGET_SHARE * F.sum("source_size").over(everywhere) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    ) / F.sum("weight").over(after)
    leveled = ranked.withColumn("_level", level)
    # Once a source is below its cap all later ones are, at the level of the first of them.
    free = F.col("_level") * F.col("weight") <= F.col("cap")
    first_free = F.min(F.when(free, F.struct((F.col("cap") / F.col("weight")).alias("at"), "_level"))).over(everywhere)
    return leveled.withColumn("_free", first_free["_level"]).select(
        "source",
        "source_size",
        "rows",
        "weight",
        F.when(F.col("_free").isNull(), F.col("cap").cast("double"))
        .otherwise(F.least(F.col("cap").cast("double"), F.col("_free") * F.col("weight")))
        .alias("target"),
    )


def shuffle_key(doc_id: Column) -> Column:
    return F.md5(F.concat(F.lit(SEED), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))


def queued(sized: DataFrame, targets: DataFrame, digits: int) -> DataFrame:
    """Rows with their source's figures and ``_before``, the words ahead of them in its queue."""
    keyed = sized.withColumn("_key", shuffle_key(F.col("doc_id"))).withColumn("_bucket", F.left("_key", F.lit(digits)))
    totals = keyed.groupBy("source", "_bucket").agg(F.sum("size").alias("_words"))
    ahead = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("source").alias("_s"), F.col("_bucket").alias("_b"), F.coalesce(F.sum("_words").over(ahead), F.lit(0)).alias("_offset")
    )
    per = targets.select(F.col("source").alias("_s2"), "source_size", "target")
    inside = Window.partitionBy("source", "_bucket").orderBy("_key", "size").rowsBetween(Window.unboundedPreceding, -1)
    return (
        keyed.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(offsets, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_b")))
        .join(per, F.col("source").eqNullSafe(F.col("_s2")))
        .withColumn("_before", F.col("_offset") + F.col("_inside"))
        .drop("_s", "_b", "_s2", "_offset", "_inside", "_bucket")
    )


def finish(turn: int) -> Column:
    """Virtual finish time of a document's copy in the given round through its queue."""
    words = F.lit(turn) * F.col("source_size") + F.col("_before") + F.col("size")
    return words / F.when(F.col("target") > 0, F.col("target"))


ORDER = ["f", "_key", "turn"]


def first_beyond(rows: DataFrame, budget: int) -> Row | None:
    """The first copy, by finish time, that no longer fits the budget; None if all fit.

    A global range sort; beyond it only one row per range partition and the running
    total of one partition are looked at.
    """
    copies = rows.where("size > 0 AND target > 0").select(
        "_key",
        "size",
        F.explode(
            F.array(*[F.struct(finish(t).alias("f"), F.lit(t).alias("turn")) for t in range(MAX_REPEATS)])
        ).alias("_c"),
    ).select("_c.f", "_key", "_c.turn", "size")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialise(
        copies.repartitionByRange(parts, *ORDER).sortWithinPartitions(*ORDER).withColumn("part", F.spark_partition_id()),
        "finish-times",
    )
    totals = ranged.groupBy("part").agg(F.sum("size").alias("words"))
    through = totals.withColumn("through", F.sum("words").over(Window.orderBy("part")))
    crossing = through.where(F.col("through") > budget).orderBy("part").first()
    if crossing is None:
        return None
    running = ranged.where(F.col("part") == crossing.part).withColumn(
        "sum", F.sum("size").over(Window.orderBy(*ORDER)) + F.lit(crossing.through - crossing.words)
    )
    return running.where(F.col("sum") > budget).orderBy(*ORDER).first()


def mix(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with size, source_size, target, taken (words) and copies (0 to 2)."""
    plain = clear_of(docs, "size", "source_size", "target", "taken", "copies")
    sized = materialise(plain.withColumn("size", word_count(F.col(text))), "sized")
    return schedule(sized)


def schedule(sized: DataFrame) -> DataFrame:
    """As ``mix`` for rows that carry their ``size`` already and can be read repeatedly."""
    narrow = sized.select("doc_id", "source", "size")
    targets = materialise(source_targets(narrow), "targets")
    rows, budget = targets.agg(F.sum("rows"), F.sum("target")).first()
    digits = max(1, math.ceil(math.log((rows or 0) / BUCKET_ROWS + 1, 16)) + 1)
    # Rounding of the summed targets must not lose the last copy of an exact fit.
    beyond = first_beyond(queued(narrow, targets, digits), math.floor((budget or 0.0) + 1e-6))

    def taken(turn: int) -> Column:
        serves = (F.col("size") > 0) & (F.col("target") > 0)
        if beyond is not None:
            place = F.struct(finish(turn).alias("f"), F.col("_key"), F.lit(turn).alias("turn"))
            serves &= place < F.struct(*[F.lit(beyond[c]).alias(c) for c in ORDER])
        return F.when(serves, F.lit(1)).otherwise(F.lit(0))

    placed = queued(sized, targets, digits)
    return placed.withColumn("copies", sum(taken(t) for t in range(MAX_REPEATS))).withColumn(
        "taken", (F.col("copies") * F.col("size")).cast("long")
    ).drop("_key", "_before")


def mixed_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """The mix itself: every taken copy as a row with the columns of ``docs``."""
    names = docs.columns
    held = docs.withColumnsRenamed({c: f"_own_{i}" for i, c in enumerate(names) if c not in ("doc_id", "source", text)})
    back = {f"_own_{i}": c for i, c in enumerate(names) if c not in ("doc_id", "source", text)}
    return (
        mix(held, text)
        .where("copies > 0")
        .withColumn("_copy", F.explode(F.expr("sequence(1, copies)")))
        .select(*held.columns)
        .withColumnsRenamed(back)
        .select(*names)
    )
