"""Approximate nearest neighbours: an NN-descent graph and greedy search over it.

Equal vectors are one node. A first graph comes from random hyperplanes: nodes on
the same side of all of them meet in groups of bounded size. Then every node
introduces its neighbours and a sample of those that name it to each other, a
local join of bounded size, and each keeps the best it has met; a few rounds of
that are the index over all rows. A search starts at a bounded sample of pivots,
and at the query's own place in the graph if it has one, and expands the best
nodes not expanded yet, round by round, until its beam is settled. The nearest
found are scored again in double precision on the original vectors.

Defined cases: vectors that are null, empty, zero, of another length than most, or hold
null or non-finite components take no part, neither as queries nor as rows.
Equal vectors tie, to the smaller id. Rows without an id take no part; of rows
that share an id the first vector in byte order counts. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import arrow_map, materialise

NEIGHBOURS = 32
#: Neighbours, and nodes naming it, that a node introduces to each other in a round.
SAMPLE = 16
ROUNDS = 4
TABLES = 6
#: Members of a first group, about.
GROUP = 96
PIVOTS = 256
STARTS = 8
BEAM = 256
EXPAND = 128
SEARCH_ROUNDS = 8
#: Nodes per query that are scored exactly.
FINAL = 24
SEED = 7


def scaled(vector: np.ndarray) -> np.ndarray:
    """The vector with 1 as its largest magnitude, so that squares neither overflow nor vanish."""
    return vector / np.abs(vector).max()


def directed(vector: np.ndarray) -> np.ndarray:
    held = scaled(vector)
    return held / np.linalg.norm(held)


def usable(rows: DataFrame) -> DataFrame:
    """vec_id, vector (doubles as bytes), digest, unit (half-precision bytes) of the vectors that take part."""

    def checked(found: Iterator[tuple]) -> Iterable[tuple]:
        for vec_id, values in found:
            if vec_id is None or not values or any(x is None for x in values):
                continue
            vector = np.array(values, dtype=np.float64)
            if np.isfinite(vector).all() and vector.any():
                raw = vector.tobytes()
                direction = directed(vector).astype("<f2").tobytes()
                yield vec_id, raw, hashlib.blake2b(raw, digest_size=16).digest(), direction

    fields = "vec_id long, vector binary, digest binary, unit binary"
    read = arrow_map(rows.select(F.col("vec_id").cast("long"), "embedding"), checked, fields)
    held = materialise(read.groupBy("vec_id").agg(F.min(F.struct("vector", "digest", "unit")).alias("v")).select("vec_id", "v.*"), "vectors")
    common = held.groupBy(F.octet_length("vector").alias("n")).count().orderBy(F.col("count").desc(), "n").first()
    return held.where(F.octet_length("vector") == (common.n if common else 0))


def unit(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, dtype="<f2").astype(np.float32)


def in_groups(rows: DataFrame, *key: str) -> DataFrame:
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, *key).sortWithinPartitions(*key)


def met(groups: DataFrame, keep: int) -> DataFrame:
    """node, other, near: the best pairs within each group of (group, node, least, unit).

    Pairs that are no nearer than what the node has already (``least``) are left out.
    """

    def joined(found: Iterator[tuple]) -> Iterable[tuple]:
        for _, members in groupby(found, key=lambda r: r[0]):
            members = list(members)
            if len(members) < 2:
                continue
            ids = np.array([m[1] for m in members])
            least = np.array([m[2] for m in members], dtype=np.float32)
            matrix = np.frombuffer(b"".join([bytes(m[3]) for m in members]), dtype="<f2").astype(np.float32)
            matrix = matrix.reshape(len(members), -1)
            near = matrix @ matrix.T
            near[ids[:, None] == ids[None, :]] = -2
            k = min(keep, len(members) - 1)
            best = np.argpartition(-near, k - 1, axis=1)[:, :k]
            value = np.take_along_axis(near, best, axis=1)
            row, column = np.nonzero(value > np.maximum(least, -1.5)[:, None])
            yield from zip(ids[row].tolist(), ids[best[row, column]].tolist(), value[row, column].tolist(), strict=True)

    return arrow_map(groups.select("group", "node", "least", "unit"), joined, "node long, other long, near float", 8192)


def best_per(rows: DataFrame, key: str, n: int, *order) -> DataFrame:
    rank = Window.partitionBy(key).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(rank)).where(F.col("_rank") <= n).drop("_rank")


def first_graph(nodes: DataFrame, count: int) -> DataFrame:
    """Pairs from groups of nodes on the same sides of random hyperplanes."""
    bits = max(0, math.ceil(math.log2(max(1, count / GROUP))))

    def placed(found: Iterator[tuple]) -> Iterable[tuple]:
        planes = None
        for node, raw in found:
            v = unit(raw)
            if planes is None:
                planes = np.random.default_rng(SEED).standard_normal((TABLES * max(1, bits), len(v))).astype(np.float32)
            sides = (planes @ v > 0).reshape(TABLES, -1)[:, :bits]
            for t, code in enumerate((sides @ (1 << np.arange(bits, dtype=np.int64))).tolist()):
                yield t << 48 | code, node, raw

    cells = materialise(arrow_map(nodes.select("node", "unit"), placed, "cell long, node long, unit binary"), "cells")
    # A cell of many nodes is dealt to groups of bounded size by hash.
    sizes = cells.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / (2 * GROUP)).alias("deal"))
    dealt = cells.join(sizes, "cell").select(
        F.xxhash64("cell", F.pmod(F.xxhash64("node", F.lit(SEED)), "deal")).alias("group"),
        "node",
        F.lit(-2.0).cast("float").alias("least"),
        "unit",
    )
    return met(in_groups(dealt, "group"), NEIGHBOURS)


def build_graph(nodes: DataFrame) -> DataFrame:
    """node, other, near: about the nearest ``NEIGHBOURS`` of every node (node, unit)."""
    count = nodes.count()
    order = (F.col("near").desc(), "other")

    def settled(pairs: DataFrame, turn: int) -> DataFrame:
        return materialise(best_per(pairs.dropDuplicates(["node", "other"]), "node", NEIGHBOURS, *order), f"graph-{turn}")

    graph = settled(first_graph(nodes, count), 0)
    for turn in range(1, ROUNDS + 1):
        least = graph.groupBy("node").agg(
            F.when(F.count(F.lit(1)) >= NEIGHBOURS, F.min("near")).otherwise(F.lit(-2.0)).cast("float").alias("least")
        )
        known = nodes.join(least, "node", "left").select("node", F.coalesce("least", F.lit(-2.0).cast("float")).alias("least"), "unit")
        own = best_per(graph, "node", SAMPLE, *order).select(F.col("node").alias("group"), F.col("other").alias("node"))
        named = best_per(
            graph.select(F.col("other").alias("group"), "node"), "group", SAMPLE, F.xxhash64("node", "group", F.lit(turn))
        )
        selves = nodes.select(F.col("node").alias("group"), "node")
        members = own.union(named).union(selves).distinct().join(known, "node")
        graph = settled(graph.union(met(in_groups(members, "group"), 8)), turn)
    return graph


def search(queries: DataFrame, nodes: DataFrame, graph: DataFrame) -> DataFrame:
    """query, node, near of the nodes each query (query, unit, node: its place or null) came closest to."""
    sample = nodes.orderBy(F.xxhash64("node", F.lit(SEED)), "node").limit(PIVOTS).collect()
    if not sample:
        return queries.select("query", F.lit(0).cast("long").alias("node"), F.lit(0.0).cast("float").alias("near")).where(F.lit(False))
    pivots = np.array([r.node for r in sample])
    matrix = np.stack([unit(bytes(r.unit)) for r in sample])

    def started(found: Iterator[tuple]) -> Iterable[tuple]:
        for query, raw in found:
            near = matrix @ unit(raw)
            for i in np.argsort(-near, kind="stable")[:STARTS].tolist():
                yield query, int(pivots[i]), float(near[i])

    def measured(pairs: DataFrame) -> DataFrame:
        both = (
            pairs.join(nodes.select("node", F.col("unit").alias("theirs")), "node")
            .join(queries.select("query", F.col("unit").alias("mine")), "query")
            .select("query", "node", "mine", "theirs")
        )

        def near(found: Iterator[tuple]) -> Iterable[tuple]:
            for query, node, mine, theirs in found:
                yield query, node, float(unit(mine) @ unit(theirs))

        return arrow_map(both, near, "query long, node long, near float", 8192)

    state = arrow_map(queries.select("query", "unit"), started, "query long, node long, near float")
    own = measured(queries.where("node IS NOT NULL").select("query", "node"))
    state = state.union(own).dropDuplicates(["query", "node"]).withColumn("done", F.lit(False))
    state = materialise(state, "search")
    # Links are walked both ways: nodes that name another are reached from it too.
    backward = graph.select(F.col("other").alias("node"), F.col("node").alias("other"), "near")
    backward = best_per(backward, "node", NEIGHBOURS, F.col("near").desc(), "other")
    adjacency = materialise(graph.union(backward).select("node", "other").distinct(), "adjacency")
    for _ in range(SEARCH_ROUNDS):
        beam = best_per(state, "query", BEAM, F.col("near").desc(), "node")
        ahead = materialise(
            best_per(beam.where("NOT done"), "query", EXPAND, F.col("near").desc(), "node").select("query", "node"), "ahead"
        )
        if ahead.isEmpty():
            break
        reached = ahead.join(adjacency, "node").select("query", F.col("other").alias("node")).distinct()
        new = measured(reached.join(state, ["query", "node"], "left_anti")).withColumn("done", F.lit(False))
        marked = state.join(ahead.withColumn("now", F.lit(True)), ["query", "node"], "left").select(
            "query", "node", "near", F.coalesce(F.col("now"), F.col("done")).alias("done")
        )
        state = materialise(marked.union(new), "search")
    return best_per(state, "query", FINAL, F.col("near").desc(), "node").select("query", "node", "near")


def nearest(rows: DataFrame, every: int, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of each row whose id ``every`` divides.

    ``rows`` (vec_id, embedding) are indexed whole; a query is no candidate of its own.
    """
    vectors = usable(rows)
    roots = vectors.groupBy("digest").agg(F.min("vec_id").alias("node"))
    placed = materialise(vectors.join(roots, "digest").select("vec_id", "node", "vector", "unit"), "placed-vectors")
    nodes = placed.where("vec_id = node").select("node", "unit")
    graph = build_graph(nodes)
    queries = placed.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query"), "unit", "node", "vector")
    found = search(queries.drop("vector"), nodes, graph)
    # Of equal vectors the k + 1 smallest ids can be among the answers, no others.
    copies = best_per(placed.select("node", "vec_id", "vector"), "node", k + 1, "vec_id")
    pairs = (
        found.select("query", "node")
        .join(copies, "node")
        .where("vec_id != query")
        .join(queries.select("query", F.col("vector").alias("mine")), "query")
        .select("query", "vec_id", "mine", "vector")
    )

    def scored(found: Iterator[tuple]) -> Iterable[tuple]:
        for query, vec_id, mine, theirs in found:
            a, b = scaled(np.frombuffer(mine)), scaled(np.frombuffer(theirs))
            yield query, vec_id, float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b)))

    exact = arrow_map(pairs, scored, "query_id long, vec_id long, score double", 8192)
    rank = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return exact.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
