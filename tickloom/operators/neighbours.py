"""Exact nearest neighbours by squared Euclidean distance, through cells around pivots.

A bounded number of corpus vectors serve as pivots; every corpus vector belongs to
the cell of its nearest one. A query first visits the cells nearest to it that
hold ``k`` vectors; the k-th distance found there bounds what can still matter. By
the triangle inequality a cell whose vectors lie between radius ``least`` and
``most`` of its pivot holds nothing nearer than the pivot's distance less ``most``,
or ``least`` less that distance; the query then visits just the cells that may hold
something as near as the bound. Cells that lie together share a room, a crowded cell
is cut into several, and queries of near cells share a block. Rooms and blocks are
written once, packed; a task reads some of each and compares a block with the rooms
that its queries visit. So what is shuffled and written grows with the rows of either
side, also where no cell can be passed over, and no pair table is built.

Equal query vectors are asked once. No more queries than there would be pivots are
compared with every row in one pass over the corpus, which costs what placing the rows
in cells would.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators import ordering
from tickloom.session import materialise

#: Most pivots; with their vectors (dimension x 8 bytes each) they go to all tasks.
MOST_PIVOTS = 4096
#: Bytes of query vectors and of corpus vectors that meet.
QUERY_BYTES = 32 * 1024 * 1024
CORPUS_BYTES = 128 * 1024 * 1024
#: Parts that smaller blocks may cut the corpus, or the queries, into: each part may meet
#: all parts of the other side. Beyond, blocks grow up to the bytes above.
MOST_PARTS = 16
#: Queries of a block that are compared at once, with the cells that any of them visits.
STRETCH = 512
#: Rough distances in memory at once.
BLOCK = 8 * 1024 * 1024
#: Files that blocks are dealt to, per core, and the rows of a block that this alone won't go below.
TASKS_PER_CORE = 2
LEAST_ROWS = 512


def _matrix(column, dimension: int, kind: str | None = "float64"):
    """An Arrow column of vectors as the rows of a matrix; of its own kind of numbers where ``kind`` is None."""
    column = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    values = column.flatten().to_numpy(zero_copy_only=False)
    return (values.astype(kind) if kind else values).reshape(-1, dimension)


def _distances(a, b):
    """Euclidean distances of all rows of ``a`` to all rows of ``b``, and a bound on their rounding errors."""
    import numpy as np

    sizes, others = (a * a).sum(axis=1), (b * b).sum(axis=1)
    squares = sizes[:, None] - 2.0 * (a @ b.T) + others[None, :]
    scale = np.sqrt(sizes) + np.sqrt(others.max(initial=0.0))
    return np.sqrt(np.maximum(squares, 0.0)), 1e-6 * scale


class _Best:
    """The ``k`` nearest of the vectors seen so far for each of ``queries``, ties by id.

    Rough distances of a block of vectors to many queries at once pick candidates, within
    what a query has already found or within ``reach``, a bound known before (squared);
    just these get exact distances.
    """

    def __init__(self, queries, k: int, reach=None):
        import numpy as np

        self.queries, self.k = queries.astype("float64"), k
        self.centre = self.queries.mean(axis=0)
        self.moved = self.queries - self.centre
        self.sizes = (self.moved * self.moved).sum(axis=1)
        self.few = self.moved.astype("float32")
        self.reach = np.full(len(queries), np.inf) if reach is None else reach * (1 + 1e-12)
        self.found: list = []
        self.waiting = 0

    def see(self, ids, vectors, some=None) -> None:
        """Compare ``vectors`` with all queries, or with those at ``some``."""
        import numpy as np

        some = np.arange(len(self.queries)) if some is None else some
        step, queries = max(1, BLOCK // 4 // vectors.shape[1]), max(1, BLOCK // max(1, min(len(vectors), BLOCK // 4 // vectors.shape[1])))
        for start in range(0, len(vectors), step):
            part = vectors[start : start + step]
            moved = part - self.centre
            norms = (moved * moved).sum(axis=1)
            most = norms.max(initial=0.0)
            few = moved.astype("float32") if 1e-20 < max(most, self.sizes.max(initial=0.0)) < 1e30 else None
            for at in range(0, len(some), queries):
                asking = some[at : at + queries]
                asked, near = self._candidates(asking, moved, few, norms, most)
                asked = asking[asked]
                distances = np.empty(len(asked))
                pairs = max(1, BLOCK // 2 // vectors.shape[1])
                for pair in range(0, len(asked), pairs):
                    gaps = part[near[pair : pair + pairs]] - self.queries[asked[pair : pair + pairs]]
                    distances[pair : pair + pairs] = (gaps * gaps).sum(axis=1)
                kept = distances <= self.reach[asked]
                if kept.any():
                    self.found.append((asked[kept], ids.take(_array(near[kept] + start)), distances[kept]))
                    self.waiting += int(kept.sum())
            if self.waiting > self.k * len(self.queries) or (self.waiting and not np.isfinite(self.reach[some]).all()):
                self._settle()

    def _candidates(self, asking, moved, few, norms, most):
        """(query, vector) of all pairs that may be among the nearest; single precision unless that leaves too many."""
        import numpy as np

        limit = min(self.k, len(moved))
        for one, other, error in ((self.few, few, 6.1e-8), (self.moved, moved, 1.2e-16)):
            if other is None:
                continue
            slack = (moved.shape[1] + 16) * error * (self.sizes[asking] + most) + 1e-300
            rough = one[asking] @ other.T
            rough -= (norms / 2).astype(rough.dtype)
            cut = (self.sizes[asking] - self.reach[asking] - slack) / 2
            if np.isinf(cut).any():
                cut = np.maximum(cut, np.partition(rough, len(moved) - limit, axis=1)[:, len(moved) - limit] - slack)
            asked, near = np.nonzero(rough >= cut.astype(rough.dtype)[:, None])
            if len(asked) <= 64 * self.k * len(asking):
                break
        return asked, near

    def _settle(self) -> None:
        """Drop what is not among the ``k`` best of its query, and tighten the reach."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        asked, distances = (np.concatenate([f[i] for f in self.found]) for i in (0, 2))
        ids = pa.concat_arrays([f[1] for f in self.found])
        order = np.empty(len(ids), dtype=np.int64)
        order[pc.sort_indices(ids).to_numpy()] = np.arange(len(ids))
        by = np.lexsort((order, distances, asked))
        place = np.arange(len(by)) - np.searchsorted(asked[by], asked[by], side="left")
        last = by[place == self.k - 1]
        self.reach[asked[last]] = np.minimum(self.reach[asked[last]], distances[last])
        by = by[place < self.k]
        self.found, self.waiting = [(asked[by], ids.take(_array(by)), distances[by])], 0

    def result(self):
        """(query, id, squared distance) as arrays, or None where nothing was found."""
        if self.waiting:
            self._settle()
        return self.found[0] if self.found else None


def _array(values):
    import pyarrow as pa

    return pa.array(values, pa.int64())


def _numbers(df: DataFrame) -> DataFrame:
    """``df`` with vectors of doubles; floats stay as they are, half as large, until they meet."""
    floats = df.schema["embedding"].dataType == T.ArrayType(T.FloatType(), df.schema["embedding"].dataType.containsNull)
    return df if floats else df.withColumn("embedding", F.col("embedding").cast("array<double>"))


def _finite(df: DataFrame) -> Column:
    """Whether a vector holds finite numbers only; compiled, where a lambda per element is not."""
    kind = df.schema["embedding"].dataType.elementType
    infinite = F.lit(float("inf")).cast(kind)
    # A null element makes the membership unknown, and a NaN is the largest of all.
    without = ~F.array_contains("embedding", infinite) & ~F.isnan(F.array_max("embedding"))
    return F.coalesce(without & (F.array_min("embedding") > -infinite), F.lit(False))


def _in_range(vectors: DataFrame, dimension: int) -> DataFrame:
    return vectors.filter(F.size("embedding") == dimension)


def _with(df: DataFrame, fields: str, make) -> DataFrame:
    """``df`` with the columns that ``make(batch)`` gives per Arrow batch, named by ``fields``."""
    added = T.StructType.fromDDL(fields)
    schema = T.StructType([*df.schema.fields, *added.fields])

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([*batch.columns, *make(batch)], names=schema.names)

    return df.mapInArrow(run, schema)


def _part_rows(asked_bytes: int, most_bytes: int, rows: int, row_bytes: int) -> int:
    """Rows of a block of ``asked_bytes``, more where that makes over ``MOST_PARTS`` parts; never over ``most_bytes``."""
    grown = min(most_bytes, math.ceil(rows / MOST_PARTS) * row_bytes)
    return max(1, max(asked_bytes, grown) // row_bytes)


def _together(pivots) -> list[int]:
    """The cells in an order in which near pivots stand together: halved again and again along the widest axis."""
    import numpy as np

    out, left = [], [np.arange(len(pivots))]
    while left:
        part = left.pop()
        if len(part) <= 2:
            out.extend(part.tolist())
            continue
        axis = np.ptp(pivots[part], axis=0).argmax()
        part = part[np.argsort(pivots[part, axis], kind="stable")]
        left += [part[len(part) // 2 :], part[: len(part) // 2]]
    return out


def _rooms(order: list[int], n: list[int], rows: int) -> tuple[list[int], list[int], int]:
    """Per cell its first room and how many rooms it is dealt to, and the number of rooms, of some ``rows`` each."""
    first, parts, room, held = [0] * len(n), [0] * len(n), 0, 0
    for cell in order:
        if not n[cell]:
            continue
        parts[cell] = math.ceil(n[cell] / rows)
        if held and held + n[cell] > rows:
            room, held = room + 1, 0
        first[cell], held = room, held + n[cell]
        if held >= rows:
            room, held = room + parts[cell], 0
    return first, parts, room + bool(held)


def _lists(rows, values, count: int):
    """Arrow lists of ``values`` by their ascending ``rows``, one list for each of ``count`` rows."""
    import numpy as np
    import pyarrow as pa

    offsets = np.searchsorted(rows, np.arange(count + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def _flat(column):
    """The row of every list element and the elements."""
    import numpy as np
    import pyarrow.compute as pc

    column = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    return (np.asarray(pc.list_parent_indices(column)), column.flatten().to_numpy(zero_copy_only=False))


def nearest(
    corpus: DataFrame,
    queries: DataFrame,
    k: int,
    query_bytes: int = QUERY_BYTES,
    corpus_bytes: int = CORPUS_BYTES,
    pivots: int = MOST_PIVOTS,
) -> DataFrame:
    """(query_id, rank, id, distance): the ``k`` nearest corpus rows of each query, ties by id.

    ``corpus`` has (id, embedding) with unique ids, ``queries`` (query_id, embedding).
    Vectors that are null or hold null or non-finite elements, and corpus rows without
    an id, take no part, nor do vectors, of either side, of another length than most of
    the corpus has; a query without an id is answered under the null id. The number of
    pivots is the square root of the corpus rows, ``pivots`` at most. Blocks of
    ``query_bytes`` and ``corpus_bytes`` meet, larger ones where these would make over
    ``MOST_PARTS`` parts.
    """
    corpus, queries = _numbers(corpus), _numbers(queries)
    wanted = materialise(queries.select("query_id", "embedding").filter(_finite(queries)), "wanted")
    vectors = wanted.select("embedding").distinct().withColumn("_q", F.monotonically_increasing_id())
    vectors = materialise(vectors, "vectors")
    named = corpus.select("id", "embedding").filter(F.col("id").isNotNull())
    if vectors.count() <= max(1, min(pivots, math.isqrt(corpus.count()))):
        ranked = _scan(named, vectors, k)
    else:
        ranked = _visits(named.filter(_finite(named)), vectors, k, query_bytes, corpus_bytes, pivots)
    asking = wanted.join(vectors, "embedding").select("query_id", "_q")
    return ranked.join(asking, "_q").select("query_id", "rank", "id", "distance")


RANKING = ["distance", "id"]


def _found_schema(corpus: DataFrame) -> T.StructType:
    kind = corpus.schema["id"].dataType
    return T.StructType([
        T.StructField("_q", T.LongType()), T.StructField("id", kind), T.StructField("distance", T.DoubleType())
    ])


def _most_common(lengths: DataFrame):
    """The row (size, n) of the length that most vectors have, the larger of two as common."""
    return lengths.filter("size > 0").orderBy(F.desc("n"), F.desc("size")).first()


def _scan(corpus: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """(_q, rank, id, distance) from one pass over the corpus: the few vectors that ask go to all tasks.

    A task keeps ``k`` rows per query. It counts the lengths of the vectors it meets, too,
    so that the most common one is known without a pass of its own.
    """
    import numpy as np

    some = vectors.toArrow().combine_chunks()
    sizes = np.array([len(v) for v in some.column("embedding")], dtype=np.int64)
    asked = {
        int(size): (np.asarray(part.column("_q")), _matrix(part.column("embedding"), int(size)))
        for size in np.unique(sizes[sizes > 0])
        for part in [some.filter(_mask(sizes == size))]
    }
    shared = corpus.sparkSession.sparkContext.broadcast(asked)
    found = _found_schema(corpus)
    schema = T.StructType([*T.StructType.fromDDL("size int, n long").fields, *found.fields])

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        best = {size: _Best(matrix, k) for size, (_, matrix) in shared.value.items()}
        seen: dict[int, int] = {}
        for batch in batches:
            at = pc.fill_null(pc.list_value_length(batch.column("embedding")), 0).to_numpy()
            for size in np.unique(at[at > 0]).tolist():
                part = batch if (at == size).all() else batch.filter(_mask(at == size))
                vectors, ids = _matrix(part.column("embedding"), size, None), part.column("id")
                finite = np.isfinite(vectors).all(axis=1)  # a null element reads as NaN
                if not finite.all():
                    vectors, ids = vectors[finite], ids.filter(_mask(finite))
                seen[size] = seen.get(size, 0) + len(vectors)
                if size in best and len(vectors):
                    best[size].see(ids, vectors)
        for size, n in seen.items():
            kind = pa.schema([("size", pa.int32()), ("n", pa.int64()), ("_q", pa.int64()), batch.schema.field("id").with_nullable(True), ("distance", pa.float64())])
            yield pa.RecordBatch.from_pydict({"size": [size], "n": [n], "_q": [None], "id": [None], "distance": [None]}, schema=kind)
            if (rows := best[size].result() if size in best else None) is not None:
                q, ids, distances = rows
                at = shared.value[size][0][q]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(q), size), pa.int32()), pa.nulls(len(q), pa.int64()), pa.array(at, pa.int64()), ids,
                    pa.array(distances, pa.float64()),
                ], schema=kind)

    scanned = materialise(corpus.mapInArrow(run, schema), "scanned")
    most = _most_common(scanned.filter("n IS NOT NULL").groupBy("size").agg(F.sum("n").alias("n")))
    hits = scanned.filter(F.col("_q").isNotNull() & (F.col("size") == F.lit(most["size"] if most else 0)))
    return ordering.top_n(hits.select(*found.names), ["_q"], RANKING, k, "rank")


def _mask(values):
    import pyarrow as pa

    return pa.array(values)


def _packed(rows: DataFrame, number: str, parts: int, name: str, rooms=None) -> DataFrame:
    """A row per block: its ``number`` and all ``rows`` of that number as compressed Arrow data (``packed``).

    With ``rooms``, which tells the rooms of some cells, also the rooms with a cell that one
    of its rows visits (``wanted``).
    """
    def run(batches):
        import pyarrow as pa

        held, kept = None, []

        def block():
            table = pa.Table.from_batches(kept).drop_columns([number])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(table.combine_chunks())
            row = {number: pa.array([held], pa.int32()), "packed": pa.array([sink.getvalue().to_pybytes()], pa.binary())}
            if rooms:
                row["wanted"] = pa.array([rooms(_flat(table.column("cells"))[1])], pa.list_(pa.int32()))
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            numbers = batch.column(number).to_numpy()
            start = 0
            for end in [*(i + 1 for i in (numbers[1:] != numbers[:-1]).nonzero()[0].tolist()), len(numbers)]:
                if end > start:
                    if held is not None and numbers[start] != held:
                        yield block()
                        kept = []
                    held = int(numbers[start])
                    kept.append(batch.slice(start, end - start))
                start = end
        if kept:
            yield block()

    schema = f"{number} int, packed binary" + (", wanted array<int>" if rooms else "")
    dealt = rows.repartition(max(1, parts), number).sortWithinPartitions(number)
    return materialise(dealt.mapInArrow(run, schema), name)


def _unpacked(data):
    import pyarrow as pa

    with pa.ipc.open_stream(data) as stream:
        return stream.read_all().combine_chunks()


def _visits(
    corpus: DataFrame, vectors: DataFrame, k: int, query_bytes: int, corpus_bytes: int, pivots: int
) -> DataFrame:
    """(_q, rank, id, distance) by cells, in two visits."""
    spark = corpus.sparkSession
    most = _most_common(corpus.groupBy(F.size("embedding").alias("size")).agg(F.count(F.lit(1)).alias("n")))
    if most is None:
        empty = spark.createDataFrame([], _found_schema(corpus))
        return empty.select("_q", F.lit(1).alias("rank"), "id", "distance")
    dimension = most["size"]
    cells = max(1, min(pivots, math.isqrt(most["n"])))
    corpus, vectors = _in_range(corpus, dimension), _in_range(vectors, dimension)
    sample = corpus.orderBy(F.xxhash64("id"), "id").limit(cells).select("embedding").toArrow()
    chosen = _matrix(sample.column("embedding"), dimension)
    cells = len(chosen)
    shared = spark.sparkContext.broadcast(chosen)

    def to_cell(batch):
        import numpy as np
        import pyarrow as pa

        away, _ = _distances(_matrix(batch.column("embedding"), dimension), shared.value)
        cell = away.argmin(axis=1)
        return pa.array(cell.astype(np.int32)), pa.array(away[np.arange(len(cell)), cell])

    placed = materialise(_with(corpus, "cell int, away double", to_cell), "cells")
    sizes = placed.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.min("away").alias("least"), F.max("away").alias("most")
    ).collect()
    n, least, furthest = [0] * cells, [0.0] * cells, [0.0] * cells
    for row in sizes:
        n[row["cell"]], least[row["cell"]], furthest[row["cell"]] = row["n"], row["least"], row["most"]

    def home(batch):
        """The nearest cells that hold ``k`` rows together, and the nearest of them."""
        import numpy as np
        import pyarrow as pa

        held = np.array(n)
        away, _ = _distances(_matrix(batch.column("embedding"), dimension), shared.value)
        by = np.argsort(np.where(held > 0, away, np.inf), axis=1, kind="stable")
        before = np.cumsum(held[by], axis=1) - held[by]
        at, place = np.nonzero((before < k) & (held[by] > 0))
        return _lists(at, by[at, place], len(by)), pa.array(by[:, 0].astype(np.int32))

    def rest(batch):
        """The cells that may hold a row as near as the k-th of those found."""
        import numpy as np

        away, slack = _distances(_matrix(batch.column("embedding"), dimension), shared.value)
        bound = np.sqrt(batch.column("reach").to_numpy(zero_copy_only=False)) + slack
        nearest_there = np.maximum(away - np.array(furthest), np.array(least) - away)
        open_ = (nearest_there <= bound[:, None] + slack[:, None]) & (np.array(n) > 0)
        return (_lists(*np.nonzero(open_), len(open_)),)

    asked = materialise(_with(vectors, "cells array<int>, own int", home), "asked")
    row_bytes, order = 8 * dimension, _together(chosen)
    tasks = TASKS_PER_CORE * spark.sparkContext.defaultParallelism

    def dealt(key: str, cell: str, counts: list[int], rows: int) -> tuple[list[int], list[int], int, Column]:
        """First block and number of blocks of each cell, how many there are, and the block of a row by its ``key``."""
        first, parts, blocks = _rooms(order, counts, rows)
        share = F.pmod(F.xxhash64(key), F.get(F.array(*map(F.lit, parts)), F.col(cell))).cast("int")
        return first, parts, blocks, F.get(F.array(*map(F.lit, first)), F.col(cell)) + share

    rows = _part_rows(corpus_bytes, CORPUS_BYTES, sum(n), row_bytes)
    first, parts, rooms, room = dealt("id", "cell", n, min(rows, max(LEAST_ROWS, math.ceil(sum(n) / tasks))))
    owned = [0] * cells
    for row in asked.groupBy("own").agg(F.count(F.lit(1)).alias("n")).collect():
        owned[row["own"]] = row["n"]
    _, _, blocks, block = dealt("_q", "own", owned, _part_rows(query_bytes, QUERY_BYTES, sum(owned), row_bytes))
    held = _packed(placed.select("id", "embedding", "cell", room.alias("room")), "room", min(rooms, tasks), "rooms")

    def rooms_of(visited):
        import numpy as np

        visited = np.unique(visited)
        shares = np.array(parts)[visited]
        into = np.arange(shares.sum()) - np.repeat(np.cumsum(shares) - shares, shares)
        return np.unique(np.repeat(np.array(first)[visited], shares) + into).tolist()

    def meet(batches):
        """Blocks of queries with the rooms they want; a block stays until another one comes."""
        import numpy as np
        import pyarrow as pa

        number = one = best = None

        def done():
            if (found := best.result() if best else None) is not None:
                q, ids, distances = found
                yield pa.RecordBatch.from_arrays([one.column("_q").chunk(0).take(_array(q)), ids, pa.array(distances)], names=["_q", "id", "distance"])

        for batch in batches:
            for i in range(batch.num_rows):
                if batch.column("block")[i].as_py() != number:
                    yield from done()
                    number, one = batch.column("block")[i].as_py(), _unpacked(batch.column("packed")[i].as_buffer())
                    reach = one.column("reach").to_numpy() if "reach" in one.column_names else None
                    best = _Best(_matrix(one.column("embedding"), dimension), k, reach)
                    at, wanted = _flat(one.column("cells"))
                    place = np.argsort(np.argsort(np.array(order))[one.column("own").to_numpy()], kind="stable")
                    stretch = np.empty(len(place), dtype=np.int64)
                    stretch[place] = np.arange(len(place)) // STRETCH
                    seen = np.zeros((math.ceil(len(place) / STRETCH), cells), dtype=bool)
                    seen[stretch[at], wanted] = True
                other = _unpacked(batch.column("held")[i].as_buffer())
                ids, cell = other.column("id").chunk(0), other.column("cell").to_numpy()
                vectors = _matrix(other.column("embedding"), dimension, None)
                there = seen[:, cell]
                alike = there.all(axis=1)
                if alike.any():
                    best.see(ids, vectors, np.sort(place[np.repeat(alike, STRETCH)[: len(place)]]))
                for turn in np.flatnonzero(~alike & there.any(axis=1)).tolist():
                    rows = np.flatnonzero(there[turn])
                    best.see(ids.take(_array(rows)), vectors[rows], place[turn * STRETCH : (turn + 1) * STRETCH])
        yield from done()

    def visit(visitors: DataFrame, name: str) -> DataFrame:
        """(_q, id, distance): the best rows of the rooms that hold a cell which a query visits, ``k`` per task."""
        went = _packed(visitors.withColumn("block", block), "block", min(blocks, tasks), f"{name}_blocks", rooms_of)
        # Compared pair by pair from the files: neither side is shuffled or written again for the other.
        pairs = went.crossJoin(held.select("room", F.col("packed").alias("held")).hint("shuffle_replicate_nl"))
        met = pairs.where(F.array_contains("wanted", F.col("room"))).select("block", "packed", "held")
        return materialise(met.mapInArrow(meet, _found_schema(corpus)), name)

    near = visit(asked, "near")
    reached = ordering.top_n(near, ["_q"], RANKING, k, "rank").groupBy("_q").agg(F.max("distance").alias("reach"))
    going_on = materialise(_with(asked.drop("cells").join(reached, "_q"), "cells array<int>", rest), "further")
    # Whatever lies within reach is met again, so the second visit alone holds the result.
    return ordering.top_n(visit(going_on, "beyond"), ["_q"], RANKING, k, "rank")
