"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

Vectors are put on an integer grid, so their number and sums are exact and a row
can be centred without rounding the mean. The rows are packed into blocks of
bounded size and written once. Every step of the bidiagonalisation is one pass
over the blocks that makes both products: u = Xv on the centred rows of a block
and, from it, the block's part of Xᵀu. A left vector is never stored: it is X
times a short coefficient vector, so a task computes the earlier ones again from
its own rows, and their inner products with u come out of the same pass. So both
bases are orthogonalised in full (the left one twice where once is not enough)
while the driver holds nothing longer than a vector has dimensions, a lost
executor costs the tasks it ran, and a pass shuffles a few numbers per task. The
singular values of the small bidiagonal matrix are the deviations times √n, its
right vectors give the components.

Steps end when the residuals of the wanted components are below the rounding
error of the largest. After a breakdown (repeated or zero deviations) a new
direction is taken up, and the steps go on until what is left of the total
variance is less than the last wanted component's, or the space is used up.

Defined cases: rows whose vector is null, empty or holds null or non-finite
entries take no part, as do rows of another length than most rows have (of
lengths equally frequent the longest counts). Entries beyond ±2^48 on the grid
are held at that bound. Null and repeated ids are rows like others. Components
without variance beyond rounding do not exist, so one vector, equal vectors and
empty tables give rows without components. A deviation that no long can hold is
null. Columns named as results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from tickloom.llm.common import clear_of, materialise

#: Largest magnitude on the grid; sums over a block of rows stay within 64 bits.
BOUND = 1 << 48
#: Numbers in a block of rows (8 MB).
BLOCK = 1 << 20
#: A component whose residual is at most this share of the largest deviation is settled.
SETTLED = 1e-13
#: Inner products with earlier left vectors above this share call for a second pass.
LOOSE = 1e-8
#: A deviation below this share of the largest is rounding.
NOISE = 1e-10
SEED = 11


def on_grid(df: DataFrame, vector: str, scale: int = 1024, offset: int = 100_000) -> DataFrame:
    """``df`` with ``x``, the long vector floor(scale * entry) + offset, for the rows that take part."""
    entry = f"cast(floor(least(greatest({scale}D * cast(c AS DOUBLE), -{BOUND}D), {BOUND}D)) AS BIGINT) + {offset}L"
    held = clear_of(df, "x") if vector.lower() != "x" else df
    sound = held.where(
        F.expr(
            f"`{vector}` IS NOT NULL AND size(`{vector}`) > 0 AND NOT exists(`{vector}`, "
            "c -> c IS NULL OR isnan(cast(c AS DOUBLE)) OR abs(cast(c AS DOUBLE)) = double('infinity'))"
        )
    )
    return sound.withColumn("x", F.expr(f"transform(`{vector}`, c -> {entry})"))


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of equal length as the rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


@dataclass(frozen=True)
class Whitening:
    """What ``fit`` learns: rows, exact sums, total variance, components and their deviations."""

    n: int
    sums: tuple[int, ...]
    total: float
    components: np.ndarray  # dimension x number
    deviations: np.ndarray
    identity_error: float
    steps: int

    @property
    def dimension(self) -> int:
        return len(self.sums)

    @property
    def explained(self) -> np.ndarray:
        return self.deviations**2 / self.total

    def centred(self, x: np.ndarray) -> np.ndarray:
        """Rows less the mean; the whole part of the mean is taken off exactly."""
        return centre(x, self.n, self.sums)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.components / self.deviations)


def centre(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    whole = np.array([s // n for s in sums], dtype=np.int64)
    part = np.array([(s % n) / n for s in sums])
    return (x - whole) - part


def blocks(rows: DataFrame, dimension: int) -> DataFrame:
    """The vectors of ``x`` that have the dimension, packed: one binary cell of longs per block."""
    most = max(1, BLOCK // dimension)

    def pack(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def cell() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"block": pa.array([b"".join(held)], pa.binary())})

        for batch in found:
            x = matrix(batch.column(0))
            for at in range(0, len(x), most):
                part = np.ascontiguousarray(x[at : at + most], dtype="<i8")
                if held and size + len(part) > most:
                    yield cell()
                    held, size = [], 0
                held.append(part.tobytes())
                size += len(part)
        if held:
            yield cell()

    return rows.where(F.size("x") == dimension).select("x").mapInArrow(pack, "block binary")


def summed(packed: DataFrame, work, dimension: int, kind: str = "double") -> list:
    """Per position, the sum over all blocks of the vector that ``work`` makes of a block's rows."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for cell in batch.column(0):
                out = work(np.frombuffer(cell.as_buffer(), dtype="<i8").reshape(-1, dimension))
                yield pa.RecordBatch.from_pydict(
                    {"place": pa.array(np.arange(len(out)), pa.int64()), "value": pa.array(out)}
                )

    parts = packed.mapInArrow(run, f"place long, value {kind}")
    value = F.col("value").cast("decimal(38,0)") if kind == "long" else F.col("value")
    total = parts.groupBy("place").agg(F.sum(value).alias("value"))
    return [r.value for r in sorted(total.collect(), key=lambda r: r.place)]


def bidiagonal(alphas: list[float], betas: list[float]) -> np.ndarray:
    return np.diag(alphas) + np.diag(betas[: len(alphas) - 1], 1)


def fit(rows: DataFrame, k: int = 8) -> Whitening:
    """The first ``k`` components of the vectors in ``x`` (see ``on_grid``), by falling variance.

    The block table lies below ``spark.checkpoint.dir``. At most ``dimension``
    vectors of that many numbers are held by the driver.
    """
    lengths = rows.groupBy(F.size("x").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("size")).first()
    if most is None:
        return Whitening(0, (), 0.0, np.empty((0, 0)), np.empty(0), 0.0, 0)
    d, n = most["size"], most["n"]
    packed = materialise(blocks(rows, d), "whitening")
    sums = tuple(int(s) for s in summed(packed, lambda x: x.sum(axis=0), d, "long"))
    total = summed(packed, lambda x: np.array([np.sum(centre(x, n, sums) ** 2)]), d)[0]
    rng = np.random.default_rng(SEED)
    right = np.empty((d, 0))  # v of every step
    lefts = np.empty((d, 0))  # coefficients: u = X c
    backs = np.empty((d, 0))  # Xᵀu
    alphas, betas, broken = [], [], False

    def new_direction() -> np.ndarray:
        v = rng.standard_normal(d)
        for _ in range(3):
            v -= right @ (right.T @ v)
            v /= np.linalg.norm(v)
        return v

    def products(c: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """|u|², inner products with the earlier left vectors, and Xᵀu, of u = Xc."""

        def work(x: np.ndarray) -> np.ndarray:
            p = centre(x, n, sums)
            u = p @ c
            return np.concatenate([[u @ u], u @ p, u @ (p @ earlier)])

        earlier = lefts
        out = np.array(summed(packed, work, d))
        return out[0], out[1 + d :], out[1 : 1 + d]

    v = new_direction()
    small = np.sqrt(total) * NOISE
    components, values = np.empty((d, 0)), np.empty(0)
    while total > 0 and right.shape[1] < d:
        right = np.column_stack([right, v])
        c = v - (betas[-1] * lefts[:, -1] if betas else 0)
        for _ in range(2):
            square, inner, back = products(c)
            c = c - lefts @ inner
            back = back - backs @ inner
            if np.linalg.norm(inner) <= LOOSE * np.sqrt(max(square, 0)):
                break
        alpha = np.sqrt(max(square - inner @ inner, 0))
        if alpha <= small:
            # v has no variance beyond what is known already.
            alpha, c, back = 0.0, np.zeros(d), np.zeros(d)
        else:
            c, back = c / alpha, back / alpha
        alphas.append(float(alpha))
        lefts, backs = np.column_stack([lefts, c]), np.column_stack([backs, back])
        w = back - alpha * v
        for _ in range(2):
            w = w - right @ (right.T @ w)
        beta = float(np.linalg.norm(w))
        if right.shape[1] == d or beta <= small:
            beta, broken = 0.0, broken or right.shape[1] < d
        left, values, turned = np.linalg.svd(bidiagonal(alphas, betas))
        components = right @ turned.T
        left_over = total - float(np.sum(values**2))
        if beta:
            residuals = beta * np.abs(left[-1, :k])
            if not broken and len(values) >= min(k, d) and np.all(residuals <= SETTLED * values[0]):
                break
        if broken and left_over <= (values[k - 1] ** 2 if len(values) >= k else NOISE * total):
            break
        betas.append(beta)
        v = w / beta if beta else (new_direction() if right.shape[1] < d else v)
    kept = min(k, int(np.sum(values > max(small, values[0] * NOISE)))) if len(values) else 0
    p, s = components[:, :kept], values[:kept]
    # The sign of a component is free; the largest entry is made positive.
    if kept:
        p = p * np.sign(p[np.abs(p).argmax(axis=0), np.arange(kept)])
    model = Whitening(n, sums, total / n, p, s / np.sqrt(n), 0.0, len(alphas))
    return Whitening(n, sums, total / n, p, s / np.sqrt(n), _identity_error(packed, model), len(alphas))


def _identity_error(packed: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened rows' covariance minus the identity, centred before multiplying."""
    k, n, d = len(model.deviations), model.n, model.dimension
    if not k:
        return 0.0
    mean = np.array(summed(packed, lambda x: model.whitened(x).sum(axis=0), d)) / n

    def work(x: np.ndarray) -> np.ndarray:
        w = model.whitened(x) - mean
        return (w.T @ w).ravel()

    covariance = np.array(summed(packed, work, d)).reshape(k, k) / n
    return float(np.abs(covariance - np.eye(k)).max())


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """Per row, the sum over dimensions of (n * x - sum)², exact; None beyond a long."""
    whole = np.array([s // n for s in sums], dtype=np.int64)
    rest = [s % n for s in sums]
    near = x - whole
    rough = ((near.astype(np.float64) - np.array(rest) / n) ** 2).sum(axis=1) * float(n) ** 2
    fits = rough < 2.0**62
    out: list[int | None] = [None] * len(x)
    exact = near[fits] * n - np.array(rest, dtype=np.int64)
    for row, value in zip(np.flatnonzero(fits).tolist(), (exact**2).sum(axis=1).tolist(), strict=True):
        out[row] = value
    for row in np.flatnonzero(~fits & (rough < 2.0**64)).tolist():
        value = sum((int(a) * n - r) ** 2 for a, r in zip(near[row].tolist(), rest, strict=True))
        out[row] = value if value < 1 << 63 else None
    return out


def whiten(rows: DataFrame, model: Whitening) -> DataFrame:
    """``rows`` of the model's dimension without ``x``, with ``whitened`` (a number per component)
    and ``deviation``, the squared distance from the mean times n²."""
    held = clear_of(rows, "whitened", "deviation").where(F.size("x") == model.dimension)
    fields = [f for f in held.schema.fields if f.name != "x"]
    names = [f.name for f in fields]
    schema = StructType(
        [*fields, StructField("whitened", ArrayType(DoubleType())), StructField("deviation", LongType())]
    )
    if not model.n:
        return held.where("false").select(
            *names, F.lit(None).cast("array<double>").alias("whitened"), F.lit(None).cast("long").alias("deviation")
        )

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            if not batch.num_rows:
                continue
            x = matrix(batch.column("x"))
            w = model.whitened(x)
            offsets = np.arange(len(x) + 1, dtype=np.int32) * w.shape[1]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in names),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(w.ravel())),
                    pa.array(deviations(x, model.n, model.sums), pa.int64()),
                ],
                names=[*names, "whitened", "deviation"],
            )

    return held.select(*names, "x").mapInArrow(run, schema)
