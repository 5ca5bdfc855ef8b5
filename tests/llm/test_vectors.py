"""Whitening against a dense eigen-decomposition."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import queries, whitening

SF = "/root/testdata/sf0.001"


def dense(x):
    """n, eigenvalues by falling size, exact squared distances times n², centred rows."""
    n, sums = len(x), [sum(c) for c in zip(*x.tolist(), strict=True)]
    centred = np.array([[(n * a - s) / n for a, s in zip(row, sums, strict=True)] for row in x.tolist()])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    far = [sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x.tolist()]
    return n, values[::-1], axes[:, ::-1], far, centred


def fitted(spark, x, k=8):
    rows = spark.createDataFrame([(i, r) for i, r in enumerate(x.tolist())], "vec_id long, x array<long>")
    rows = rows.repartition(3)
    model = whitening.fit(rows, k)
    done = sorted(whitening.whiten(rows, model).collect(), key=lambda r: r.vec_id)
    return model, done


def equal_up_to_sign(got, want):
    got, want = np.array(got), np.array(want)
    for at in range(got.shape[1]):
        gap = min(np.abs(got[:, at] - want[:, at]).max(), np.abs(got[:, at] + want[:, at]).max())
        assert gap < 1e-7 * max(1, np.abs(want[:, at]).max())


def test_registered_query_equals_the_dense_result(spark):
    rows = [r for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    x = np.array([[math.floor(1024 * float(c)) + 100_000 for c in r.embedding] for r in rows])
    n, values, axes, far, centred = dense(x)
    want = centred @ axes[:, :8] / np.sqrt(values[:8])
    got = queries.op11_whitening(spark, SF)
    assert got.dtypes == [
        ("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"),
        ("whitened", "double"), ("explained", "double"), ("identity_error", "double"),
    ]
    cells = {(r.vec_id, r.component): r for r in got.collect()}
    assert len(cells) == 8 * n and {c.n for c in cells.values()} == {n}
    assert [cells[r.vec_id, 1].deviation for r in rows] == far
    equal_up_to_sign([[cells[r.vec_id, k].whitened for k in range(1, 9)] for r in rows], want)
    for k in range(1, 9):
        assert cells[rows[0].vec_id, k].explained == pytest.approx(values[k - 1] / values.sum(), rel=1e-9)
    assert cells[rows[0].vec_id, 1].identity_error < 1e-9


def test_components_settle_before_the_space_is_used_up(spark):
    rng = np.random.default_rng(3)
    scales = np.concatenate([[9e4, 5e4, 2e4], np.full(37, 30.0)])
    x = np.floor(rng.standard_normal((600, 40)) * scales).astype(np.int64) + 100_000
    n, values, axes, far, centred = dense(x)
    model, done = fitted(spark, x, 3)
    assert model.steps < 40
    equal_up_to_sign([r.whitened for r in done], centred @ axes[:, :3] / np.sqrt(values[:3]))
    assert [r.deviation for r in done] == [f if f < 1 << 63 else None for f in far]
    assert model.identity_error < 1e-9


def test_equal_deviations_are_all_found(spark):
    x = np.vstack([3 * np.eye(5, dtype=np.int64), -3 * np.eye(5, dtype=np.int64)])
    model, done = fitted(spark, x)
    assert np.allclose(model.deviations, math.sqrt(18 / 10)) and len(model.deviations) == 5
    assert model.identity_error < 1e-12
    assert {r.deviation for r in done} == {900}


def test_fewer_vectors_than_dimensions(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(-500, 500, (4, 7))
    _, values, _, far, _ = dense(x)
    model, done = fitted(spark, x)
    assert np.allclose(model.deviations**2, values[:3])
    assert [r.deviation for r in done] == far and model.identity_error < 1e-9


def test_rows_that_take_no_part(spark):
    odd = [
        (1, [1.0, 2.0, 3.0]), (2, None), (3, []), (4, [1.0, None, 2.0]), (5, [float("nan"), 1.0, 2.0]),
        (6, [float("inf"), 0.0, 1.0]), (7, [1.0, 2.0]), (8, [0.5, -2.0, 3.5]), (8, [0.5, -2.0, 3.5]),
        (None, [-1.0, 0.25, 2.0]), (9, [1e300, -1e300, 0.0]),
    ]
    df = spark.createDataFrame(odd, "vec_id long, embedding array<double>")
    rows = whitening.on_grid(df.withColumns({"X": F.lit(1), "Whitened": F.lit("a"), "note": F.lit("b")}), "embedding")
    model = whitening.fit(rows, 8)
    done = whitening.whiten(rows, model)
    assert done.columns == ["vec_id", "embedding", "note", "whitened", "deviation"]
    got = done.collect()
    assert model.n == 5 and sorted((r.vec_id or 0) for r in got) == [0, 1, 8, 8, 9]
    # The far row alone is beyond a long; the others still differ from the mean it moves.
    assert {r.deviation for r in got} == {None}
    assert model.identity_error < 1e-4


def test_grid_of_entries(spark):
    df = spark.createDataFrame([(1, [0.5, -0.5, 0.0004, -0.0004])], "vec_id long, embedding array<double>")
    assert whitening.on_grid(df, "embedding").first().x == [100_512, 99_488, 100_000, 99_999]


@pytest.mark.parametrize("vectors", [[], [[1, 2]], [[4, 4], [4, 4], [4, 4]]])
def test_nothing_to_whiten(spark, vectors):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, x array<long>")
    model = whitening.fit(rows)
    assert len(model.deviations) == 0 and model.identity_error == 0
    assert [(r.whitened, r.deviation) for r in whitening.whiten(rows, model).collect()] == [([], 0)] * len(vectors)
