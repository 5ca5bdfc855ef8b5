"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Features are the distinct n-grams of a lower-cased text, hashed. On a bounded
sample of labelled rows, presence counts per class give each feature its
log-count ratio; the features that part the classes most clearly are kept and a
logistic regression is fitted on the ratios. Scoring reads whole texts and needs
the weights only, a table of fixed size.

Defined cases: null and empty texts hold no n-gram and get the score of the
intercept. Labels that are null or without a document are left out; repeated
labels of a document count once, as toxic if any is. Without rows of both
classes every score is 1 if all labels are toxic, else 0. A null id is never held
out. Repeated rows get equal scores; only the text decides a score.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import U64, arrow_map, materialise, mixed

#: At most so many labelled rows are fitted on: toxic ones first, up to half of it, then
#: others, each by the smallest id hashes. Their weights restore the shares of all labels.
SAMPLE_ROWS = 10_000
#: What a toxic row weighs beyond that: misses are dearer than false alarms.
TOXIC_WEIGHT = 2.0
ORDERS = (3, 4, 5)
BITS = 20
#: Features kept for the regression: so many per toxic row of the sample, and at most.
KEPT_PER_ROW = 3
KEPT = 1 << 12
SMOOTHING = 1.0
RIDGE = 1e-3
STEPS = 250
FOLDS = 5


class Model(NamedTuple):
    """Weights per hashed feature (zero: not a feature) and the intercept."""

    weights: np.ndarray
    intercept: float


def held_out(doc_id: Column) -> Column:
    """Rows that are never learnt from: the id's checksum is divisible by five."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def features(text: str | None) -> np.ndarray:
    """Hashed n-grams of a text, repeats included."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(U64)
    found, rolling = [], np.zeros(len(points), dtype=U64)
    for order in range(1, max(ORDERS) + 1):
        n = len(points) - order + 1
        if n <= 0:
            break
        rolling = rolling[:n] * U64(0x100000001B3) + points[order - 1 :] + U64(order)
        if order in ORDERS:
            found.append(mixed(rolling + U64(order)) >> U64(64 - BITS))
    return np.concatenate(found).astype(np.int64) if found else np.empty(0, dtype=np.int64)


def labelled(labels: DataFrame) -> DataFrame:
    """doc_id, toxic (1 or 0) of the labels that may be learnt from."""
    return (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max((F.col("toxic") != 0).cast("int")).alias("toxic"))
    )


def sample(docs: DataFrame, known: DataFrame) -> DataFrame:
    """text, toxic of at most ``SAMPLE_ROWS`` rows of ``known``.

    The sample of ids is bounded, so it can go to every task and the documents stay where they are.
    """

    def first(toxic: int, n: int) -> DataFrame:
        return known.where(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)

    bad = first(1, SAMPLE_ROWS // 2)
    ids = bad.union(first(0, SAMPLE_ROWS - bad.count()))
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("text", "toxic")


def class_counts(rows: DataFrame) -> DataFrame:
    """feature, n (rows that hold it), toxic (of those, toxic ones); a task adds up its rows first."""

    def counted(found: Iterator[tuple]) -> Iterable[tuple]:
        totals = np.zeros((2, 1 << BITS), dtype=np.int64)
        for text, toxic in found:
            present = np.unique(features(text))
            totals[0, present] += 1
            if toxic:
                totals[1, present] += 1
        held = np.flatnonzero(totals[0])
        yield from zip(held.tolist(), totals[0, held].tolist(), totals[1, held].tolist(), strict=True)

    partial = arrow_map(rows, counted, "feature long, n long, toxic long", rows=1 << 16)
    return partial.groupBy("feature").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    known = materialise(labelled(labels), "labels")
    rows = materialise(sample(docs, known), "labelled")
    total, bad = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.when(F.col("toxic") != 0, 1)), F.lit(0))).first()
    weights = np.zeros(1 << BITS, dtype=np.float32)
    if not 0 < bad < total:
        return Model(weights, float("inf") if bad else float("-inf"))
    good = total - bad
    apart = (
        F.abs(F.col("toxic") / bad - (F.col("n") - F.col("toxic")) / good)
        / F.sqrt(F.col("n") / total * (1 - F.col("n") / total) + F.lit(1.0 / total))
    )
    counts = class_counts(rows).where("n >= 3").orderBy(apart.desc(), "feature").limit(min(KEPT, KEPT_PER_ROW * bad)).collect()
    if not counts:
        return Model(weights, float(np.log(bad / good)))
    kept = np.array([c.feature for c in counts])
    with_it = np.array([c.toxic for c in counts], dtype=float)
    without = np.array([c.n for c in counts], dtype=float) - with_it
    ratios = np.log((with_it + SMOOTHING) / (bad + 2 * SMOOTHING)) - np.log(
        (without + SMOOTHING) / (good + 2 * SMOOTHING)
    )
    place = np.full(1 << BITS, -1, dtype=np.int32)
    place[kept] = np.arange(len(kept))

    def present(found: Iterator[tuple]) -> Iterable[tuple]:
        for text, toxic in found:
            held = np.unique(place[features(text)])
            yield int(bool(toxic)), held[held >= 0].astype("<i4").tobytes()

    chosen = arrow_map(rows, present, "toxic int, held binary").collect()
    columns = [np.frombuffer(bytes(r.held), dtype="<i4") for r in chosen]
    toxic = np.array([r.toxic for r in chosen], dtype=float)
    all_bad, all_good = known.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first()
    weighed = np.where(toxic > 0, TOXIC_WEIGHT * all_bad / bad, all_good / good)
    betas, intercept = regress(columns, toxic, ratios, weighed / weighed.sum())
    weights[kept] = betas * ratios
    return Model(weights, intercept)


def regress(
    columns: list[np.ndarray], toxic: np.ndarray, ratios: np.ndarray, weighed: np.ndarray
) -> tuple[np.ndarray, float]:
    """Logistic regression on log-count ratios, by Adam steps over all rows of the sample; ``weighed`` adds up to 1."""
    lengths = np.array([len(c) for c in columns])
    column, row = np.concatenate(columns), np.repeat(np.arange(len(columns), dtype=np.int32), lengths)
    rows, width = len(columns), len(ratios)
    betas, intercept = np.zeros(width), float(np.log(weighed @ toxic / (weighed @ (1 - toxic))))
    moment, square = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, STEPS + 1):
        margin = np.bincount(row, weights=(ratios * betas)[column], minlength=rows) + intercept
        error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - toxic) * weighed
        gradient = np.append(
            ratios * np.bincount(column, weights=error[row], minlength=width) + RIDGE * betas, error.sum()
        )
        moment = 0.9 * moment + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        move = 0.02 * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
        betas -= move[:-1]
        intercept -= float(move[-1])
    return betas, intercept


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    weights, intercept = model
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def scored(found: Iterator[tuple]) -> Iterable[tuple]:
        table = shared.value
        for doc_id, out, text in found:
            at = features(text)
            at = np.unique(at[table[at] != 0])
            margin = float(table[at].sum(dtype=np.float64)) + intercept
            yield doc_id, out, float(1 / (1 + np.exp(-np.clip(margin, -700, 700)))) if np.isfinite(margin) else float(margin > 0)

    rows = docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")), "text")
    result = arrow_map(rows, scored, "doc_id long, held_out boolean, score double")
    return result.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
