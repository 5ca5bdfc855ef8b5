"""Text vectors from a fitted Spark ML model: hashed word counts, weighted by rarity, unit length."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.feature import IDF, CountVectorizerModel, Normalizer, SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DIMENSION = 768
COUNTS = "_counts"
#: Texts whose counts are in memory at once.
COUNTED_TEXTS = 1024

# Lower-case runs of letters and digits; a word's slot is its CRC-32 modulo the dimension.
SLOTS = r"""SELECT *, transform(regexp_extract_all(lower(text), r'[\p{L}\p{N}]+', 0),
  w -> CAST(crc32(w) % %DIM% AS STRING)) AS _slots FROM __THIS__"""


def _counting(dimension: int) -> list:
    slots = SQLTransformer(statement=SLOTS.replace("%DIM%", str(dimension)))
    vocabulary = [str(slot) for slot in range(dimension)]
    counts = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="_slots", outputCol=COUNTS)
    return [slots, counts]


@cache
def _word_characters() -> str:
    """All letters and digits by the tables of the JVM, which may be of another Unicode version than Python's."""
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    return SparkSession.active()._jvm.java.util.regex.Pattern.compile(r"[^\p{L}\p{N}]+").matcher(every).replaceAll("")


def _counted(text: Column, dimension: int) -> Column:
    """What the model's counting stages make of a text, in Arrow batches."""
    known = _word_characters()
    # Characters that Python's tables tell otherwise lie in these ranges, far from most texts.
    odd, between = re.compile("[\u0870-\u1fff\u2c00-\U0010ffff]"), re.compile(r"[^\x00-\x7f\w]+")
    blanked = bytes(i if i > 127 or chr(i).isalnum() else 32 for i in range(256))

    def counts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import numpy as np

        held = None
        for batch in batches:
            if batch.null_count:
                raise ValueError("a text to count the words of is null")
            sizes, indices, values = [], [], []
            for start in range(0, len(batch), COUNTED_TEXTS):
                lengths, words = [], []
                for text in batch.slice(start, COUNTED_TEXTS).to_pylist():
                    if not text.isascii():
                        if odd.search(text):
                            held = held or frozenset(known)
                            text = "".join([c if c in held else " " for c in text])
                        else:
                            text = between.sub(" ", text)
                    found = text.encode().translate(blanked).split()
                    lengths.append(len(found))
                    words += found
                rows = np.repeat(np.arange(len(lengths)), lengths)
                slots = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % dimension
                times = np.bincount(rows * dimension + slots, minlength=len(lengths) * dimension)
                at = np.flatnonzero(times)
                sizes.append(np.bincount(at // dimension, minlength=len(lengths)))
                indices.append((at % dimension).astype(np.int32))
                values.append(times[at].astype(np.float64))
            n, joined = len(batch), [np.concatenate(x) if x else np.empty(0) for x in (sizes, indices, values)]
            offsets = pa.array(np.concatenate([[0], np.cumsum(joined[0])]).astype(np.int32))
            parts = [
                pa.array(np.zeros(n, dtype=np.int8)), pa.array(np.full(n, dimension, dtype=np.int32)),
                pa.ListArray.from_arrays(offsets, pa.array(joined[1].astype(np.int32))), pa.ListArray.from_arrays(offsets, pa.array(joined[2])),
            ]
            yield pa.StructArray.from_arrays(parts, names=["type", "size", "indices", "values"])

    return F.arrow_udf(counts, VectorUDT())(F.lower(text))


def count_words(texts: DataFrame, dimension: int = DIMENSION) -> DataFrame:
    """The rows with their slot counts, so that fitting and embedding read each text once."""
    return texts.withColumn(COUNTS, _counted(F.col("text"), dimension))


def fit_embedder(texts: DataFrame, dimension: int = DIMENSION) -> PipelineModel:
    """Learn the slot weights from the ``text`` column; the model holds ``dimension`` numbers.

    Slots come from a standard checksum, so the same text gets the same slots in
    any engine. A slot found in d of n texts weighs ln((n + 1) / (d + 1)).
    """
    counted = texts if COUNTS in texts.columns else count_words(texts, dimension)
    weights = IDF(inputCol=COUNTS, outputCol="_weighted").fit(counted.select(COUNTS))
    unit = Normalizer(inputCol="_weighted", outputCol="_unit", p=2.0)
    return PipelineModel([*_counting(dimension), weights, unit])


def embed(model: PipelineModel, texts: DataFrame) -> DataFrame:
    """The rows of ``texts`` with the vector of their ``text`` as ``embedding``."""
    if COUNTS not in texts.columns:
        texts = count_words(texts, len(model.stages[1].vocabulary))
    for stage in model.stages[2:]:
        texts = stage.transform(texts)
    vector = vector_to_array("_unit", "float32")
    return texts.withColumn("embedding", vector).drop(COUNTS, "_weighted", "_unit")


def save_embedder(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_embedder(path: str) -> PipelineModel:
    return PipelineModel.load(path)
