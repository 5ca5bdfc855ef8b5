"""Index build, batched retrieval and its evaluation."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import text as X
from tickloom.operators import embedding, evaluation, lookups, neighbours
from tickloom.schemas import EVALUATION_K, TOP_K
from tickloom.session import materialise, scratch_path, spread
from tickloom.sources import buckets, corpus, tables

PASSAGES = (
    "query_id string, rank int, id string, source string, text string, "
    "metadata map<string,string>, distance double"
)


def collection_path(index: str) -> str:
    return f"{index}/collection"


def collection(spark: SparkSession, index: str) -> DataFrame:
    return buckets.read(spark, collection_path(index))


def collection_ids(spark: SparkSession, index: str) -> DataFrame:
    return collection(spark, index).select("id")


def upsert_vectors(spark: SparkSession, index: str, new: DataFrame) -> buckets.Written:
    """Insert or replace entries by id, as one new version; only the buckets of these ids are stored anew."""
    return buckets.upsert(new, collection_path(index), "id")


def build_index(
    raw: DataFrame, index: str, chunking: bool = True, dimension: int = embedding.DIMENSION
) -> dict:
    """Chunk and embed the corpus (source, raw) and publish exactly its entries.

    Publishing the current ids only is the upsert and the removal of stale
    entries in one write, of the buckets that differ. An empty corpus changes nothing.
    """
    spark = raw.sparkSession
    cut = corpus.chunk_corpus(corpus.parse_documents(spread(raw)), chunking)
    chunks = materialise(embedding.count_words(cut, dimension), "chunks")
    count = chunks.count()
    if count == 0:
        return {"docs_indexed": 0, "collection": collection_path(index)}
    model = embedding.fit_embedder(chunks, dimension)
    try:
        stored = collection_ids(spark, index)
        stale = lookups.orphans(stored, chunks).count()
    except tables.TableUnavailable:
        stale = 0
    # The model lies under a name of its own, which the version that needs it carries.
    saved = f"{index}/models/{uuid.uuid4().hex}"
    embedding.save_embedder(model, saved)
    # Dealt before they are vectors: word counts are a fraction of their size.
    placed = buckets.place(chunks, collection_path(index), "id")
    buckets.publish(embedding.embed(model, placed), collection_path(index), "id", notes={"model": saved})
    return {
        "docs_indexed": count,
        "stale_removed": stale,
        "embedding_dim": dimension,
        "collection": collection_path(index),
        "collection_count": buckets.read_state(spark, collection_path(index)).rows,
    }


def passages(collection: DataFrame, embedded: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest entries of each embedded query with their text, source and distance."""
    hits = neighbours.nearest(collection.select("id", "embedding"), embedded, k)
    entries = collection.select("id", "text", "metadata")
    found = hits.join(entries, "id")
    source = X.passage_source(F.col("metadata"), F.col("id"))
    return found.select(
        "query_id", "rank", "id", source.alias("source"), "text", "metadata", "distance"
    )


def retrieve(spark: SparkSession, index: str, queries: DataFrame, k: int = TOP_K) -> DataFrame:
    """Passages for every row of ``queries`` (query_id, text); none when there is no index yet."""
    try:
        state = buckets.read_state(spark, collection_path(index))
    except tables.TableUnavailable:
        return spark.createDataFrame([], PASSAGES)
    model: PipelineModel = embedding.load_embedder(state.notes["model"])
    return passages(collection(spark, index), embedding.embed(model, queries), k)


def evaluate(raw: DataFrame, questions: DataFrame, top_k: int = EVALUATION_K, chunking: bool = True) -> DataFrame:
    """Scores of ``questions`` (id, question, expected) over a fresh index of the corpus, as one row."""
    spark = raw.sparkSession
    index = scratch_path(spark, "evaluation")
    build = build_index(raw, index, chunking)
    files = raw.select("source").distinct().count()
    asked = questions.select(F.col("id").alias("query_id"), F.col("question").alias("text"))
    found = retrieve(spark, index, asked, min(top_k, max(files, 1)))
    scores = evaluation.retrieval_scores(evaluation.label_rank(questions, found))
    return scores.withColumns(
        {
            "corpus_documents": F.lit(files).cast("long"),
            "embedding_dim": F.lit(build.get("embedding_dim")).cast("int"),
        }
    )
