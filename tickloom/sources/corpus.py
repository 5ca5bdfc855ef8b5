"""Markdown corpora: files or a landed table in, parsed documents and chunks out."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import text as X
from tickloom.functions import times as TM
from tickloom.operators.summaries import union_all
from tickloom.sources import files, tables

RAW = "source string, raw string"


def read_markdown_corpus(
    spark: SparkSession, path: str, glob: str = "*.md", source: Column | None = None
) -> DataFrame:
    """(source, raw) for every matching file of a folder, not of its sub-folders; none if it is missing.

    The source is the file name unless ``source`` derives it from the path otherwise.
    """
    try:
        texts = files.read_whole(spark, path, glob)
        if texts is None:
            texts = spark.read.text(path, wholetext=True, pathGlobFilter=glob)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], RAW)
    return texts.select(
        (F.col("_metadata.file_name") if source is None else source).alias("source"), X.plain_newlines(F.col("value")).alias("raw")
    )


def write_markdown_corpus(raw: DataFrame, path: str) -> None:
    """One text file per document (source, raw) under a ``source=...`` folder of its own."""
    placed = raw.select("source", "raw").repartition("source")
    if files.local_path(raw.sparkSession, path):
        files.write_lines(placed.sortWithinPartitions("source"), path, "source", F.col("raw"), ".txt")
    else:
        placed.write.partitionBy("source").text(path)


def union_corpus(context: DataFrame, briefings: DataFrame) -> DataFrame:
    return union_all([context, briefings])


def sorted_corpus(raw: DataFrame) -> DataFrame:
    return raw.orderBy("source")


def parse_documents(raw: DataFrame) -> DataFrame:
    """(id, source, text, metadata); the source always overrides a front-matter key of that name."""
    metadata = X.with_entry(X.front_matter(F.col("raw")), "source", F.col("source"))
    return raw.select(
        F.col("source").alias("id"), "source", X.body_text(F.col("raw")).alias("text"), metadata.alias("metadata")
    )


def chunk_corpus(documents: DataFrame, chunking: bool = True) -> DataFrame:
    """(id, source, chunk_no, text, metadata), one row per chunk numbered from 0 in its document.

    A document without a chunk that is long enough stays whole, with a null
    number, as does every document when ``chunking`` is off. The work is local
    to each row: nothing is shuffled to number the chunks.
    """
    if not chunking:
        return documents.select(
            "id", "source", F.lit(None).cast("int").alias("chunk_no"), "text", "metadata"
        )
    title = F.coalesce(F.try_element_at(F.col("metadata"), F.lit("title")), F.lit(""))
    cut = documents.select(
        "id",
        "source",
        F.col("text").alias("whole"),
        "metadata",
        F.posexplode_outer(X.chunk_texts(title, F.col("text"))).alias("chunk_no", "piece"),
    )
    split = F.col("chunk_no").isNotNull()
    number = F.col("chunk_no").cast("string")
    return cut.select(
        F.when(split, F.concat("id", F.lit("#"), number)).otherwise(F.col("id")).alias("id"),
        "source",
        "chunk_no",
        F.when(split, F.col("piece")).otherwise(F.col("whole")).alias("text"),
        F.when(split, X.with_entry(F.col("metadata"), "chunk", number))
        .otherwise(F.col("metadata"))
        .alias("metadata"),
    )


def render_briefings(briefings: DataFrame) -> DataFrame:
    """(source, raw) markdown for rows of (ticker, text, sources, generated_at)."""
    at = F.col("generated_at")
    raw = F.concat(
        F.lit("---\ntype: briefing\nticker: "),
        "ticker",
        F.lit("\ndate: "),
        TM.iso_date(at),
        F.lit("\nsources: "),
        X.sources_line(F.col("sources")),
        F.lit("\n---\n"),
        X.strip(F.col("text")),
        F.lit("\n"),
    )
    name = F.concat("ticker", F.lit("_"), TM.file_stamp(at), F.lit(".md"))
    return briefings.select(name.alias("source"), raw.alias("raw"))


def append_briefings(briefings: DataFrame, path: str) -> int | None:
    """Add generated briefings to the stored corpus, from where the next index build reads them."""
    return tables.append_version(render_briefings(briefings), path)


def read_briefings(spark: SparkSession, path: str) -> DataFrame:
    """The stored briefings; none when nothing was stored yet."""
    try:
        return tables.read_table(spark, path).rows
    except tables.TableUnavailable:
        return spark.createDataFrame([], RAW)
