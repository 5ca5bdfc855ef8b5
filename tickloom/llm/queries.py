"""The registered queries of the numbered operators, each over its whole table, beside its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import (
    aligned,
    ann,
    html,
    mixing,
    near,
    ordered,
    pieces,
    quality,
    repeats,
    tokenstore,
    toxicity,
    warc,
    whitening,
)
from tickloom.llm.common import materialise, scratch_path, table, word_count
from tickloom.llm.paths import vocabulary, word_pattern

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


#: Words in SQL, after the contract: runs of other than ASCII blanks.
SQL_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

QUALITY_SQL = rf"""
WITH base AS (SELECT doc_id, coalesce(text, '') AS text, {SQL_WORDS} AS w FROM documents),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM base),
line_counts AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines,
    count(*) FILTER (ends_with(line, '...') OR ends_with(line, '…')) AS n_ellipsis_lines
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1),
starts AS (
  SELECT doc_id, unnest(range(1, len(w) - 3)) AS i, w FROM base WHERE len(w) >= 5),
windows AS (SELECT doc_id, i, w[i:i + 4] AS run FROM starts),
repeated AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, run) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS k FROM repeated) GROUP BY 1),
counts AS (
  SELECT b.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_ellipsis_lines, 0) AS n_ellipsis_lines, coalesce(c.n, 0) AS n_repeat_words,
    len(list_intersect(w, ['{"', '".join(dict.fromkeys(quality.STOP_WORDS))}'])) AS n_stop_words
  FROM base b LEFT JOIN line_counts USING (doc_id) LEFT JOIN covered c USING (doc_id)),
judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 100 * word_chars <= 2500 * n_words AND 100 * n_symbols <= 30 * n_words
    AND 100 * n_dup_lines <= 50 * n_lines AND 100 * n_ellipsis_lines <= 30 * n_lines
    AND (n_stop_words >= 2 OR n_words <= 50) AS kept
FROM judged"""


@query()
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@query()
def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


@query(QUALITY_SQL)
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query()
def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    tokenstore.write_store(table(spark, sf_dir, "documents"), path, vocabulary("word_bpe_49k.json"))
    return tokenstore.read_store(spark, path).withColumnRenamed("key", "doc_id")


MIXING_SQL = rf"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, CAST(len({SQL_WORDS}) AS BIGINT) AS size,
    md5('mix' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS k FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS s FROM sized GROUP BY source),
weighted AS (
  SELECT source, s, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM per),
budget AS (SELECT 1.5::DOUBLE * sum(s) AS b, count(*) AS n FROM weighted),
fill AS (  -- the sources that are full, found round by round
  SELECT 0 AS round, []::VARCHAR[] AS filled, (SELECT b FROM budget) / (SELECT sum(w) FROM weighted) AS level
  UNION ALL
  SELECT round + 1, f2, level2 FROM (
    SELECT round, filled,
      (SELECT list(coalesce(source, chr(0)) ORDER BY source) FROM weighted WHERE w * level > 2 * s
         OR list_contains(filled, coalesce(source, chr(0)))) AS f2,
      ((SELECT b FROM budget) - (SELECT coalesce(sum(2 * s), 0) FROM weighted WHERE w * level > 2 * s
         OR list_contains(filled, coalesce(source, chr(0)))))
        / (SELECT sum(w) FROM weighted WHERE NOT (w * level > 2 * s
         OR list_contains(filled, coalesce(source, chr(0))))) AS level2
    FROM fill) WHERE len(f2) > len(filled)),
targets AS (
  SELECT source, s, least(2.0::DOUBLE * s, w * (SELECT level FROM fill ORDER BY round DESC LIMIT 1)) AS target
  FROM weighted),
queue AS (
  SELECT z.*, t.s, t.target, sum(size) OVER (PARTITION BY z.source ORDER BY k, size ROWS UNBOUNDED PRECEDING) AS upto
  FROM sized z JOIN targets t ON z.source IS NOT DISTINCT FROM t.source),
copies AS (
  SELECT doc_id, k, size, turn, (turn * s + upto) / target AS f FROM queue, (SELECT unnest([0, 1]) AS turn)
  WHERE size > 0 AND target > 0),
served AS (SELECT *, sum(size) OVER (ORDER BY f, k, turn ROWS UNBOUNDED PRECEDING) AS total FROM copies),
beyond AS (SELECT f, k, turn FROM served WHERE total > (SELECT floor(sum(target) + 1e-6) FROM targets)
  ORDER BY f, k, turn LIMIT 1),
taken AS (
  SELECT doc_id, sum(size) AS taken FROM served
  WHERE (SELECT count(*) FROM beyond) = 0 OR (f, k, turn) < (SELECT (f, k, turn) FROM beyond) GROUP BY 1)
SELECT q.doc_id, size, CAST(q.s AS BIGINT) AS source_size, round(target, 6) AS target,
  CAST(coalesce(taken, 0) AS BIGINT) AS taken
FROM queue q LEFT JOIN taken t ON q.doc_id = t.doc_id"""


@query(MIXING_SQL)
def op5_mix_to_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = materialise(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sized")
    return mixing.schedule(sized).select(
        "doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken"
    )


@query()
def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.digests(docs, vocabulary("piece_bpe_32k.model"))


@query()
def op7_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.summary(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query()
def op8_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), every=50, k=5)


@query()
def op9_minhash_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near.near_duplicates(docs, size=3, similarity=85)


@query()
def op10_warc_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    streams, archives = scratch_path(spark, "warc-streams"), scratch_path(spark, "warc")
    warc.write_streams(table(spark, sf_dir, "pages"), streams)
    warc.normalise(spark, streams, archives)
    return warc.read_records(spark, archives).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query()
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.on_grid(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "embedding")
    model = whitening.fit(rows.select("vec_id", "x"), k=8)
    done = whitening.whiten(rows.select(F.col("vec_id").cast("long"), "x"), model)
    explained = F.array(*(F.lit(float(e)) for e in model.explained)).cast("array<double>")
    return done.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )


@query()
def op12_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The place in its file tells rows under one id apart, and is the same at every read.
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long"), "text", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index")
    )
    found = ordered.edits(docs, by=["doc_id", "file", "row_index"])
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        ordered.as_text(F.col("components")).alias("fingerprint"),
        ordered.as_text(F.col("edited_components")).alias("edited_fingerprint"),
        ordered.likeness(F.col("components"), F.col("edited_components")).alias("near_edited"),
        ordered.likeness(F.col("components"), F.col("next_components")).alias("near_next"),
    )


@query()
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return aligned.summary(
        docs, vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"), word_pattern()
    )
