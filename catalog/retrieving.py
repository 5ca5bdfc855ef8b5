"""Chunking, vectors, nearest neighbours, evaluation, prompts and news."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.derive import BLANKS, CHUNKS, LATEST_BARS, MARKDOWN, SECTIONS, markdown, table
from catalog.market import bars, curated
from catalog.registry import query, rounded
from tickloom.functions import columns as C
from tickloom.functions import text as X
from tickloom.operators import embedding, evaluation, lookups, neighbours, ordering, summaries
from tickloom.plans import prompts, retrieval
from tickloom.schemas import MIN_QUESTIONS_PER_DOCUMENT, TOP_K
from tickloom.session import materialise, scratch_path
from tickloom.sources import buckets, corpus, evalset, news


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.parse_documents(markdown(spark, sf_dir))


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.chunk_corpus(documents(spark, sf_dir))


@query(f"WITH {MARKDOWN} SELECT source, raw FROM markdown")
def read_markdown_corpus(spark, sf_dir):
    """One text file per document, read back whole; the folder name carries the source."""
    path = scratch_path(spark, "files")
    corpus.write_markdown_corpus(markdown(spark, sf_dir), path)
    folder = F.regexp_extract(F.col("_metadata.file_path"), "/source=([^/]+)/", 1)
    files = corpus.read_markdown_corpus(spark, f"{path}/*", "*.txt", folder)
    return files.withColumn("raw", F.regexp_replace("raw", r"\n\z", ""))


@query(f"WITH {MARKDOWN} SELECT source, type, title, lang, body FROM parsed_docs")
def split_front_matter(spark, sf_dir):
    meta = F.col("metadata")
    return documents(spark, sf_dir).select(
        "source", *[F.try_element_at(meta, F.lit(k)).alias(k) for k in ("type", "title", "lang")],
        F.col("text").alias("body"),
    )


@query(f"WITH {SECTIONS} SELECT source, heading, text FROM sections")
def split_sections(spark, sf_dir):
    cut = documents(spark, sf_dir).select("source", F.explode(X.sections(F.col("text"))).alias("s"))
    return cut.select("source", "s.heading", "s.text")


@query(f"WITH {CHUNKS} SELECT source, heading, piece FROM piece_rows")
def split_bullets(spark, sf_dir):
    cut = documents(spark, sf_dir).select("source", F.explode(X.section_pieces(F.col("text"))).alias("s"))
    return cut.select("source", "s.heading", F.explode("s.pieces").alias("piece"))


@query(f"WITH {CHUNKS} SELECT id, source, chunk_no, text FROM chunks")
def chunk_corpus(spark, sf_dir):
    return chunks(spark, sf_dir).drop("metadata")


@query(f"WITH {CHUNKS} SELECT source, max(chunk_no) AS last_chunk, count(*) AS chunks FROM chunks GROUP BY 1")
def chunk_number(spark, sf_dir):
    return chunks(spark, sf_dir).groupBy("source").agg(
        F.max("chunk_no").alias("last_chunk"), F.count(F.lit(1)).alias("chunks")
    )


@query(f"WITH {MARKDOWN} SELECT source AS id, source, CAST(NULL AS INTEGER) AS chunk_no, body AS text FROM parsed_docs")
def chunking_off(spark, sf_dir):
    return corpus.chunk_corpus(documents(spark, sf_dir), chunking=False).drop("metadata")


@query("SELECT doc_id, text FROM documents WHERE length(text) >= 80")
def min_length(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.filter(X.long_enough(F.col("text"))).select("doc_id", "text")


@query(f"WITH {MARKDOWN} SELECT source, raw FROM markdown ORDER BY source")
def sorted_corpus(spark, sf_dir):
    return corpus.sorted_corpus(markdown(spark, sf_dir))


@query("SELECT page_id, list_last(string_split(url, '/')) AS file_name FROM pages")
def file_name(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", X.file_name(F.col("url")).alias("file_name"))


@query("""WITH words AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM documents)
SELECT doc_id, array_to_string(w[i:i+4], ' ') AS gram FROM (
  SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM words)""")
def five_grams(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(X.n_grams(F.col("text"))).alias("gram"))


@query("SELECT doc_id, replace('$' || text, '$', '\\$') AS text FROM documents")
def escape_dollar(spark, sf_dir):
    priced = F.concat(F.lit("$"), F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", X.escape_dollar(priced).alias("text"))


@query(f"""WITH {LATEST_BARS} SELECT DISTINCT "Ticker", "Ticker" || ' market context technical analysis' AS question
FROM raw_bars""")
def retrieval_query(spark, sf_dir):
    names = bars(spark, sf_dir).select("Ticker").distinct()
    return names.select("Ticker", X.retrieval_query(F.col("Ticker")).alias("question"))


# Vectors -------------------------------------------------------------------


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label")


def centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean vector of each label and of each of eight groups in it, as queries over the whole table."""
    at = vectors(spark, sf_dir).select(
        (F.col("label") * 8 + F.col("id") % 8).alias("query_id"), "label", F.posexplode("embedding").alias("pos", "x")
    )
    means = at.groupBy("query_id", "label", "pos").agg(F.round(F.avg(F.col("x").cast("double")), 6).alias("x"))
    whole = means.groupBy("query_id", "label").agg(F.array_sort(F.collect_list(F.struct("pos", "x"))).alias("v"))
    return whole.select("query_id", "label", F.transform("v", lambda e: e["x"]).alias("embedding"))


CENTROIDS = """spread AS (
  SELECT label * 8 + vec_id % 8 AS query_id, label, unnest(embedding)::DOUBLE AS x, unnest(range(64)) AS pos
  FROM embeddings),
means AS (SELECT query_id, label, pos, round(avg(x), 6) AS x FROM spread GROUP BY 1, 2, 3),
centroids AS (SELECT query_id, label, list(x ORDER BY pos) AS v FROM means GROUP BY 1, 2)"""


def ranking_sql(queries: str, k: int) -> str:
    return f"""pairs AS (
  SELECT q.query_id, e.vec_id AS id, e.label AS source,
    list_sum(list_transform(list_zip(q.v, e.embedding), lambda p: (p[1] - p[2]::DOUBLE) * (p[1] - p[2]::DOUBLE))) AS distance
  FROM {queries} q, embeddings e),
ranking AS (SELECT query_id, CAST(rank AS INTEGER) AS rank, id, source, distance FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM pairs) WHERE rank <= {k})"""


def neighbours_of_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neighbours.nearest(vectors(spark, sf_dir), centroids(spark, sf_dir), TOP_K)
    return found.join(vectors(spark, sf_dir).select("id", F.col("label").alias("source")), "id")


NEAREST = "query_id, rank, id, round(distance, 6) AS distance"


@query(f"WITH {CENTROIDS}, {ranking_sql('centroids', 6)} SELECT {NEAREST} FROM ranking")
def nearest(spark, sf_dir):
    return rounded(neighbours.nearest(vectors(spark, sf_dir), centroids(spark, sf_dir), TOP_K), 6, "distance")


EVERY_VECTOR = "every AS (SELECT vec_id AS query_id, embedding::DOUBLE[] AS v FROM embeddings)"


@query(f"WITH {EVERY_VECTOR}, {ranking_sql('every', 6)} SELECT {NEAREST} FROM ranking")
def nearest_of_every_vector(spark, sf_dir):
    """Every vector asks, in small blocks, so cells are cut on both sides."""
    asked = vectors(spark, sf_dir).select(F.col("id").alias("query_id"), "embedding")
    found = neighbours.nearest(
        vectors(spark, sf_dir), asked, TOP_K, query_bytes=16 * 1024, corpus_bytes=16 * 1024
    )
    return rounded(found, 6, "distance")


@query(f"WITH {CENTROIDS}, {ranking_sql('centroids', 3)} SELECT query_id, rank, id FROM ranking")
def top_k(spark, sf_dir):
    return neighbours.nearest(vectors(spark, sf_dir), centroids(spark, sf_dir), 3).drop("distance")


@query(f"""WITH {CENTROIDS} SELECT e.vec_id AS id, round(list_sum(list_transform(list_zip(c.v, e.embedding),
  lambda p: (p[1] - p[2]::DOUBLE) * (p[1] - p[2]::DOUBLE))), 6) AS distance
FROM embeddings e JOIN centroids c ON c.query_id = e.label * 8 + e.vec_id % 8""")
def l2_squared(spark, sf_dir):
    own = vectors(spark, sf_dir).withColumn("query_id", F.col("label") * 8 + F.col("id") % 8)
    means = centroids(spark, sf_dir).select("query_id", F.col("embedding").alias("mean"))
    gap = C.l2_squared(F.col("mean"), F.col("embedding"))
    return own.join(means, "query_id").select("id", F.round(gap, 6).alias("distance"))


RANKS = f"""WITH {CENTROIDS}, {ranking_sql('centroids', 6)}, ranks AS (
  SELECT c.query_id AS id, c.label AS expected, min(r.rank) AS rank
  FROM centroids c LEFT JOIN ranking r ON r.query_id = c.query_id AND r.source = c.label GROUP BY 1, 2)"""


def ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = centroids(spark, sf_dir).select(F.col("query_id").alias("id"), F.col("label").alias("expected"))
    return evaluation.label_rank(asked, neighbours_of_centroids(spark, sf_dir))


@query(f"{RANKS} SELECT * FROM ranks")
def label_rank(spark, sf_dir):
    return ranks(spark, sf_dir)


@query(f"{RANKS} SELECT id, coalesce(1.0::DOUBLE / rank, 0) AS reciprocal_rank FROM ranks")
def reciprocal_rank(spark, sf_dir):
    return ranks(spark, sf_dir).select("id", C.reciprocal_rank(F.col("rank")).alias("reciprocal_rank"))


@query(f"""{RANKS} SELECT count(*) AS questions, count(*) FILTER (WHERE rank <= 1) AS hit_at_1,
  count(*) FILTER (WHERE rank <= 3) AS hit_at_3,
  round(count(*) FILTER (WHERE rank <= 1) / count(*), 4) AS precision_at_1,
  round(count(*) FILTER (WHERE rank <= 3) / count(*), 4) AS hit_rate_at_3,
  round(avg(coalesce(1.0::DOUBLE / rank, 0)), 4) AS mrr FROM ranks""")
def retrieval_scores(spark, sf_dir):
    return evaluation.retrieval_scores(ranks(spark, sf_dir))


@query(f"""{RANKS} SELECT k::INTEGER AS k, avg((coalesce(rank, 99) <= k)::INTEGER) AS hit_rate
FROM ranks, (VALUES (1), (2), (3), (6)) t(k) GROUP BY 1""")
def hit_at_k(spark, sf_dir):
    return evaluation.hit_at_k(ranks(spark, sf_dir), [1, 2, 3, 6])


@query(f"""WITH {CENTROIDS}, {ranking_sql('centroids', 6)}, per AS (
  SELECT r.query_id, sum(length(d.text)) AS characters, count(*) AS passages
  FROM ranking r JOIN documents d ON d.doc_id = r.id GROUP BY 1)
SELECT count(*) AS queries, round(avg(characters), 6) AS mean_characters, round(avg(passages), 6) AS mean_passages FROM per""")
def context_size(spark, sf_dir):
    texts = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    size = evaluation.context_size(neighbours_of_centroids(spark, sf_dir).join(texts, "id"))
    return rounded(size, 6, "mean_characters", "mean_passages")


@query("SELECT count(*) AS collection_count, CAST(max(len(embedding)) AS INTEGER) AS embedding_dim FROM embeddings")
def index_summary(spark, sf_dir):
    return evaluation.index_summary(vectors(spark, sf_dir))


# The stored collection -------------------------------------------------------

NEW_ENTRIES = """entries AS (
  SELECT 'old' AS kind, vec_id AS id, label FROM embeddings WHERE label < 7
  UNION ALL SELECT 'new', vec_id, label + 100 FROM embeddings WHERE label > 3)"""


def two_loads(spark: SparkSession, sf_dir: str) -> str:
    """Labels below 7 stored first, then labels above 3 upserted with another label."""
    index = scratch_path(spark, "index")
    rows = vectors(spark, sf_dir)
    retrieval.upsert_vectors(spark, index, rows.filter("label < 7"))
    retrieval.upsert_vectors(spark, index, rows.filter("label > 3").withColumn("label", F.col("label") + 100))
    return index


@query(f"""WITH {NEW_ENTRIES} SELECT id, label FROM entries WHERE kind = 'new'
UNION ALL SELECT id, label FROM entries WHERE kind = 'old' AND id NOT IN (SELECT id FROM entries WHERE kind = 'new')""")
def upsert_vectors(spark, sf_dir):
    return retrieval.collection(spark, two_loads(spark, sf_dir)).select("id", "label")


@query("""SELECT count(DISTINCT vec_id) AS entries, true AS other_buckets_kept, true AS same_rows_store_nothing FROM embeddings""")
def untouched_buckets(spark, sf_dir):
    """One label's entries change: the buckets without them keep their files."""
    index = scratch_path(spark, "buckets")
    rows = vectors(spark, sf_dir)
    retrieval.upsert_vectors(spark, index, rows)
    path = retrieval.collection_path(index)
    before = buckets.read_state(spark, path)
    changed = rows.filter(F.col("label") == 3).withColumn("label", F.lit(103))
    hit = set(buckets.touched(changed, before))
    retrieval.upsert_vectors(spark, index, changed)
    after = buckets.read_state(spark, path)
    kept = all(after.live[b] == before.live[b] for b in before.live if b not in hit)
    again = retrieval.upsert_vectors(spark, index, changed)
    return spark.range(1).select(
        F.lit(after.rows).cast("long").alias("entries"),
        F.lit(kept and all(after.live[b] == after.version for b in hit)).alias("other_buckets_kept"),
        F.lit(again.stored == 0).alias("same_rows_store_nothing"),
    )


@query("SELECT vec_id AS id FROM embeddings")
def collection_ids(spark, sf_dir):
    return retrieval.collection_ids(spark, two_loads(spark, sf_dir))


@query(f"WITH {CHUNKS} SELECT id FROM chunks WHERE source IN (SELECT source FROM markdown WHERE lang = 'es')")
def orphans(spark, sf_dir):
    """Every chunk is stored; the Spanish documents are gone from the corpus."""
    left = table(spark, sf_dir, "documents").filter("lang <> 'es'").select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(".md")).alias("source")
    )
    current = chunks(spark, sf_dir).join(left, "source", "left_semi")
    return lookups.orphans(chunks(spark, sf_dir).select("id"), current)


@query(f"WITH {MARKDOWN} SELECT source, raw FROM markdown UNION ALL SELECT 'b' || item_id || '.md', text FROM benchmark")
def union_corpus(spark, sf_dir):
    briefings = table(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("b"), F.col("item_id").cast("string"), F.lit(".md")).alias("source"), F.col("text").alias("raw")
    )
    return corpus.union_corpus(markdown(spark, sf_dir), briefings)


@query("SELECT doc_id AS id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def id_difference(spark, sf_dir):
    have = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))
    return lookups.not_in(have, table(spark, sf_dir, "labels"), "id", "doc_id")


# Question sets ----------------------------------------------------------------

QUESTIONS = """questions AS (
  SELECT 'c' || conv_id || '-' || turn AS id, text AS question, 'd' || conv_id * 15 || '.md' AS expected
  FROM conversations)"""


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation turn as a question for one document; some of those do not exist."""
    return table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("id"),
        F.col("text").alias("question"),
        F.concat(F.lit("d"), (F.col("conv_id") * 15).cast("string"), F.lit(".md")).alias("expected"),
    )


@query(f"WITH {MARKDOWN}, {QUESTIONS} SELECT id, expected FROM questions WHERE expected NOT IN (SELECT source FROM markdown)")
def missing_labels(spark, sf_dir):
    return evaluation.missing_labels(questions(spark, sf_dir), markdown(spark, sf_dir)).select("id", "expected")


@query(f"WITH {MARKDOWN}, {QUESTIONS} SELECT source FROM markdown WHERE source NOT IN (SELECT expected FROM questions)")
def unasked_documents(spark, sf_dir):
    return evaluation.unasked_documents(markdown(spark, sf_dir), questions(spark, sf_dir))


@query(f"""WITH {QUESTIONS} SELECT expected, count(*) AS "count", count(*) < 3 AS too_few FROM questions GROUP BY 1""")
def label_balance(spark, sf_dir):
    return summaries.label_balance(questions(spark, sf_dir), MIN_QUESTIONS_PER_DOCUMENT)


@query("""SELECT user_id AS id, count(*) AS "count" FROM events GROUP BY 1 HAVING count(*) > 1""")
def duplicate_ids(spark, sf_dir):
    return summaries.duplicate_ids(table(spark, sf_dir, "events").select(F.col("user_id").alias("id")))


@query("""WITH questions AS (
  SELECT item_id AS id, regexp_extract_all(lower(text), '[a-z0-9]+') AS w, 'src' || item_id % 20 AS expected FROM benchmark),
grams AS (SELECT id, expected, array_to_string(w[i:i+4], ' ') AS gram FROM (
  SELECT *, unnest(range(1, len(w) - 3)) AS i FROM questions)),
pairs AS (SELECT g.id, d.doc_id, count(*) AS quotes FROM grams g JOIN documents d ON d.source = g.expected
  WHERE contains(lower(d.text), g.gram) GROUP BY 1, 2)
SELECT id, max(quotes) AS quotes, count(*) AS matching_texts FROM pairs GROUP BY 1""")
def quoted_questions(spark, sf_dir):
    asked = table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("id"),
        F.col("text").alias("question"),
        F.concat(F.lit("src"), (F.col("item_id") % 20).cast("string")).alias("expected"),
    )
    return lookups.quoted_questions(asked, table(spark, sf_dir, "documents").select("source", "text"))


# Prompts and briefings ----------------------------------------------------------

SHOWN = ["Date", "Open", "High", "Low", "Close", "Volume"]


def recent_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.latest_n(bars(spark, sf_dir), ["Ticker"], ["Date"], 5, presort=False)


def _cell(name: str) -> str:
    value = f'CAST("{name}" AS VARCHAR)'
    return f"""lpad({value}, CAST(greatest(length('{name}'),
      max(length({value})) OVER (PARTITION BY "Ticker")) AS INTEGER), ' ')"""


def _head(name: str) -> str:
    value = f'CAST("{name}" AS VARCHAR)'
    return f"""lpad('{name}', CAST(greatest(length('{name}'),
      max(length({value})) OVER (PARTITION BY "Ticker")) AS INTEGER), ' ')"""


BARS_TEXT = LATEST_BARS + f""", recent AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY "Ticker" ORDER BY "Date" DESC) AS rn FROM bars) WHERE rn <= 5),
cells AS (SELECT "Ticker", "Date" AS day, concat_ws(' ', {", ".join(map(_cell, SHOWN))}) AS line,
  concat_ws(' ', {", ".join(map(_head, SHOWN))}) AS head FROM recent),
bars_text AS (SELECT "Ticker", min(head) || chr(10) || string_agg(line, chr(10) ORDER BY day) AS bars
  FROM cells GROUP BY 1)"""

CONTEXT = """hits AS (
  SELECT 'S' || source[4:] AS query_id, doc_id, source || '-' || doc_id || '.md' AS name, text,
    row_number() OVER (PARTITION BY source ORDER BY n_chars, doc_id) AS rank FROM documents),
contexts AS (
  SELECT query_id, string_agg('[' || name || ']' || chr(10) || text, chr(10) || chr(10) ORDER BY rank) AS context,
    string_agg(name, ', ' ORDER BY rank) AS sources FROM hits WHERE rank <= 6 GROUP BY 1)"""


def passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The six shortest documents of each source as the passages of the ticker with its number."""
    rows = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("S"), F.substr(F.col("source"), F.lit(4))).alias("query_id"),
        F.concat("source", F.lit("-"), F.col("doc_id").cast("string"), F.lit(".md")).alias("source"),
        "doc_id",
        "n_chars",
        "text",
    )
    order = [F.col("n_chars"), F.col("doc_id")]
    return ordering.top_n(rows, ["query_id"], order, TOP_K, "rank").select("query_id", "rank", "source", "text")


@query(f"WITH {BARS_TEXT} SELECT * FROM bars_text")
def bars_text(spark, sf_dir):
    return prompts.bars_text(recent_bars(spark, sf_dir), SHOWN)


@query(f"WITH {CONTEXT} SELECT query_id, context FROM contexts")
def context_block(spark, sf_dir):
    return prompts.context_block(passages(spark, sf_dir)).drop("sources")


@query(f"WITH {CONTEXT} SELECT query_id, sources FROM contexts")
def sources_list(spark, sf_dir):
    block = prompts.context_block(passages(spark, sf_dir))
    return block.select("query_id", X.sources_line(F.col("sources")).alias("sources"))


@query(f"""WITH {BARS_TEXT}, {CONTEXT} SELECT "Ticker", bars, context, coalesce(sources, '') AS sources
FROM bars_text LEFT JOIN contexts ON query_id = "Ticker" """)
def prompt_inputs(spark, sf_dir):
    shown = prompts.bars_text(recent_bars(spark, sf_dir), SHOWN)
    both = prompts.prompt_inputs(shown, prompts.context_block(passages(spark, sf_dir)))
    return both.withColumn("sources", F.coalesce(F.array_join("sources", ", "), F.lit("")))


def _text(value: str) -> str:
    return value.replace("'", "''")


PROMPT = f"""'{_text(prompts.TASK)}' || "Ticker" || ':' || chr(10) || bars || chr(10) || chr(10)
  || CASE WHEN context IS NULL THEN '{_text(prompts.NO_CONTEXT)}' ELSE '{_text(prompts.CITE)}' || chr(10) || context END
  || chr(10) || chr(10) || '{_text(prompts.ASK)}'"""


@query(f"""WITH {BARS_TEXT}, {CONTEXT} SELECT "Ticker", {PROMPT} AS prompt, coalesce(sources, 'none') AS sources
FROM bars_text LEFT JOIN contexts ON query_id = "Ticker" """)
def assemble_prompt(spark, sf_dir):
    shown = prompts.bars_text(recent_bars(spark, sf_dir), SHOWN)
    both = prompts.prompt_inputs(shown, prompts.context_block(passages(spark, sf_dir)))
    return prompts.assemble_prompt(both).withColumn("sources", X.sources_line(F.col("sources")))


@query(f"""WITH written AS (SELECT 'T' || e.event_id AS ticker, d.text, e.ts, d.lang FROM events e
  JOIN documents d ON d.doc_id = e.event_id)
SELECT ticker || '_' || strftime(ts, '%Y%m%dT%H%M%S') || '.md' AS source,
  '---' || chr(10) || 'type: briefing' || chr(10) || 'ticker: ' || ticker || chr(10) || 'date: '
  || strftime(ts, '%Y-%m-%d') || chr(10) || 'sources: ' || CASE WHEN lang = 'de' THEN 'none' ELSE lang || '.md, a.md' END
  || chr(10) || '---' || chr(10) || trim(text, {BLANKS}) || chr(10) AS raw FROM written""")
def append_briefings(spark, sf_dir):
    """Each document as the text generated for one ticker at an event's time."""
    events = table(spark, sf_dir, "events").select(F.col("event_id").alias("doc_id"), F.col("ts").alias("generated_at"))
    none = F.array().cast("array<string>")
    written = table(spark, sf_dir, "documents").join(events, "doc_id").select(
        F.concat(F.lit("T"), F.col("doc_id").cast("string")).alias("ticker"),
        "text",
        F.when(F.col("lang") == "de", none)
        .otherwise(F.array(F.concat("lang", F.lit(".md")), F.lit("a.md")))
        .alias("sources"),
        "generated_at",
    )
    path = scratch_path(spark, "briefings")
    corpus.append_briefings(written, path)
    return corpus.read_briefings(spark, path)


# Text vectors -----------------------------------------------------------------

def crc_step(entry: int) -> int:
    for _ in range(8):
        entry = (entry >> 1) ^ (0xEDB88320 if entry & 1 else 0)
    return entry


CRC_TABLE = "[" + ", ".join(f"{crc_step(i)}::BIGINT" for i in range(256)) + "]"

SLOT = f"""xor(4294967295::BIGINT, list_reduce(
  [4294967295::BIGINT] || list_transform(range(octet_length(encode(w))), lambda i:
    ('0x' || hex(encode(w))[2 * i + 1:2 * i + 2])::BIGINT),
  lambda c, b: xor({CRC_TABLE}[(xor(c, b) & 255) + 1], c >> 8))) % 768"""


def slots_sql(key: str, source: str) -> str:
    """How often each slot occurs in each text; a word's slot is worked out once."""
    words = f"SELECT {key} AS id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) AS w FROM {source}"
    return f"""(SELECT id, slot, count(*) AS n FROM ({words})
  JOIN (SELECT w, {SLOT} AS slot FROM (SELECT DISTINCT w FROM ({words}))) USING (w) GROUP BY ALL)"""


def vector_sql(key: str, source: str) -> str:
    """Unit vectors of a text relation, weighted by how rare a slot is among the chunks."""
    return f"""(
  SELECT id, slot, CAST(n * weight / sqrt(sum((n * weight) * (n * weight)) OVER (PARTITION BY id)) AS FLOAT)::DOUBLE AS x
  FROM (SELECT s.id, s.slot, s.n, ln((t.total + 1) / (coalesce(d.n, 0) + 1)) AS weight
    FROM {slots_sql(key, source)} s, total t LEFT JOIN frequency d ON d.slot = s.slot))"""


EMBEDDED = CHUNKS + f""", chunk_slots AS {slots_sql("id", "chunks")},
frequency AS (SELECT slot, count(*) AS n FROM chunk_slots GROUP BY 1),
total AS (SELECT count(*) AS total FROM chunks),
embedded AS {vector_sql("id", "chunks")}"""

CHECKSUM = "768 AS dim, round(sqrt(sum(x * x)), 4) AS norm, round(sum(slot * x), 4) AS checksum"


def asked_sql(asked: str, k: int) -> str:
    """The k nearest chunks of every question, as a join on shared slots."""
    return EMBEDDED + f""", asked AS ({asked}), asked_vectors AS {vector_sql("query_id", "asked")},
asked_norms AS (SELECT id AS query_id, sum(x * x) AS s FROM asked_vectors GROUP BY 1),
chunk_norms AS (SELECT id, sum(x * x) AS s FROM embedded GROUP BY 1),
products AS (SELECT a.id AS query_id, e.id, sum(a.x * e.x) AS p
  FROM asked_vectors a JOIN embedded e USING (slot) GROUP BY ALL),
distances AS (SELECT q.query_id, c.id, round(coalesce(n.s, 0) + coalesce(m.s, 0) - 2 * coalesce(p.p, 0), 9) AS distance
  FROM asked q CROSS JOIN chunks c LEFT JOIN asked_norms n ON n.query_id = q.query_id LEFT JOIN chunk_norms m ON m.id = c.id
  LEFT JOIN products p ON p.query_id = q.query_id AND p.id = c.id),
found AS (SELECT query_id, CAST(rank AS INTEGER) AS rank, f.id, c.source, c.text, f.distance FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM distances) f
  JOIN chunks c ON c.id = f.id WHERE rank <= {k})"""


def checksum(df: DataFrame, *names: str) -> DataFrame:
    """Dimension, length and a position-weighted sum of each vector."""
    kept = [df.schema[n] for n in names]
    schema = T.StructType([*kept, *T.StructType.fromDDL("dim int, norm double, checksum double").fields])

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            vectors = batch.column("embedding")
            size = pc.list_value_length(vectors)
            values, at = vectors.flatten().to_numpy(zero_copy_only=False).astype("float64"), pc.fill_null(size, 0).to_numpy()
            row = np.repeat(np.arange(len(at)), at)
            place = np.arange(len(values)) - np.repeat(np.cumsum(at) - at, at)
            gone = size.is_null().to_numpy(zero_copy_only=False)
            sums = [np.bincount(row, weights=w, minlength=len(at)) for w in (values * values, values * place)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), size.cast(pa.int32()),
                 pa.array(np.sqrt(sums[0]), pa.float64(), mask=gone), pa.array(sums[1], pa.float64(), mask=gone)],
                names=schema.names,
            )

    return rounded(df.select(*names, "embedding").mapInArrow(run, schema), 4, "norm", "checksum")


def built(spark: SparkSession, sf_dir: str) -> str:
    index = scratch_path(spark, "built")
    retrieval.build_index(markdown(spark, sf_dir), index)
    return index


@query(f"WITH {EMBEDDED} SELECT id, {CHECKSUM} FROM embedded GROUP BY 1")
def embed_corpus(spark, sf_dir):
    counted = embedding.count_words(chunks(spark, sf_dir).select("id", "text")).drop("text")
    texts = materialise(counted, "counted")
    return checksum(embedding.embed(embedding.fit_embedder(texts), texts), "id")


@query(f"""WITH {EMBEDDED}, asked AS (SELECT item_id, text FROM benchmark), vectors AS {vector_sql("item_id", "asked")}
SELECT id, {CHECKSUM} FROM vectors GROUP BY 1""")
def embed_queries(spark, sf_dir):
    """Questions with the model fitted on the chunks."""
    model = embedding.fit_embedder(chunks(spark, sf_dir).select("id", "text"))
    asked = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), "text")
    return checksum(embedding.embed(model, asked), "id")


PROBES = (0, 100, 767)


@query(f"""WITH {EMBEDDED} SELECT id, source, chunk_no, 768 AS dim,
  {", ".join(f"round(coalesce(max(x) FILTER (WHERE slot = {i}), 0), 5) AS x{i}" for i in PROBES)}
FROM embedded JOIN chunks USING (id) GROUP BY 1, 2, 3""")
def build_index(spark, sf_dir):
    """The stored entries, with a few numbers of each vector."""
    stored = retrieval.collection(spark, built(spark, sf_dir))
    probes = [F.round(F.get("embedding", i).cast("double"), 5).alias(f"x{i}") for i in PROBES]
    return stored.select("id", "source", "chunk_no", F.size("embedding").alias("dim"), *probes)


@query(f"""WITH {asked_sql("SELECT CAST(item_id AS VARCHAR) AS query_id, text FROM benchmark", TOP_K)}
SELECT query_id, rank, id, source, round(distance, 6) AS distance FROM found""")
def retrieve(spark, sf_dir):
    asked = table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("query_id"), "text")
    found = retrieval.retrieve(spark, built(spark, sf_dir), asked)
    return found.select("query_id", "rank", "id", "source", F.round("distance", 6).alias("distance"))


LABELLED = "SELECT 'd' || doc_id || '.md' AS query_id, text FROM documents JOIN labels USING (doc_id)"


@query(f"""WITH {asked_sql(LABELLED, 5)}, ranks AS (
  SELECT q.query_id, min(f.rank) AS rank FROM asked q
  LEFT JOIN found f ON f.query_id = q.query_id AND f.source = q.query_id GROUP BY 1)
SELECT count(*) AS questions, count(*) FILTER (WHERE rank <= 1) AS hit_at_1,
  count(*) FILTER (WHERE rank <= 3) AS hit_at_3,
  round(count(*) FILTER (WHERE rank <= 1) / count(*), 4) AS precision_at_1,
  round(count(*) FILTER (WHERE rank <= 3) / count(*), 4) AS hit_rate_at_3,
  round(avg(coalesce(1.0::DOUBLE / rank, 0)), 4) AS mrr,
  (SELECT count(*) FROM documents) AS corpus_documents, 768 AS embedding_dim FROM ranks""")
def evaluate(spark, sf_dir):
    """The text of each labelled document asks for that document."""
    name = F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(".md"))
    labelled = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id")
    asked = labelled.select(name.alias("id"), F.col("text").alias("question"), name.alias("expected"))
    return retrieval.evaluate(markdown(spark, sf_dir), asked)


@query(f"""WITH {asked_sql("SELECT 'S' || s_suppkey AS query_id, 'S' || s_suppkey || ' market context technical analysis' AS text FROM supplier", TOP_K)},
{BARS_TEXT}, contexts AS (
  SELECT query_id, string_agg('[' || source || ']' || chr(10) || text, chr(10) || chr(10) ORDER BY rank) AS context,
    string_agg(source, ', ' ORDER BY rank) AS sources FROM found GROUP BY 1)
SELECT "Ticker", {PROMPT} AS prompt, coalesce(sources, 'none') AS sources
FROM bars_text LEFT JOIN contexts ON query_id = "Ticker" """)
def briefing_inputs(spark, sf_dir):
    done = prompts.briefing_inputs(spark, curated(spark, sf_dir), built(spark, sf_dir), columns=["Date", *SHOWN[1:]])
    return done.withColumn("sources", X.sources_line(F.col("sources")))


# News ---------------------------------------------------------------------------


def news_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feed item per event; its shape follows the event type, its text the event."""
    kind, event = F.col("event_type"), F.col("event_id").cast("string")
    title = F.concat(F.lit('"title":"Event '), event, F.lit('"'))
    link = F.concat(F.lit('{"url":"http://n/'), event, F.lit('"}'))
    item = (
        F.when(kind == "click", F.concat(F.lit('{"content":{'), title,
               F.lit(',"provider":{"displayName":"Desk"},"clickThroughUrl":'), link, F.lit("}}")))
        .when(kind == "view", F.concat(F.lit("{"), title, F.lit(',"provider":"Desk","canonicalUrl":"http://c"}')))
        .when(kind == "signup", F.concat(F.lit('{"content":{'), title, F.lit(',"clickThroughUrl":"x","canonicalUrl":"y"}}')))
        .when(kind == "purchase", F.concat(F.lit('{"content":'), F.col("props"), F.lit("}")))
        .otherwise(F.concat(F.lit('{"content":{"clickThroughUrl":{},"canonicalUrl":"http://c"},'), title, F.lit("}")))
    )
    return table(spark, sf_dir, "events").select(
        F.concat(F.upper("event_type"), F.lit("-"), F.col("user_id").cast("string")).alias("ticker"),
        F.col("event_id").alias("position"),
        item.alias("item"),
    )


@query("""SELECT ticker, position, title, publisher, link FROM (
  SELECT upper(event_type) || '-' || user_id AS ticker, event_id AS position,
    row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id) AS rn,
    CASE WHEN event_type IN ('click', 'view', 'signup') THEN 'Event ' || event_id ELSE 'No title' END AS title,
    CASE event_type WHEN 'click' THEN 'Desk' ELSE 'Unknown source' END AS publisher,
    CASE event_type WHEN 'click' THEN 'http://n/' || event_id WHEN 'view' THEN 'http://c'
      WHEN 'error' THEN 'http://c' ELSE '#' END AS link
  FROM events) WHERE rn <= 3""")
def flatten_news(spark, sf_dir):
    return news.flatten_news(news_items(spark, sf_dir))
