"""Market-shaped inputs derived from the driver tables, in Spark and in SQL.

Each function reads a whole driver table; the SQL constant of the same name
spells out the same rows for the side-by-side check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import text as X
from tickloom.functions import times as TM
from tickloom.session import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


LINE_COLUMNS = [
    "l_shipdate", "l_suppkey", "l_extendedprice", "l_discount", "l_tax", "l_quantity", "l_orderkey", "l_linenumber",
    "l_partkey",
]


def raw_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One landed bar per line item: ticker by supplier, day by ship date.

    Several lines of a supplier on one day are repeated ingests of that day's
    bar; the stamp orders them.
    """
    price = F.col("l_extendedprice")
    stamp = F.concat_ws(
        "-",
        F.lit("2026-01-01T00:00:00+00:00/run"),
        F.lpad(F.col("l_orderkey").cast("string"), 12, "0"),
        F.col("l_linenumber").cast("string"),
        F.lpad(F.col("l_partkey").cast("string"), 12, "0"),
    )
    return spread(table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS)).select(
        TM.iso_date(F.col("l_shipdate")).alias("Date"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("Ticker"),
        (price * (1 - F.col("l_discount") / 2)).alias("Open"),
        (price * (1 + F.col("l_tax"))).alias("High"),
        (price * (1 - F.col("l_discount"))).alias("Low"),
        price.alias("Close"),
        F.col("l_quantity").cast("long").alias("Volume"),
        stamp.alias("ingested_at_utc"),
    )


RAW_BARS = """raw_bars AS (
  SELECT strftime(l_shipdate, '%Y-%m-%d') AS "Date", 'S' || l_suppkey AS "Ticker",
    l_extendedprice * (1 - l_discount / 2) AS "Open", l_extendedprice * (1 + l_tax) AS "High",
    l_extendedprice * (1 - l_discount) AS "Low", l_extendedprice AS "Close", CAST(l_quantity AS BIGINT) AS "Volume",
    '2026-01-01T00:00:00+00:00/run-' || lpad(CAST(l_orderkey AS VARCHAR), 12, '0') || '-' || l_linenumber || '-'
      || lpad(CAST(l_partkey AS VARCHAR), 12, '0') AS ingested_at_utc
  FROM lineitem)"""

LATEST_BARS = RAW_BARS + """, bars AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY "Ticker", "Date" ORDER BY ingested_at_utc DESC) AS rn
    FROM raw_bars) WHERE rn = 1)"""

CURATED = LATEST_BARS + """, lagged AS (
  SELECT *, lag("Close") OVER (PARTITION BY "Ticker" ORDER BY "Date") AS prev_close FROM bars),
returns AS (
  SELECT *, ("Close" - prev_close) / nullif(prev_close, 0) AS daily_return FROM lagged),
curated AS (
  SELECT "Date", "Ticker", "Open", "High", "Low", "Close", "Volume", ingested_at_utc, prev_close,
    avg("Close") OVER (PARTITION BY "Ticker" ORDER BY "Date" ROWS 19 PRECEDING) AS "SMA_20",
    avg("Close") OVER (PARTITION BY "Ticker" ORDER BY "Date" ROWS 49 PRECEDING) AS "SMA_50",
    daily_return,
    stddev_samp(daily_return) OVER (PARTITION BY "Ticker" ORDER BY "Date" ROWS 19 PRECEDING)
      AS volatility_20d
  FROM returns)"""


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tick per event."""
    return table(spark, sf_dir, "events").select(
        F.upper("event_type").alias("ticker"),
        F.col("value").alias("price"),
        (F.col("event_id") % 500 + 1).alias("size"),
        TM.iso_time(F.col("ts")).alias("event_time"),
        (F.col("ts").cast("timestamp") + F.expr("INTERVAL 1 SECOND")).alias("kafka_timestamp"),
        "event_id",
        "ts",
    )


TICKS = """ticks AS (
  SELECT upper(event_type) AS ticker, value AS price, event_id % 500 + 1 AS size,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS event_time,
    ts + INTERVAL 1 SECOND AS kafka_timestamp, event_id, ts
  FROM events)"""


def wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks as keyed JSON messages; some payloads are broken on purpose."""
    rows = ticks(spark, sf_dir)
    value = X.render_tick(F.col("ticker"), F.col("price"), F.col("size"), F.col("event_time"))
    broken = (
        F.when(F.col("event_id") % 97 == 0, F.lit("not json"))
        .when(F.col("event_id") % 89 == 0, F.concat(F.lit('{"ticker":"'), "ticker", F.lit('","price":"x"}')))
        .otherwise(value)
    )
    return rows.select(
        F.col("ticker").alias("key"), broken.alias("value"), F.col("kafka_timestamp").alias("timestamp")
    )


PARSED = TICKS + """, parsed AS (
  SELECT CASE WHEN event_id % 97 = 0 THEN NULL ELSE ticker END AS ticker,
    CASE WHEN event_id % 97 = 0 OR event_id % 89 = 0 THEN NULL ELSE price END AS price,
    CASE WHEN event_id % 97 = 0 OR event_id % 89 = 0 THEN NULL ELSE size END AS size,
    CASE WHEN event_id % 97 = 0 OR event_id % 89 = 0 THEN NULL ELSE event_time END AS event_time,
    kafka_timestamp
  FROM ticks)"""


def landed_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks with the micro-batch (500 events each) they landed in and its commit time."""
    rows = ticks(spark, sf_dir).withColumn("batch_id", F.floor(F.col("event_id") / 500))
    commits = rows.groupBy("batch_id").agg(
        (F.max("kafka_timestamp") + F.expr("INTERVAL 2 SECONDS")).alias("committed_at")
    )
    return rows.join(commits, "batch_id")


LANDED = TICKS + """, commits AS (
  SELECT event_id // 500 AS batch_id, max(kafka_timestamp) + INTERVAL 2 SECOND AS committed_at
  FROM ticks GROUP BY 1),
landed AS (
  SELECT t.*, c.batch_id, c.committed_at FROM ticks t JOIN commits c ON t.event_id // 500 = c.batch_id)"""


def markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as markdown files: front matter, a bullet section and a prose section."""
    front = F.concat(
        F.lit("---\ntype: note\ntitle: Notes of "), "source", F.lit("\nlang: "), "lang", F.lit("\n---\n")
    )
    body = F.concat(
        F.lit("# "), "source", F.lit("\n\n## Lines\n\nLead-in.\n\n- "), F.replace("text", F.lit("\n"), F.lit("\n- ")),
        F.lit("\n\n## Prose\n\n"), "text", F.lit("\n"),
    )
    return spread(table(spark, sf_dir, "documents")).select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(".md")).alias("source"),
        F.concat(F.when(F.col("lang") == "de", F.lit("")).otherwise(front), body).alias("raw"),
    )


BLANKS = (
    "chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||' '||chr(133)||chr(160)"
    "||chr(5760)||chr(8192)||chr(8193)||chr(8194)||chr(8195)||chr(8196)||chr(8197)||chr(8198)||chr(8199)"
    "||chr(8200)||chr(8201)||chr(8202)||chr(8232)||chr(8233)||chr(8239)||chr(8287)||chr(12288)"
)

MARKDOWN = """markdown AS (
  SELECT 'd' || doc_id || '.md' AS source, 'Notes of ' || source AS title, lang, source AS origin,
    (CASE WHEN lang = 'de' THEN '' ELSE '---' || chr(10) || 'type: note' || chr(10) || 'title: Notes of ' || source
       || chr(10) || 'lang: ' || lang || chr(10) || '---' || chr(10) END)
    || '# ' || source || chr(10) || chr(10) || '## Lines' || chr(10) || chr(10) || 'Lead-in.' || chr(10) || chr(10)
    || '- ' || replace(text, chr(10), chr(10) || '- ') || chr(10) || chr(10) || '## Prose' || chr(10) || chr(10)
    || text || chr(10) AS raw
  FROM documents),
parsed_docs AS (
  SELECT source, CASE WHEN lang = 'de' THEN NULL ELSE 'note' END AS type,
    CASE WHEN lang = 'de' THEN NULL ELSE title END AS title,
    CASE WHEN lang = 'de' THEN NULL ELSE lang END AS lang,
    trim(CASE WHEN starts_with(raw, '---' || chr(10))
      THEN regexp_extract(raw, '(?s)^---\\n(.*?)\\n---\\n(.*)$', 2) ELSE raw END, {blanks}) AS body
  FROM markdown)""".replace("{blanks}", BLANKS)

SECTIONS = MARKDOWN + """, section_parts AS (
  SELECT source, title, [''] || regexp_extract_all(body, '(?m)^##+\\s+(.*)$', 1) AS headings,
    regexp_split_to_array(body, '(?m)^##+\\s+.*$') AS texts
  FROM parsed_docs),
numbered AS (
  SELECT source, title, unnest(headings) AS heading, unnest(texts) AS text,
    unnest(range(1, len(texts) + 1)) AS section FROM section_parts),
sections AS (
  SELECT source, title, section, trim(heading, {blanks}) AS heading, trim(text, {blanks}) AS text
  FROM numbered WHERE trim(text, {blanks}) <> '')""".replace("{blanks}", BLANKS)

CHUNKS = SECTIONS + """, bullet_parts AS (
  SELECT *, regexp_split_to_array(text, '(?m)^- ') AS parts FROM sections),
bullets AS (
  SELECT *, list_filter(list_transform(parts[2:], lambda p: trim(p, {blanks})), lambda p: p <> '') AS items
  FROM bullet_parts),
pieces AS (
  SELECT source, title, section, heading,
    CASE WHEN len(parts) > 4 AND len(items) > 0
      THEN list_transform(items, lambda i:
        (CASE WHEN heading <> '' THEN heading || chr(10) || chr(10) ELSE '' END) || '- ' || i)
      ELSE [text] END AS texts
  FROM bullets),
piece_rows AS (
  SELECT source, title, section, heading, unnest(texts) AS piece, unnest(range(1, len(texts) + 1)) AS item
  FROM pieces),
headed AS (
  SELECT *, concat_ws(' - ', nullif(title, ''), nullif(heading, '')) AS header FROM piece_rows),
titled AS (
  SELECT source, section, item,
    trim(CASE WHEN header <> '' AND NOT contains(piece, header)
      THEN header || chr(10) || chr(10) || piece ELSE piece END, {blanks}) AS text
  FROM headed),
kept AS (
  SELECT source, text, row_number() OVER (PARTITION BY source ORDER BY section, item) - 1 AS chunk_no
  FROM titled WHERE length(text) >= 80),
chunks AS (
  SELECT source || '#' || chunk_no AS id, source, CAST(chunk_no AS INTEGER) AS chunk_no, text FROM kept
  UNION ALL
  SELECT source AS id, source, NULL AS chunk_no, body AS text FROM parsed_docs
  WHERE source NOT IN (SELECT source FROM kept))""".replace("{blanks}", BLANKS)
