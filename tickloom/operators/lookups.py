"""Lookups and membership tests as equi-joins.

No side is forced to broadcast: Spark broadcasts a side only when its measured
size is below the session's threshold, and shuffles with skew handling otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions import columns as C
from tickloom.functions import text as X
from tickloom.schemas import DEFAULT_PRICE


def not_in(left: DataFrame, right: DataFrame, key: str, right_key: str | None = None) -> DataFrame:
    """Rows of ``left`` whose key does not occur in ``right``; repeats on the right collapse first."""
    known = right.select(F.col(right_key or key).alias(key)).distinct()
    return left.join(known, key, "left_anti")


def last_close(bars: DataFrame) -> DataFrame:
    """The close of the newest day that has one, per ticker."""
    priced = bars.filter(F.col("Close").isNotNull() & ~F.isnan("Close"))
    order = F.struct("Date", *[c for c in ("ingested_at_utc",) if c in bars.columns], "Close")
    return priced.groupBy("Ticker").agg(F.max_by("Close", order).alias("last_close"))


def seed_prices(portfolio: DataFrame, bars: DataFrame, default: float = DEFAULT_PRICE) -> DataFrame:
    """Every portfolio ticker with its last close, or ``default``."""
    closes = last_close(bars.join(portfolio.select("Ticker").distinct(), "Ticker", "left_semi"))
    seed = C.with_default(F.col("last_close"), default)
    return portfolio.join(closes, "Ticker", "left").select("Ticker", seed.alias("seed_price"))


def failed_tickers(portfolio: DataFrame, batch: DataFrame) -> DataFrame:
    return not_in(portfolio, batch, "Ticker")


def orphans(stored: DataFrame, current: DataFrame) -> DataFrame:
    """Stored entries whose id is not in the current corpus."""
    return not_in(stored, current, "id")


def upsert(stored: DataFrame, new: DataFrame) -> DataFrame:
    """New entries plus the stored ones they do not replace."""
    return not_in(stored, new, "id").unionByName(new, allowMissingColumns=True)


def quoted_questions(questions: DataFrame, corpus: DataFrame, run: int = 5) -> DataFrame:
    """Questions with a run of ``run`` words found verbatim in a text of their expected source.

    The inner words of a run stand in a text between single blanks, so they are an exact
    key: texts are indexed by (source, inner words), with the token before and behind,
    which end and start with the run's outer words where the run is found. Questions and
    texts meet on that key alone, so a source that holds much of the corpus is spread
    over its runs, and only postings that some question asks for go on.
    """
    if run < 3:
        raise ValueError("a run needs inner words: three words at least")
    parts = F.split("gram", " ")
    wanted = questions.select(
        "id", F.col("expected").alias("source"), F.posexplode(X.n_grams(F.col("question"), run)).alias("place", "gram")
    ).select(
        "id",
        "source",
        "place",
        F.array_join(F.slice(parts, 2, run - 2), " ").alias("inner"),
        F.get(parts, F.lit(0)).alias("first"),
        F.get(parts, F.lit(run - 1)).alias("last"),
    )
    # A text's number serves to tell texts apart within this plan only.
    numbered = corpus.select("source", F.split(F.lower("text"), " ").alias("tokens"), F.monotonically_increasing_id().alias("text_no"))
    at = F.explode(F.sequence(F.lit(0), F.size("tokens") - run)).alias("at")
    windows = numbered.filter(F.size("tokens") >= run).select("source", "text_no", "tokens", at)
    postings = windows.select(
        "source",
        "text_no",
        F.array_join(F.slice("tokens", F.col("at") + 2, run - 2), " ").alias("inner"),
        F.get("tokens", F.col("at")).alias("before"),
        F.get("tokens", F.col("at") + run - 1).alias("behind"),
    )
    met = wanted.join(postings, ["source", "inner"])
    quoted = met.filter(F.endswith("before", "first") & F.startswith("behind", "last"))
    found = quoted.groupBy("id", "source", "text_no", "place").agg(F.lit(1).alias("quote"))
    per_text = found.groupBy("id", "source", "text_no").agg(F.sum("quote").alias("quotes"))
    return per_text.groupBy("id").agg(F.max("quotes").alias("quotes"), F.count(F.lit(1)).alias("matching_texts"))


def reconcile(ingest_runs: DataFrame, transform_runs: DataFrame) -> DataFrame:
    """Rows ingested beside the rows each transform run read and wrote."""
    upstream = ingest_runs.select("run_id", F.col("rows_ingested").alias("upstream_rows_ingested"))
    return transform_runs.join(upstream, "run_id", "left")
