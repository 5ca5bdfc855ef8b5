"""Grounded prompts for every ticker at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import text as X
from tickloom.operators import ordering
from tickloom.plans import retrieval
from tickloom.schemas import BAR_VIEW, BARS_RANGE, DEFAULT_BARS, TOP_K, bounded_arg
from tickloom.session import materialise

# How a missing number and a missing context read in a prompt.
MISSING = "NaN"
NO_CONTEXT = "No prior context was retrieved for this query."

TASK = "You brief institutional investors before the market opens. These are the latest bars of "
CITE = "Notes found for this briefing. Name the bracketed source of each note you rely on, and no other:"
ASK = (
    "Write two or three sentences on price action, momentum and technical sentiment, "
    "in professional terms, and rest them on the notes where those apply."
)


def bars_text(recent: DataFrame, columns: Sequence[str] = BAR_VIEW) -> DataFrame:
    """(Ticker, bars): each ticker's bars as a right-aligned text table, oldest first.

    ``recent`` holds a bounded number of bars per ticker (see ``latest_n``).
    """
    shown = [c for c in columns if c in recent.columns]
    cells = F.array(*[F.coalesce(F.col(c).cast("string"), F.lit(MISSING)) for c in shown])
    header = F.array(*[F.lit(c) for c in shown])
    per_ticker = recent.groupBy("Ticker").agg(
        F.array_sort(F.collect_list(F.struct("Date", cells.alias("cells")))).alias("rows")
    )
    lines = F.concat(F.array(header), F.transform("rows", lambda r: r["cells"]))
    widths = F.transform(
        F.sequence(F.lit(0), F.lit(len(shown) - 1)),
        lambda i: F.array_max(F.transform("lines", lambda line: F.length(F.get(line, i)))),
    )
    text = F.array_join(
        F.transform(
            "lines",
            lambda line: F.array_join(
                F.zip_with(line, F.col("widths"), lambda cell, w: F.lpad(cell, w, F.lit(" "))), " "
            ),
        ),
        "\n",
    )
    laid_out = per_ticker.select("Ticker", lines.alias("lines")).withColumn("widths", widths)
    return laid_out.select("Ticker", text.alias("bars"))


def context_block(passages: DataFrame) -> DataFrame:
    """(query_id, context, sources): passages as ``[source]`` blocks in rank order."""
    ranked = passages.groupBy("query_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", "source", "text"))).alias("hits")
    )
    blocks = F.transform("hits", lambda h: F.concat(F.lit("["), h["source"], F.lit("]\n"), h["text"]))
    return ranked.select(
        "query_id",
        F.array_join(blocks, "\n\n").alias("context"),
        F.transform("hits", lambda h: h["source"]).alias("sources"),
    )


def prompt_inputs(bars: DataFrame, contexts: DataFrame) -> DataFrame:
    """Each ticker's bar table beside its context; a ticker without passages keeps its bars."""
    keyed = contexts.withColumnRenamed("query_id", "Ticker")
    return bars.join(keyed, "Ticker", "left")


def assemble_prompt(inputs: DataFrame) -> DataFrame:
    """(Ticker, prompt, sources) from (Ticker, bars, context, sources)."""
    notes = F.when(
        F.col("context").isNotNull(), F.concat(F.lit(CITE + "\n"), F.col("context"))
    ).otherwise(F.lit(NO_CONTEXT))
    prompt = F.concat(
        F.lit(TASK), "Ticker", F.lit(":\n"), "bars", F.lit("\n\n"), notes, F.lit("\n\n" + ASK)
    )
    sources = F.coalesce("sources", F.array().cast("array<string>"))
    return inputs.select("Ticker", prompt.alias("prompt"), sources.alias("sources"))


def briefing_inputs(
    spark: SparkSession,
    curated: DataFrame,
    index: str,
    bars: int = DEFAULT_BARS,
    k: int = TOP_K,
    columns: Sequence[str] = BAR_VIEW,
) -> DataFrame:
    """The prompt and the retrieved sources of every ticker in ``curated``."""
    bounded_arg("bars", bars, BARS_RANGE)
    shown = [c for c in columns if c in curated.columns]
    latest = ordering.latest_n(curated.select("Ticker", "Date", *(c for c in shown if c not in ("Ticker", "Date"))), ["Ticker"], ["Date"], bars, presort=False)
    # Every ticker has a latest bar, so the bars are gone through once, for these and for the questions.
    recent = materialise(latest, "recent")
    asked = recent.select("Ticker").distinct().select(
        F.col("Ticker").alias("query_id"), X.retrieval_query(F.col("Ticker")).alias("text")
    )
    found = retrieval.retrieve(spark, index, asked, k)
    return assemble_prompt(prompt_inputs(bars_text(recent, columns), context_block(found)))
