"""Landed news items per ticker."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions import text as X
from tickloom.operators import ordering

SHOWN = 3


def flatten_news(news: DataFrame, shown: int = SHOWN) -> DataFrame:
    """(ticker, position, title, publisher, link) of each ticker's first items.

    ``news`` has (ticker, position, item): the JSON text of an item and its place in the feed.
    """
    first = ordering.top_n(news, ["ticker"], [F.col("position"), F.col("item")], shown, "_rank")
    return first.select("ticker", "position", X.news_item(F.col("item")).alias("n")).select(
        "ticker", "position", "n.title", "n.publisher", "n.link"
    )
