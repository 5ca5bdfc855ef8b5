"""Where the catalog modules record their queries and SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL that gives the same rows."""

    def register(fn: Query) -> Query:
        if fn.__name__ in QUERIES:
            raise ValueError(f"query {fn.__name__} is registered twice")

        @wraps(fn)
        def in_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        QUERIES[fn.__name__] = in_utc
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    from pyspark.sql import functions as F

    return df.withColumns({n: F.round(n, digits) for n in names})
