"""Column expressions and projections on built-in functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def keep_present(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])


def enforce_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to the declared types in the declared order; a bad value fails the job."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def schema_rejects(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows ``enforce_schema`` would fail on, each with the names of its bad columns."""
    bad = [
        F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), F.lit(f.name))
        for f in schema.fields
    ]
    return df.withColumn("rejected_columns", F.concat_ws(",", *bad)).filter(
        F.col("rejected_columns") != ""
    )


def stamp_ingest(df: DataFrame, run_time: str) -> DataFrame:
    return df.withColumn("ingested_at_utc", F.lit(run_time))


def json_safe(df: DataFrame) -> DataFrame:
    """NaN becomes null in every floating-point column."""
    floats = (T.DoubleType, T.FloatType)
    return df.select(
        *[
            F.nanvl(F.col(f.name), F.lit(None)).alias(f.name)
            if isinstance(f.dataType, floats)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def drop_if_exists(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def as_text(df: DataFrame, *names: str) -> DataFrame:
    """Cast the named columns to string where they exist."""
    return df.withColumns({n: F.col(n).cast("string") for n in names if n in df.columns})


def with_default(value: Column, default: float) -> Column:
    return F.coalesce(value, F.lit(default))


def for_ticker(df: DataFrame, column: str, tickers: str | Sequence[str], normalised: bool = True) -> DataFrame:
    """Rows of the given tickers, case-insensitively.

    With ``normalised`` the stored column is already upper case (the ingest
    writes it that way), so the bare column is compared and the filter reaches
    the Parquet scan. Otherwise the stored value is upper-cased first.
    """
    names = [tickers] if isinstance(tickers, str) else list(tickers)
    stored = F.col(column) if normalised else F.upper(F.col(column))
    return df.filter(stored.isin(*[n.upper() for n in names]))


def numeric_metrics(df: DataFrame, value: str = "value") -> DataFrame:
    """Keep the entries whose value parses as a number, as doubles."""
    return df.withColumn(value, F.col(value).try_cast("double")).filter(F.col(value).isNotNull())


def status_filter(df: DataFrame, status: str = "status") -> DataFrame:
    return df.filter(F.col(status).rlike("^(4..|5..)$"))


def route_template(path: Column, templates: Sequence[str]) -> Column:
    """The template a raw path matches (``{x}`` stands for one segment), else ``unmatched``."""
    out = F.lit("unmatched")
    for template in reversed(list(templates)):
        parts = ["[^/]+" if p.startswith("{") else "\\Q" + p + "\\E" for p in template.split("/")]
        out = F.when(path.rlike("^" + "/".join(parts) + "$"), F.lit(template)).otherwise(out)
    return out


def daily_return(close: Column, previous: Column) -> Column:
    return F.try_divide(close - previous, previous)


def reciprocal_rank(rank: Column) -> Column:
    return F.coalesce(F.try_divide(F.lit(1.0), rank), F.lit(0.0))


def l2_squared(a: Column, b: Column) -> Column:
    gaps = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")))
    return F.aggregate(gaps, F.lit(0.0), lambda acc, g: acc + g * g)


def trend_setup(close: Column, sma_20: Column, sma_50: Column) -> Column:
    """Bullish above both averages with the short one leading, bearish in the mirror case."""
    bullish = (close > sma_20) & (close > sma_50) & (sma_20 > sma_50)
    bearish = (close < sma_20) & (close < sma_50) & (sma_20 < sma_50)
    return F.when(bullish, F.lit("bullish")).when(bearish, F.lit("bearish")).otherwise(F.lit("neutral"))
