"""Market bars, ticks and retrieval tables as Spark DataFrame operators."""

__version__ = "0.1.0"
