"""Date and time expressions."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date and time formats.
ISO_DATE = "yyyy-MM-dd"
ISO_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"
FILE_STAMP = "yyyyMMdd'T'HHmmss"


def iso_now() -> str:
    return datetime.now(timezone.utc).isoformat()


def iso_date(ts: Column) -> Column:
    return F.date_format(ts, ISO_DATE)


def iso_time(ts: Column) -> Column:
    """ISO text with a zero offset, for a timestamp that already is in UTC."""
    return F.date_format(ts, ISO_TIME)


def file_stamp(ts: Column) -> Column:
    return F.date_format(ts, FILE_STAMP)


def parse_event_time(text: Column) -> Column:
    """ISO text with an offset to an instant; null when it does not parse."""
    return F.try_to_timestamp(text)


def micros(ts: Column) -> Column:
    return F.unix_micros(ts)


def seconds_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1e6)
