"""Event time, parsed once, and the calendar columns cut from it."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def event_time(text: Column) -> Column:
    """ISO-8601 text with zone to TIMESTAMP; text that is no time becomes null instead of failing the job."""
    return F.try_to_timestamp(text)


def iso_text(ts: Column) -> Column:
    """The instant in UTC, whatever the session's zone."""
    return F.date_format(F.to_utc_timestamp(ts, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
