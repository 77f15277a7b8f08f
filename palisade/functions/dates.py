"""Timestamps are naive UTC (``timestamp_ntz``); ages always take an explicit ``as_of``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.]\d{1,9})?)?(Z|[+-]\d{2}:\d{2})?)?$"


def parse_timestamp(text: Column) -> Column:
    """ISO text to naive UTC; offsets are applied, text without one is taken as UTC, anything else is null.

    Needs the session zone UTC, which ``palisade.session`` sets.
    """
    return F.when(text.rlike(ISO), text.try_cast("timestamp").cast("timestamp_ntz"))


def iso_seconds(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def iso_utc(ts: Column) -> Column:
    """``2024-01-31T10:00:00Z``; microseconds are shown only when there are any."""
    micros = F.date_format(ts, "SSSSSS")
    seconds = iso_seconds(ts)
    return F.when(micros == "000000", F.concat(seconds, F.lit("Z"))).otherwise(
        F.concat(seconds, F.lit("."), micros, F.lit("Z"))
    )


def day_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def age_days(ts: Column, as_of: str) -> Column:
    """Whole days from ``ts`` to ``as_of``, floored, never negative, null when unknown."""
    moment = F.lit(as_of).cast("timestamp_ntz")
    seconds = F.timestamp_diff("SECOND", ts, moment)
    return F.greatest(F.lit(0), F.floor(seconds / 86400)).cast("bigint")


def day_boundaries(ts: Column, as_of: str) -> Column:
    """Number of midnights between ``ts`` and ``as_of`` (a calendar-day difference)."""
    return F.datediff(F.lit(as_of).cast("date"), ts.cast("date")).cast("bigint")
