"""Closed intervals with open ends, and knowledge time."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .scalar import col, try_iso_date


def as_of(day: Column | str, start, end) -> Column:
    """True where start <= day <= end; a null or unreadable end of the interval is open."""
    day = F.lit(day) if isinstance(day, str) else day
    a, b = try_iso_date(start), try_iso_date(end)
    return (a.isNull() | (a <= day)) & (b.isNull() | (b >= day))


def interval_valid(start, end) -> Column:
    """False only where both ends are given and start is after end."""
    return F.coalesce(col(start) <= col(end), F.lit(True))


def learned_at(receipt, source) -> Column:
    """A record's own receipt time, else its source's."""
    return F.coalesce(col(receipt), col(source))


def is_utc_timestamp(c) -> Column:
    """ISO text with a time that ends in Z or +00:00."""
    text = col(c)
    return text.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|\+00:00)$") & F.try_to_timestamp(F.substring(text, 1, 10), F.lit("yyyy-MM-dd")).isNotNull()
