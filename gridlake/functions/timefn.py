"""Event-time parsing (P19) and device local time strings (P25)."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# RFC 3339: date 'T' time, optional fraction of 1-9 digits, zone 'Z' or +hh:mm.
RFC3339_SHAPE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?(Z|[+-]\d{2}:\d{2})$"
RFC3339_PATTERN = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS]XXX"


def parse_rfc3339(text: Column) -> Column:
    """Timestamp of an RFC 3339 string, NULL for anything else.

    The shape check keeps lenient forms (date only, space separator) out; the
    optional 9-letter fraction accepts 1 to 9 digits when parsing.
    """
    parsed = F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS]XXX"))
    return F.when(text.rlike(RFC3339_SHAPE), parsed)


def event_time(device_timestamp: Column, received_at: Column) -> Column:
    """Device time when it is a valid RFC 3339 string, else the receive time (Q25)."""
    return F.coalesce(parse_rfc3339(device_timestamp), received_at)


def device_local_time(date: Column, time: Column, tz: Column | None = None) -> Column:
    """``dd/MM/yyyy`` + ``HH:mm:ss`` strings -> timestamp; with a zone name, to UTC."""
    local = F.try_to_timestamp(F.concat(date, F.lit(" "), time), F.lit("dd/MM/yyyy HH:mm:ss"))
    if tz is None:
        return local
    return F.when(tz.isNotNull() & (tz != ""), F.to_utc_timestamp(local, tz)).otherwise(local)


def micros(t: datetime) -> int:
    """Microseconds since the epoch; a time without zone is UTC."""
    t = t if t.tzinfo else t.replace(tzinfo=timezone.utc)
    d = t - datetime(1970, 1, 1, tzinfo=timezone.utc)
    return (d.days * 86400 + d.seconds) * 1_000_000 + d.microseconds
