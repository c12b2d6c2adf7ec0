"""Temporal column helpers (C3, C11, M11, lake partition parts).

All helpers are built-in Spark expressions; they assume the UTC session of
:func:`changelake.session.configure`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: time zone of the lake's daily partitions and the partition formats
LAKE_ZONE = "Asia/Seoul"
PARTITION_FORMATS = {"year": "yyyy", "month": "MM", "day": "dd"}


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def format_epoch_millis(c: str | Column, fmt: str = "yyyy-MM-dd'T'HH:mm:ss.SSS") -> Column:
    """Epoch milliseconds -> text (UTC session)."""
    return F.date_format(F.timestamp_millis(_col(c)), fmt)


def date_from_days(c: str | Column) -> Column:
    """C11: DATE carried as days since the epoch -> date."""
    return F.date_from_unix_date(_col(c).cast("int"))


def timestamp_from_epoch(c: str | Column, unit: str = "ms") -> Column:
    """C11: DATETIME/TIMESTAMP carried as epoch ms (precision <= 3) or us (precision > 3)."""
    c = _col(c)
    if unit == "ms":
        return F.timestamp_millis(c)
    if unit == "us":
        return F.timestamp_micros(c)
    raise ValueError(f"unit must be 'ms' or 'us', not {unit!r}")


def unit_for_precision(precision: int) -> str:
    """Temporal unit of a DATETIME column from its declared fractional precision."""
    return "ms" if precision <= 3 else "us"


def time_of_day_text(c: str | Column) -> Column:
    """C11: TIME as microseconds of the day -> ``HH:mm:ss.SSSSSS`` text."""
    return F.date_format(F.timestamp_micros(_col(c)), "HH:mm:ss.SSSSSS")


def iso_timestamp(c: str | Column) -> Column:
    """C11: ISO-8601 text with zone (``...Z``) -> timestamp; malformed text -> null."""
    return F.try_to_timestamp(_col(c))


def mixed_ts_decode(c: str | Column) -> Column:
    """A connector time that is either epoch ms (number or digits) or ISO text (taken as UTC)."""
    c = _col(c)
    as_ms = c.try_cast("bigint")
    return F.coalesce(F.timestamp_millis(as_ms), F.try_to_timestamp(c.cast("string")))


def lake_partition_columns(ts: str | Column, zone: str = LAKE_ZONE) -> dict[str, Column]:
    """year/month/day text of an instant in the lake's zone (KST: 15:00 UTC is the next day)."""
    local = F.from_utc_timestamp(_col(ts), zone)
    return {name: F.date_format(local, fmt) for name, fmt in PARTITION_FORMATS.items()}


def iso_text(c: str | Column, fmt: str = "yyyy-MM-dd HH:mm:ss.SSSSSS") -> Column:
    """Timestamp -> fixed-width text (used where results are compared as text)."""
    return F.date_format(_col(c), fmt)
