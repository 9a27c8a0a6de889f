"""Time arithmetic on TIMESTAMP_NTZ that never reads the clock or the session zone."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, functions as F

REPORT_WINDOW = timedelta(minutes=30)
DAWN, DUSK = "timestamp_ntz'0001-01-01 00:00:00'", "timestamp_ntz'9999-12-31 00:00:00'"


def seconds_between_sql(start: str, end: str) -> str:
    """Number of whole-second boundaries crossed between two timestamps."""
    return f"cast(unix_timestamp({end}) - unix_timestamp({start}) as int)"


def ts(value: datetime | str) -> Column:
    text = value if isinstance(value, str) else value.isoformat(sep=" ")
    return F.expr(f"timestamp_ntz'{text}'")


def snapshot_day(c: str = "snapshot_date") -> Column:
    """Partition value of a snapshot."""
    return F.expr(f"cast({c} as date)")


def time_chunk_sql(c: str, days: int) -> str:
    """Number of the fixed-length stretch of ``days`` days a timestamp falls in.

    Never NULL: joins on it then infer no extra filter, so both sides can share an exchange.
    """
    return f"coalesce(cast(floor(unix_date(cast({c} as date)) / {days}) as int), 0)"


def earliest_first_sql(c: str) -> str:
    """Orderable value that is larger for an earlier timestamp (for use inside max(struct))."""
    return f"{DUSK} - {c}"


def report_window(start: datetime | None, end: datetime) -> tuple[datetime, datetime]:
    """Report bounds; the default start is 30 minutes before the end."""
    return (start if start is not None else end - REPORT_WINDOW), end


def in_window(start: datetime, end: datetime, c: str = "snapshot_date") -> Column:
    return F.col(c).between(ts(start), ts(end))
