"""Exact decimal arithmetic: unit conversions, averages, percentages and rates.

Ratios are computed with integer division and rounded half up once, so a result does not depend
on an intermediate decimal scale.  A zero divisor gives NULL; with ``strict=True`` it raises.
Arguments are column names or expression text.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

PAGE_KB = 8.0
LEGACY_PAGE_KB = 8.192
_KB_PER_GB = 1 << 20
_LONG_MAX = (1 << 63) - 1


def ratio_sql(num: str, den: str, digits: int = 2, *, strict: bool = False) -> str:
    divisor = den if strict else f"nullif({den}, 0)"
    n = f"cast(abs({num}) * {2 * 10**digits} as decimal(36,2))"
    d = f"cast(abs({divisor}) as decimal(28,2))"
    return _signed(num, den, f"({n} + {d}) div (2 * {d})", digits)


def whole_ratio_sql(num: str, den: str, digits: int = 2, *, strict: bool = False) -> str:
    """The same for BIGINT arguments: long arithmetic unless a value is too large for it."""
    divisor = den if strict else f"nullif({den}, 0)"
    scale = 2 * 10**digits
    fits = f"abs({num}) <= {_LONG_MAX // (2 * scale)} and abs({den}) <= {_LONG_MAX // 4}"
    fast = f"(abs({num}) * {scale} + abs({divisor})) div (2 * abs({divisor}))"
    d = f"cast(abs({divisor}) as decimal(20,0))"
    wide = f"(cast(abs({num}) as decimal(20,0)) * {scale} + {d}) div (2 * {d})"
    return _signed(num, den, f"if({fits}, {fast}, {wide})", digits)


def _signed(num: str, den: str, units: str, digits: int) -> str:
    return f"cast(if(({num} < 0) <> ({den} < 0), -1, 1) * ({units}) * {10**-digits:.{digits}f}BD as decimal(28,{digits}))"


def ratio(num: str, den: str, digits: int = 2, *, strict: bool = False) -> Column:
    """``num / den`` rounded half up to ``digits`` places, as decimal(28, digits)."""
    return F.expr(ratio_sql(num, den, digits, strict=strict))


def percent_sql(num: str, den: str, *, strict: bool = False) -> str:
    return f"cast({ratio_sql(f'(100 * {num})', den, strict=strict)} as decimal(18,2))"


def percent(num: str, den: str, *, strict: bool = False) -> Column:
    """Percentage with two decimals."""
    return F.expr(percent_sql(num, den, strict=strict))


def safe_average(total: str, requests: str) -> Column:
    """Average per request; 0 when there were no requests."""
    return F.expr(f"if({requests} = 0, 0, cast({ratio_sql(total, requests)} as decimal(18,2)))").cast("decimal(18,2)")


def kb_to_gb_sql(c: str) -> str:
    return f"cast({c} / {_KB_PER_GB}BD as decimal(18,2))"


def pages_to_mb_sql(pages: str, page_kb: float = PAGE_KB, digits: int = 2) -> str:
    return f"cast(cast({pages} as decimal(20,0)) * {page_kb}BD / 1024BD as decimal(18,{digits}))"


def pages_to_mb(pages: str, page_kb: float = PAGE_KB, digits: int = 2) -> Column:
    return F.expr(pages_to_mb_sql(pages, page_kb, digits))


def pages_to_gb(pages: str, page_kb: float = PAGE_KB, digits: int = 3) -> Column:
    return F.expr(f"cast(cast({pages} as decimal(20,0)) * {page_kb}BD / {_KB_PER_GB}BD as decimal(18,{digits}))")


def bytes_to_gb(c: str) -> Column:
    return F.expr(f"cast(cast({c} as decimal(20,0)) / {1 << 30}BD as decimal(18,2))")


def free_percent(free: str, total: str) -> Column:
    """Free space as a share of total space, two decimals; NULL for an empty drive."""
    return percent(free, total)
