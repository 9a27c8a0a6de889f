"""Surrogate keys and change hashes, reproducible in any engine that has MD5."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F



def joined(parts: Sequence[str]) -> str:
    """SQL text that joins the parts so that no two lists of parts give the same text.

    Each part carries its length; NULL has none, so it differs from every text.
    """
    marked = [f"coalesce(concat(length(cast({p} as string)), ':', cast({p} as string)), 'null')" for p in parts]
    return f"concat_ws('|', {', '.join(marked)})"


def surrogate_id(*keys: str) -> Column:
    """60-bit id from the MD5 of the key parts (fits a BIGINT)."""
    return F.expr(f"cast(conv(substring(md5({joined(keys)}), 1, 15), 16, 10) as bigint)")


def instance_key(server: str, instance: str) -> Column:
    """Id of an instance from its server and instance name (default instance when NULL)."""
    return surrogate_id(f"lower(rtrim({server}))", f"lower(rtrim(coalesce({instance}, 'MSSQLSERVER')))")


def row_hash(columns: Sequence[str]) -> Column:
    """Hash of a row for change detection; NULL and '' hash differently."""
    return F.expr(f"md5({joined(columns)})")
