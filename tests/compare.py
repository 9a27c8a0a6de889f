"""Side-by-side run of a registered query and its SQL twin in DuckDB."""

from __future__ import annotations

import datetime
import decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def normalised(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[str]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr(tuple(_plain(r[i]) for i in order)) for r in rows)


def compare(spark, sf_dir: str, query, sql: str, con=None) -> str | None:
    """None when equal, else what differs first."""
    con = con or connect(sf_dir)
    df = query(spark, sf_dir)
    got_columns, got = normalised(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    want_columns, want = normalised([d[0] for d in result.description], result.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        extra, missing = sorted(set(got) - set(want))[:3], sorted(set(want) - set(got))[:3]
        return f"{len(got)} rows != {len(want)}; extra {extra}, missing {missing}"
    for g, w in zip(got, want):
        if g != w:
            return f"{got_columns}: {g} != {w}"
    return None
