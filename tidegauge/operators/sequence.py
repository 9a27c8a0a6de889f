"""The order of snapshots per instance: what came before, and was the server restarted."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.time import seconds_between_sql, time_chunk_sql
from .series import CHUNK_DAYS

SEQUENCE_COLUMNS = ("prev_snapshot", "next_snapshot", "first_measure", "interval_s")


def snapshot_sequence(
    samples: DataFrame,
    *,
    parity: bool = False,
    forced: DataFrame | None = None,
    chunk_days: int = CHUNK_DAYS,
) -> DataFrame:
    """(instance_id, snapshot_date, instance_started) -> previous and next snapshot, first-measure
    flag and interval in seconds.

    A snapshot is a first measure when no earlier one exists or the server was started since; its
    interval then runs from the server start.  ``parity=True`` misses a restart at the very instant
    of the previous snapshot.  ``forced`` (instance_id, snapshot_date) marks snapshots that start
    over although the server did not.

    One row per (instance, snapshot) after a pre-aggregation, so a busy snapshot costs one row.  The
    neighbours are found inside stretches of ``chunk_days``; one edge row per stretch crosses over.
    """
    points = (
        samples.groupBy("instance_id", "snapshot_date")
        .agg(F.max("instance_started").alias("instance_started"))
        .selectExpr("*", f"{time_chunk_sql('snapshot_date', chunk_days)} as _chunk")
    )
    by_instance = "over (partition by instance_id order by _chunk)"
    edges = (
        points.groupBy("instance_id", "_chunk")
        .agg(
            F.expr("min(snapshot_date) as _first"),
            F.expr("max(struct(snapshot_date, instance_started)) as _last"),
        )
        .selectExpr(
            "instance_id", "_chunk", f"lag(_last) {by_instance} as _before", f"lead(_first) {by_instance} as _after"
        )
    )
    inside = "over (partition by instance_id, _chunk order by snapshot_date)"
    neighbours = points.selectExpr(
        "*",
        f"lag(snapshot_date) {inside} as _lag",
        f"lag(instance_started) {inside} as _lag_started",
        f"lead(snapshot_date) {inside} as _lead",
    )
    sequenced = neighbours.join(edges, ["instance_id", "_chunk"]).selectExpr(
        "instance_id",
        "snapshot_date",
        "instance_started",
        "coalesce(_lag, _before.snapshot_date) as prev_snapshot",
        "coalesce(_lag_started, _before.instance_started) as _prev_started",
        "coalesce(_lead, _after) as next_snapshot",
    )
    restarted = "prev_snapshot < instance_started" if parity else "_prev_started <> instance_started"
    first = f"prev_snapshot is null or {restarted}"
    if forced is not None:
        marks = forced.selectExpr("instance_id", "snapshot_date", "true as _forced").distinct()
        sequenced = sequenced.join(marks, ["instance_id", "snapshot_date"], "left")
        first = f"{first} or coalesce(_forced, false)"
    since = "if(first_measure, instance_started, prev_snapshot)"
    return sequenced.selectExpr("*", f"({first}) as first_measure").selectExpr(
        "instance_id",
        "snapshot_date",
        "instance_started",
        *SEQUENCE_COLUMNS[:-1],
        f"{seconds_between_sql(since, 'snapshot_date')} as interval_s",
    )


def last_snapshots(df: DataFrame) -> DataFrame:
    """Newest snapshot, number of rows and latest server start per instance."""
    return df.groupBy("instance_id").agg(
        F.max("snapshot_date").alias("last_snapshot"),
        F.count("*").alias("row_count"),
        F.max("instance_started").alias("instance_started"),
    )


def with_sequence(df: DataFrame, sequence: DataFrame, *more: str, hashed: bool = False) -> DataFrame:
    """Attaches the sequence columns, and ``more`` of its columns, by (instance, snapshot).

    No broadcast hint: the sequence grows with fleet and history, so Spark picks a broadcast only
    when its measured size allows one.  ``hashed`` is for many samples: a task then holds its part of the sequence, a row per
    poll, and lets the samples pass instead of sorting them.
    """
    polls = sequence.select("instance_id", "snapshot_date", *SEQUENCE_COLUMNS, *more)
    return df.join(polls.hint("shuffle_hash") if hashed else polls, ["instance_id", "snapshot_date"])
