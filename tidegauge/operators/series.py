"""Look-back over long time series without putting a whole series into one task.

A series (one counter of one server, say) may hold a large part of all rows.  Its history is cut
into stretches of ``chunk_days`` days; windows run inside a stretch, and only one row per stretch
crosses a border.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.time import time_chunk_sql

CHUNK_DAYS = 7
#: Rows that a task of a look-back sorts, about; at some 300 bytes each.
TASK_ROWS = 500_000


def row_tasks(rows: DataFrame, *, task_rows: int = TASK_ROWS) -> int | None:
    """Tasks for a look-back over stored ``rows``: more with more rows, so a task sorts about ``task_rows`` however many there are.

    Without a number Spark merges partitions by their compressed size, and samples compress to a tenth or less.  Counts the
    rows at once, so they should be stored.  None for what a few tasks hold: there Spark's own choice is better.
    """
    tasks = -(-rows.count() // task_rows)
    return tasks if tasks > 8 else None


def running_max_before(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: str,
    out: str,
    *,
    chunk_days: int = CHUNK_DAYS,
) -> DataFrame:
    """Largest ``value`` (expression text; a struct compares field by field) over all earlier rows of
    the series.

    NULL on the first row.  Two levels: the maximum of each stretch is carried forward over the
    stretches (one row each), then combined with the running maximum inside the stretch.  The rows
    are shuffled and sorted once, by (keys, stretch); the carried side joins on the same columns.
    """
    rows = df.selectExpr("*", f"{value} as _value", f"{time_chunk_sql(order, chunk_days)} as _chunk")
    stretch, series = ", ".join([*keys, "_chunk"]), ", ".join(keys)
    earlier = "rows between unbounded preceding and 1 preceding"
    carried = (
        rows.groupBy(*keys, "_chunk")
        .agg({"_value": "max"})
        .selectExpr(
            *keys, "_chunk", f"max(`max(_value)`) over (partition by {series} order by _chunk {earlier}) as _carried"
        )
    )
    inside = f"max(_value) over (partition by {stretch} order by {order} {earlier})"
    return (
        rows.selectExpr("*", f"{inside} as _inside")
        .join(carried, [*keys, "_chunk"])
        .selectExpr(*df.columns, f"greatest(_carried, _inside) as {out}")
    )


def with_previous_snapshot(
    df: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    *,
    cluster: Sequence[str] | None = None,
    chunk_days: int = CHUNK_DAYS,
    tasks: int | None = None,
) -> DataFrame:
    """Adds ``prev_<value>``: the value of the same key at the previous snapshot of the instance.

    Needs the columns of ``snapshot_sequence`` (``prev_snapshot``, ``next_snapshot``).  NULL when the
    key has no row at exactly that snapshot, however many older rows it has.  Repeated rows of a key
    and snapshot give one row.

    One shuffle by (cluster, stretch), where ``cluster`` defaults to the keys, over so many ``tasks`` (``row_tasks``).  A row whose next
    snapshot lies in a later stretch is also sent there, to be seen by ``lag``, and dropped again.
    Rows of the result stay clustered by (cluster, ``_chunk``); callers may reuse that before
    dropping ``_chunk``.
    """
    cluster = list(cluster or keys)
    home, following = time_chunk_sql("snapshot_date", chunk_days), time_chunk_sql("next_snapshot", chunk_days)
    crosses = f"next_snapshot is not null and {following} > {home}"
    placed = df.selectExpr("*", f"explode(if({crosses}, array({home}, {following}), array({home}))) as _chunk")
    # The copy for the later stretch carries what the look-back sees, no more.
    seen = {*cluster, *keys, *values, "snapshot_date"}
    placed = placed.select(
        *[F.col(f"`{c}`") if c in seen else F.when(F.expr(f"_chunk = {home}"), F.col(f"`{c}`")).alias(c) for c in df.columns], "_chunk"
    )
    placed = placed.repartition(*([tasks] if tasks else []), *cluster, "_chunk")
    over = f"over (partition by {', '.join(dict.fromkeys([*cluster, *keys]))}, _chunk order by snapshot_date)"
    adjacent = f"lag(snapshot_date) {over} = prev_snapshot"
    # A sample delivered twice must not find itself: one row per key and snapshot, the largest values, goes on.
    # Clustering and order are those of the look-back, so this costs no exchange and no other sort.
    same = ", ".join([*dict.fromkeys([*cluster, *keys]), "_chunk", "snapshot_date"])
    largest = ", ".join(f"{v} desc" for v in values)
    once = placed.selectExpr("*", f"row_number() over (partition by {same} order by {largest}) as _copy")
    looked_up = once.where("_copy = 1").selectExpr(
        "*", *[f"if({adjacent}, lag({v}) {over}, null) as prev_{v}" for v in values]
    )
    return looked_up.where(f"_chunk = {home}").drop("_copy")


def as_of(
    df: DataFrame,
    log: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    *,
    time: str = "snapshot_date",
    since: str = "since",
    chunk_days: int = CHUNK_DAYS,
) -> DataFrame:
    """Adds the columns ``values`` of the last row of ``log`` for the same keys at or before ``time``; NULL if there is none.

    Both tables become one series that is shuffled once, by keys and stretch: the last value inside a stretch is carried on by
    a window, the last value of each stretch over the stretches (one row each).  Of several log rows at one instant the
    largest holds.
    """
    series, columns = list(keys), df.columns
    own, told = F.struct(*[F.col(f"`{c}`") for c in columns]), F.struct(F.col(since).alias("_since"), *[F.col(v).alias(v) for v in values])
    nothing = F.lit(None)
    rows = df.select(*series, F.col(time).alias("_at"), own.alias("_row"), nothing.cast(_type_of(log, told)).alias("_told"))
    changes = log.where(F.col(since).isNotNull()).select(
        *series, F.col(since).alias("_at"), nothing.cast(_type_of(df, own)).alias("_row"), told.alias("_told")
    )
    placed = rows.unionByName(changes).withColumn("_chunk", F.expr(time_chunk_sql("_at", chunk_days)))
    placed = placed.repartition(*series, "_chunk")
    stretch, whole = ", ".join([*series, "_chunk"]), ", ".join(series)
    # Log rows come before rows of the same instant, the largest last.
    inside = f"last(_told, true) over (partition by {stretch} order by _at, _row is not null, _told rows unbounded preceding)"
    carried = (
        placed.where("_told is not null")
        .groupBy(*series, "_chunk")
        .agg(F.max("_told").alias("_last"))
        .unionByName(placed.where("_row is not null").select(*series, "_chunk").distinct().withColumn("_last", nothing.cast(_type_of(log, told))))
        .groupBy(*series, "_chunk")
        .agg(F.max("_last").alias("_last"))
        .selectExpr(
            *series, "_chunk",
            f"last(_last, true) over (partition by {whole} order by _chunk rows between unbounded preceding and 1 preceding) as _before",
        )
    )
    found = placed.selectExpr("*", f"{inside} as _inside").where("_row is not null").join(carried, [*series, "_chunk"], "left")
    state = F.coalesce("_inside", "_before")
    return found.select("_row.*", *[state[v].alias(v) for v in values])


def _type_of(df: DataFrame, column: Column):
    return df.select(column.alias("c")).schema["c"].dataType
