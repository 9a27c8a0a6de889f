"""The query views over ``perf_snap`` and ``wait_summary``.

Each pivot is one aggregation by (instance, snapshot) over the fact table joined to the counter
dimension.  Names are compared by key, so case and trailing blanks do not matter.

``tasks`` (``row_tasks`` of the stored facts) is for many facts: their rows, those of the view's counters, are dealt to so many
tasks by snapshot before they are aggregated.  Rows of a snapshot lie in many files, so groups made file by file would fill a
task as the files grow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.labels import wait_category
from ..functions.numeric import kb_to_gb_sql, percent_sql
from ..functions.text import key_in_sql, key_is_sql, literal_key, name_key_sql, quoted
from ..operators.dimension import counter_families
from ..operators.waits import drop_innocuous, with_interval_averages
from ..sources.constants import (
    MEMORY_GB_COLUMNS,
    MEMORY_INSTANCES,
    MEMORY_OBJECTS,
    PAGE_LIFE_COLUMN,
    RATIO_COLUMNS,
    THROUGHPUT_COLUMNS,
    UNCATEGORISED_WAIT,
    WAIT_TIME_COLUMNS,
    WAIT_TIME_INSTANCE,
    WAIT_TIME_OBJECT,
)

BY = ("instance_id", "snapshot_date")
_VALUE = "instance_perf_value"


def _ends_with_any(key: str, names: tuple[str, ...]) -> str:
    return "(" + " or ".join(f"endswith({key}, {quoted(literal_key(n))})" for n in names) + ")"


_IS_MEMORY = f"{_ends_with_any('object_key', MEMORY_OBJECTS)} and {key_in_sql('instance_key', MEMORY_INSTANCES)}"
_IS_WAIT_TIME = _ends_with_any("object_key", (WAIT_TIME_OBJECT,))


def throughput(snaps: DataFrame, params: DataFrame, *, tasks: int | None = None) -> DataFrame:
    """Fourteen throughput counters side by side."""
    return _facts(snaps, params, tasks=tasks).groupBy(*BY).agg(*_throughput_columns())


def memory_snapshot(
    snaps: DataFrame, params: DataFrame, *, strict: bool = False, tasks: int | None = None
) -> DataFrame:
    """Memory figures in GB, and page life expectancy.  ``strict`` raises from 1000 GB on."""
    return _facts(snaps, params, _IS_MEMORY, tasks=tasks).groupBy(*BY).agg(*_memory_columns(strict))


def waittime_snapshot(snaps: DataFrame, params: DataFrame, *, tasks: int | None = None) -> DataFrame:
    """Average wait times in ms of nine wait classes."""
    return _facts(snaps, params, _IS_WAIT_TIME, tasks=tasks).groupBy(*BY).agg(*_wait_time_columns())


def snapshot_pivots(
    snaps: DataFrame, params: DataFrame, *, strict: bool = False, tasks: int | None = None
) -> DataFrame:
    """Throughput, memory and wait times in a single pass over the facts.

    Holds the snapshots present in all three views.
    """
    return (
        _facts(snaps, params, tasks=tasks)
        .groupBy(*BY)
        .agg(
            *_throughput_columns(),
            *_memory_columns(strict, _IS_MEMORY),
            *_wait_time_columns(_IS_WAIT_TIME),
            F.expr(f"bool_or({_IS_MEMORY}) as _memory"),
            F.expr(f"bool_or({_IS_WAIT_TIME}) as _wait_time"),
        )
        .where("_memory and _wait_time")
        .drop("_memory", "_wait_time")
    )


def summary_ratio(
    snaps: DataFrame, params: DataFrame, *, parity: bool = False, strict: bool = False, tasks: int | None = None
) -> DataFrame:
    """Ratio counters against their base, in percent.

    A ratio needs both values in the snapshot; it is NULL when either is missing or the base is 0.
    ``parity`` uses -1 for a missing value, so an unmonitored ratio reads 100.  Startup rows count.

    Pairs are formed by regrouping facts under their base's id, not by joining facts to facts.
    """
    families = counter_families(params)
    names = ["parent_counter", "parent_instance", "base_counter", "base_instance"]
    members = families.selectExpr(
        "inline(array(struct(base_id as inst_perf_param_id, true as is_base),"
        " struct(parent_id as inst_perf_param_id, false as is_base)))",
        "base_id",
        *names,
    )
    pairs = (
        _by_snapshot(snaps.select(*BY, "inst_perf_param_id", _VALUE), members, tasks)
        .join(members, "inst_perf_param_id")
        .groupBy(*BY, "base_id", *names)
        .agg(
            F.expr(f"max(if(is_base, {_VALUE}, null)) as base"),
            F.expr(f"max(if(is_base, null, {_VALUE})) as part"),
        )
        .where("base is not null and part is not null")
    )
    ratios = []
    for column, parent, base, instance in RATIO_COLUMNS:
        of_parent = f"{key_is_sql('parent_counter', parent)} and {key_is_sql('parent_instance', instance)}"
        of_base = f"{key_is_sql('base_counter', base)} and {key_is_sql('base_instance', instance)}"
        part, divisor = f"if({of_parent}, part, null)", f"if({of_base} and base <> 0, base, null)"
        if parity:
            part, divisor = f"coalesce({part}, -1)", f"coalesce({divisor}, -1)"
        value = percent_sql(f"max({part})", f"max({divisor})")
        ratios.append(F.expr(f"{_narrow(value) if strict else value} as {column}"))
    return pairs.groupBy(*BY).agg(*ratios)


def wait_categories(
    current: DataFrame, history: DataFrame | None = None, *, exclude: DataFrame | None = None, parity: bool = False
) -> DataFrame:
    """Current and archived waits with their category.

    Leaves out first measures, ignorable types and waits of 1 ms or less on average.  Rows found in
    both tables (an archive move between its two steps) appear once.
    """
    columns = ["instance_id", "snapshot_date", "wait_type", "wait_requests", "wait_time", "signal_wait_time"]

    def legs(df: DataFrame) -> DataFrame:
        return drop_innocuous(df, exclude=exclude, parity=parity).where("not first_measure_from_start").select(*columns)

    rows = legs(current) if history is None else legs(current).unionByName(legs(history))
    return (
        with_interval_averages(rows.distinct())
        .where(f"wait_time_request_average > 1 and not {key_is_sql(name_key_sql('wait_type'), UNCATEGORISED_WAIT)}")
        .withColumn("wait_category", wait_category("wait_type"))
    )


def _facts(snaps: DataFrame, params: DataFrame, scope: str = "true", *, tasks: int | None = None) -> DataFrame:
    names = params.selectExpr(
        "inst_perf_param_id",
        f"{name_key_sql('object_nm')} as object_key",
        f"{name_key_sql('counter_nm')} as counter_key",
        f"{name_key_sql('instance_nm')} as instance_key",
    ).where(scope)
    measured = snaps.where("not startup_measure_ind").select(*BY, "inst_perf_param_id", _VALUE)
    return _by_snapshot(measured, names, tasks).join(names, "inst_perf_param_id")


def _by_snapshot(rows: DataFrame, counters: DataFrame, tasks: int | None) -> DataFrame:
    """The rows of ``counters``, all of a snapshot in one of ``tasks``; names are joined behind the exchange, so none is sent."""
    if not tasks:
        return rows
    wanted = counters.select("inst_perf_param_id")
    return rows.join(wanted, "inst_perf_param_id", "left_semi").repartition(tasks, *BY)


def _pick(column: str, value: str, *conditions: str | None) -> Column:
    return F.expr(f"max(if({' and '.join(c for c in conditions if c)}, {value}, null)) as {column}")


def _throughput_columns() -> list[Column]:
    return [
        _pick(column, _VALUE, key_is_sql("counter_key", counter), instance and key_is_sql("instance_key", instance))
        for column, counter, instance in THROUGHPUT_COLUMNS
    ]


def _memory_columns(strict: bool, scope: str | None = None) -> list[Column]:
    gb = _narrow(kb_to_gb_sql(_VALUE)) if strict else kb_to_gb_sql(_VALUE)
    wanted = [(column, gb, counter) for column, counter in MEMORY_GB_COLUMNS]
    wanted.append((PAGE_LIFE_COLUMN[0], _VALUE, PAGE_LIFE_COLUMN[1]))
    return [_pick(column, value, key_is_sql("counter_key", counter), scope) for column, value, counter in wanted]


def _wait_time_columns(scope: str | None = None) -> list[Column]:
    instance = key_is_sql("instance_key", WAIT_TIME_INSTANCE)
    return [_pick(c, _VALUE, key_is_sql("counter_key", n), instance, scope) for c, n in WAIT_TIME_COLUMNS]


def _narrow(value: str) -> str:
    return f"cast({value} as decimal(5,2))"
