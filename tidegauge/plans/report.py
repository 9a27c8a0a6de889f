"""The performance report: five results for a time window."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from ..functions.numeric import percent
from ..functions.text import key_is_sql, name_key_sql
from ..functions.time import report_window
from ..operators.waits import with_interval_averages
from ..sources.constants import REPORT_COLUMNS
from ..sources.readers import between_snapshots
from .views import BY, memory_snapshot, snapshot_pivots, summary_ratio, throughput, waittime_snapshot


def snapshot_report(
    snaps: DataFrame, params: DataFrame, *, parity: bool = False, strict: bool = False, tasks: int | None = None
) -> DataFrame:
    """One wide row per snapshot, newest first; a snapshot missing in any view is left out.

    Three of the four views share one pass over the facts; the ratios take a second.  ``tasks`` as in ``views``.
    """
    ratios = summary_ratio(snaps, params, parity=parity, strict=strict, tasks=tasks)
    wide = ratios.join(snapshot_pivots(snaps, params, strict=strict, tasks=tasks), list(BY))
    return wide.select(*REPORT_COLUMNS).orderBy(F.desc("snapshot_date"), "instance_id")


def snapshot_report_from_views(
    snaps: DataFrame, params: DataFrame, *, parity: bool = False, tasks: int | None = None
) -> DataFrame:
    """The same report as a join of the four views."""
    wide = summary_ratio(snaps, params, parity=parity, tasks=tasks)
    for view in (memory_snapshot, throughput, waittime_snapshot):
        wide = wide.join(view(snaps, params, tasks=tasks), list(BY))
    return wide.select(*REPORT_COLUMNS).orderBy(F.desc("snapshot_date"), "instance_id")


def wait_share(waits: DataFrame, *, strict: bool = False) -> DataFrame:
    """Each wait type's share of its snapshot's wait and signal time, in percent.

    The total covers all types of the snapshot, also those left out for having no wait time.  A
    snapshot without signal time has NULL shares.  One shuffle, by snapshot: the sums per type and
    the snapshot totals use the same partitioning, and a snapshot holds about a thousand types.
    """
    snapshot = "over (partition by instance_id, snapshot_date)"
    summed = (
        with_interval_averages(waits)
        .repartition(*BY)
        .groupBy(*BY, "wait_type")
        .agg(
            F.sum("wait_time").alias("_wait"),
            F.sum("signal_wait_time").alias("_signal"),
            F.max("wait_time_request_average").alias("wait_time_request_average"),
            F.max("signal_wait_time_request_average").alias("signal_wait_time_request_average"),
        )
        .selectExpr("*", f"sum(_wait) {snapshot} as _all_wait", f"sum(_signal) {snapshot} as _all_signal")
        .where("_wait > 0")
    )
    wait_pct = percent("_wait", "_all_wait", strict=strict)
    signal_pct = percent("_signal", "if(_all_signal > 0, _all_signal, null)")
    if strict:
        wait_pct, signal_pct = wait_pct.cast("decimal(5,2)"), signal_pct.cast("decimal(5,2)")
    return summed.select(
        *BY,
        "wait_type",
        wait_pct.alias("wait_pct"),
        signal_pct.alias("signal_wait_pct"),
        "wait_time_request_average",
        "signal_wait_time_request_average",
    )


def wait_share_report(waits: DataFrame, *, strict: bool = False) -> DataFrame:
    """``wait_share`` newest first, then by signal share, types without one last."""
    return wait_share(waits, strict=strict).orderBy(
        F.desc("snapshot_date"), F.desc_nulls_last("signal_wait_pct"), "instance_id", "wait_type"
    )


def io_summary(filestats: DataFrame, file_type: str | None = None) -> DataFrame:
    """Reads, writes and stall time per database, over all files or one kind (``rows``, ``log``)."""
    rows = filestats if file_type is None else filestats.where(key_is_sql(name_key_sql("db_file_type"), file_type))
    return rows.groupBy("instance_id", "database_name").agg(
        F.sum("num_of_reads").alias("total_reads"),
        F.sum("num_of_writes").alias("total_writes"),
        F.sum("io_stall_ms").alias("sum_io_stall_ms"),
    )


def io_summaries(filestats: DataFrame) -> DataFrame:
    """``io_summary`` over all files and over each kind, told apart by ``files`` (all, rows, log): one pass over the statistics."""
    kinds = {"all": F.lit(True)} | {k: F.coalesce(F.expr(key_is_sql(name_key_sql("db_file_type"), k)), F.lit(False)) for k in ("rows", "log")}
    totals = {"total_reads": "num_of_reads", "total_writes": "num_of_writes", "sum_io_stall_ms": "io_stall_ms"}
    parts = []
    for kind, member in kinds.items():
        sums = [F.sum(F.when(member, F.col(c))).alias(name) for name, c in totals.items()]
        parts.append(F.struct(F.lit(kind).alias("files"), F.count_if(member).alias("n"), *sums).alias(f"_{kind}"))
    summed = filestats.groupBy("instance_id", "database_name").agg(*parts)
    rows = summed.select("instance_id", "database_name", F.explode(F.array(*[f"_{k}" for k in kinds])).alias("_part"))
    return rows.where("_part.n > 0").select("_part.files", "instance_id", "database_name", *[f"_part.{t}" for t in totals])


def performance_report(
    tables: dict[str, DataFrame],
    *,
    end: datetime,
    start: datetime | None = None,
    parity: bool = False,
    strict: bool = False,
    tasks: int | None = None,
) -> dict[str, DataFrame]:
    """The five results over ``[start, end]`` (default: the 30 minutes before ``end``).

    ``tables`` holds perf_snap with counter_dimension, wait_summary and filestats; results of a table
    not given are left out.  Results are lazy, so one that nobody collects costs nothing.  ``io`` holds the three IO results
    (``io_all``, ``io_rows``, ``io_log``) from one pass.  Tables with ``snapshot_day`` are pruned to the window.
    ``tasks`` (``row_tasks`` of the perf_snap rows) keeps the tasks of ``snapshots`` small over many of them.
    """
    start, end = report_window(start, end)
    within = {name: between_snapshots(df, start, end) for name, df in tables.items() if name != "counter_dimension"}
    results = {}
    if "perf_snap" in within:
        results["snapshots"] = snapshot_report(
            within["perf_snap"], tables["counter_dimension"], parity=parity, strict=strict, tasks=tasks
        )
    if "wait_summary" in within:
        results["waits"] = wait_share_report(within["wait_summary"], strict=strict)
    if "filestats" in within:
        results["io"] = io_summaries(within["filestats"])
        for kind in ("all", "rows", "log"):
            results[f"io_{kind}"] = io_summary(within["filestats"], None if kind == "all" else kind)
    return results
