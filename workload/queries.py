"""Registered queries: each runs one operator or view of the library over whole tables.

Decimals are returned as whole hundredths (or thousandths), so that engines with other decimal
scales can be compared exactly.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

import tidegauge as tg
from tidegauge.functions.keys import row_hash
from tidegauge.functions.labels import edition_label
from tidegauge.functions.text import drive_letter, drive_prefix
from tidegauge.functions.time import ts
from tidegauge.operators.series import row_tasks
from tidegauge.plans.report import snapshot_report_from_views
from tidegauge.plans.views import BY
from tidegauge.schemas import IO_MEASURES
from tidegauge.sources.constants import AVERAGE, BASE, CUSTOM, RATE, RATIO
from tidegauge.sources.readers import read_snapshots
from tidegauge.sources.history import add_piece, create_tables, move_aged, read_current, read_history
from tidegauge.streaming.deltas import counter_delta_stream, read_counter_deltas
from tidegauge.streaming.windows import (
    archive_resources_stream,
    read_accounts,
    read_archive,
    read_missed,
    read_report,
    report_stream,
    windowed_report,
)

from . import derived
from .derived import GAUGE
from .staging import read_stream_in_any_order, run_stream, shared_folder, staged

Query = Callable[[SparkSession, str], DataFrame]
DB = ("database_name",)
REPORT_START, REPORT_END = datetime(2024, 1, 12), datetime(2024, 1, 22, 12)
IO_START, IO_END = datetime(1996, 6, 1), datetime(1998, 2, 1)
ARCHIVE_ASOF, ARCHIVE_DAYS = datetime(2024, 1, 30, 12), 14
REINITIALIZED_AT = "2024-01-20 08:00:00"
DRIVE_THRESHOLD = 20


def hundredths(c: str) -> str:
    return f"cast({c} * 100 as bigint) as {c}"


def thousandths(c: str) -> str:
    return f"cast({c} * 1000 as bigint) as {c}"


def whole(c: str) -> str:
    return f"cast({c} as bigint) as {c}"


def _pivot_columns(df: DataFrame) -> DataFrame:
    return df.selectExpr(*BY, *[hundredths(c) for c in df.columns if c not in BY])


# ---- shared inputs ---------------------------------------------------------------------------


def _counters(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Counter samples and their dimension.  Both feed several consumers, so they are written once.

    Spark knows the size of a written dimension, so samples are not exchanged by name to meet it.
    """
    samples = _counter_samples(spark, sf_dir)
    return samples, staged(spark, tg.counter_dimension(samples), "counter_dimension")


def _counter_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(spark, _some_twice(derived.raw_counters(spark, sf_dir), "cntr_value"), "counters")


def _snaps(spark: SparkSession, sf_dir: str, *types: int) -> DataFrame:
    samples, params = _counters(spark, sf_dir)
    if types:
        params = params.where(F.col("counter_type").isin(*types))
    return tg.counter_delta(samples, params, tasks=row_tasks(samples))


def _facts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``perf_snap`` and the counter dimension, as stored tables."""
    samples, params = _counters(spark, sf_dir)
    return staged(spark, tg.counter_delta(samples, params, tasks=row_tasks(samples)), "perf_snap"), params


def _wait_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(spark, derived.raw_waits(spark, sf_dir), "waits")


def _waits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tg.wait_delta(_wait_samples(spark, sf_dir))


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tg.io_delta(staged(spark, _some_twice(derived.raw_io(spark, sf_dir), IO_MEASURES[0]), "io"))


def _some_twice(samples: DataFrame, value: str) -> DataFrame:
    """Delivery at least once: every fifth sample, by its value, arrives twice.  Results are those of single delivery."""
    return samples.withColumn("_copies", F.expr(f"explode(if({value} % 5 = 0, array(1, 2), array(1)))")).drop("_copies")


def _snap_columns(df: DataFrame) -> DataFrame:
    return df.selectExpr(
        *BY,
        "inst_perf_param_id",
        hundredths("instance_perf_value"),
        whole("cumulative_perf_value"),
        "startup_measure_ind",
        "measurement_interval_s",
    )


def _wait_columns(df: DataFrame, *more) -> DataFrame:
    return df.selectExpr(
        *BY,
        "wait_type",
        whole("wait_requests"),
        whole("wait_time"),
        whole("signal_wait_time"),
        whole("cumulative_wait_requests"),
        whole("cumulative_wait_time"),
        whole("cumulative_signal_wait_time"),
        whole("interval_in_seconds"),
        "first_measure_from_start",
        *more,
    )


# ---- snapshots and counters --------------------------------------------------------------------


def snapshot_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tg.snapshot_sequence(derived.raw_waits(spark, sf_dir))


def snapshot_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tg.last_snapshots(derived.raw_waits(spark, sf_dir))


def counter_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tg.server_prefixes(derived.raw_counters(spark, sf_dir))


def perf_snap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _snap_columns(_snaps(spark, sf_dir))


def counter_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _snap_columns(_snaps(spark, sf_dir, RATE))


def counter_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _snap_columns(_snaps(spark, sf_dir, CUSTOM))


def counter_gauge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _snap_columns(_snaps(spark, sf_dir, GAUGE, RATIO, BASE))


def _averages(spark: SparkSession, sf_dir: str, base: str) -> DataFrame:
    samples, params = _counters(spark, sf_dir)
    params = params.withColumn("log_ind", F.expr(f"endswith(object_nm, 'Latches') and counter_type in ({AVERAGE}, {BASE})"))
    snaps = tg.counter_delta(samples, params, base=base, tasks=row_tasks(samples))
    averages = params.where(F.col("counter_type") == AVERAGE).select("inst_perf_param_id")
    return _snap_columns(snaps.join(averages, "inst_perf_param_id", "left_semi"))


def counter_average_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _averages(spark, sf_dir, "interval")


def counter_average_ratio_cumulative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _averages(spark, sf_dir, "cumulative")


def counter_first_measure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _snap_columns(_snaps(spark, sf_dir)).where("startup_measure_ind")


def counter_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tg.build_counter_dim(derived.raw_counters(spark, sf_dir))


def counter_flag_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tg.flag_counters(tg.build_counter_dim(derived.raw_counters(spark, sf_dir)))


def counter_flag_rules_cloud(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = tg.build_counter_dim(derived.raw_counters(spark, sf_dir), with_custom=False)
    return tg.flag_counters(dim, edition_code=5)


def _editions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tg.instance_editions(derived.raw_config(spark, sf_dir))


def counter_flag_rules_fleet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Servers and cloud databases in one call: rules of one edition give its instances rows of their own."""
    dim = tg.counter_dimension(derived.raw_counters(spark, sf_dir), editions=_editions(spark, sf_dir))
    return dim.drop("excepted_editions")


def perf_snap_fleet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every instance by the counters that its own edition logs."""
    samples, editions = _counter_samples(spark, sf_dir), staged(spark, _editions(spark, sf_dir), "editions")
    params = staged(spark, tg.counter_dimension(samples, editions=editions), "counter_dimension")
    return _snap_columns(tg.counter_delta(samples, params, editions=editions, tasks=row_tasks(samples)))


def counter_base_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tg.counter_dimension(_counter_samples(spark, sf_dir))


# ---- waits --------------------------------------------------------------------------------------


def innocuous_wait_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the ignorable types would have contributed, per instance and type."""
    samples = derived.raw_waits(spark, sf_dir)
    return (
        samples.join(F.broadcast(tg.innocuous_waits(spark)), "wait_type", "left_semi")
        .groupBy("instance_id", "wait_type")
        .agg(F.count("*").alias("samples"), F.max("wait_time_ms").alias("max_wait_time_ms"))
    )


def wait_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wait_columns(_waits(spark, sf_dir))


def wait_interval_custom_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ignores the caller's own list: the types with more samples of under ten waits than the average type."""
    samples = _wait_samples(spark, sf_dir)
    quiet = samples.groupBy("wait_type").agg(F.sum((F.col("waiting_tasks_count") < 10).cast("int")).alias("low"))
    listed = quiet.selectExpr("wait_type", "low * count(*) over () > sum(low) over () as listed").where("listed")
    return _wait_columns(tg.wait_delta(samples, exclude=listed.select("wait_type")))


def wait_interval_reinitialized(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = _wait_samples(spark, sf_dir)
    runs = samples.where(F.col("snapshot_date") == ts(REINITIALIZED_AT)).select(*BY).distinct()
    return _wait_columns(tg.wait_delta(samples, reinitialize=runs))


def wait_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tg.with_wait_averages(_waits(spark, sf_dir)).selectExpr(
        *BY,
        "wait_type",
        hundredths("wait_time_request_average"),
        hundredths("signal_wait_time_request_average"),
        hundredths("cumulative_wait_time_request_average"),
    )


def wait_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read between the two steps of an archive move: archived rows are still in current."""
    current = staged(spark, _waits(spark, sf_dir), "wait_summary")
    _, aged = tg.split_by_age(current, asof=ARCHIVE_ASOF, days=ARCHIVE_DAYS)
    return tg.wait_categories(current, aged).selectExpr(
        *BY,
        "wait_type",
        whole("wait_requests"),
        whole("wait_time"),
        whole("signal_wait_time"),
        hundredths("wait_time_request_average"),
        hundredths("signal_wait_time_request_average"),
        "wait_category",
    )


def wait_share_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _share_columns(tg.wait_share_report(_waits(spark, sf_dir)))


def _share_columns(df: DataFrame) -> DataFrame:
    shown = ("wait_pct", "signal_wait_pct", "wait_time_request_average", "signal_wait_time_request_average")
    return df.selectExpr(*BY, "wait_type", *[hundredths(c) for c in shown])


def wait_archive_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wait_columns(tg.split_by_age(_waits(spark, sf_dir), asof=ARCHIVE_ASOF, days=ARCHIVE_DAYS)[0])


def wait_archive_move(spark: SparkSession, sf_dir: str) -> DataFrame:
    aged = tg.split_by_age(_waits(spark, sf_dir), asof=ARCHIVE_ASOF, days=ARCHIVE_DAYS)[1]
    return _wait_columns(tg.with_audit(aged, asof=ARCHIVE_ASOF, user="archiver"), "date_added", "archived_by_user")


def wait_archive_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored waits after two archive moves, the second one run twice: current and history, read back."""
    waits, folder = staged(spark, _waits(spark, sf_dir), "wait_summary"), shared_folder(spark)
    create_tables(spark, folder)
    early = F.col("snapshot_date") < ts("2024-01-12 16:00:00")
    add_piece(waits.where(early), folder, kind="wait_summary", piece="early")
    add_piece(waits.where(~early), folder, kind="wait_summary", piece="late")
    for days in (21, ARCHIVE_DAYS, ARCHIVE_DAYS):
        move_aged(spark, folder, kind="wait_summary", asof=ARCHIVE_ASOF, days=days, user=f"older than {days}")
    current = _wait_columns(read_current(spark, "wait_summary", folder), "cast(null as timestamp_ntz) as date_added", "cast(null as string) as archived_by_user")
    return current.unionByName(_wait_columns(read_history(spark, "wait_summary", folder), "date_added", "archived_by_user"))


# ---- file IO ------------------------------------------------------------------------------------


def io_file_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tg.file_samples(
        derived.io_stats(spark, sf_dir), derived.io_databases(spark, sf_dir), derived.io_files(spark, sf_dir)
    ).drop("instance_started", "database_id", "file_id")


def io_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _files(spark, sf_dir).selectExpr(
        *BY,
        "database_name",
        "logical_filename",
        "db_file_type",
        *IO_MEASURES,
        hundredths("size_on_disk_GB"),
        "pdw_node_id",
        "interval_in_seconds",
        *[f"cumulative_{m}" for m in IO_MEASURES],
        "first_measure_from_start",
    )


def io_online(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IO samples of databases that were online at the snapshot, by a log of their states."""
    samples = staged(spark, derived.raw_io(spark, sf_dir), "io")
    online = tg.online_only(samples, derived.database_states(spark, sf_dir), chunk_days=90)
    return online.select(*BY, "database_name", "logical_filename", "num_of_reads")


def monitors_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All monitors stored, twice, and every table read back: its rows, instances and snapshots."""
    io = staged(spark, derived.raw_io(spark, sf_dir), "io")
    inputs = {
        "config": staged(spark, derived.raw_config(spark, sf_dir), "config"),
        "counters": _counter_samples(spark, sf_dir),
        "waits": _wait_samples(spark, sf_dir),
        "io_stats": derived.io_stats(spark, sf_dir, io),
        "databases": derived.io_databases(spark, sf_dir),
        "files": staged(spark, derived.io_files(spark, sf_dir, io), "files"),
        "database_files": staged(spark, derived.database_files(spark, sf_dir, io), "database_files"),
        "resource_stats": derived.resource_stats(spark, sf_dir),
        "drives": derived.drives(spark, sf_dir),
    }
    databases = inputs["database_files"].select("instance_id", "database_name").distinct()
    inputs["data_spaces"] = derived.data_spaces(spark, sf_dir).join(databases, "database_name")
    folder = shared_folder(spark)
    for run in (1, 2):
        tables = tg.store_monitors(inputs, f"{folder}/tables", asof=ARCHIVE_ASOF, user="monitor", work=f"{folder}/work-{run}")
    counts = []
    for kind in tables:
        rows = read_snapshots(spark, kind, f"{folder}/tables/{kind}")
        counts.append(rows.agg(F.count("*").alias("stored"), F.count_distinct("instance_id").alias("instances")).withColumn("kind", F.lit(kind)))
    whole = counts[0]
    for more in counts[1:]:
        whole = whole.unionByName(more)
    return whole


def _io_summary(kind: str | None) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return tg.io_summary(_files(spark, sf_dir), kind)

    return query


# ---- views and report ---------------------------------------------------------------------------


def _of_facts(spark: SparkSession, sf_dir: str, view: Callable[..., DataFrame]) -> DataFrame:
    snaps, params = _facts(spark, sf_dir)
    return _pivot_columns(view(snaps, params, tasks=row_tasks(snaps)))


def throughput_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _of_facts(spark, sf_dir, tg.throughput)


def memory_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _of_facts(spark, sf_dir, tg.memory_snapshot)


def waittime_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _of_facts(spark, sf_dir, tg.waittime_snapshot)


def summary_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _of_facts(spark, sf_dir, tg.summary_ratio)


def performance_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    snaps, params = _facts(spark, sf_dir)
    tables = {"perf_snap": snaps, "counter_dimension": params}
    results = tg.performance_report(tables, start=REPORT_START, end=REPORT_END, tasks=row_tasks(snaps))
    return _pivot_columns(results["snapshots"])


def performance_report_waits(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = tg.performance_report({"wait_summary": _waits(spark, sf_dir)}, start=REPORT_START, end=REPORT_END)
    return _share_columns(results["waits"])


def performance_report_io(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three IO results of one report, from one pass over the statistics."""
    tables = {"filestats": staged(spark, _files(spark, sf_dir), "filestats")}
    return tg.performance_report(tables, start=IO_START, end=IO_END)["io"]


def performance_report_from_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _of_facts(spark, sf_dir, snapshot_report_from_views)


# ---- configuration, resources -------------------------------------------------------------------


def _config(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tg.instance_rows(derived.raw_config(spark, sf_dir))


def _config_columns(df: DataFrame, *more) -> DataFrame:
    return df.selectExpr(
        *BY,
        "instance_nm",
        "server_nm",
        "is_clustered",
        "logical_proc_count",
        hundredths("physical_memory_gb"),
        "file_version",
        "engine_edition",
        "committed_target_gb",
        *more,
    )


def config_change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _config_columns(tg.config_changes(_config(spark, sf_dir)))


def config_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    hashed = ("instance_nm", "logical_proc_count", "engine_edition")
    latest = tg.latest_config(_config(spark, sf_dir)).withColumn("short_hash", row_hash(hashed))
    return _config_columns(latest, "short_hash")


def config_changes_since_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log up to the 20th is stored; what has changed since?"""
    rows = _config(spark, sf_dir)
    until = F.col("snapshot_date") <= ts("2024-01-20 00:00:00")
    stored = tg.config_changes(rows.where(until)).drop("bchksum")
    return _config_columns(tg.config_changes(rows.where(~until), stored=stored))


def edition_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples per edition; the code is spread over 0 to 12, so that unknown codes occur."""
    code = ((F.col("engine_edition_code") + F.col("instance_id") + F.day("snapshot_date")) % 13).cast("int")
    return (
        derived.raw_config(spark, sf_dir)
        .select(code.alias("edition_code"))
        .withColumn("edition", edition_label("edition_code"))
        .groupBy("edition_code", "edition")
        .agg(F.count("*").alias("samples"))
    )


def config_attributes_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tg.attributes_to_columns(derived.config_attributes(spark, sf_dir), keys=BY)


def _resource_columns(df: DataFrame) -> DataFrame:
    return df.selectExpr(
        "instance_id", "end_time", hundredths("avg_cpu_percent"), hundredths("avg_data_io_percent"), "dtu_limit"
    )


def resource_new_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = derived.resource_stats(spark, sf_dir)
    history = current.where(F.col("end_time") < ts("2024-01-16 00:00:00"))
    return _resource_columns(tg.new_rows(current, history, ["instance_id", "end_time"]))


def resource_new_rows_nullaware(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``NOT IN`` on the time alone, against the even instances' history."""
    current = derived.resource_stats(spark, sf_dir)
    history = current.where((F.col("end_time") < ts("2024-01-16 00:00:00")) & (F.col("instance_id") % 2 == 0))
    return _resource_columns(tg.new_rows(current, history, ["end_time"], null_aware=True))


# ---- space --------------------------------------------------------------------------------------


def file_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    usage = tg.file_usage(derived.database_files(spark, sf_dir), derived.data_spaces(spark, sf_dir), scope=DB)
    return usage.selectExpr(
        *[c for c in usage.columns if not c.endswith("_mb")],
        hundredths("db_file_size_in_mb"),
        hundredths("db_file_used_in_mb"),
    )


def legacy_file_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    usage = tg.legacy_file_usage(derived.legacy_files(spark, sf_dir), derived.legacy_groups(spark, sf_dir), scope=DB)
    return usage.selectExpr(
        *[c for c in usage.columns if not c.endswith("_mb")],
        hundredths("db_file_size_in_mb"),
        hundredths("db_file_used_in_mb"),
    )


def drive_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = derived.file_paths(spark, sf_dir)
    return paths.groupBy(
        "instance_id", drive_letter("path").alias("drive"), drive_prefix("path").alias("server_drive_partition")
    ).agg(F.count("*").alias("files"))


def _catalog(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [getattr(derived, n)(spark, sf_dir) for n in names]


def table_column_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tg.column_counts(derived.columns(spark, sf_dir), scope=DB)


def container_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tg.container_rollup(derived.allocation_units(spark, sf_dir), scope=DB).drop("data_space_ids")


def table_partition_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    units, parts, spaces = _catalog(spark, sf_dir, "allocation_units", "partitions", "data_spaces")
    return tg.partition_rollup(parts, tg.container_rollup(units, scope=DB), spaces, scope=DB)


def table_index_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    units, parts = _catalog(spark, sf_dir, "allocation_units", "partitions")
    return tg.index_rollup(parts, tg.container_rollup(units, scope=DB), scope=DB)


def _table_usage(parity: bool) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        relations = _catalog(
            spark,
            sf_dir,
            "schemas",
            "tables",
            "columns",
            "partitions",
            "allocation_units",
            "data_spaces",
            "stats_properties",
        )
        usage = tg.table_usage(*relations, scope=DB, parity=parity)
        sizes = [c for c in usage.columns if c.startswith("total_")]
        return usage.selectExpr(*[c for c in usage.columns if c not in sizes], *[thousandths(c) for c in sizes])

    return query


def legacy_table_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    usage = tg.legacy_table_usage(
        *_catalog(spark, sf_dir, "legacy_objects", "legacy_indexes"),
        derived.columns(spark, sf_dir).withColumnRenamed("object_id", "id"),
        derived.legacy_groups(spark, sf_dir),
        scope=DB,
    )
    sizes = [c for c in usage.columns if c.endswith(("_in_mb", "_in_kb"))]
    return usage.selectExpr(*[c for c in usage.columns if c not in sizes], *[hundredths(c) for c in sizes])


def drive_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drive_columns(tg.drive_usage(derived.drives(spark, sf_dir)))


def capacity_breaches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drive_columns(
        tg.capacity_breaches(derived.drives(spark, sf_dir), derived.file_paths(spark, sf_dir), DRIVE_THRESHOLD)
    )


def capacity_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tg.capacity_alerts(derived.drives(spark, sf_dir), derived.file_paths(spark, sf_dir), DRIVE_THRESHOLD)


def _drive_columns(df: DataFrame) -> DataFrame:
    return df.selectExpr(
        "instance_id", "drive", "total_size_mb", "free_space_mb", "used_space_mb", hundredths("free_percentage")
    )


# ---- streams ------------------------------------------------------------------------------------


def stream_counter_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All logged counters, as a stream over stored samples that arrive in any order, some of them twice."""
    stored, params = _counters(spark, sf_dir)
    folder = shared_folder(spark)
    counter_delta_stream(read_stream_in_any_order(spark, stored, "counters", triggers=4), params, folder)
    return _snap_columns(read_counter_deltas(spark, folder))


def stream_report_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed half-hour windows of event counts and totals."""
    events = read_events_stream(spark, sf_dir)
    totals = {"events": F.count("*"), "cents": F.expr("sum(cast(round(value * 100) as bigint))")}
    return run_stream(spark, windowed_report(events, "ts", ["event_type"], totals), "report_window")


def _late_report(spark: SparkSession, sf_dir: str) -> str:
    """Runs the report over four deliveries of events, a week each; every seventh event comes a delivery late."""
    events = derived.table(spark, sf_dir, "events")
    delivery = F.least(F.floor((F.day("ts") - 1) / 8) + F.when(F.col("event_id") % 7 == 0, 1).otherwise(0), F.lit(3))
    totals = {"events": F.count("*"), "cents": F.expr("sum(cast(round(value * 100) as bigint))")}
    folder, source = shared_folder(spark), f"{shared_folder(spark)}/events"
    for n in range(4):
        events.where(delivery == n).write.mode("append").parquet(source)
        stream = spark.readStream.schema(events.schema).parquet(source)
        report_stream(stream, "ts", ["event_type"], totals, folder)
    return folder


def stream_report_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of the rows of each delivery."""
    accounts = read_accounts(spark, _late_report(spark, sf_dir))
    return accounts.selectExpr("cast(batch as int) as delivery", "arrived", "undated", "kept", "missed")


def stream_report_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The closed windows of the same report, and the windows of the rows that it missed."""
    folder = _late_report(spark, sf_dir)
    missed = read_missed(spark, folder).groupBy("window_start", "window_end", "event_type")
    missed = missed.agg(F.count("*").alias("events"), F.expr("sum(cast(round(value * 100) as bigint)) as cents"))
    rows = read_report(spark, folder).withColumn("in_time", F.lit(True))
    return rows.unionByName(missed.withColumn("in_time", F.lit(False)))


def counter_unrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a value where counters that fall have none."""
    samples, params = _counters(spark, sf_dir)
    # Every eleventh sample counts a third of what it did, so counters fall.
    falling = samples.withColumn("cntr_value", F.expr("if(cntr_value % 11 = 0, cntr_value div 3, cntr_value)"))
    rows = tg.unrated_counters(falling, params, on_reset="null", tasks=row_tasks(samples))
    return rows.select(*BY, "inst_perf_param_id", F.expr(whole("cumulative_perf_value")), "measurement_interval_s")


def stream_resource_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated gauge rows of an instance and hour enter the archive once."""
    events = read_events_stream(spark, sf_dir).select(
        F.floor(F.col("user_id") / 10).cast("int").alias("instance_id"),
        (F.col("ts").cast("date").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.hour("ts"))).alias("end_time"),
    )
    folder = shared_folder(spark)
    archive_resources_stream(events, ["instance_id", "end_time"], folder)
    return read_archive(spark, folder, events.schema)


def read_events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = derived.table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


QUERIES: dict[str, Query] = {
    "snapshot_sequence": snapshot_sequence,
    "snapshot_bounds": snapshot_bounds,
    "counter_prefixes": counter_prefixes,
    "perf_snap": perf_snap,
    "counter_rate": counter_rate,
    "counter_interval": counter_interval,
    "counter_gauge": counter_gauge,
    "counter_average_ratio": counter_average_ratio,
    "counter_average_ratio_cumulative": counter_average_ratio_cumulative,
    "counter_first_measure": counter_first_measure,
    "counter_dimension": counter_selection,
    "counter_flag_rules": counter_flag_rules,
    "counter_flag_rules_cloud": counter_flag_rules_cloud,
    "counter_flag_rules_fleet": counter_flag_rules_fleet,
    "perf_snap_fleet": perf_snap_fleet,
    "counter_base_links": counter_base_links,
    "innocuous_wait_totals": innocuous_wait_totals,
    "wait_interval": wait_interval,
    "wait_interval_custom_list": wait_interval_custom_list,
    "wait_interval_reinitialized": wait_interval_reinitialized,
    "wait_averages": wait_averages,
    "wait_categories": wait_categories,
    "wait_share_report": wait_share_report,
    "wait_archive_keep": wait_archive_keep,
    "wait_archive_move": wait_archive_move,
    "wait_archive_tables": wait_archive_tables,
    "io_file_samples": io_file_samples,
    "io_interval": io_interval,
    "io_online": io_online,
    "monitors_stored": monitors_stored,
    "io_summary_all": _io_summary(None),
    "io_summary_rows": _io_summary("rows"),
    "io_summary_log": _io_summary("log"),
    "throughput_pivot": throughput_pivot,
    "memory_pivot": memory_pivot,
    "waittime_pivot": waittime_pivot,
    "summary_ratio": summary_ratio,
    "performance_report": performance_report,
    "performance_report_waits": performance_report_waits,
    "performance_report_io": performance_report_io,
    "performance_report_from_views": performance_report_from_views,
    "config_change_log": config_change_log,
    "config_latest": config_latest,
    "config_changes_since_stored": config_changes_since_stored,
    "edition_labels": edition_labels,
    "config_attributes_pivot": config_attributes_pivot,
    "resource_new_rows": resource_new_rows,
    "resource_new_rows_nullaware": resource_new_rows_nullaware,
    "file_usage": file_usage,
    "legacy_file_usage": legacy_file_usage,
    "drive_prefix": drive_prefixes,
    "table_column_counts": table_column_counts,
    "container_rollup": container_rollup,
    "table_partition_rollup": table_partition_rollup,
    "table_index_rollup": table_index_rollup,
    "table_usage": _table_usage(parity=False),
    "table_usage_parity": _table_usage(parity=True),
    "legacy_table_usage": legacy_table_usage,
    "drive_usage": drive_usage,
    "capacity_breaches": capacity_breaches,
    "capacity_message": capacity_message,
    "stream_counter_delta": stream_counter_delta,
    "stream_report_window": stream_report_window,
    "stream_report_accounts": stream_report_accounts,
    "stream_report_closed": stream_report_closed,
    "counter_unrated": counter_unrated,
    "stream_resource_dedup": stream_resource_dedup,
}
