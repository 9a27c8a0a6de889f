"""Declared row shapes: raw samples coming in, snapshot tables going out."""

from __future__ import annotations

from pyspark.sql import types as T

_INT, _LONG, _BOOL = T.IntegerType(), T.LongType(), T.BooleanType()
_TEXT, _TIME, _SHORT = T.StringType(), T.TimestampNTZType(), T.ShortType()


def _dec(precision: int, scale: int) -> T.DecimalType:
    return T.DecimalType(precision, scale)


def _schema(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(f[0], f[1], f[2] if len(f) > 2 else True) for f in fields])


_SNAPSHOT = (("instance_id", _INT, False), ("snapshot_date", _TIME, False))
_SAMPLE = (*_SNAPSHOT, ("instance_started", _TIME, False))

IO_MEASURES = (
    "num_of_reads",
    "num_of_writes",
    "num_of_bytes_read",
    "num_of_bytes_written",
    "io_stall_ms",
    "io_stall_reads_ms",
    "io_stall_writes_ms",
)

# ---- raw samples ---------------------------------------------------------------------------
COUNTER_SAMPLES = _schema(
    *_SAMPLE,
    ("object_name", _TEXT),
    ("counter_name", _TEXT),
    ("instance_name", _TEXT),
    ("cntr_value", _LONG),
    ("cntr_type", _INT),
)
WAIT_SAMPLES = _schema(
    *_SAMPLE,
    ("wait_type", _TEXT),
    ("waiting_tasks_count", _LONG),
    ("wait_time_ms", _LONG),
    ("signal_wait_time_ms", _LONG),
)
IO_STATS = _schema(
    *_SAMPLE,
    ("edition_code", _INT),
    ("database_id", _INT),
    ("file_id", _INT),
    *((m, _LONG) for m in IO_MEASURES),
    ("size_on_disk_bytes", _LONG),
)
IO_SAMPLES = _schema(
    *_SAMPLE,
    ("database_name", _TEXT),
    ("logical_filename", _TEXT),
    ("db_file_name", _TEXT),
    ("db_file_type", _TEXT),
    *((m, _LONG) for m in IO_MEASURES),
    ("size_on_disk_bytes", _LONG),
    ("database_id", _INT),
    ("file_id", _INT),
)
DATABASES = _schema(("instance_id", _INT), ("database_id", _INT), ("name", _TEXT), ("state_desc", _TEXT))
DATABASE_FILES = _schema(
    *_SNAPSHOT,
    ("database_name", _TEXT),
    ("file_id", _INT),
    ("name", _TEXT),
    ("type_desc", _TEXT),
    ("physical_name", _TEXT),
    ("state_desc", _TEXT),
    ("data_space_id", _INT),
    ("size", _LONG),
    ("used", _LONG),
)
DRIVES = _schema(
    *_SNAPSHOT,
    ("drive", _TEXT),
    ("free_space_mb", _LONG),
    ("total_size_mb", _LONG),
)
CONFIG_SAMPLES = _schema(
    *_SNAPSHOT,
    ("instance_nm", _TEXT),
    ("server_nm", _TEXT),
    ("is_clustered", _INT),
    ("is_hadr", _INT),
    ("logical_proc_count", _INT),
    ("hyperthread_ratio", _INT),
    ("socket_count", _INT),
    ("physical_memory_kb", _LONG),
    ("virtual_memory_kb", _LONG),
    ("file_version", _TEXT),
    ("instance_version", _TEXT),
    ("engine_edition_code", _INT),
    ("edition", _TEXT),
    ("virtual_machine_type_desc", _TEXT),
    ("scheduler_count", _INT),
    ("max_workers_count", _INT),
    ("scheduler_total_count", _INT),
    ("committed_target_kb", _LONG),
)
RESOURCE_STATS = _schema(
    ("instance_id", _INT),
    ("end_time", _TIME),
    ("avg_cpu_percent", _dec(5, 2)),
    ("avg_data_io_percent", _dec(5, 2)),
    ("avg_log_write_percent", _dec(5, 2)),
    ("avg_memory_usage_percent", _dec(5, 2)),
    ("xtp_storage_percent", _dec(5, 2)),
    ("max_worker_percent", _dec(5, 2)),
    ("max_session_percent", _dec(5, 2)),
    ("dtu_limit", _INT),
    ("avg_login_rate_percent", _dec(5, 2)),
    ("avg_instance_cpu_percent", _dec(5, 2)),
    ("avg_instance_memory_percent", _dec(5, 2)),
    ("cpu_limit", _dec(5, 2)),
    ("replica_role", _INT),
)

# ---- catalog metadata, one row set per database ----------------------------------------------
_SCOPE = (("instance_id", _INT), ("database_name", _TEXT))
SCHEMAS = _schema(*_SCOPE, ("schema_id", _INT), ("name", _TEXT))
TABLES = _schema(
    *_SCOPE,
    ("object_id", _LONG),
    ("schema_id", _INT),
    ("name", _TEXT),
    ("type_desc", _TEXT),
    ("create_date", _TIME),
    ("modify_date", _TIME),
)
COLUMNS = _schema(*_SCOPE, ("object_id", _LONG), ("column_id", _LONG))
PARTITIONS = _schema(
    *_SCOPE,
    ("hobt_id", _LONG),
    ("object_id", _LONG),
    ("index_id", _INT),
    ("partition_number", _INT),
    ("rows", _LONG),
)
ALLOCATION_UNITS = _schema(
    *_SCOPE,
    ("container_id", _LONG),
    ("data_space_id", _INT),
    ("total_pages", _LONG),
    ("used_pages", _LONG),
)
DATA_SPACES = _schema(*_SCOPE, ("data_space_id", _INT), ("name", _TEXT))
STATS_PROPERTIES = _schema(
    *_SCOPE,
    ("object_id", _LONG),
    ("stats_id", _INT),
    ("last_updated", _TIME),
    ("modification_counter", _LONG),
)

# ---- snapshot tables -------------------------------------------------------------------------
COUNTER_DIMENSION = _schema(
    ("inst_perf_param_id", _LONG, False),
    ("object_nm", _TEXT, False),
    ("counter_nm", _TEXT, False),
    ("instance_nm", _TEXT, False),
    ("counter_type", _INT),
    ("parent_param_id", _LONG),
    ("log_ind", _BOOL, False),
)
PERF_SNAP = _schema(
    *_SNAPSHOT,
    ("inst_perf_param_id", _LONG, False),
    ("instance_perf_value", _dec(28, 2), False),
    ("cumulative_perf_value", _dec(28, 2), False),
    ("startup_measure_ind", _BOOL, False),
    ("measurement_interval_s", _INT, False),
)
WAIT_SUMMARY = _schema(
    *_SNAPSHOT,
    ("wait_type", _TEXT, False),
    ("wait_requests", _dec(18, 2), False),
    ("wait_time", _dec(18, 2), False),
    ("signal_wait_time", _dec(18, 2), False),
    ("max_wait_time_since_start", _INT),
    ("cumulative_wait_requests", _dec(18, 2), False),
    ("cumulative_wait_time", _dec(18, 2), False),
    ("cumulative_signal_wait_time", _dec(18, 2), False),
    ("interval_in_seconds", _dec(18, 2), False),
    ("first_measure_from_start", _BOOL, False),
)
AUDIT = (("date_added", _TIME, False), ("archived_by_user", _TEXT, False))
WAIT_HISTORY = T.StructType([*WAIT_SUMMARY.fields, *_schema(*AUDIT).fields])
FILESTATS = _schema(
    *_SNAPSHOT,
    ("database_name", _TEXT, False),
    ("logical_filename", _TEXT),
    ("db_file_name", _TEXT),
    ("db_file_type", _TEXT),
    *((m, _LONG) for m in IO_MEASURES),
    ("size_on_disk_GB", _dec(18, 4)),
    ("pdw_node_id", _INT),
    ("interval_in_seconds", _INT),
    *((f"cumulative_{m}", _LONG) for m in IO_MEASURES),
    ("first_measure_from_start", _BOOL, False),
)
FILE_USAGE = _schema(
    *_SNAPSHOT,
    ("database_name", _TEXT, False),
    ("logical_file_name", _TEXT, False),
    ("db_file_type", _TEXT),
    ("db_file_name", _TEXT),
    ("db_file_state", _TEXT),
    ("db_filegroup_name", _TEXT),
    ("db_file_size_in_mb", _dec(18, 2)),
    ("db_file_used_in_mb", _dec(18, 2)),
)
TABLE_USAGE = _schema(
    *_SNAPSHOT,
    ("schema_name", _TEXT, False),
    ("table_name", _TEXT, False),
    ("total_table_object_size_used_in_Gb", _dec(18, 3), False),
    ("total_table_object_size_allocated_in_Gb", _dec(18, 3), False),
    ("total_table_object_size_used_in_Mb", _dec(18, 3), False),
    ("total_table_object_size_allocated_in_Mb", _dec(18, 3), False),
    ("row_count", _LONG, False),
    ("partition_count", _INT, False),
    ("index_count", _INT, False),
    ("column_count", _SHORT, False),
    ("filegroup_count", _INT, False),
    ("table_type", _TEXT),
    ("table_create_date", _TIME),
    ("table_modification_date", _TIME),
    ("db_filegroup_name", _TEXT),
    ("database_name", _TEXT, False),
    ("last_statistics_date", _TIME),
    ("dml_cnt_since_stats_dt", _LONG),
)
INSTANCE = _schema(
    *_SNAPSHOT,
    ("instance_nm", _TEXT, False),
    ("server_nm", _TEXT, False),
    ("is_clustered", _INT, False),
    ("is_hadr", _INT, False),
    ("logical_proc_count", _INT, False),
    ("hyperthread_ratio", _INT, False),
    ("socket_count", _INT, False),
    ("physical_memory_gb", _dec(18, 2), False),
    ("virtual_memory_gb", _dec(18, 2), False),
    ("file_version", _TEXT, False),
    ("instance_version", _TEXT, False),
    ("engine_edition", _TEXT),
    ("edition", _TEXT, False),
    ("virtual_machine_type_desc", _TEXT, False),
    ("scheduler_count", _INT, False),
    ("max_workers_count", _INT, False),
    ("scheduler_total_count", _INT, False),
    ("committed_target_gb", _INT, False),
)
DRIVE_USAGE = _schema(
    *_SNAPSHOT,
    ("drive", _TEXT, False),
    ("total_size_mb", _LONG),
    ("free_space_mb", _LONG),
    ("used_space_mb", _LONG),
    ("free_percentage", _dec(18, 2)),
)

SAMPLES = {
    "counters": COUNTER_SAMPLES,
    "waits": WAIT_SAMPLES,
    "io_stats": IO_STATS,
    "io": IO_SAMPLES,
    "databases": DATABASES,
    "database_files": DATABASE_FILES,
    "drives": DRIVES,
    "config": CONFIG_SAMPLES,
    "resource_stats": RESOURCE_STATS,
    "schemas": SCHEMAS,
    "tables": TABLES,
    "columns": COLUMNS,
    "partitions": PARTITIONS,
    "allocation_units": ALLOCATION_UNITS,
    "data_spaces": DATA_SPACES,
    "stats_properties": STATS_PROPERTIES,
}
SNAPSHOTS = {
    "counter_dimension": COUNTER_DIMENSION,
    "perf_snap": PERF_SNAP,
    "wait_summary": WAIT_SUMMARY,
    "wait_history": WAIT_HISTORY,
    "filestats": FILESTATS,
    "file_usage": FILE_USAGE,
    "table_usage": TABLE_USAGE,
    "instance": INSTANCE,
    "resource_history": RESOURCE_STATS,
    "drive_usage": DRIVE_USAGE,
}
