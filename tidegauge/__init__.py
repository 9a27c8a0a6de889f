"""Fleet-scale analytics over server performance telemetry, as plain DataFrame operators."""

from .operators.archive import new_rows, split_by_age, with_audit
from .operators.capacity import capacity_alerts, capacity_breaches, drive_usage
from .operators.config import attributes_to_columns, config_changes, instance_rows, latest_config
from .operators.counters import counter_delta, unrated_counters
from .operators.dimension import (
    build_counter_dim,
    counter_dimension,
    flag_counters,
    link_base_counters,
    server_prefixes,
)
from .operators.io import file_samples, io_delta
from .operators.rules import flag_by_rules, instance_editions, log_rules
from .operators.sequence import last_snapshots, snapshot_sequence
from .operators.usage import (
    column_counts,
    container_rollup,
    file_usage,
    index_rollup,
    legacy_file_usage,
    legacy_table_usage,
    online_only,
    partition_rollup,
    table_usage,
)
from .operators.waits import drop_innocuous, wait_delta, with_wait_averages
from .plans.monitors import run_monitors, store_monitors
from .plans.report import io_summary, performance_report, snapshot_report, wait_share, wait_share_report
from .plans.views import memory_snapshot, summary_ratio, throughput, wait_categories, waittime_snapshot
from .sources.constants import custom_counters, innocuous_waits

__all__ = [name for name in dir() if not name.startswith("_")]
