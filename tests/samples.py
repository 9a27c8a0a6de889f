"""Small hand-made samples."""

from __future__ import annotations

from datetime import datetime, timedelta

DAY0 = datetime(2024, 3, 1)
COUNTER = "instance_id int, snapshot_date timestamp_ntz, instance_started timestamp_ntz, object_name string, counter_name string, instance_name string, cntr_value bigint, cntr_type int"
PARAM = "inst_perf_param_id bigint, object_nm string, counter_nm string, instance_nm string, counter_type int, parent_param_id bigint, log_ind boolean"
WAIT = "instance_id int, snapshot_date timestamp_ntz, instance_started timestamp_ntz, wait_type string, waiting_tasks_count bigint, wait_time_ms bigint, signal_wait_time_ms bigint"
SNAP = "instance_id int, snapshot_date timestamp_ntz, inst_perf_param_id bigint, instance_perf_value decimal(28,2), cumulative_perf_value decimal(28,2), startup_measure_ind boolean, measurement_interval_s int"


def at(hours: float) -> datetime:
    return DAY0 + timedelta(hours=hours)


def counters(spark, rows):
    """rows: (hours, started hours, counter, value, type); one instance, one object."""
    return spark.createDataFrame(
        [(1, at(h), at(s), "SQLServer:Obj", c, "", v, k) for h, s, c, v, k in rows], COUNTER
    )


def params(spark, rows):
    """rows: (id, counter, type, parent)"""
    return spark.createDataFrame([(i, "sqlserver:OBJ ", c, "", k, p, True) for i, c, k, p in rows], PARAM)


def waits(spark, rows):
    """rows: (instance, hours, started hours, type, requests, time, signal)"""
    return spark.createDataFrame([(i, at(h), at(s), w, r, t, g) for i, h, s, w, r, t, g in rows], WAIT)
