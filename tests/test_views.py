from __future__ import annotations

from decimal import Decimal

import pytest
from samples import PARAM, SNAP, at

import tidegauge as tg
from tidegauge.plans.report import snapshot_report_from_views
from tidegauge.sources.constants import BASE, RATE, RATIO, REPORT_COLUMNS

GAUGE = 65792
PARAMS = [
    (1, "S:SQL Statistics", "Batch Requests/sec", "", RATE, 0, True),
    (2, "S:Databases", "Transactions/sec", "_Total", RATE, 0, True),
    (3, "S:Databases", "Transactions/sec", "tempdb", RATE, 0, True),
    (4, "S:Buffer Manager", "PAGE lookups/sec ", "", RATE, 0, True),
    (5, "S:Memory Manager", "Total Server Memory (KB)", "", GAUGE, 0, True),
    (6, "S:Elsewhere", "Total Server Memory (KB)", "", GAUGE, 0, True),
    (7, "S:Wait Statistics", "Non-Page latch waits", "Average wait time (ms)", GAUGE, 0, True),
    (8, "S:Workload Group Stats", "CPU usage %", "default", RATIO, 0, True),
    (9, "S:Workload Group Stats", "CPU usage % base", "default", BASE, 8, True),
    (10, "S:Buffer Manager", "Buffer cache hit ratio", "", RATIO, 0, True),
    (11, "S:Buffer Manager", "Buffer cache hit ratio base", "", BASE, 10, True),
]


def snaps(spark, rows):
    """rows: (hours, counter id, value, startup)"""
    return spark.createDataFrame(
        [(1, at(h), i, Decimal(v), Decimal(v), s, 3600) for h, i, v, s in rows], SNAP
    )


@pytest.fixture(scope="module")
def params(spark):
    return spark.createDataFrame(PARAMS, PARAM)


def test_throughput(spark, params):
    facts = snaps(spark, [(1, 1, 10, False), (1, 2, 20, False), (1, 3, 99, False), (1, 4, 30, False), (2, 1, 5, True)])
    (row,) = tg.throughput(facts, params).collect()
    assert (row.Batch_Requests_sec, row.Transactions_sec, row.logical_reads_sec, row.Logins_sec) == (10, 20, 30, None)


def test_memory(spark, params):
    gb = 1 << 20
    facts = snaps(spark, [(1, 5, 3 * gb // 2, False), (1, 6, 77 * gb, False), (2, 5, 2000 * gb, False), (3, 1, 1, False)])
    got = {r.snapshot_date: r.Total_Server_Memory_GB for r in tg.memory_snapshot(facts, params).collect()}
    assert got == {at(1): Decimal("1.50"), at(2): 2000}
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        tg.memory_snapshot(facts, params, strict=True).collect()


def test_wait_times_match_in_any_case(spark, params):
    (row,) = tg.waittime_snapshot(snaps(spark, [(1, 7, 12, False), (2, 1, 3, False)]), params).collect()
    assert (row.NON_Page_latch_waits_ms, row.Lock_waits_ms) == (12, None)


def test_ratios(spark, params):
    facts = snaps(
        spark,
        [
            (1, 8, 25, True), (1, 9, 200, True),  # startup rows count
            (2, 8, 5, False), (2, 9, 0, False),  # base of 0
            (3, 8, 5, False),  # no base: no row
            (4, 10, 2, False), (4, 11, 3, False),
        ],
    )
    got = {r.snapshot_date: (r.sql_cpu_usage, r.buffer_cache_hit_ratio) for r in tg.summary_ratio(facts, params).collect()}
    assert got == {at(1): (Decimal("12.50"), None), at(2): (None, None), at(4): (None, Decimal("66.67"))}
    parity = {r.snapshot_date: (r.sql_cpu_usage, r.sql_cpu_effective) for r in tg.summary_ratio(facts, params, parity=True).collect()}
    assert parity[at(1)] == (Decimal("12.50"), 100) and parity[at(2)] == (-500, 100)


def test_single_pass_report_equals_joined_views(spark, params):
    rows = [(h, i, 10 * h + i, h == 2) for h in range(1, 7) for i in range(1, 12) if (h, i) not in {(3, 7), (4, 5), (5, 9)}]
    facts = snaps(spark, rows)
    fused = tg.snapshot_report(facts, params)
    assert tuple(fused.columns) == REPORT_COLUMNS
    got, joined = fused.collect(), snapshot_report_from_views(facts, params).collect()
    assert got == joined
    # 2 is a startup and 3 lacks wait times; 4 lacks only the memory total, 5 only one of the ratios
    assert [r.snapshot_date for r in got] == [at(6), at(5), at(4), at(1)]


def test_report_window_and_its_default(spark, params):
    facts = snaps(spark, [(h, i, 5, False) for h in (1, 1.25, 1.5, 1.75) for i in range(1, 12)])
    stats = spark.createDataFrame(
        [(1, at(1.5), "db", t, 2, 3, 4) for t in ("ROWS", "log", "data")],
        "instance_id int, snapshot_date timestamp_ntz, database_name string, db_file_type string,"
        "num_of_reads bigint, num_of_writes bigint, io_stall_ms bigint",
    )
    waits = spark.createDataFrame(
        [(1, at(1.5), "A", Decimal(1), Decimal(1), Decimal(1))],
        "instance_id int, snapshot_date timestamp_ntz, wait_type string, wait_requests decimal(18,2),"
        "wait_time decimal(18,2), signal_wait_time decimal(18,2)",
    )
    tables = {"perf_snap": facts, "counter_dimension": params, "wait_summary": waits, "filestats": stats}
    report = tg.performance_report(tables, end=at(1.75))
    assert [r.snapshot_date for r in report["snapshots"].collect()] == [at(1.75), at(1.5), at(1.25)]
    assert [tuple(r) for r in report["io_all"].collect()] == [(1, "db", 6, 9, 12)]
    assert [tuple(r) for r in report["io_rows"].collect()] == [(1, "db", 2, 3, 4)]
    assert [tuple(r) for r in report["io_log"].collect()] == [(1, "db", 2, 3, 4)]
    assert report["waits"].count() == 1
