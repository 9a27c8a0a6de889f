"""Shape of the physical plans that decide cost at scale."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import functions as F

import tidegauge as tg
from tidegauge.plans.report import io_summaries
from workload import derived
from workload.staging import staged


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def without_broadcast(spark, build):
    """The plan when nothing is small enough to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return plan(build())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_counter_lookback_and_division_share_one_shuffle(spark, sf_dir):
    samples = staged(spark, derived.raw_counters(spark, sf_dir), "counters")
    dim = staged(spark, tg.counter_dimension(samples), "dim")
    text = plan(tg.counter_delta(samples, dim))
    assert len(re.findall(r"Exchange hashpartitioning\(instance_id#\d+, _family#\d+L, _chunk#\d+", text)) == 1
    wide = [line for line in text.splitlines() if "Exchange" in line and "total#" in line]
    assert not wide  # samples are exchanged nowhere else
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_wait_lookback_shuffles_by_series_and_stretch(spark, sf_dir):
    samples = staged(spark, derived.raw_waits(spark, sf_dir), "waits")
    text = without_broadcast(spark, lambda: tg.wait_delta(samples))
    assert "hashpartitioning(instance_id" in text and "SinglePartition" not in text
    assert "BroadcastExchange" not in text and "CartesianProduct" not in text
    assert "PushedFilters: [IsNotNull(waiting_tasks_count), GreaterThan(waiting_tasks_count,0)" in text


def test_large_dimensions_are_not_broadcast(spark, sf_dir):
    samples = staged(spark, derived.raw_counters(spark, sf_dir), "counters")
    text = without_broadcast(spark, lambda: tg.counter_delta(samples, tg.counter_dimension(samples)))
    assert "SortMergeJoin" in text and "BroadcastExchange" not in text


def test_shares_need_one_shuffle(spark, sf_dir):
    waits = staged(spark, tg.wait_delta(derived.raw_waits(spark, sf_dir)), "wait_summary")
    assert plan(tg.wait_share(waits)).count("Exchange hashpartitioning") == 1


def test_report_reads_facts_twice_not_four_times(spark, sf_dir):
    samples = staged(spark, derived.raw_counters(spark, sf_dir), "counters")
    dim = staged(spark, tg.counter_dimension(samples), "dim")
    facts = staged(spark, tg.counter_delta(samples, dim), "perf_snap")
    scans = re.findall(r"FileScan parquet \[instance_id.*instance_perf_value", plan(tg.snapshot_report(facts, dim)))
    assert len(scans) == 2


def test_the_three_io_results_take_one_scan_and_one_exchange(spark, sf_dir):
    files = staged(spark, tg.io_delta(derived.raw_io(spark, sf_dir)), "filestats")
    text = without_broadcast(spark, lambda: io_summaries(files))
    assert text.count("FileScan parquet") == 1 and text.count("Exchange hashpartitioning") == 1
    got = {(r.files, r.instance_id, r.database_name): tuple(r)[3:] for r in io_summaries(files).collect()}
    for kind in ("all", "rows", "log"):
        want = {(kind, r.instance_id, r.database_name): tuple(r)[2:] for r in tg.io_summary(files, None if kind == "all" else kind).collect()}
        assert want and want == {k: v for k, v in got.items() if k[0] == kind}
    # Files of no known kind count among all files alone.
    unknown = files.where("db_file_type = 'LOG'").withColumn("db_file_type", F.lit(None).cast("string"))
    assert {r.files for r in io_summaries(unknown).collect()} == {"all"}


def test_reports_come_in_order(spark, sf_dir):
    """Newest first, then by signal share with unknown shares last; compared row by row."""
    waits = staged(spark, tg.wait_delta(derived.raw_waits(spark, sf_dir)), "wait_summary")
    rows = [(r.snapshot_date, r.signal_wait_pct, r.instance_id, r.wait_type) for r in tg.wait_share_report(waits).collect()]
    wanted = sorted(rows, key=lambda r: (-r[0].timestamp(), r[1] is None, -(r[1] or 0), r[2], r[3]))
    assert rows == wanted and len({r[0] for r in rows}) > 10 and any(a[1] != b[1] for a, b in zip(rows, rows[1:]))
    snaps = tg.performance_report(_facts(spark, sf_dir), start=datetime(2024, 1, 5), end=datetime(2024, 1, 25))["snapshots"].collect()
    dates = [r.snapshot_date for r in snaps]
    assert len(set(dates)) > 10 and dates in (sorted(dates), sorted(dates, reverse=True))


def _facts(spark, sf_dir):
    samples = staged(spark, derived.raw_counters(spark, sf_dir), "counters")
    dim = staged(spark, tg.counter_dimension(samples), "dim")
    return {"perf_snap": staged(spark, tg.counter_delta(samples, dim), "perf_snap"), "counter_dimension": dim}
