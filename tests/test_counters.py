from __future__ import annotations

from datetime import timedelta
from decimal import Decimal

import pytest
from samples import at, counters, params

import tidegauge as tg
from tidegauge.sources.constants import AVERAGE, BASE, CUSTOM, RATE, RATIO

GAUGE = 65792


def values(df):
    return {
        (r.inst_perf_param_id, r.snapshot_date): (r.instance_perf_value, r.startup_measure_ind, r.measurement_interval_s)
        for r in df.collect()
    }


def test_rate_restart_gap_and_new_counter(spark):
    samples = counters(
        spark,
        [
            (1, 0, "A/sec", 3600, RATE),
            (2, 0, "A/sec", 7200, RATE),
            (3, 0, "Other", 1, GAUGE),  # A is missing here
            (4, 0, "A/sec", 14400, RATE),
            (4, 0, "Other", 5, GAUGE),
            (6, 5, "A/sec", 360, RATE),  # restarted at 5
        ],
    )
    got = values(tg.counter_delta(samples, params(spark, [(1, "a/SEC", RATE, 0), (2, "other", GAUGE, 0)])))
    assert got[(1, at(1))] == (Decimal(3600), True, 3600)
    assert got[(1, at(2))] == (Decimal(1), False, 3600)
    assert got[(1, at(4))] == (Decimal(4), False, 3600)  # nothing at 3, so it counts from 0
    assert got[(1, at(6))] == (Decimal(360), True, 3600)
    assert got[(2, at(4))] == (Decimal(5), False, 3600)


def test_negative_values_are_taken_as_magnitudes(spark):
    samples = counters(spark, [(1, 0, "A", -5, GAUGE)])
    assert values(tg.counter_delta(samples, params(spark, [(1, "A", GAUGE, 0)])))[(1, at(1))][0] == 5


def test_rounding_is_half_up(spark):
    samples = counters(spark, [(0, -1, "A", 0, RATE), (200 / 3600, -1, "A", 1, RATE)])
    got = values(tg.counter_delta(samples, params(spark, [(1, "A", RATE, 0)])))
    assert got[(1, at(200 / 3600))][0] == Decimal("0.01")  # 0.005


@pytest.mark.parametrize(
    "on_reset, expected", [("keep", Decimal(-60)), ("null", None), ("cumulative", Decimal(40))]
)
def test_fall_without_restart(spark, on_reset, expected):
    samples = counters(spark, [(1, 0, "A", 100, CUSTOM), (2, 0, "A", 40, CUSTOM)])
    got = values(tg.counter_delta(samples, params(spark, [(1, "A", CUSTOM, 0)]), on_reset=on_reset))
    assert got.get((1, at(2)), (None,))[0] == expected


def test_zero_second_interval(spark):
    samples = counters(spark, [(1, 0, "A", 100, RATE), (1 + 0.1 / 3600, 0, "A", 200, RATE)])
    dim = params(spark, [(1, "A", RATE, 0)])
    assert len(values(tg.counter_delta(samples, dim))) == 1
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        tg.counter_delta(samples, dim, strict=True).collect()


def test_restart_at_the_instant_of_a_snapshot(spark):
    rows = [(1, 0, "A", 100, CUSTOM), (2, 1, "A", 30, CUSTOM)]  # started at 1, as the first snapshot
    dim = params(spark, [(1, "A", CUSTOM, 0)])
    assert values(tg.counter_delta(counters(spark, rows), dim))[(1, at(2))] == (Decimal(30), True, 3600)
    unseen = values(tg.counter_delta(counters(spark, rows), dim, parity=True))
    assert unseen[(1, at(2))] == (Decimal(-70), False, 3600)


def test_average_divides_by_its_base(spark):
    rows = []
    for hour, value, base in [(1, 100, 10), (2, 160, 14), (3, 200, 14), (4, 230, None)]:
        rows.append((hour, 0, "Average T (ms)", value, AVERAGE))
        if base is not None:
            rows.append((hour, 0, "Average T base", base, BASE))
    dim = params(spark, [(1, "Average T (ms)", AVERAGE, 0), (2, "Average T base", BASE, 1)])
    got = values(tg.counter_delta(counters(spark, rows), dim))
    assert [got[(1, at(h))][0] for h in (1, 2, 3, 4)] == [10, 15, 40, 30]  # no gain, no base: divided by 1
    total = values(tg.counter_delta(counters(spark, rows), dim, base="cumulative"))
    assert [total[(1, at(h))][0] for h in (1, 2, 3, 4)] == [10, Decimal("4.29"), Decimal("2.86"), 30]


@pytest.mark.parametrize("chunk_days", [1, 2, 100000])
def test_chunk_length_does_not_matter(spark, chunk_days):
    rows = [(h, 100 if h > 100 else 0, "A", 7 * h, CUSTOM) for h in range(1, 200, 5) if h % 3]
    dim = params(spark, [(1, "A", CUSTOM, 0)])
    got = values(tg.counter_delta(counters(spark, rows), dim, chunk_days=chunk_days))
    expected, last = {}, None
    for h, started, _, v, _ in rows:
        first = last is None or last[1] != started
        span = (h - started if first else h - last[0]) * 3600
        expected[(1, at(h))] = (Decimal(v if first else v - last[2]), first, span)
        last = (h, started, v)
    assert got == expected


def test_differences_add_up_to_the_total(spark, sf_dir):
    from workload import derived

    samples = derived.raw_counters(spark, sf_dir)
    snaps = tg.counter_delta(samples, tg.counter_dimension(samples)).join(
        samples.select("instance_id", "snapshot_date", "instance_started").distinct(), ["instance_id", "snapshot_date"]
    )
    custom = tg.counter_dimension(samples).where(f"counter_type = {CUSTOM}").select("inst_perf_param_id")
    sums = (
        snaps.join(custom, "inst_perf_param_id", "left_semi")
        .groupBy("instance_id", "instance_started", "inst_perf_param_id")
        .agg({"instance_perf_value": "sum", "cumulative_perf_value": "max"})
        .collect()
    )
    assert sums and all(r["sum(instance_perf_value)"] == r["max(cumulative_perf_value)"] for r in sums)


def test_dimension_rules(spark):
    rows = [
        ("MSSQL$X:Databases", "Transactions/sec", "_Total", RATE),
        ("MSSQL$X:Databases", "Transactions/sec", "userdb", RATE),
        ("MSSQL$X:Broker Activation", "Tasks", "msdb", GAUGE),
        ("MSSQL$X:Buffer Manager", " Page Lookups/sec ", "", RATE),
        ("MSSQL$X:Buffer Manager", "Page lookups/sec", " ", RATE),
        ("MSSQL$X:Databases", "Log Growths", "_Total", GAUGE),
        ("MSSQL$X:Latches", "Average Latch Wait Time (ms)", "", AVERAGE),
        ("MSSQL$X:Latches", "Average Latch Wait Time Base", "", BASE),
        ("MSSQL$X:Resource", "Usage", "", RATIO),
        ("MSSQL$X:Resource", "Usage base", "", BASE),
    ]
    samples = spark.createDataFrame(rows, "object_name string, counter_name string, instance_name string, cntr_type int")
    dim = tg.counter_dimension(samples, edition_code=5).collect()
    by_name = {(r.counter_nm.lower(), r.instance_nm): r for r in dim}
    assert len(dim) == 7 and ("transactions/sec", "userdb") not in by_name and ("tasks", "msdb") not in by_name
    assert by_name[("page lookups/sec", "")].log_ind and by_name[("log growths", "_Total")].log_ind
    latch = by_name[("average latch wait time (ms)", "")].inst_perf_param_id
    assert by_name[("average latch wait time base", "")].parent_param_id == latch
    parity = {r.counter_nm: r for r in tg.counter_dimension(samples, parity=True).collect()}
    assert parity["Average Latch Wait Time Base"].parent_param_id == 0
    assert parity["Usage base"].parent_param_id == parity["Usage"].inst_perf_param_id
    assert "Tasks" in parity and not parity["Log Growths"].log_ind
    assert sum(r.counter_type == CUSTOM for r in parity.values()) == 10


def test_snapshot_sequence_interval_counts_second_boundaries(spark):
    samples = counters(spark, [(0, -1, "A", 1, GAUGE)])
    later = samples.selectExpr("instance_id", "snapshot_date + interval '0.9' second as snapshot_date", "instance_started")
    both = samples.select("instance_id", "snapshot_date", "instance_started").union(
        later.selectExpr("instance_id", "snapshot_date + interval '0.2' second", "instance_started")
    ).union(later)
    got = {r.snapshot_date: r.interval_s for r in tg.snapshot_sequence(both).collect()}
    assert got[at(0) + timedelta(seconds=1.1)] == 1 and got[at(0) + timedelta(seconds=0.9)] == 0
