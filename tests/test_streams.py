from __future__ import annotations

from samples import at, counters, params

import tidegauge as tg
from tidegauge.sources.constants import AVERAGE, BASE, CUSTOM, RATE
from tidegauge.streaming.deltas import counter_delta_stream, read_counter_deltas, read_late_samples
from tidegauge.streaming.windows import archive_resources_stream, dedup_resources, windowed_report
from workload.staging import run_stream


def feed(spark, folder, parts):
    """Stream over ``parts``, one trigger each, in the given order."""
    schema = None
    for n, part in enumerate(parts):
        schema = part.schema
        part.coalesce(1).write.mode("append").parquet(str(folder))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def snap_rows(df):
    return sorted(
        (r.inst_perf_param_id, r.snapshot_date, r.instance_perf_value, r.startup_measure_ind, r.measurement_interval_s)
        for r in df.collect()
    )


def test_stream_equals_batch(spark, tmp_path):
    rows = []
    for hour in range(1, 40):
        started = 0 if hour < 22 else 21.5
        up = hour - started
        rows += [
            (hour, started, "R", int(100 * up), RATE),
            (hour, started, "C", int(3 * up * up), CUSTOM),
            (hour, started, "Average T (ms)", int(50 * up), AVERAGE),
            (hour, started, "Average T base", int(up) // 3, BASE),
        ]
    dim = params(
        spark, [(1, "R", RATE, 0), (2, "C", CUSTOM, 0), (3, "Average T (ms)", AVERAGE, 0), (4, "Average T base", BASE, 3)]
    )
    parts = [counters(spark, [r for r in rows if a <= r[0] < b]) for a, b in ((0, 9), (9, 10), (10, 30), (30, 99))]
    folder = str(tmp_path / "out")
    counter_delta_stream(feed(spark, tmp_path / "in", parts), dim, folder)
    assert snap_rows(read_counter_deltas(spark, folder)) == snap_rows(tg.counter_delta(counters(spark, rows), dim))
    assert read_late_samples(spark, folder).count() == 0


def test_late_samples_are_counted_and_used(spark, tmp_path):
    dim = params(spark, [(1, "C", CUSTOM, 0)])
    parts = [counters(spark, [(h, 0, "C", 10 * h, CUSTOM)]) for h in (1, 3, 2, 4)]
    folder = str(tmp_path / "out")
    counter_delta_stream(feed(spark, tmp_path / "in", parts), dim, folder)
    got = sorted((r.snapshot_date, int(r.instance_perf_value)) for r in read_counter_deltas(spark, folder).collect())
    assert got == [(at(1), 10), (at(2), 10), (at(3), 10), (at(4), 10)]
    assert [(r.instance_id, r.late_samples, r.batch) for r in read_late_samples(spark, folder).collect()] == [(1, 1, 2)]


def test_counter_and_base_in_different_triggers(spark, tmp_path):
    dim = params(spark, [(3, "Average T (ms)", AVERAGE, 0), (4, "Average T base", BASE, 3)])
    counter = [(h, 0, "Average T (ms)", 100 * h, AVERAGE) for h in (1, 2)]
    bases = [(h, 0, "Average T base", 10 * h, BASE) for h in (1, 2)]
    parts = [[counter[0]], [counter[1]], bases, bases]
    folder = str(tmp_path / "out")
    counter_delta_stream(feed(spark, tmp_path / "in", [counters(spark, p) for p in parts]), dim, folder)
    assert snap_rows(read_counter_deltas(spark, folder)) == snap_rows(tg.counter_delta(counters(spark, counter + bases), dim))


def test_sliding_report_closes_windows(spark, tmp_path):
    rows = spark.createDataFrame([(at(0.1), 1), (at(0.4), 2), (at(3), 4)], "ts timestamp_ntz, v int")
    from pyspark.sql import functions as F

    stream = windowed_report(
        feed(spark, tmp_path / "in", [rows]), "ts", [], {"v": F.sum("v")}, slide="5 minutes"
    )
    got = {r.window_start: r.v for r in run_stream(spark, stream, "out").collect()}
    assert got[at(0)] == 3 and got[at(20 / 60)] == 2 and at(3) not in got


def test_repeated_gauges_enter_once(spark, tmp_path):
    schema = "instance_id int, end_time timestamp_ntz, avg_cpu_percent int"
    parts = [spark.createDataFrame([(1, at(1), 5), (1, at(2), 6)], schema), spark.createDataFrame([(1, at(2), 6), (2, at(2), 7)], schema)]
    stream = dedup_resources(feed(spark, tmp_path / "in", parts), ["instance_id", "end_time"])
    assert sorted((r.instance_id, r.end_time) for r in run_stream(spark, stream, "out").collect()) == [
        (1, at(1)),
        (1, at(2)),
        (2, at(2)),
    ]


def test_gauges_hours_late_enter_the_archive(spark, tmp_path):
    schema = "instance_id int, end_time timestamp_ntz, avg_cpu_percent int"
    parts = [[(1, at(50), 5)], [(1, at(50), 5), (1, at(1), 6)], [(2, at(30), 7), (1, at(1), 6)]]
    stream = feed(spark, tmp_path / "in", [spark.createDataFrame(p, schema) for p in parts])
    archive_resources_stream(stream, ["instance_id", "end_time"], str(tmp_path / "out"))
    rows = spark.read.schema(schema).parquet(f"{tmp_path}/out/archive").collect()
    assert sorted((r.instance_id, r.end_time) for r in rows) == [(1, at(1)), (1, at(50)), (2, at(30))]
