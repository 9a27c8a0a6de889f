"""Sinks, readers, the archive move and incremental appends."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F, types as T
from samples import at, waits

import tidegauge as tg
from tidegauge.schemas import SNAPSHOTS
from tidegauge.sources.readers import read_catalog, read_io_stats, read_snapshots
from tidegauge.sources.sinks import KEYS, append_dimension, append_missing, append_snapshots, archive_move


def summary(spark, hours=range(0, 96, 6)):
    return tg.wait_delta(waits(spark, [(1, h, -1, w, h + 1, 2 * h + 2, 0) for h in hours for w in ("A", "B")]))


def keys(df):
    return sorted((r.instance_id, r.snapshot_date, r.wait_type) for r in df.collect())


def test_append_read_and_prune(spark, tmp_path):
    path = str(tmp_path / "waits")
    append_snapshots(summary(spark), path, kind="wait_summary")
    assert keys(read_snapshots(spark, "wait_summary", path)) == keys(summary(spark))
    window = read_snapshots(spark, "wait_summary", path, start=at(24), end=at(30))
    assert {r.snapshot_date for r in window.collect()} == {at(24), at(30)}
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_day" in plan and "PushedFilters: [IsNotNull(snapshot_date)" in plan


def test_repeated_append_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "waits")
    append_snapshots(summary(spark, range(0, 24, 6)), path, kind="wait_summary")
    append_missing(summary(spark), path, kind="wait_summary")
    append_missing(summary(spark), path, kind="wait_summary")
    assert keys(read_snapshots(spark, "wait_summary", path)) == keys(summary(spark))


def test_archive_move_can_be_repeated(spark, tmp_path):
    history, first, second = (str(tmp_path / p) for p in ("history", "current-1", "current-2"))
    current = summary(spark)
    asof = at(72)
    archive_move(current, history, first, asof=asof, days=1, user="me")
    stored = read_snapshots(spark, "wait_history", history)
    archive_move(current, history, second, asof=asof, days=1, user="me", history=stored)  # lost and run again
    archived, kept = read_snapshots(spark, "wait_history", history), read_snapshots(spark, "wait_summary", second)
    assert keys(archived) + keys(kept) == keys(current)
    assert max(r.snapshot_date for r in archived.collect()) == at(48)  # the cutoff itself is archived
    assert {(r.date_added, r.archived_by_user) for r in archived.collect()} == {(asof, "me")}


def test_split_is_complete_and_disjoint(spark):
    df = summary(spark)
    keep, aged = tg.split_by_age(df, asof=at(50.5), days=1)
    assert keys(keep.unionByName(aged)) == keys(df) and not set(keys(keep)) & set(keys(aged))


RESOURCE = "instance_id int, end_time timestamp_ntz"


def test_new_rows(spark):
    current = spark.createDataFrame([(1, at(1)), (1, at(2)), (2, at(1)), (2, None)], RESOURCE)
    history = spark.createDataFrame([(1, at(1))], RESOURCE)
    got = {(r.instance_id, r.end_time) for r in tg.new_rows(current, history, ["instance_id", "end_time"]).collect()}
    assert got == {(1, at(2)), (2, at(1)), (2, None)}


@pytest.mark.parametrize(
    "stored, expected", [([(1, at(1))], [at(2)]), ([(1, at(1)), (1, None)], []), ([], [at(1), at(1), at(2), None])]
)
def test_not_in_with_nulls(spark, stored, expected):
    current = spark.createDataFrame([(1, at(1)), (1, at(2)), (2, at(1)), (2, None)], RESOURCE)
    history = spark.createDataFrame(stored, RESOURCE)
    got = [r.end_time for r in tg.new_rows(current, history, ["end_time"], null_aware=True).collect()]
    assert sorted(got, key=lambda t: t or datetime.max) == expected
    current.createOrReplaceTempView("cur"), history.createOrReplaceTempView("hist")
    sql = spark.sql("select * from cur where end_time not in (select end_time from hist)")
    assert sorted((r.end_time for r in sql.collect()), key=lambda t: t or datetime.max) == expected


def test_catalog_of_all_databases_or_one(spark, tmp_path):
    rows = [(i, d, o, 1) for i in (1, 2) for d in ("a", "b") for o in range(3)]
    df = spark.createDataFrame(rows, "instance_id int, database_name string, object_id bigint, column_id bigint")
    df.write.partitionBy("instance_id", "database_name").parquet(str(tmp_path / "columns"))
    everything = read_catalog(spark, "columns", str(tmp_path / "columns"))
    assert everything.count() == 12 and tg.column_counts(everything).count() == 12
    assert read_catalog(spark, "columns", str(tmp_path / "columns"), database="a").count() == 6


def test_io_stats_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "io")
    spark.createDataFrame([(1, 2, 3), (1, 5, 1)], "instance_id int, database_id int, file_id int").write.parquet(path)
    one = read_io_stats(spark, path, database_id=2, file_id=3)
    assert one.count() == 1 and read_io_stats(spark, path).count() == 2
    assert "EqualTo(database_id,2)" in one._jdf.queryExecution().executedPlan().toString()


def test_run_monitors_writes_what_it_can(spark, tmp_path):
    inputs = {"waits": waits(spark, [(1, 1, 0, "A", 1, 1, 1)])}
    results = tg.run_monitors(inputs)
    assert list(results) == ["wait_summary"] and results["wait_summary"].count() == 1
    append_dimension(tg.innocuous_waits(spark), str(tmp_path / "names"))
    assert spark.read.parquet(str(tmp_path / "names")).count() == 104


def test_every_kind_is_stored_and_read_back(spark, tmp_path):
    for kind, keys in KEYS.items():
        schema = SNAPSHOTS[kind]
        time = "end_time" if "end_time" in keys else "snapshot_date"
        text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
        value = {"timestamp_ntz": None, "string": "x", "boolean": "true"}
        rows = [tuple(str(at(h)) if f.name == time else value.get(f.dataType.simpleString(), "1") for f in schema.fields) for h in (1, 30)]
        plain = spark.createDataFrame(rows, text).withColumn(time, F.col(time).cast("timestamp_ntz"))
        if kind == "table_usage":
            plain = plain.withColumn("column_count", F.col("column_count").cast("bigint"))
        path = str(tmp_path / kind)
        append_snapshots(plain, path, kind=kind)
        append_missing(plain, path, kind=kind)
        assert read_snapshots(spark, kind, path).count() == 2, kind
        assert read_snapshots(spark, kind, path, start=at(20), end=at(40)).count() == 1, kind


def test_catalog_rows_are_dated_by_the_caller(spark, tmp_path):
    schema = SNAPSHOTS["file_usage"]
    row = spark.createDataFrame([(1, "db", "f")], "instance_id int, database_name string, logical_file_name string")
    append_snapshots(row, str(tmp_path / "u"), kind="file_usage", asof=at(5))
    assert [r.snapshot_date for r in read_snapshots(spark, "file_usage", str(tmp_path / "u")).collect()] == [at(5)]
    assert "snapshot_date" in schema.fieldNames()


def test_catalog_history_stays_apart(spark):
    dates = [at(1), at(30)]
    files = spark.createDataFrame([(1, "db", d, 1, "f", "ROWS", "p", "ONLINE", 128, 64) for d in dates], "instance_id int, database_name string, snapshot_date timestamp_ntz, data_space_id int, name string, type_desc string, physical_name string, state_desc string, size bigint, used bigint")
    spaces = spark.createDataFrame([(1, "db", d, 1, "PRIMARY") for d in dates], "instance_id int, database_name string, snapshot_date timestamp_ntz, data_space_id int, name string")
    assert tg.file_usage(files, spaces).count() == 2
    units = spark.createDataFrame([(1, "db", d, 7, 1, 4, 4) for d in dates], "instance_id int, database_name string, snapshot_date timestamp_ntz, container_id bigint, data_space_id int, total_pages bigint, used_pages bigint")
    assert [r.total_pages for r in tg.container_rollup(units).collect()] == [4, 4]
