"""File IO, configuration, space and drives on hand-made rows."""

from __future__ import annotations

from decimal import Decimal

import pytest
from samples import at

import tidegauge as tg
from tidegauge.schemas import IO_MEASURES

IO = (
    "instance_id int, snapshot_date timestamp_ntz, instance_started timestamp_ntz, database_name string,"
    "logical_filename string, db_file_type string, "
    + ", ".join(f"{m} bigint" for m in IO_MEASURES)
    + ", size_on_disk_bytes bigint"
)


def test_io_delta(spark):
    def row(hour, started, database, file, total):
        return (1, at(hour), at(started), database, file, "ROWS", *[total] * 7, 3 << 29)

    rows = [
        row(1, 0, "db", "f1", 10),
        row(2, 0, "DB", "F1 ", 25),  # another spelling of the same file
        row(2, 0, "db", "f2", 5),  # new file
        row(3, 0, "db", "f2", 9),
        row(4, 0, "db", "f1", 30),  # missing at 3
        row(9, 8, "db", "f1", 2),  # restarted
    ]
    got = {
        (r.snapshot_date, r.logical_filename.strip().lower()): (r.num_of_reads, r.io_stall_writes_ms, r.interval_in_seconds)
        for r in tg.io_delta(spark.createDataFrame(rows, IO)).collect()
    }
    assert got == {
        (at(1), "f1"): (10, 10, 3600),
        (at(2), "f1"): (15, 15, 3600),
        (at(2), "f2"): (None, None, 3600),
        (at(3), "f2"): (4, 4, 3600),
        (at(4), "f1"): (None, None, 3600),
        (at(9), "f1"): (2, 2, 3600),
    }
    assert {r.size_on_disk_GB for r in tg.io_delta(spark.createDataFrame(rows, IO)).collect()} == {Decimal("1.5")}


def test_file_samples_of_server_and_cloud(spark):
    stats = [
        (1, at(1), at(0), 3, 2, 1, *[1] * 7, 8),  # tempdb of a server has a name
        (2, at(1), at(0), 5, 2, 2, *[1] * 7, 8),  # tempdb of a cloud database has not
        (2, at(1), at(0), 5, 1, 1, *[1] * 7, 8),  # master of a cloud database is left out
        (2, at(1), at(0), 5, 5, 1, *[1] * 7, 8),
        (2, at(1), at(0), 5, 5, 1, *[1] * 7, 8),  # delivered twice
    ]
    schema = (
        "instance_id int, snapshot_date timestamp_ntz, instance_started timestamp_ntz, edition_code int, database_id int,"
        "file_id int, " + ", ".join(f"{m} bigint" for m in IO_MEASURES) + ", size_on_disk_bytes bigint"
    )
    databases = [(1, 2, "tempdb"), (2, 1, "master"), (2, 5, "app")]
    files = [(1, 2, 1, "tempdev", "t.mdf", "ROWS"), (2, 1, 1, "m", "m.mdf", "ROWS"), (2, 5, 1, "app_data", "a.mdf", "ROWS")]
    got = tg.file_samples(
        spark.createDataFrame(stats, schema),
        spark.createDataFrame(databases, "instance_id int, database_id int, name string"),
        spark.createDataFrame(
            files, "instance_id int, database_id int, file_id int, name string, physical_name string, type_desc string"
        ),
    )
    assert sorted((r.instance_id, r.database_name, r.logical_filename, r.db_file_type) for r in got.collect()) == [
        (1, "tempdb", "tempdev", "ROWS"),
        (2, "app", "app_data", "ROWS"),
        (2, "tempdb", "tempdb log unknown", "log"),
    ]


def test_file_samples_feed_io_delta_without_loss(spark, sf_dir):
    from workload import derived

    stats = derived.io_stats(spark, sf_dir).distinct().cache()
    samples = tg.file_samples(stats, derived.io_databases(spark, sf_dir), derived.io_files(spark, sf_dir))
    unknown = stats.where("edition_code = 5 and database_id = 2 and file_id > 2")
    per_snapshot = unknown.groupBy("instance_id", "snapshot_date").count()
    assert per_snapshot.where("count > 1").count() > 0  # several files share the label
    sums = [f"sum({m})" for m in IO_MEASURES]
    got = tg.io_delta(samples.unionAll(samples)).where("logical_filename = 'unk'")
    totals = got.selectExpr("count(*)", *[f"sum(cumulative_{m})" for m in IO_MEASURES]).first()
    assert tuple(totals) == tuple(unknown.selectExpr("count(*)", *sums).first())


def test_files_of_one_label_have_their_own_differences(spark):
    schema = IO + ", database_id int, file_id int"
    rows = [(1, at(h), at(0), "tempdb", "unk", "unk", *[f * h] * 7, 1 << 30, 2, f) for h in (1, 2) for f in (3, 4, 5, 6)]
    got = tg.io_delta(spark.createDataFrame([*rows, *rows], schema)).where("not first_measure_from_start").collect()
    assert sorted(r.num_of_reads for r in got) == [3, 4, 5, 6]


@pytest.mark.parametrize("chunk_days", [1, 100000])
def test_configuration_log_keeps_returns(spark, chunk_days):
    rows = [(1, at(24 * d), 8 if d in (0, 1, 4, 5) else 16) for d in range(6)] + [(2, at(24), 8), (2, at(48), 8)]
    df = spark.createDataFrame(rows, "instance_id int, snapshot_date timestamp_ntz, logical_proc_count int")
    got = [(r.instance_id, r.snapshot_date, r.logical_proc_count) for r in tg.config_changes(df, chunk_days=chunk_days).collect()]
    assert sorted(got) == [(1, at(0), 8), (1, at(48), 16), (1, at(96), 8), (2, at(24), 8)]


def test_configuration_log_goes_on_from_the_stored_one(spark):
    schema = "instance_id int, snapshot_date timestamp_ntz, logical_proc_count int"
    stored = spark.createDataFrame([(1, at(0), 8), (1, at(24), 16)], schema)
    rows = spark.createDataFrame([(1, at(24), 8), (1, at(48), 16), (1, at(72), 8), (2, at(72), 4)], schema)
    got = [(r.instance_id, r.snapshot_date) for r in tg.config_changes(rows, stored=stored).collect()]
    assert sorted(got) == [(1, at(72)), (2, at(72))]


def test_null_and_empty_hash_differently(spark):
    df = spark.createDataFrame([(1, at(0), None), (1, at(1), "")], "instance_id int, snapshot_date timestamp_ntz, edition string")
    assert tg.config_changes(df).count() == 2


def test_drive_alerts(spark):
    drives = spark.createDataFrame(
        [(1, "C", 1, 100), (1, "D", 10, 100), (1, "E", 50, 100), (2, "D", 90, 100), (3, "D", 5, 0)],
        "instance_id int, drive string, free_space_mb bigint, total_size_mb bigint",
    )
    files = spark.createDataFrame([(i, p) for i in (1, 2, 3) for p in ("d:\\a.mdf", "E:\\b.mdf")], "instance_id int, path string")
    breaches = tg.capacity_breaches(drives, files, 20).collect()
    assert [(r.instance_id, r.drive, r.free_percentage) for r in breaches] == [(1, "D", 10)]  # C holds no file
    (alert,) = tg.capacity_alerts(drives, files, 20).collect()
    assert alert.breaching == 1 and alert.message.count("\r") == 3  # lists all drives
    assert alert.message.startswith(" Drive: C Free (%): 1.00\tSpace Free (MB): 1.00 Total Space (MB): 100.00\r Drive: D")


def test_swapped_file_sizes_of_cloud_databases(spark):
    files = spark.createDataFrame(
        [(1, "db", "f", "ROWS", "p", "ONLINE", 1, 1024, 128, 5), (1, "db", "l", "LOG", "p", "ONLINE", None, 1024, None, 3)],
        "instance_id int, database_name string, name string, type_desc string, physical_name string, state_desc string,"
        "data_space_id int, size bigint, used bigint, edition_code int",
    )
    spaces = spark.createDataFrame([(1, "db", 1, "PRIMARY")], "instance_id int, database_name string, data_space_id int, name string")

    def sizes(**options):
        return {
            r.logical_file_name: (r.db_filegroup_name, r.db_file_size_in_mb, r.db_file_used_in_mb)
            for r in tg.file_usage(files, spaces, **options).collect()
        }

    assert sizes() == {"f": ("PRIMARY", 8, 1), "l": ("LOG", 8, 0)}
    assert sizes(parity=True)["f"] == ("PRIMARY", 1, 8)
