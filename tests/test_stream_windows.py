"""Reports that account for late rows, and the archive of gauges by day."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from samples import at
from test_streams import feed

from tidegauge.streaming import windows
from tidegauge.streaming.windows import archive_resources_stream, read_accounts, read_archive, read_missed, read_report, report_stream

SCHEMA = "ts timestamp_ntz, k string, v int"


def totals():
    return {"v": F.sum("v"), "top": F.max("v")}


def brute(parts, length, slide, delay):
    """Windows, missed (row, window) pairs by trigger, and counts by trigger."""
    newest, open_, closed, missed, counts = None, [], {}, [], []
    for n, rows in enumerate(parts):
        before, kept, gone, undated = newest, 0, 0, 0
        for t, k, v in rows:
            if t is None:
                undated += 1
                continue
            start = datetime(1970, 1, 1) + ((t - datetime(1970, 1, 1)) // slide) * slide
            while start > t - length:
                if before is None or start + length > before - delay:
                    kept += 1
                    open_.append((start, k, v))
                else:
                    gone += 1
                    missed.append((t, k, v, start, n))
                start -= slide
            newest = t if newest is None else max(newest, t)
        counts.append((n, len(rows), undated, kept + gone, kept, gone))
        for start, k, v in [o for o in open_ if newest is not None and o[0] + length <= newest - delay]:
            total, top = closed.get((start, k), (0, -1))
            closed[start, k] = (total + v, max(top, v))
        open_ = [o for o in open_ if newest is None or o[0] + length > newest - delay]
    return {(*w, *v) for w, v in closed.items()}, sorted(missed), counts


PARTS = [
    [(None, "a", 1)],
    [(at(1), "a", 1), (at(1.1), "b", 2), (at(2), "a", 3)],
    [(at(1.2), "a", 10), (at(1.9), "b", 20), (at(2.6), None, 30), (None, "a", 40)],
    [(at(2.1), "a", 100), (at(0), "b", 200)],
    [(at(9), "a", 1000), (at(2.7), "a", 2000)],
]


@pytest.mark.parametrize("slide", [None, 10])
def test_every_row_is_accounted_for(spark, tmp_path, slide):
    folder, length, delay = str(tmp_path / "out"), timedelta(minutes=30), timedelta(minutes=10)
    stream = feed(spark, tmp_path / "in", [spark.createDataFrame(p, SCHEMA) for p in PARTS])
    report_stream(stream, "ts", ["k"], totals(), folder, slide=slide and f"{slide} minutes")
    closed, missed, counts = brute(PARTS, length, timedelta(minutes=slide) if slide else length, delay)
    assert {(r.window_start, r.k, r.v, r.top) for r in read_report(spark, folder).collect()} == closed and closed
    got = [(r.ts, r.k, r.v, r.window_start, r.batch) for r in read_missed(spark, folder).collect()]
    assert sorted(got) == missed and len(missed) > 1
    accounts = read_accounts(spark, folder).select("batch", "arrived", "undated", "placed", "kept", "missed").orderBy("batch")
    assert [tuple(r) for r in accounts.collect()] == counts


def test_a_killed_trigger_counts_nothing_twice(spark, tmp_path, monkeypatch):
    folder, commits, commit = str(tmp_path / "out"), [], windows.commit_generation

    def failing(*args):
        commits.append(1)
        if len(commits) == 3:
            raise RuntimeError("killed")
        commit(*args)

    monkeypatch.setattr(windows, "commit_generation", failing)
    stream = feed(spark, tmp_path / "in", [spark.createDataFrame(p, SCHEMA) for p in PARTS])
    with pytest.raises(Exception, match="killed"):
        report_stream(stream, "ts", ["k"], totals(), folder)
    assert read_accounts(spark, folder).count() == 2
    monkeypatch.setattr(windows, "commit_generation", commit)
    report_stream(stream, "ts", ["k"], totals(), folder)
    closed, missed, counts = brute(PARTS, timedelta(minutes=30), timedelta(minutes=30), timedelta(minutes=10))
    assert {(r.window_start, r.k, r.v, r.top) for r in read_report(spark, folder).collect()} == closed
    assert read_missed(spark, folder).count() == len(missed) and read_accounts(spark, folder).count() == len(counts)


GAUGE = "instance_id int, end_time timestamp_ntz, cpu int"


def test_null_keys_enter_once_and_the_smallest_of_equal_keys(spark, tmp_path):
    parts = [
        [(1, at(1), 7), (1, at(1), 5), (None, at(1), 1), (1, None, 2)],
        [(None, at(1), 0), (1, None, 9), (None, None, 3), (2, at(30), None), (2, at(30), 4)],
        [(None, None, 8), (1, at(1), 1), (2, at(30), 6)],
    ]
    folder = str(tmp_path / "out")
    stream = feed(spark, tmp_path / "in", [spark.createDataFrame(p, GAUGE) for p in parts])
    archive_resources_stream(stream, ["instance_id", "end_time"], folder)
    rows = {(r.instance_id, r.end_time): r.cpu for r in read_archive(spark, folder, stream.schema).collect()}
    assert rows == {(1, at(1)): 5, (None, at(1)): 1, (1, None): 2, (None, None): 3, (2, at(30)): None}


def test_a_trigger_reads_only_the_days_of_its_rows(spark, tmp_path):
    """The files of other days can be gone."""
    folder = tmp_path / "out"
    parts = [[(1, at(24 * d), d)] for d in range(4)] + [[(1, at(24), 9), (2, at(24), 9)]]
    frames = [spark.createDataFrame(p, GAUGE) for p in parts]
    archive_resources_stream(feed(spark, tmp_path / "in", frames[:4]), ["instance_id", "end_time"], str(folder))
    for day in (0, 2, 3):
        for file in (folder / "archive").glob(f"archive_day={at(24 * day).date()}/*/*.parquet"):
            file.write_bytes(b"no file of this kind")
    archive_resources_stream(feed(spark, tmp_path / "in", frames[4:]), ["instance_id", "end_time"], str(folder))
    day = spark.read.parquet(str(folder / "archive" / f"archive_day={at(24).date()}"))
    assert sorted(tuple(r) for r in day.select("instance_id", "cpu").collect()) == [(1, 1), (2, 9)]


def test_the_day_has_to_be_part_of_the_key(spark, tmp_path):
    stream = feed(spark, tmp_path / "in", [spark.createDataFrame([(1, at(1), 1)], GAUGE)])
    with pytest.raises(ValueError, match="end_time"):
        archive_resources_stream(stream, ["instance_id"], str(tmp_path / "out"))
