"""Moves between current and history: one commit, the boundary day alone written again, killed at each step."""

from __future__ import annotations

from datetime import timedelta
from pathlib import Path

import pytest
from samples import at, waits

import tidegauge as tg
from tidegauge.sources import history
from tidegauge.sources.history import add_piece, create_tables, move_aged, read_current, read_history

KIND = "wait_summary"


def rows(spark, hours):
    return tg.wait_delta(waits(spark, [(1, h, 0, w, 10 * n + 1, n, n) for n, h in enumerate(hours, 1) for w in ("A", "B")]))


def files(folder):
    return {str(f.relative_to(folder)) for f in Path(folder).glob("data/**/*.parquet")}


def hours_of(df):
    found = df.collect()
    assert len(found) == len({(r.instance_id, r.snapshot_date, r.wait_type) for r in found})
    return sorted({(r.snapshot_date - at(0)) / timedelta(hours=1) for r in found})


@pytest.fixture
def folder(spark, tmp_path):
    create_tables(spark, str(tmp_path))
    add_piece(rows(spark, [1, 20, 30, 50]), str(tmp_path), kind=KIND, piece="first")
    add_piece(rows(spark, [51, 60, 80]), str(tmp_path), kind=KIND, piece="second")
    return str(tmp_path)


def test_move_and_read_back(spark, folder):
    before = files(folder)
    move_aged(spark, folder, kind=KIND, asof=at(75), days=1, user="u")  # cutoff 51 h, on the third day
    assert hours_of(read_current(spark, KIND, folder)) == [60, 80]
    assert hours_of(read_history(spark, KIND, folder)) == [1, 20, 30, 50, 51]
    assert {(r.date_added, r.archived_by_user) for r in read_history(spark, KIND, folder).collect()} == {(at(75), "u")}
    day = str(at(51).date())
    assert {f for f in before if day not in f} == {f for f in files(folder) if day not in f}
    move_aged(spark, folder, kind=KIND, asof=at(90), days=1, user="v")  # cutoff 66 h, the same day again
    assert hours_of(read_current(spark, KIND, folder)) == [80]
    added = {r.snapshot_date: r.archived_by_user for r in read_history(spark, KIND, folder).collect()}
    assert added[at(51)] == "u" and added[at(60)] == "v"


def test_repeated_runs_change_nothing(spark, folder):
    for _ in range(2):
        move_aged(spark, folder, kind=KIND, asof=at(75), days=1, user="u")
    add_piece(rows(spark, [1, 20, 30, 50]), folder, kind=KIND, piece="first")
    assert hours_of(read_history(spark, KIND, folder)) == [1, 20, 30, 50, 51]
    add_piece(rows(spark, [51, 60, 80]), folder, kind=KIND, piece="second")
    assert hours_of(read_current(spark, KIND, folder)) == [60, 80]


def test_pruned_by_day(spark, folder):
    for f in Path(folder).glob(f"data/snapshot_day={at(1).date()}/**/*.parquet"):
        f.write_bytes(b"no file of this kind")
    assert hours_of(read_current(spark, KIND, folder, start=at(25), end=at(55))) == [30, 50, 51]


def test_nothing_aged_and_empty_tables(spark, tmp_path, folder):
    move_aged(spark, folder, kind=KIND, asof=at(24), days=2, user="u")
    assert hours_of(read_history(spark, KIND, folder)) == [] and len(hours_of(read_current(spark, KIND, folder))) == 7
    empty = str(tmp_path / "empty")
    create_tables(spark, empty)
    add_piece(rows(spark, []), empty, kind=KIND, piece="none")
    move_aged(spark, empty, kind=KIND, asof=at(24), user="u")
    assert read_current(spark, KIND, empty).count() == read_history(spark, KIND, empty).count() == 0


@pytest.mark.parametrize("killed_at", ["before aged", "after aged", "after kept", "half a pointer", "after pointer"])
def test_a_killed_move_leaves_both_tables(spark, folder, monkeypatch, killed_at):
    write, commit, writes = history._write, history.commit_generation, []

    def failing_write(part, path, kind, piece):
        writes.append(piece)
        if killed_at == "before aged":
            raise RuntimeError("killed")
        write(part, path, kind, piece)
        if killed_at == ("after aged" if len(writes) == 1 else "after kept"):
            raise RuntimeError("killed")

    def failing_commit(pointer, path, generation):
        if killed_at == "half a pointer":
            Path(f"{path}/slot={generation % 2}").mkdir(exist_ok=True)
            for f in Path(f"{path}/slot={generation % 2}").glob("*.parquet"):
                f.unlink()
            raise RuntimeError("killed")
        commit(pointer, path, generation)
        raise RuntimeError("killed")

    monkeypatch.setattr(history, "_write", failing_write)
    monkeypatch.setattr(history, "commit_generation", failing_commit)
    with pytest.raises(RuntimeError, match="killed"):
        move_aged(spark, folder, kind=KIND, asof=at(75), days=1, user="u")
    done = killed_at == "after pointer"
    assert hours_of(read_current(spark, KIND, folder)) == ([60, 80] if done else [1, 20, 30, 50, 51, 60, 80])
    assert hours_of(read_history(spark, KIND, folder)) == ([1, 20, 30, 50, 51] if done else [])
    monkeypatch.setattr(history, "_write", write)
    monkeypatch.setattr(history, "commit_generation", commit)
    move_aged(spark, folder, kind=KIND, asof=at(75), days=1, user="u")
    assert hours_of(read_current(spark, KIND, folder)) == [60, 80]
    assert hours_of(read_history(spark, KIND, folder)) == [1, 20, 30, 50, 51]
