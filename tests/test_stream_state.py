"""The counter stream's state: bounded reading, late data, stale rows, triggers that are killed."""

from __future__ import annotations

import os
import random
from pathlib import Path

import pytest
from samples import COUNTER, at, counters, params
from test_streams import feed, snap_rows

import tidegauge as tg
from tidegauge.sources.constants import AVERAGE, BASE, CUSTOM, RATE
from tidegauge.streaming import deltas
from tidegauge.streaming.deltas import counter_delta_stream, read_counter_deltas, read_late_samples, read_unrated

KINDS = [("R", RATE), ("C", CUSTOM), ("Average T (ms)", AVERAGE), ("Average T base", BASE)]


def dim(spark):
    return params(spark, [(1, "R", RATE, 0), (2, "C", CUSTOM, 0), (3, "Average T (ms)", AVERAGE, 0), (4, "Average T base", BASE, 3)])


def drawn(spark, seed, n, parts):
    """Samples of three instances over months, some missing, in drawn triggers, mostly in order."""
    draw, dealt = random.Random(seed), [[] for _ in range(parts)]
    for instance in (1, 2, 3):
        hours = sorted(draw.sample(range(1, 24 * 100), n))
        restart = draw.choice(hours) + 0.5
        for h in hours:
            started = restart if h > restart else 0
            trigger = min(parts - 1, h * parts // 2400)
            for name, kind in KINDS:
                if draw.random() < 0.85:
                    row = (instance, at(h), at(started), "SQLServer:Obj", name, "", int((h - started) * draw.randint(90, 110)), kind)
                    for _ in range(draw.choice([1, 1, 1, 2])):
                        dealt[draw.choice([trigger, trigger, trigger, draw.randrange(parts)])].append(row)
    return [spark.createDataFrame(rows, COUNTER) for rows in dealt if rows]


def union(frames):
    whole = frames[0]
    for f in frames[1:]:
        whole = whole.unionByName(f)
    return whole


def ordered(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("seed,n,parts", [(1, 12, 4), (2, 30, 3)])
def test_any_order_equals_batch(spark, tmp_path, seed, n, parts):
    frames, folder = drawn(spark, seed, n, parts), str(tmp_path / "out")
    counter_delta_stream(feed(spark, tmp_path / "in", frames), dim(spark), folder, on_reset="null")
    whole = union(frames)
    assert ordered(read_counter_deltas(spark, folder)) == ordered(tg.counter_delta(whole, dim(spark), on_reset="null"))
    assert ordered(read_unrated(spark, folder)) == ordered(tg.unrated_counters(whole, dim(spark), on_reset="null"))
    assert read_late_samples(spark, folder).count() > 0


def test_a_snapshot_computed_anew_to_no_row_loses_its_rows(spark, tmp_path):
    """The third trigger brings a sample 0.3 seconds before the second one: no second lies between them."""
    rows = [(1, 0, "R", 3600, RATE), (2 + 0.5 / 3600, 0, "R", 7200, RATE), (2 + 0.2 / 3600, 0, "R", 7100, RATE)]
    folder = str(tmp_path / "out")
    counter_delta_stream(feed(spark, tmp_path / "in", [counters(spark, [r]) for r in rows]), dim(spark), folder)
    got = snap_rows(read_counter_deltas(spark, folder))
    assert got == snap_rows(tg.counter_delta(counters(spark, rows), dim(spark))) and len(got) == 2
    assert [r.snapshot_date for r in read_unrated(spark, folder).collect()] == [at(2 + 0.5 / 3600)]


def test_far_behind_after_silent_months(spark, tmp_path):
    hours = [1, 24 * 200, 24 * 201, 24 * 150, 24 * 201.5, 24 * 20, 0.5]
    rows = [[(h, 0, "C", int(10 * h), CUSTOM)] for h in hours]
    folder = str(tmp_path / "out")
    counter_delta_stream(feed(spark, tmp_path / "in", [counters(spark, r) for r in rows]), dim(spark), folder)
    assert snap_rows(read_counter_deltas(spark, folder)) == snap_rows(tg.counter_delta(counters(spark, sum(rows, [])), dim(spark)))


def files_under(path: str) -> list[Path]:
    return [Path(d) / f for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")]


def test_reading_does_not_grow_with_triggers(spark, tmp_path, monkeypatch):
    read, per_trigger = deltas._read, []

    def counted(session, schema, *paths, base=None):
        files = [f for p in paths for f in files_under(p.removeprefix("file:"))]
        per_trigger[-1][0] += len(files)
        per_trigger[-1][1] += sum(f.stat().st_size for f in files)
        return read(session, schema, *paths, base=base)

    advance = deltas._advance

    def counting(*args):
        per_trigger.append([0, 0])
        advance(*args)

    monkeypatch.setattr(deltas, "_read", counted)
    monkeypatch.setattr(deltas, "_advance", counting)
    # Thirty triggers in order; from the third on each brings a sample of the trigger before as well.
    frames = []
    for t in range(30):
        rows = [(t * 30 + h, 0, name, 1000 * t + h, kind) for h in (1, 9, 17) for name, kind in KINDS]
        late = [(t * 30 - 20, 0, "R", 1000 * t, RATE)] if t % 5 == 3 else []
        frames.append(counters(spark, rows + late).coalesce(1))
    counter_delta_stream(feed(spark, tmp_path / "in", frames), dim(spark), str(tmp_path / "out"))
    assert len(per_trigger) == 30
    in_order = [per_trigger[t] for t in range(1, 30) if t % 5 != 3]
    behind = [per_trigger[t] for t in range(8, 30) if t % 5 == 3]
    assert max(f for f, _ in in_order) <= in_order[0][0] + 6
    assert max(b for _, b in in_order[12:]) <= 1.1 * max(b for _, b in in_order[:12])
    # A late trigger reads polls of at most two months: files by trigger, one row per poll.
    assert max(b for _, b in behind) < 3 * max(b for _, b in in_order) + 60 * 3_000
    assert snap_rows(read_counter_deltas(spark, str(tmp_path / "out"))) == snap_rows(tg.counter_delta(union(frames), dim(spark)))


@pytest.mark.parametrize("killed_at", [2, 5, 7])
def test_a_killed_trigger_leaves_what_was_committed(spark, tmp_path, monkeypatch, killed_at):
    rows = [[(h, 0, "C", 10 * h, CUSTOM), (h, 0, "R", 90 * h, RATE)] for h in (1, 3, 2, 4)]
    folder, writes = str(tmp_path / "out"), []

    def failing(inner, trigger):
        def write(*args, **options):
            writes.append(1)
            # Triggers write six tables each, then the state.
            if len(writes) == 7 * trigger + killed_at:
                if killed_at > 1:
                    inner(*args, **options)
                raise RuntimeError("killed")
            inner(*args, **options)

        return write

    write, commit = deltas._write, deltas.commit_generation
    monkeypatch.setattr(deltas, "_write", failing(write, 2))
    monkeypatch.setattr(deltas, "commit_generation", failing(commit, 2))
    stream = feed(spark, tmp_path / "in", [counters(spark, r) for r in rows])
    with pytest.raises(Exception, match="killed"):
        counter_delta_stream(stream, dim(spark), folder)
    committed = 3 if killed_at == 7 else 2
    assert snap_rows(read_counter_deltas(spark, folder)) == snap_rows(
        tg.counter_delta(counters(spark, sum(rows[:committed], [])), dim(spark))
    )
    monkeypatch.setattr(deltas, "_write", write)
    monkeypatch.setattr(deltas, "commit_generation", commit)
    counter_delta_stream(stream, dim(spark), folder)
    assert snap_rows(read_counter_deltas(spark, folder)) == snap_rows(tg.counter_delta(counters(spark, sum(rows, [])), dim(spark)))
    assert [(r.instance_id, r.late_samples, r.batch) for r in read_late_samples(spark, folder).collect()] == [(1, 2, 2)]


def test_editions_in_a_stream(spark, tmp_path):
    from test_rules import fleet, samples

    whole = samples(spark)
    table = tg.counter_dimension(whole, editions=fleet(spark))
    parts = [whole.where(f"snapshot_date = timestamp_ntz'{at(h)}'") for h in (1, 2)]
    folder = str(tmp_path / "out")
    counter_delta_stream(feed(spark, tmp_path / "in", parts), table, folder, editions=fleet(spark))
    assert ordered(read_counter_deltas(spark, folder)) == ordered(tg.counter_delta(whole, table, editions=fleet(spark)))
