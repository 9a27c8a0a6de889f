"""As-of states, shared inputs of monitors, and tables that a repeated run leaves as they are."""

from __future__ import annotations

import random

import pytest
from samples import COUNTER, at, waits

import tidegauge as tg
from tidegauge.operators.series import as_of
from tidegauge.plans import monitors
from tidegauge.sources.constants import CUSTOM
from tidegauge.sources.readers import read_snapshots

SAMPLE = "instance_id int, database_name string, snapshot_date timestamp_ntz, n int"
STATES = "instance_id int, database_name string, since timestamp_ntz, state_desc string"


@pytest.mark.parametrize("chunk_days", [1, 7, 400])
def test_as_of_against_every_pair(spark, chunk_days):
    draw = random.Random(chunk_days)
    rows = [(draw.randint(1, 2), draw.choice("ab"), at(draw.randint(0, 900)), n) for n in range(150)]
    log = [(draw.randint(1, 2), draw.choice("abc"), at(draw.randint(0, 900)), draw.choice("xyz")) for _ in range(40)]
    got = as_of(spark.createDataFrame(rows, SAMPLE), spark.createDataFrame(log, STATES), ["instance_id", "database_name"], ["state_desc"], chunk_days=chunk_days)
    want = []
    for i, d, t, n in rows:
        known = [(s, state) for li, ld, s, state in log if (li, ld) == (i, d) and s <= t]
        want.append((i, d, t, n, max(known)[1] if known else None))
    assert sorted(map(tuple, got.collect()), key=lambda r: r[3]) == want


def test_a_database_taken_offline_and_back(spark):
    samples = spark.createDataFrame([(1, "Db", at(h), h) for h in (1, 5, 10, 200, 300)] + [(1, "other", at(5), 0)], SAMPLE)
    log = [(1, "DB ", at(4), "offline"), (1, "db", at(10), "Online"), (1, "db", at(250), "RESTORING"), (1, None, at(1), "OFFLINE"), (1, "db", None, "OFFLINE")]
    got = tg.online_only(samples, spark.createDataFrame(log, STATES))
    assert got.columns == samples.columns and sorted(r.n for r in got.collect()) == [0, 1, 10, 200]
    assert tg.online_only(samples, spark.createDataFrame([], STATES)).count() == 6
    assert tg.online_only(samples.limit(0), spark.createDataFrame(log, STATES)).count() == 0


def fleet_inputs(spark):
    rows = [(i, at(h), at(0), "Custom:IO", "Physical Reads", "Total", 10 * h, CUSTOM) for i in (1, 2) for h in (1, 2)]
    config = spark.createDataFrame([(1, at(1), 3), (2, at(1), 5)], "instance_id int, snapshot_date timestamp_ntz, engine_edition_code int")
    resource = [(1, at(1), 1), (1, at(1), 1), (2, at(1), 1)]
    return {
        "counters": spark.createDataFrame(rows, COUNTER),
        "waits": waits(spark, [(1, 1, 0, "A", 1, 1, 1), (1, 2, 0, "A", 3, 3, 3)]),
        "editions": tg.instance_editions(config),
        "resource_stats": spark.createDataFrame(resource, "instance_id int, end_time timestamp_ntz, dtu_limit int"),
    }


def test_what_is_missing_is_derived(spark):
    results = tg.run_monitors(fleet_inputs(spark))
    assert sorted(results) == ["perf_snap", "resource_history", "wait_summary"]
    assert {r.instance_id for r in results["perf_snap"].collect()} == {1}  # the second is a cloud database
    with pytest.raises(KeyError):
        tg.run_monitors({}, which=["wait_summary"])


def test_shared_inputs_are_written_once(spark, tmp_path, monkeypatch):
    calls = []
    derived = dict(monitors.DERIVED)
    needs, wanted, make = derived["editions"]
    monkeypatch.setitem(monitors.DERIVED, "editions", (needs, wanted, lambda i: calls.append(1) or make(i)))
    inputs = fleet_inputs(spark)
    del inputs["editions"]
    inputs["config"] = spark.createDataFrame([(1, at(1), 3), (2, at(1), 5)], "instance_id int, snapshot_date timestamp_ntz, engine_edition_code int")
    results = tg.run_monitors(inputs, which=["perf_snap"], folder=str(tmp_path))
    assert calls == [1] and [p.name for p in tmp_path.iterdir()] == ["editions"]
    assert results["perf_snap"].count() == 2


def test_stored_twice_and_after_a_kill(spark, tmp_path, monkeypatch):
    folder, append = str(tmp_path / "tables"), monitors.append_missing

    def failing(rows, path, *, kind, asof):
        if kind == "wait_summary":
            raise RuntimeError("killed")
        append(rows, path, kind=kind, asof=asof)

    monkeypatch.setattr(monitors, "append_missing", failing)
    store = lambda n: tg.store_monitors(fleet_inputs(spark), folder, asof=at(9), user="u", work=str(tmp_path / n))
    with pytest.raises(RuntimeError, match="killed"):
        store("a")
    monkeypatch.setattr(monitors, "append_missing", append)
    for n in "bc":
        assert sorted(store(n)) == ["perf_snap", "resource_history", "wait_summary"]
    counts = {k: read_snapshots(spark, k, f"{folder}/{k}").count() for k in ("perf_snap", "resource_history", "wait_summary")}
    assert counts == {"perf_snap": 2, "resource_history": 2, "wait_summary": 2}
