"""Work of a task, and what is exchanged, as the tables grow."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F
from samples import at

import tidegauge as tg
from tidegauge.operators.series import row_tasks, with_previous_snapshot
from tidegauge.plans.report import snapshot_report_from_views
from workload import derived, queries
from workload.staging import staged


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_tasks_grow_with_rows(spark):
    assert row_tasks(spark.range(800), task_rows=100) is None
    assert row_tasks(spark.range(801), task_rows=100) == 9
    assert row_tasks(spark.range(8000), task_rows=100) == 80


@pytest.mark.parametrize("fleet", [False, True])
def test_many_tasks_give_the_same_counters_and_sort_no_samples_for_the_sequence(spark, sf_dir, fleet):
    samples = staged(spark, derived.raw_counters(spark, sf_dir), "counters")
    options = {"editions": tg.instance_editions(derived.raw_config(spark, sf_dir))} if fleet else {}
    dim = staged(spark, tg.counter_dimension(samples, **options), "dim")
    few, many = tg.counter_delta(samples, dim, **options), tg.counter_delta(samples, dim, tasks=50, **options)
    assert many.count() == few.count() > 0 and many.exceptAll(few).isEmpty() and few.exceptAll(many).isEmpty()
    text = plan(tg.counter_delta(samples, dim, tasks=50, **options))
    assert re.search(r"Exchange hashpartitioning\(instance_id#\d+, _family#\d+L, _chunk#\d+, 50\), REPARTITION_BY_NUM", text)
    assert re.search(r"ShuffledHashJoin \[instance_id#\d+, snapshot_date#\d+\]", text)


@pytest.mark.parametrize("raw", [derived.raw_counters, derived.raw_waits])
def test_rows_per_counter_and_wait_type_are_not_exchanged(spark, sf_dir, raw):
    exchanged = [line for line in plan(raw(spark, sf_dir)).splitlines() if "Exchange" in line]
    assert exchanged and not [line for line in exchanged if "series" in line or "wait_type" in line]


def test_copies_over_a_border_carry_keys_and_values_only(spark):
    rows = [(1, "a", at(0), None, at(200), 5, "long"), (1, "a", at(200), at(0), None, 7, "text")]
    schema = "instance_id int, k string, snapshot_date timestamp_ntz, prev_snapshot timestamp_ntz, next_snapshot timestamp_ntz, v int, note string"
    got = with_previous_snapshot(spark.createDataFrame(rows, schema), ["instance_id", "k"], ["v"], chunk_days=1)
    assert sorted((r.v, r.prev_v, r.note) for r in got.collect()) == [(5, None, "long"), (7, 5, "text")]
    assert "CASE WHEN" in plan(got)


VIEWS = {
    "throughput_pivot": tg.throughput,
    "memory_pivot": tg.memory_snapshot,
    "waittime_pivot": tg.waittime_snapshot,
    "summary_ratio": tg.summary_ratio,
    "performance_report": tg.snapshot_report,
    "performance_report_from_views": snapshot_report_from_views,
}


@pytest.fixture(scope="module")
def stored(spark, sf_dir):
    return queries._facts(spark, sf_dir)


@pytest.mark.parametrize("view", VIEWS.values(), ids=VIEWS)
def test_views_group_facts_behind_one_exchange_by_snapshot(spark, stored, view):
    facts, dim = stored
    # Facts without an instance or a time, facts of no counter, and a dimension with repeated rows.
    gone = "if(instance_perf_value % 5 = 0, null, {0}) as {0}".format
    odd = facts.selectExpr(gone("instance_id"), gone("snapshot_date"), *facts.columns[2:])
    odd = facts.unionByName(odd).unionByName(odd.withColumn("inst_perf_param_id", F.lit(None).cast("bigint")))
    twice = dim.unionByName(dim)
    few, many = view(odd, twice).collect(), view(odd, twice, tasks=9).collect()
    assert few and sorted(map(repr, many)) == sorted(map(repr, few))
    # Facts that are smaller than the dimension would be broadcast to it; only the plan of these is looked at.
    large = facts.crossJoin(spark.range(1000)).drop("id")
    dealt = [line for line in plan(view(large, dim, tasks=50)).splitlines() if "Exchange hashpartitioning(instance_id" in line]
    assert dealt and all(re.search(r"\(instance_id#\d+, snapshot_date#\d+, 50\), REPARTITION_BY_NUM", line) for line in dealt)


@pytest.mark.parametrize("name", VIEWS)
def test_queries_deal_facts_by_their_rows(spark, sf_dir, stored, monkeypatch, name):
    monkeypatch.setattr(queries, "_facts", lambda *_: stored)
    monkeypatch.setattr(queries, "row_tasks", lambda rows: 50 if rows is stored[0] else None)
    text = plan(queries.QUERIES[name](spark, sf_dir))
    assert re.search(r"Exchange hashpartitioning\(instance_id#\d+, snapshot_date#\d+, 50\), REPARTITION_BY_NUM", text)
