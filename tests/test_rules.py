from __future__ import annotations

import re

from samples import COUNTER, at

import tidegauge as tg
from tidegauge.operators.rules import KEYS, RULES, match_rules, with_name_keys
from tidegauge.sources.constants import AVERAGE, BASE, CUSTOM

GAUGE = 65792


def names(spark, rows):
    return spark.createDataFrame(rows, "object_nm string, counter_nm string, instance_nm string").transform(with_name_keys)


def like(text, pattern):
    if pattern is None:
        return True
    parts = re.findall(r"\\.|.", pattern.rstrip(" ").lower())
    regex = "".join(".*" if p == "%" else "." if p == "_" else re.escape(p[-1]) for p in parts)
    return re.fullmatch(regex, text.rstrip(" ").lower()) is not None


def test_patterns_against_every_pair(spark):
    counters = [("SQLServer:Locks", "Lock Waits/sec ", "_Total"), ("MSSQL$A:Locks", "lock waits/SEC", "xTotal"), ("a", "b", ""), ("a%", "a_b", "c\\d")]
    rules = [
        ("%Locks", "Lock Waits/sec", "\\_Total", None, True),
        ("%Locks", "Lock%", "_Total", 5, True),
        ("%", "%", None, 3, False),
        ("mssql$%", "%waits%", "%", 8, True),
        (None, "B", "", None, True),
        ("a\\%", "a\\_b", "c\\\\d", None, True),
        ("a", "a_b", None, 5, True),
        ("", "", "", 1, True),
        ("%s", "locks", None, None, True),
    ]
    got = match_rules(names(spark, counters), spark.createDataFrame(rules, RULES))
    want = {
        (*(n.rstrip(" ").lower() for n in c), edition, flag)
        for c in counters
        for *patterns, edition, flag in rules
        if all(like(n, p) for n, p in zip(c, patterns))
    }
    assert {tuple(r) for r in got.select(*KEYS, "edition", "log_ind").collect()} == want and len(want) > 8


def test_table_of_built_in_rules_flags_as_the_predicate_does(spark, sf_dir):
    from workload import derived

    dim = tg.build_counter_dim(derived.raw_counters(spark, sf_dir))
    editions = spark.createDataFrame([(1, 3)], "instance_id int, edition int")
    by_table = tg.flag_by_rules(dim, tg.log_rules(spark), editions).where("log_ind").select("inst_perf_param_id").collect()
    by_predicate = tg.flag_counters(dim).where("log_ind").select("inst_perf_param_id").collect()
    assert {r[0] for r in by_table} == {r[0] for r in by_predicate}


def samples(spark):
    rows = []
    for instance in (1, 2, 3, 4):
        for h in (1, 2):
            rows += [
                (instance, at(h), at(0), "X:Databases", "Log Growths", "_Total", 10 * h, GAUGE),
                (instance, at(h), at(0), "X:Databases", "Transactions/sec", "_Total", 5, GAUGE),
                (instance, at(h), at(0), "Custom:IO", "Physical Reads", "Total", 100 * h, CUSTOM),
                (instance, at(h), at(0), "X:Latches", "Average Latch Wait Time (ms)", "", 60 * h, AVERAGE),
                (instance, at(h), at(0), "X:Latches", "Average Latch Wait Time base", "", 2 * h, BASE),
            ]
    return spark.createDataFrame(rows, COUNTER)


def fleet(spark):
    return spark.createDataFrame([(1, 3), (2, 5), (3, 8), (4, None)], "instance_id int, edition int")


def test_each_instance_logs_what_its_edition_logs(spark):
    dim = tg.counter_dimension(samples(spark), editions=fleet(spark))
    ids = {r.inst_perf_param_id: (r.counter_nm, r.engine_edition) for r in dim.collect()}
    assert len(ids) == dim.count()
    got = {(r.instance_id, *ids[r.inst_perf_param_id]) for r in tg.counter_delta(samples(spark), dim, editions=fleet(spark)).collect()}
    every = {(i, "Transactions/sec", None) for i in (1, 2, 3, 4)}
    assert got == every | {(i, "Physical Reads", None) for i in (1, 3, 4)} | {(2, "Log Growths", 5)}
    # The rows for all editions alone hold for every instance.
    plain = {r.inst_perf_param_id for r in tg.counter_delta(samples(spark), dim).collect()}
    assert all(ids[i][1] is None for i in plain)


def test_ids_stay_when_an_edition_joins(spark):
    small = tg.counter_dimension(samples(spark), editions=fleet(spark).where("edition = 3")).collect()
    large = {r.inst_perf_param_id: r for r in tg.counter_dimension(samples(spark), editions=fleet(spark)).collect()}
    assert all(r.engine_edition is None and large[r.inst_perf_param_id].log_ind == r.log_ind for r in small)


def test_a_counter_and_its_base_meet_in_each_edition(spark):
    """A rule of one edition for the average alone, a rule for all editions for its base."""
    rows = [("%latches", "average latch wait time (ms)", None, 5, True), ("%latches", "%base", None, None, True)]
    dim = tg.counter_dimension(samples(spark), editions=fleet(spark), rules=spark.createDataFrame(rows, RULES))
    logged = {(r.counter_nm, r.engine_edition): r for r in dim.where("log_ind").collect()}
    average, base = logged["Average Latch Wait Time (ms)", 5], logged["Average Latch Wait Time base", 5]
    assert base.parent_param_id == average.inst_perf_param_id != logged["Average Latch Wait Time base", None].parent_param_id
    got = tg.counter_delta(samples(spark), dim, editions=fleet(spark)).where(f"inst_perf_param_id = {average.inst_perf_param_id}")
    assert sorted((r.instance_id, float(r.instance_perf_value)) for r in got.collect()) == [(2, 30.0), (2, 30.0)]


def test_a_rule_that_turns_off_outweighs(spark):
    rows = [("%", "%", None, None, True), ("%databases", "log%", None, 8, False), ("%databases", "tran%", None, None, False)]
    dim = tg.counter_dimension(samples(spark), editions=fleet(spark), rules=spark.createDataFrame(rows, RULES))
    flags = {(r.counter_nm, r.engine_edition): r.log_ind for r in dim.where("object_nm like '%Databases'").collect()}
    assert flags == {("Log Growths", None): True, ("Log Growths", 8): False, ("Transactions/sec", None): False}


def test_no_edition_known_and_no_rules(spark):
    nobody = fleet(spark).where("instance_id = 4")
    dim = tg.counter_dimension(samples(spark), editions=nobody, rules=spark.createDataFrame([], RULES))
    assert {(r.log_ind, r.engine_edition) for r in dim.collect()} == {(False, None)}
    assert tg.counter_delta(samples(spark), dim, editions=nobody).collect() == []


def test_newest_known_edition(spark):
    rows = [(1, at(1), 3), (1, at(3), 5), (1, at(5), None), (2, at(1), None)]
    config = spark.createDataFrame(rows, "instance_id int, snapshot_date timestamp_ntz, engine_edition_code int")
    assert [tuple(r) for r in tg.instance_editions(config).collect()] == [(1, 5)]
