"""The counter dimension: which counters exist, which are logged, which share a base."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.keys import surrogate_id
from ..functions.text import key_in_sql, key_is_sql, literal_key, object_family_sql, quoted
from ..sources.constants import (
    AVERAGE,
    BASE,
    CUSTOM,
    LOG_RULES,
    PER_DATABASE_FAMILIES,
    RATIO,
    SUMMARY_INSTANCES,
    custom_counters,
)
from .rules import KEYS, NAMES, base_name_sql, custom_exclusions, flag_by_rules, log_rules, with_name_keys

_COLUMNS = (
    "inst_perf_param_id",
    "object_nm",
    "counter_nm",
    "instance_nm",
    "counter_type",
    "parent_param_id",
    "log_ind",
)


def server_prefixes(samples: DataFrame) -> DataFrame:
    """The prefixes named servers put before their objects: ``MSSQL$NAME`` of ``MSSQL$NAME:Locks``."""
    return (
        samples.where("startswith(upper(object_name), 'MSSQL$')")
        .selectExpr("instance_id", "substring_index(object_name, ':', 1) as prefix")
        .distinct()
    )


def build_counter_dim(samples: DataFrame, *, with_custom: bool = True, parity: bool = False) -> DataFrame:
    """One row per counter seen, without those listed once per database.

    Object families such as ``Databases`` repeat every counter for every database; of these only the
    ``_Total`` and ``tempdb`` rows are kept.  The server prefix (``SQLServer:``, ``MSSQL$NAME:``) is
    cut per row.  ``with_custom`` adds the collector-computed counters.  ``parity`` lets broker
    activation through and files one custom counter under another object.

    Duplicates spelled differently collapse into the smallest spelling.  Exact duplicates, the
    repeated polls, go first and by hash, so they cost one row per task.
    """
    families = [f for f in PER_DATABASE_FAMILIES if not (parity and f == "Broker Activation")]
    per_database = key_in_sql(object_family_sql("object_key"), families)
    listed = samples.selectExpr(
        "trim(object_name) as object_nm",
        "trim(counter_name) as counter_nm",
        "trim(instance_name) as instance_nm",
        "cntr_type as counter_type",
    ).distinct()
    kept = listed.transform(with_name_keys).where(
        f"not {per_database} or {key_in_sql('instance_key', SUMMARY_INSTANCES)}"
    )
    if with_custom:
        custom = custom_counters(samples.sparkSession, parity=parity).withColumn("counter_type", F.lit(CUSTOM))
        kept = kept.unionByName(custom.transform(with_name_keys))
    return (
        kept.groupBy(*KEYS)
        .agg(*[F.min(c).alias(c) for c in (*NAMES, "counter_type")])
        .select(
            surrogate_id(*KEYS).alias("inst_perf_param_id"),
            *NAMES,
            "counter_type",
            F.expr("0L as parent_param_id"),
            F.expr("false as log_ind"),
        )
    )


def flag_counters(dim: DataFrame, *, edition_code: int | None = None, rules: Sequence[tuple] = LOG_RULES) -> DataFrame:
    """Turns logging on for counters matched by a rule; a counter already logged stays logged.

    Rules are a short fixed list of name patterns, so they become one predicate over the dimension.
    A rule bound to an edition applies only when ``edition_code`` is that edition.
    """
    active = [r for r in rules if r[5] is None or r[5] == edition_code]
    matched = " or ".join(["log_ind", *[_rule_sql(r) for r in active]])
    return dim.transform(with_name_keys).withColumn("log_ind", F.expr(matched)).select(*_COLUMNS)


def link_base_counters(dim: DataFrame, *, parity: bool = False) -> DataFrame:
    """Gives each base counter the id of the counter it divides.

    The base of ``Average Wait Time (ms)`` is called ``Average Wait Time base``: same object, same
    instance.  Both meet in one group of a window, without a join of the dimension to itself.
    ``parity`` links ratio counters only, not averages.
    """
    kinds = RATIO if parity else f"{RATIO}, {AVERAGE}"
    parent = f"min(if(counter_type in ({kinds}), inst_perf_param_id, null))"
    # Rows of one edition are linked with each other.
    edition = ", engine_edition" if "engine_edition" in dim.columns else ""
    pair = f"over (partition by object_key, instance_key, _base_key{edition})"
    return (
        dim.transform(with_name_keys)
        .selectExpr("*", f"{base_name_sql(parity=parity)} as _base_key")
        .selectExpr("*", f"if(counter_type = {BASE}, {parent} {pair}, null) as _parent")
        .withColumn("parent_param_id", F.coalesce("_parent", "parent_param_id"))
        .select(*dim.columns)
    )


def counter_dimension(
    samples: DataFrame,
    *,
    editions: DataFrame | None = None,
    rules: DataFrame | None = None,
    edition_code: int | None = None,
    with_custom: bool | None = None,
    parity: bool = False,
) -> DataFrame:
    """Build, flag and link in one call.  A single cloud database has no custom counters.

    editions  (instance_id, edition) of a fleet, one row per instance: flags hold per edition, see ``flag_by_rules``
    rules     rules as a table (``rules.RULES``), the built-in ones (``rules.log_rules``) by default; needs ``editions``
    """
    if editions is not None:
        spark = samples.sparkSession
        rules = (rules if rules is not None else log_rules(spark)).unionByName(custom_exclusions(editions))
        dim = build_counter_dim(samples, with_custom=with_custom is not False, parity=parity)
        return link_base_counters(flag_by_rules(dim, rules, editions), parity=parity)
    if rules is not None:
        raise ValueError("rules as a table need the editions of the fleet")
    if with_custom is None:
        with_custom = edition_code is None or edition_code <= 4 or edition_code == 8
    dim = build_counter_dim(samples, with_custom=with_custom, parity=parity)
    return link_base_counters(flag_counters(dim, edition_code=edition_code), parity=parity)


def counter_families(params: DataFrame) -> DataFrame:
    """Logged counter / base pairs: (base_id, base keys, parent_id, parent keys)."""
    logged = params.where("log_ind").transform(with_name_keys)
    base = logged.where("parent_param_id <> 0").selectExpr(
        "inst_perf_param_id as base_id",
        "parent_param_id as parent_id",
        "counter_key as base_counter",
        "instance_key as base_instance",
    )
    parent = logged.selectExpr(
        "inst_perf_param_id as parent_id", "counter_key as parent_counter", "instance_key as parent_instance"
    )
    return base.join(parent, "parent_id")


def _rule_sql(rule: tuple) -> str:
    object_match, object_name, counter_match, counters, instance, _ = rule
    matcher = {"ends": "endswith", "starts": "startswith"}[object_match]
    hits = [f"{matcher}(object_key, {quoted(literal_key(object_name))})"]
    if counter_match == "is":
        hits.append(key_in_sql("counter_key", counters))
    else:
        starts = [f"startswith(counter_key, {quoted(literal_key(c))})" for c in counters]
        hits.append(f"({' or '.join(starts)})")
    if instance is not None:
        hits.append(key_is_sql("instance_key", instance))
    return f"({' and '.join(hits)})"
