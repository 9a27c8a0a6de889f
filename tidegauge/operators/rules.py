"""Which counters are logged, by rules that are data, for fleets of several editions.

A rule is a row of ``LIKE`` patterns over object, counter and instance names.  It turns logging on, or off
(``log_ind`` false, which outweighs), everywhere or for the instances of one engine edition.  Rules meet the dimension in a
join by pattern.  So that no name is compared with every rule, a pattern is filed under the first letters before its first
wildcard, and a name looks only under the beginnings of its own; patterns that start with a wildcard are filed apart.

The dimension of a fleet has one row per counter for all editions, and a further one, with an id of its own, for each
edition whose flag differs.  Ids of other editions stay as they are when an edition joins the fleet.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.keys import surrogate_id
from ..functions.text import name_key_sql
from ..sources.constants import AVERAGE, LOG_RULES, RATIO

RULES = "object_like string, counter_like string, instance_like string, edition int, log_ind boolean"
NAMES = ("object_nm", "counter_nm", "instance_nm")
KEYS = ("object_key", "counter_key", "instance_key")
#: Letters of a pattern's literal beginning that it is filed under, at most.
_FILED = 4


def _literal(text: str) -> str:
    return "".join("\\" + c if c in "%_\\" else c for c in text)


def log_rules(spark: SparkSession, rules: Sequence[tuple] = LOG_RULES) -> DataFrame:
    """The built-in rules as a table, one row per counter pattern."""
    rows = []
    for object_match, object_name, counter_match, counters, instance, edition in rules:
        object_like = f"%{_literal(object_name)}" if object_match == "ends" else f"{_literal(object_name)}%"
        for counter in counters:
            counter_like = _literal(counter) + ("" if counter_match == "is" else "%")
            rows.append((object_like, counter_like, None if instance is None else _literal(instance), edition, True))
    return spark.createDataFrame(rows, RULES)


def instance_editions(config: DataFrame) -> DataFrame:
    """(instance_id, edition): the newest known engine edition code of each instance."""
    known = config.where("engine_edition_code is not null")
    return known.groupBy("instance_id").agg(F.max_by("engine_edition_code", "snapshot_date").alias("edition"))


def with_name_keys(df: DataFrame) -> DataFrame:
    return df.selectExpr("*", *[f"{name_key_sql(n)} as {k}" for k, n in zip(KEYS, NAMES)])


def match_rules(names: DataFrame, rules: DataFrame) -> DataFrame:
    """(name keys, edition, log_ind) of the rules that names match; names without a rule are absent.

    A NULL pattern matches every name; a NULL edition means all editions.
    """
    begins = "regexp_extract(lower({0}), '^[^%_\\\\\\\\]*', 0)"
    filed = rules.selectExpr(
        *[f"lower(rtrim({p}_like)) as {p}_like" for p in ("object", "counter", "instance")],
        "edition",
        "log_ind",
        f"left({begins.format('counter_like')}, {_FILED}) as _counter",
        f"left({begins.format('object_like')}, {_FILED}) as _object",
    ).selectExpr("*", "case when _counter <> '' then 'c' || _counter when _object <> '' then 'o' || _object else '' end as _file")
    files = ", ".join(f"'{k}' || left({c}, {n})" for k, c in (("c", KEYS[1]), ("o", KEYS[0])) for n in range(1, _FILED + 1))
    looked = names.selectExpr(*KEYS, f"explode(array_distinct(array('', {files}))) as _file")
    patterns = [f"coalesce({k} like {k.replace('_key', '_like')}, {k.replace('_key', '_like')} is null)" for k in KEYS]
    hits = looked.join(filed, (looked["_file"] == filed["_file"]) & F.expr(" and ".join(patterns)))
    return hits.select(*KEYS, "edition", "log_ind").distinct()


def flag_by_rules(dim: DataFrame, rules: DataFrame, editions: DataFrame) -> DataFrame:
    """Sets ``log_ind`` by the rules and adds a row for each edition of the fleet whose flags differ.

    Adds ``engine_edition`` (NULL: all editions but those of ``excepted_editions``).  A counter and its base
    (same object and instance, names by ``base_name_sql``) get rows for the same editions, so that they meet in each of them.
    """
    fleet = editions.select("edition").where("edition is not null").distinct()
    everywhere = rules.where("edition is null")
    bound = rules.where("edition is not null").join(fleet, "edition", "left_semi").select(*rules.columns)
    keyed = dim.transform(with_name_keys).withColumn("_base_key", F.expr(base_name_sql()))
    found = match_rules(keyed, everywhere.unionByName(bound))
    on, off = F.bool_or("log_ind"), F.bool_or(~F.col("log_ind"))
    common = found.where("edition is null").groupBy(*KEYS).agg((on & ~off).alias("_all"))
    special = found.where("edition is not null").groupBy(*KEYS, "edition").agg(on.alias("_on"), off.alias("_off"))
    flagged = keyed.join(common, list(KEYS), "left").withColumn("log_ind", F.expr("log_ind or coalesce(_all, false)")).drop("_all")
    own = special.join(flagged.select(*KEYS, "_base_key", "log_ind"), list(KEYS)).selectExpr(
        *KEYS, "_base_key", "edition", "log_ind as _common", "(log_ind or _on) and not _off as _own"
    )
    family = ["object_key", "instance_key", "_base_key"]
    differing = own.where("_own <> _common").groupBy(*family).agg(F.sort_array(F.collect_set("edition")).alias("excepted_editions"))
    rows = flagged.join(differing, family, "left")
    apart = (
        rows.where("excepted_editions is not null")
        .withColumn("engine_edition", F.explode("excepted_editions"))
        .join(own.selectExpr(*[f"{k} as _{k}" for k in KEYS], "edition as _edition", "_own"),
              F.expr(" and ".join([f"{k} = _{k}" for k in KEYS] + ["engine_edition = _edition"])), "left")
        .withColumn("log_ind", F.coalesce("_own", "log_ind"))
        .withColumn("inst_perf_param_id", surrogate_id(*KEYS, "engine_edition"))
        .withColumn("excepted_editions", F.lit(None).cast("array<int>"))
    )
    columns = [*dim.columns, "engine_edition", "excepted_editions"]
    return rows.withColumn("engine_edition", F.lit(None).cast("int")).select(*columns).unionByName(apart.select(*columns))


def custom_exclusions(editions: DataFrame) -> DataFrame:
    """Rules that keep the collector-computed counters off the editions that have none: all but 1 to 4 and 8."""
    without = editions.select("edition").where("edition is not null and not (edition <= 4 or edition = 8)").distinct()
    return without.selectExpr(
        "'Custom:%' as object_like", "'%' as counter_like", "cast(null as string) as instance_like", "edition", "false as log_ind"
    )


def base_name_sql(*, parity: bool = False) -> str:
    """Name that a counter's base goes by; ``parity`` knows bases of ratio counters only, not of averages."""
    kinds = f"{RATIO}" if parity else f"{RATIO}, {AVERAGE}"
    return f"if(counter_type in ({kinds}), rtrim(replace(counter_key, ' (ms)', '')) || ' base', counter_key)"
