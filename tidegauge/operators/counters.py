"""Cumulative performance counters to interval values, rates and averages."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.numeric import whole_ratio_sql
from ..functions.text import name_key_sql
from ..sources.constants import AVERAGE, BASE, DIFFERENCED, RATE
from .rules import KEYS, NAMES
from .sequence import snapshot_sequence, with_sequence
from .series import CHUNK_DAYS, with_previous_snapshot

ON_RESET = {
    "keep": "{gain}",
    "null": "if({gain} >= 0, {gain}, null)",
    "cumulative": "if({gain} >= 0, {gain}, total)",
}


def counter_delta(
    samples: DataFrame,
    params: DataFrame,
    *,
    sequence: DataFrame | None = None,
    editions: DataFrame | None = None,
    base: str = "interval",
    on_reset: str = "keep",
    keep_unrated: bool = False,
    strict: bool = False,
    parity: bool = False,
    chunk_days: int = CHUNK_DAYS,
    tasks: int | None = None,
) -> DataFrame:
    """Raw counter samples -> ``perf_snap`` rows for every logged counter and snapshot.

    First measure after a server start: the cumulative value.  Later: a per-second rate, an interval
    difference or the gauge itself, by counter type; a key absent from the previous snapshot counts
    from 0.  Average counters are then divided by their base counter (1 when the base is 0 or NULL).

    base      "interval": divide by what the base gained in the interval; "cumulative": by its total.
    on_reset  a counter that fell without a restart: "keep" the negative difference, "null" (drops
              the row) or "cumulative" (take the new total).
    strict    raise on a zero-second interval instead of leaving the row out.
    keep_unrated  give the rows left out too, with a NULL value (``unrated_counters`` gives them alone).
    editions  (instance_id, edition), one row per instance: with a dimension that has rows of their own for some editions,
              each instance takes those of its edition.  Without it, the rows for all editions hold for every instance.

    tasks     of the look-back, see ``row_tasks``: for many samples, so that a task does not grow with them.

    A counter and its base travel together: look-back and division share one shuffle.
    """
    if base not in ("interval", "cumulative") or on_reset not in ON_RESET:
        raise ValueError(f"base={base!r}, on_reset={on_reset!r}")
    sequence = sequence if sequence is not None else snapshot_sequence(samples, parity=parity, chunk_days=chunk_days)
    if editions is not None and "engine_edition" in params.columns:
        # One row per poll carries the edition along, so the samples meet no further relation.
        sequence = sequence.join(editions.select("instance_id", "edition"), "instance_id", "left")
        matched = with_sequence(match_names(samples, params), sequence, "edition", hashed=bool(tasks)).transform(take_edition)
    else:
        matched = with_sequence(match_counters(samples, params), sequence, hashed=bool(tasks))
    looked_up = with_previous_snapshot(
        matched,
        ["instance_id", "inst_perf_param_id"],
        ["total"],
        cluster=["instance_id", "_family"],
        chunk_days=chunk_days,
        tasks=tasks,
    )
    gain = ON_RESET[on_reset].format(gain="(total - coalesce(prev_total, 0))")
    divisor = "_gained" if base == "interval" else "total"
    members = "over (partition by instance_id, _family, _chunk, snapshot_date)"
    rate, average = whole_ratio_sql("_gained", "interval_s", strict=strict), whole_ratio_sql("_gained", "_divisor")
    valued = (
        looked_up.selectExpr("*", f"if(first_measure, total, {gain}) as _gained")
        .selectExpr(
            "*",
            f"""case when first_measure then cast(total as decimal(28,2))
                     when counter_type = {RATE} then {rate}
                     when counter_type in {DIFFERENCED} then cast(_gained as decimal(28,2))
                     else cast(total as decimal(28,2)) end as _value""",
        )
        .selectExpr("*", f"coalesce(nullif(max(if(_is_base, {divisor}, null)) {members}, 0), 1) as _divisor")
    )
    if not keep_unrated:
        valued = valued.where("_value is not null")
    return valued.selectExpr(
        "instance_id",
        "snapshot_date",
        "inst_perf_param_id",
        f"if(counter_type = {AVERAGE} and _value is not null, {average}, _value) as instance_perf_value",
        "cast(total as decimal(28,2)) as cumulative_perf_value",
        "first_measure as startup_measure_ind",
        "interval_s as measurement_interval_s",
    )


def unrated_counters(samples: DataFrame, params: DataFrame, **options) -> DataFrame:
    """The rows that ``counter_delta`` leaves out: rates over no second, and falls with ``on_reset="null"``."""
    rows = counter_delta(samples, params, keep_unrated=True, **options)
    return rows.where("instance_perf_value is null").drop("instance_perf_value")


_PARENT = "coalesce(nullif(parent_param_id, 0), inst_perf_param_id)"
_MATCHED = (
    "inst_perf_param_id",
    "counter_type",
    f"{_PARENT} as _family",
    f"(counter_type = {BASE} and {_PARENT} <> inst_perf_param_id) as _is_base",
)


def match_counters(samples: DataFrame, params: DataFrame, *, keep: tuple[str, ...] = ()) -> DataFrame:
    """Samples of logged counters, with their dimension row; names match by key.

    ``_family`` groups a counter with its base counter: the parent's id where there is one.  ``keep``
    names further sample columns to pass through.
    """
    logged = params.where("log_ind")
    if "engine_edition" in params.columns:
        logged = logged.where("engine_edition is null")
    return _measured(samples, keep).join(logged.selectExpr(*_DIMENSION_KEYS, *_MATCHED), list(KEYS)).drop(*KEYS)


def match_names(samples: DataFrame, params: DataFrame) -> DataFrame:
    """Samples of counters that some edition logs, with the dimension rows of all editions (``_all`` and ``_by_edition``)."""
    row = f"struct(log_ind, {', '.join(_MATCHED)})"
    named = params.selectExpr(*_DIMENSION_KEYS, "engine_edition", "log_ind", f"{row} as _row").groupBy(*KEYS)
    rows = named.agg(
        F.expr("max(if(engine_edition is null, _row, null)) as _all"),
        F.expr("map_from_entries(collect_list(if(engine_edition is null, null, struct(engine_edition, _row)))) as _by_edition"),
        F.bool_or("log_ind").alias("_logged"),
    )
    return _measured(samples).join(rows.where("_logged").drop("_logged"), list(KEYS)).drop(*KEYS)


def take_edition(matched: DataFrame) -> DataFrame:
    """The dimension row of the instance's own edition, if it is logged there."""
    own = matched.withColumn("_row", F.expr("coalesce(if(edition is null, null, _by_edition[edition]), _all)")).where("_row.log_ind")
    return own.select("*", *[f"_row.{c}" for c in ("inst_perf_param_id", "counter_type", "_family", "_is_base")]).drop(
        "_row", "_all", "_by_edition", "edition"
    )


_DIMENSION_KEYS = [f"{name_key_sql(n)} as {k}" for k, n in zip(KEYS, NAMES)]


def _measured(samples: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return samples.selectExpr(
        "instance_id",
        "snapshot_date",
        f"{name_key_sql('object_name')} as object_key",
        f"{name_key_sql('counter_name')} as counter_key",
        f"{name_key_sql('instance_name')} as instance_key",
        "abs(cntr_value) as total",
        *keep,
    )
