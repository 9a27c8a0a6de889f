"""Cumulative counters to interval values over a stream of samples: the batch operator, trigger by trigger.

A trigger stores its samples, finds the snapshots that they touch (their own, and the ones right after them) and computes
those anew with ``counter_delta`` from the samples of these snapshots and of the ones before.  So a sample may come
late, twice, or in another trigger than its base or its neighbours: the result is that of one batch over everything
that has arrived.

What a trigger reads does not grow with the number of triggers before it.  The samples of the last two snapshots of each
instance are kept apart as the tail, which holds all that new and unfinished snapshots look back to.  Only for samples behind
the tail are older ones read: the order of snapshots from the month before the oldest of them on, a row per poll, and of the stored
samples just the days of the triggers that hold the needed snapshots.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.time import snapshot_day
from ..operators.counters import counter_delta
from ..operators.sequence import SEQUENCE_COLUMNS, snapshot_sequence
from ..operators.series import CHUNK_DAYS, row_tasks
from ..schemas import COUNTER_SAMPLES, PERF_SNAP
from ..sources.slots import commit_generation, newest_generation, read_generation, slot

_BATCH = T.StructField("batch", T.LongType())
_DAY = T.StructField("snapshot_day", T.DateType())
_AT = ("instance_id", "snapshot_date")
_POLL = [T.StructField("instance_id", T.IntegerType()), *[T.StructField(c, T.TimestampNTZType()) for c in ("snapshot_date", "instance_started")]]
_POLLS = T.StructType([*_POLL, T.StructField("late_samples", T.LongType())])
#: The last two snapshots of each instance, its first one, and the months that hold polls.
_STATE = T.StructType(
    [*_POLL, T.StructField("first_snapshot", T.TimestampNTZType()), T.StructField("months", T.ArrayType(T.StringType()))]
)
_MONTH = "date_format(snapshot_date, 'yyyy-MM')"


def counter_delta_stream(
    samples: DataFrame,
    params: DataFrame,
    folder: str,
    *,
    editions: DataFrame | None = None,
    base: str = "interval",
    on_reset: str = "keep",
    parity: bool = False,
    chunk_days: int = CHUNK_DAYS,
    every: str | None = None,
) -> StreamingQuery:
    """Runs ``counter_delta`` over a stream of counter samples until its input is used up.

    ``every`` ("5 minutes") polls on and returns the running query at once.

    ``folder`` (shared by all executors) keeps the samples by trigger and day, the polls by month, the tail and the results;
    ``read_counter_deltas``, ``read_unrated`` and ``read_late_samples`` read them.  A trigger writes folders of its own
    number, then the tail, then the state, which commits it.  One that is run again after a failure replaces what it wrote, and
    readers see what is committed.
    """
    options = {"editions": editions, "base": base, "on_reset": on_reset, "parity": parity, "chunk_days": chunk_days}

    def advance(arrived: DataFrame, batch: int) -> None:
        _advance(arrived, batch, params, folder, options)

    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    query = (
        samples.writeStream.foreachBatch(advance)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(**trigger)
        .start()
    )
    if every is None:
        query.awaitTermination()
    return query


def _advance(arrived: DataFrame, batch: int, params: DataFrame, folder: str, options: dict) -> None:
    spark, last = arrived.sparkSession, batch - 1
    dated = arrived.select(*COUNTER_SAMPLES.fieldNames()).withColumn("snapshot_day", snapshot_day())
    # A file for each day rather than one for each day and task.
    _write(dated.hint("rebalance", "snapshot_day"), f"{folder}/samples/batch={batch}", "snapshot_day")
    new = _read(spark, COUNTER_SAMPLES, f"{folder}/samples/batch={batch}")
    if batch:
        state = read_generation(spark, f"{folder}/state", _STATE, last, "instance_id")
        tail = _read(spark, COUNTER_SAMPLES, slot(f"{folder}/tail", last))
        months = set(_months(spark, folder, last))
    else:
        state, tail, months = spark.createDataFrame([], _STATE), spark.createDataFrame([], COUNTER_SAMPLES), set()

    known = state.groupBy("instance_id").agg(F.max("snapshot_date").alias("_last"), F.min("first_snapshot").alias("_first"))
    polls = new.groupBy(*_AT).agg(F.max("instance_started").alias("instance_started"), F.count("*").alias("n"))
    polls = polls.join(known, "instance_id", "left").selectExpr(
        *_POLLS.fieldNames()[:3], "if(snapshot_date <= _last, n, 0) as late_samples", f"{_MONTH} as month", f"{batch}L as batch", "_last", "_first"
    )
    # One row per poll of the trigger: small, and used by all that follows.
    _write(polls, slot(f"{folder}/polls_now", batch))
    polls = spark.read.schema(polls.schema).parquet(slot(f"{folder}/polls_now", batch))
    _write(polls.select(*_POLLS.fieldNames(), "month", "batch"), f"{folder}/polls", "month", "batch", dynamic=True)
    found = polls.agg(F.collect_set("month"), F.min(F.expr("if(snapshot_date < _last, month, null)"))).first()
    months |= set(found[0])

    recent = state.select(*_POLLS.fieldNames()[:3]).unionByName(polls.select(*_POLLS.fieldNames()[:3]))
    if found[1] is None:
        needed, stored = _needed(spark, folder, batch, recent, polls, options), new.unionByName(tail)
    else:
        needed, at = _needed_behind_tail(spark, folder, batch, polls, sorted(months), found[1], options)
        # The days of the triggers that hold them: a list of folders, no listing of others.
        places = at.join(_by_poll(needed), list(_AT), "left_semi").select("batch", snapshot_day().alias("day")).distinct().collect()
        stored = _read(spark, COUNTER_SAMPLES, *[f"{folder}/samples/batch={p.batch}/snapshot_day={p.day}" for p in places])
    # Samples meet the needed snapshots as their sequence; all others go there.
    delta = counter_delta(stored, params, sequence=needed, keep_unrated=True, tasks=row_tasks(stored), **options)
    touched = needed.where("touched").select(*_AT)
    rows = delta.join(_by_poll(touched), list(_AT), "left_semi")
    # A row without a counter for each touched snapshot: one that is left without rows replaces its older rows too.
    marks = touched.select(*_AT, *[F.lit(None).cast(f.dataType).alias(f.name) for f in PERF_SNAP.fields if f.name not in _AT])
    _write(rows.unionByName(marks), f"{folder}/perf_snap/batch={batch}")

    rank = "row_number() over (partition by instance_id order by snapshot_date desc) as _rank"
    latest = recent.groupBy(*_AT).agg(F.max("instance_started").alias("instance_started")).selectExpr("*", rank).where("_rank <= 2")
    _write(new.unionByName(tail).join(latest.select(*_AT), list(_AT), "left_semi"), slot(f"{folder}/tail", batch))
    first = polls.groupBy("instance_id").agg(F.least(F.min("snapshot_date"), F.min("_first")).alias("_first"))
    first = first.unionByName(known.select("instance_id", "_first")).groupBy("instance_id").agg(F.min("_first").alias("first_snapshot"))
    seen = F.array(*[F.lit(m) for m in sorted(months)]).cast("array<string>")
    commit_generation(latest.join(first, "instance_id").withColumn("months", seen).select(*_STATE.fieldNames()), f"{folder}/state", batch)


def _needed(spark: SparkSession, folder: str, batch: int, history: DataFrame, polls: DataFrame, options: dict) -> DataFrame:
    """The snapshots of the trigger and those right after them (``touched``), and those right before them, with their sequence."""
    own = [_by_poll(polls.select("instance_id", F.col("snapshot_date").alias(c), F.lit(True).alias(f"_{c}"))) for c in _NEIGHBOURS]
    sequence = snapshot_sequence(history, parity=options["parity"], chunk_days=options["chunk_days"])
    for c, mine in zip(_NEIGHBOURS, own):
        sequence = sequence.join(mine, ["instance_id", c], "left")
    marks = [f"_{c} is not null" for c in _NEIGHBOURS]
    rows = sequence.where(" or ".join(marks)).selectExpr(*_AT, "instance_started", *SEQUENCE_COLUMNS, f"({marks[0]} or {marks[1]}) as touched")
    path = slot(f"{folder}/needed", batch)
    _write(rows, path)
    return spark.read.schema(rows.schema).parquet(path)


#: A snapshot is needed if it, the one before it or the one after it is in the trigger.
_NEIGHBOURS = ("snapshot_date", "prev_snapshot", "next_snapshot")


def _needed_behind_tail(
    spark: SparkSession, folder: str, batch: int, polls: DataFrame, months: list[str], oldest: str, options: dict
) -> tuple[DataFrame, DataFrame]:
    """The same for a trigger with samples behind the tail, and which trigger holds the samples of each snapshot.

    Polls are read from the month before the oldest late one, and from further back only while an instance that was seen before
    finds no earlier snapshot.
    """
    instances = polls.select("instance_id").distinct()
    start, further = months.index(oldest), 1
    while True:
        start = max(0, start - further)
        at = _read(spark, T.StructType([*_POLLS.fields, _BATCH]), *[f"{folder}/polls/month={m}" for m in months[start:]], base=f"{folder}/polls")
        at = at.where(F.col("batch") <= batch).join(instances, "instance_id", "left_semi")
        needed = _needed(spark, folder, batch, at, polls, options)
        if start == 0:
            return needed, at
        alone = needed.where("prev_snapshot is null").join(polls.where("snapshot_date > _first").select(*_AT), list(_AT), "left_semi")
        if alone.isEmpty():
            return needed, at
        further *= 2


def _by_poll(polls: DataFrame) -> DataFrame:
    """Marks rows by poll for a join that keeps them off the driver: they grow with fleet and history, and each trigger joins
    them several times, so a broadcast each time would send more with every one."""
    return polls.hint("shuffle_hash")


def read_counter_deltas(spark: SparkSession, folder: str) -> DataFrame:
    """``perf_snap`` rows as of the last committed trigger: each snapshot as it was last computed."""
    return _newest(spark, folder).where("instance_perf_value is not null")


def read_unrated(spark: SparkSession, folder: str) -> DataFrame:
    """Counters of snapshots that have no value: rates over no second, and falls with ``on_reset="null"``."""
    return _newest(spark, folder).where("instance_perf_value is null").drop("instance_perf_value")


def _newest(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.read.schema(T.StructType([*PERF_SNAP.fields, _BATCH])).parquet(f"{folder}/perf_snap")
    rows = rows.where(F.col("batch") <= newest_generation(spark, f"{folder}/state"))
    last = rows.where("inst_perf_param_id is null").groupBy(*_AT).agg(F.max("batch").alias("batch"))
    return rows.where("inst_perf_param_id is not null").join(_by_poll(last), [*_AT, "batch"], "left_semi").drop("batch")


def read_late_samples(spark: SparkSession, folder: str) -> DataFrame:
    """How many samples of each trigger were at or before their instance's newest snapshot; they are used all the same."""
    polls = spark.read.schema(T.StructType([*_POLLS.fields, _BATCH])).parquet(f"{folder}/polls")
    late = polls.where((F.col("late_samples") > 0) & (F.col("batch") <= newest_generation(spark, f"{folder}/state")))
    return late.groupBy("instance_id", "batch").agg(F.sum("late_samples").alias("late_samples"))


def _months(spark: SparkSession, folder: str, batch: int) -> list[str]:
    row = spark.read.schema(_STATE).parquet(slot(f"{folder}/state", batch)).where("months is not null").select("months").first()
    return row[0] if row else []


def _read(spark: SparkSession, schema: T.StructType, *paths: str, base: str | None = None) -> DataFrame:
    reader = spark.read.schema(schema)
    rows = (reader.option("basePath", base) if base else reader).parquet(*paths)
    return rows.select(*schema.fieldNames())


def _write(rows: DataFrame, path: str, *by: str, dynamic: bool = False) -> None:
    writer = rows.write.mode("overwrite")
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(*by) if by else writer).parquet(path)
