"""Windowed reports and the deduplicated resource archive over streams.

Watermarks need an instant, samples carry wall-clock times: they are read in the session zone, and
window bounds are given back as wall-clock times.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..sources.slots import commit_generation, newest_generation, read_generation, slot

_BATCH = T.StructField("batch", T.LongType())
_DAY = T.StructField("archive_day", T.DateType())
_DAYS = T.StructType([_DAY])
_TIME = T.StructType([T.StructField("newest", T.TimestampNTZType())])


def windowed_report(
    rows: DataFrame,
    time: str,
    keys: Sequence[str],
    measures: Mapping[str, Column],
    *,
    length: str = "30 minutes",
    slide: str | None = None,
    late_after: str = "10 minutes",
) -> DataFrame:
    """Aggregates per time window and key; a window appears once it is closed.

    Tumbling by default; ``slide="5 minutes"`` gives the last half hour at every poll.  Grouping is by
    window and key with partial aggregation before the shuffle, so a busy key costs little.
    """
    window = F.window("_at", length, slide) if slide else F.window("_at", length)
    return (
        rows.withColumn("_at", F.col(time).cast("timestamp"))
        .withWatermark("_at", late_after)
        .groupBy(window.alias("_window"), *keys)
        .agg(*[c.alias(n) for n, c in measures.items()])
        .select(
            F.col("_window.start").cast("timestamp_ntz").alias("window_start"),
            F.col("_window.end").cast("timestamp_ntz").alias("window_end"),
            *keys,
            *measures,
        )
    )


def dedup_resources(rows: DataFrame, keys: Sequence[str], *, time: str = "end_time", late_after: str = "1 hour") -> DataFrame:
    """First row per key within the watermark, for appending to the resource archive."""
    timed = rows.withColumn("_at", F.col(time).cast("timestamp")).withWatermark("_at", late_after)
    return timed.dropDuplicatesWithinWatermark(list(keys)).drop("_at")


def report_stream(
    rows: DataFrame,
    time: str,
    keys: Sequence[str],
    measures: Mapping[str, Column],
    folder: str,
    *,
    length: str = "30 minutes",
    slide: str | None = None,
    late_after: str = "10 minutes",
    every: str | None = None,
) -> StreamingQuery:
    """``windowed_report`` that loses no row unseen: rows too late for a window are stored and counted.

    A window closes once it ended ``late_after`` before the newest time of any trigger; its rows are aggregated then.  A row whose window
    closed in an earlier trigger goes to the missed rows instead (``read_missed``); each trigger counts rows by what became of them
    (``read_accounts``).  A trigger reads its own rows and those of open windows, whose span bounds them.  ``folder``, ``every`` and
    killed triggers are as in ``counter_delta_stream``.
    """
    def advance(arrived: DataFrame, batch: int) -> None:
        spark = arrived.sparkSession
        now, was = slot(f"{folder}/arrived", batch), slot(f"{folder}/open", batch - 1)
        arrived.write.mode("overwrite").parquet(now)
        new = spark.read.schema(arrived.schema).parquet(now)
        before = _newest(spark, folder, batch - 1)
        newest = max((t for t in (before, new.agg(F.max(time)).first()[0]) if t is not None), default=None)
        window = F.window(time, length, slide) if slide else F.window(time, length)
        placed = new.where(F.col(time).isNotNull()).withColumn("_window", window)
        placed = placed.selectExpr(*[f"`{c}`" for c in arrived.columns], "_window.start as window_start", "_window.end as window_end")
        on_time = F.lit(True) if before is None else F.col("window_end") > _mark(before, late_after)
        placed.where(~on_time).write.mode("overwrite").parquet(f"{folder}/missed/batch={batch}")
        placed = placed.withColumn("_kept", on_time)
        counts = placed.agg(F.count("*").alias("placed"), F.count_if("_kept").alias("kept"), F.count_if(~F.col("_kept")).alias("missed"))
        undated = new.agg(F.count("*").alias("arrived"), F.count_if(F.col(time).isNull()).alias("undated"))
        # Two single rows, so this is no product of tables.
        undated.join(F.broadcast(counts)).write.mode("overwrite").parquet(f"{folder}/accounts/batch={batch}")

        waiting = placed.where("_kept").drop("_kept")
        if batch:
            waiting = waiting.unionByName(spark.read.schema(waiting.schema).parquet(was))
        closed = F.lit(False) if newest is None else F.col("window_end") <= _mark(newest, late_after)
        report = waiting.where(closed).groupBy("window_start", "window_end", *keys).agg(*[c.alias(n) for n, c in measures.items()])
        report.write.mode("overwrite").parquet(f"{folder}/report/batch={batch}")
        waiting.where(~closed).write.mode("overwrite").parquet(slot(f"{folder}/open", batch))
        commit_generation(spark.createDataFrame([(newest,)], _TIME), f"{folder}/state", batch)

    return _run(rows, advance, folder, every)


def _mark(newest: datetime, late_after: str) -> Column:
    return F.expr(f"{_literal(newest)} - interval {late_after}")


def _literal(at: datetime) -> str:
    return f"timestamp_ntz'{at.isoformat(sep=' ')}'"


def _newest(spark: SparkSession, folder: str, batch: int) -> datetime | None:
    if batch < 0:
        return None
    row = read_generation(spark, f"{folder}/state", _TIME, batch, "newest").first()
    return row[0] if row else None


def read_report(spark: SparkSession, folder: str) -> DataFrame:
    """Closed windows, as of the last committed trigger."""
    return _committed(spark, folder, "report").drop("batch")


def read_missed(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that came after a window of theirs had closed, with that window and the trigger that brought them."""
    return _committed(spark, folder, "missed")


def read_accounts(spark: SparkSession, folder: str) -> DataFrame:
    """By trigger: rows that arrived, rows without a time, rows in windows, and how many of these were kept and missed.

    ``placed = kept + missed``; with windows that do not overlap also ``arrived = kept + missed + undated``.
    """
    return _committed(spark, folder, "accounts")


def _committed(spark: SparkSession, folder: str, table: str) -> DataFrame:
    rows = spark.read.parquet(f"{folder}/{table}")
    return rows.where(F.col("batch") <= newest_generation(spark, f"{folder}/state"))


def archive_resources_stream(
    rows: DataFrame, keys: Sequence[str], folder: str, *, time: str = "end_time", every: str | None = None
) -> StreamingQuery:
    """Appends rows whose key the archive does not hold, however late they come, until the input is used up.

    The archive lies in ``folder`` by the day of ``time``, which has to be one of the keys: a key has one day, so a trigger compares with the
    days that its rows fall in and reads no others.  NULL keys are keys like others and enter once.  Of several rows of a key in one
    trigger the smallest enters, in the order of the columns.  ``every`` and killed triggers are as in ``counter_delta_stream``.
    """
    keys, schema = list(keys), rows.schema
    if time not in keys:
        raise ValueError(f"{time} is not one of the keys {keys}")
    others = [c for c in rows.columns if c not in keys]
    stored_schema = T.StructType([*[f for f in schema.fields if f.name in keys], _BATCH])

    def advance(arrived: DataFrame, batch: int) -> None:
        spark = arrived.sparkSession
        now = slot(f"{folder}/arrived", batch)
        smallest = F.min(F.struct(*others)) if others else F.count("*")
        once = arrived.groupBy(*keys).agg(smallest.alias("_row"))
        once = once.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others]).select(*schema.fieldNames())
        day = F.coalesce(F.expr(f"cast(`{time}` as date)"), F.expr("date'0001-01-01'")).alias("archive_day")
        once.select("*", day).write.mode("overwrite").parquet(now)
        fresh = spark.read.schema(T.StructType([*schema.fields, _DAY])).parquet(now)
        days = {r[0] for r in fresh.select("archive_day").distinct().collect()}
        known = read_generation(spark, f"{folder}/state", _DAYS, batch - 1, "archive_day") if batch else spark.createDataFrame([], _DAYS)
        stored = {r[0] for r in known.collect()}
        if days & stored:
            paths = [f"{folder}/archive/archive_day={d}" for d in sorted(days & stored)]
            there = spark.read.schema(stored_schema).option("basePath", f"{folder}/archive").parquet(*paths)
            there = there.where(F.col("batch") < batch).select(*[F.col(k).alias(f"_{k}") for k in keys])
            same = F.expr(" and ".join(f"`{k}` <=> `_{k}`" for k in keys))
            fresh = fresh.join(there, same, "left_anti")
        fresh.withColumn("batch", F.lit(batch).cast("long")).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("archive_day", "batch").parquet(f"{folder}/archive")
        commit_generation(spark.createDataFrame([(d,) for d in sorted(days | stored)], _DAYS), f"{folder}/state", batch)

    return _run(rows, advance, folder, every)


def read_archive(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """The archive as of the last committed trigger."""
    rows = spark.read.schema(T.StructType([*schema.fields, _BATCH])).parquet(f"{folder}/archive")
    return rows.where(F.col("batch") <= newest_generation(spark, f"{folder}/state")).select(*schema.fieldNames())


def _run(rows: DataFrame, advance, folder: str, every: str | None) -> StreamingQuery:
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    query = (
        rows.writeStream.foreachBatch(advance)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(**trigger)
        .start()
    )
    if every is None:
        query.awaitTermination()
    return query
