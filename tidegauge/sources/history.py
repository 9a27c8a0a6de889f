"""A snapshot table and its history behind one pointer.

Rows lie in pieces: folders ``data/snapshot_day=D/piece=P``.  The pointer, a small table with a row for each piece, says whether a piece
belongs to the current table or to history.  So moving aged days is a change of the pointer: their files stay where they are, under
their names, and both tables change in the one write that commits it.  Only the day that the cutoff falls into is written
again, split in two; the pointer keeps the pieces it was split from, as in neither table.  A job that is killed at any step leaves the tables as they were and can be run again; it writes the
same folders.  One job at a time changes a table.

Reads take the pieces of the asked days from the pointer and list no other folder.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import schemas
from ..functions.time import snapshot_day, ts
from .readers import DAY, between_snapshots
from .sinks import KEYS, conformed, time_column
from .slots import commit_generation, newest_generation, read_generation

_PIECE = T.StructField("piece", T.StringType())
POINTER = T.StructType(
    [
        T.StructField("in_history", T.BooleanType()),
        DAY,
        _PIECE,
        T.StructField("date_added", T.TimestampNTZType()),
        T.StructField("archived_by_user", T.StringType()),
    ]
)


def create_tables(spark: SparkSession, folder: str) -> None:
    """An empty table with an empty history."""
    commit_generation(spark.createDataFrame([], POINTER), f"{folder}/pointer", 0)


def add_piece(df: DataFrame, folder: str, *, kind: str, piece: str, asof: datetime | None = None) -> None:
    """Adds rows to the current table as ``piece``, a name for this run: a repeated run replaces its own rows, and adds none.

    Days of the piece that have moved to history since, or were split, are not written again.
    """
    spark, time = df.sparkSession, time_column(kind)
    rows = conformed(df, kind, asof).withColumn("snapshot_day", snapshot_day(time))
    generation, pointer = _pointer(spark, folder)
    settled = F.coalesce("in_history", F.lit(True))
    moved = [r.snapshot_day for r in pointer.where(settled & (F.col("piece") == piece)).collect()]
    rows = rows.where(~F.col("snapshot_day").isin(moved)) if moved else rows
    _write(rows, folder, kind, piece)
    written = rows.select("snapshot_day").distinct()
    entries = written.select(F.lit(False).alias("in_history"), "snapshot_day", F.lit(piece).alias("piece")).select(
        "*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in POINTER.fields[3:]]
    )
    others = pointer.where(settled | (F.col("piece") != piece))
    commit_generation(others.unionByName(entries), f"{folder}/pointer", generation + 1)


def move_aged(spark: SparkSession, folder: str, *, kind: str, asof: datetime, days: int = 1, user: str) -> None:
    """Moves rows that are at least ``days`` old at ``asof`` from the current table to history."""
    cutoff = asof - timedelta(days=days)
    generation, pointer = _pointer(spark, folder)
    current = pointer.where("not in_history")
    border = [r.piece for r in current.where(F.col("snapshot_day") == F.lit(cutoff.date())).collect()]
    replaced, added = F.lit(False), []
    if border:
        rows = _read_pieces(spark, kind, folder, [(cutoff.date(), p) for p in border])
        aged = F.col(time_column(kind)) <= ts(cutoff)
        some = rows.agg(F.bool_or(aged).alias("aged"), F.bool_or(~aged).alias("kept")).first()
        if some.aged:
            stamp = cutoff.strftime("%Y%m%dT%H%M%S.%f")
            replaced = (F.col("snapshot_day") == F.lit(cutoff.date())) & ~F.coalesce("in_history", F.lit(True))
            rows = rows.drop("piece")
            for name, part, there in ((f"aged-{stamp}", rows.where(aged), True), (f"kept-{stamp}", rows.where(~aged), some.kept)):
                if there:
                    _write(part, folder, kind, name)
                    added.append((name.startswith("aged"), cutoff.date(), name, asof if name.startswith("aged") else None, user if name.startswith("aged") else None))
    whole = ~F.col("in_history") & (F.col("snapshot_day") < F.lit(cutoff.date()))
    if not added and pointer.where(whole).isEmpty():
        return
    moved = pointer.withColumns(
        {
            "date_added": F.when(whole, ts(asof)).otherwise(F.col("date_added")),
            "archived_by_user": F.when(whole, F.lit(user)).otherwise(F.col("archived_by_user")),
            "in_history": F.when(whole, True).when(~replaced, F.col("in_history")),
        }
    )
    commit_generation(moved.unionByName(spark.createDataFrame(added, POINTER)), f"{folder}/pointer", generation + 1)


def read_current(spark: SparkSession, kind: str, folder: str, *, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """Rows of the current table, of the days of an optional time range."""
    return _read_table(spark, kind, folder, start, end, history=False).drop("snapshot_day", "piece")


def read_history(spark: SparkSession, kind: str, folder: str, *, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """Rows of history with ``date_added`` and ``archived_by_user``, of the days of an optional time range."""
    rows = _read_table(spark, kind, folder, start, end, history=True)
    audit = _pointer(spark, folder)[1].where("in_history").drop("in_history")
    # A row for each day and piece: Spark broadcasts it as long as its size allows.
    return rows.join(audit, ["snapshot_day", "piece"]).drop("snapshot_day", "piece")


def _pointer(spark: SparkSession, folder: str) -> tuple[int, DataFrame]:
    generation = newest_generation(spark, f"{folder}/pointer")
    return generation, read_generation(spark, f"{folder}/pointer", POINTER, generation, "piece")


def _read_table(spark: SparkSession, kind: str, folder: str, start, end, *, history: bool) -> DataFrame:
    listed = _pointer(spark, folder)[1].where(F.col("in_history") == history)
    if start is not None:
        listed = listed.where(F.col("snapshot_day") >= F.lit(start.date()))
    if end is not None:
        listed = listed.where(F.col("snapshot_day") <= F.lit(end.date()))
    rows = _read_pieces(spark, kind, folder, [(r.snapshot_day, r.piece) for r in listed.collect()])
    return between_snapshots(rows, start, end, time_column(kind))


def _read_pieces(spark: SparkSession, kind: str, folder: str, pieces: list[tuple]) -> DataFrame:
    schema = T.StructType([*schemas.SNAPSHOTS[kind].fields, DAY, _PIECE])
    if not pieces:
        return spark.createDataFrame([], schema)
    paths = [f"{folder}/data/snapshot_day={day}/piece={piece}" for day, piece in pieces]
    return spark.read.schema(schema).option("basePath", f"{folder}/data").parquet(*paths)


def _write(rows: DataFrame, folder: str, kind: str, piece: str) -> None:
    time = time_column(kind)
    (
        rows.withColumn("piece", F.lit(piece))
        .hint("rebalance", "snapshot_day")
        .sortWithinPartitions("snapshot_day", F.col(time).desc(), *[c for c in KEYS[kind] if c != time])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("snapshot_day", "piece")
        .parquet(f"{folder}/data")
    )
