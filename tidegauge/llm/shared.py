"""Helpers that the operators share: word patterns, staged tables in the cluster's shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Runs of characters other than ASCII white space (Java's and RE2's syntax).
WORD = r"[^\x20\x09-\x0D]+"
#: ASCII white space.
SPACES = " \t\n\x0b\x0c\r"


def scratch_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, else one beside the warehouse's tables."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir") + "/scratch"
    return root.rstrip("/")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def staged(frame: DataFrame, name: str) -> DataFrame:
    """Written once as Parquet in the shared folder and read again: cuts lineage, and its size is known to the planner."""
    path = scratch_folder(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def drop_staged(*frames: DataFrame) -> None:
    """Removes the files of tables made by ``staged`` that nothing reads any more."""
    for frame in frames:
        session = frame.sparkSession
        for file in {f.rsplit("/", 1)[0] for f in frame.inputFiles()}:
            path = session._jvm.org.apache.hadoop.fs.Path(file)
            path.getFileSystem(session._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def shielded(frame: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The frame with neutral column names, and the neutral name of each: inputs may hold columns of any name."""
    inner = {name: f"in_{i}" for i, name in enumerate(frame.columns)}
    return frame.toDF(*inner.values()), inner


def unshielded(inner: dict[str, str], added: list[str]) -> list[Column]:
    """The input's columns under their own names, but for those that an added column of the same name replaces."""
    taken = {a.lower() for a in added}
    return [F.col(i).alias(name) for name, i in inner.items() if name.lower() not in taken]


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
