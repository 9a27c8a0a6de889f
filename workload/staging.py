"""Written tables in the shared folder, for stream sources, stream sinks and reused inputs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder under the cluster's checkpoint directory, else beside the warehouse's tables: both are shared."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir") + "/scratch"
    return f"{root.rstrip('/')}/tidegauge-{uuid.uuid4().hex}"


def staged(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written out and read back, so several consumers share one computation."""
    path = f"{shared_folder(spark)}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_stream_in_any_order(spark: SparkSession, df: DataFrame, name: str, *, triggers: int) -> DataFrame:
    """``df`` as a stream of files that hold rows of all keys and times, some files per trigger."""
    path = f"{shared_folder(spark)}/{name}"
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(files, F.xxhash64(*df.columns)).write.parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", -(-files // triggers)).parquet(path)


def run_stream(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    """Runs a stream over all available input into a Parquet table and returns the table."""
    folder = shared_folder(spark)
    query = (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{folder}/{name}")
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/{name}")
