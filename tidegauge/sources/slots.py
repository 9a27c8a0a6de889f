"""Small tables that one run of a job replaces as a whole, so that the next run finds either the old or the new rows.

A table has two folders.  Generation n goes to folder n % 2, as one file that carries its number in each row; the generation
before stays untouched in the other folder.  A job that is killed while it writes leaves the generation before, and one that is run
again replaces only what it wrote itself.  So writing a generation is the commit point of everything written before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

GENERATION = T.StructField("generation", T.LongType())


def slot(folder: str, generation: int) -> str:
    return f"{folder}/slot={generation % 2}"


def commit_generation(rows: DataFrame, folder: str, generation: int) -> None:
    """Makes ``rows`` the newest generation; a row without values marks the generation of a table without rows."""
    marker = rows.sparkSession.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields])
    stamped = rows.unionByName(marker).withColumn("generation", F.lit(generation).cast("long"))
    stamped.coalesce(1).write.mode("overwrite").parquet(slot(folder, generation))


def newest_generation(spark: SparkSession, folder: str) -> int | None:
    """Number of the last committed generation, of a table that has one."""
    found = spark.read.schema(T.StructType([GENERATION])).parquet(folder)
    return found.agg(F.max("generation")).first()[0]


def read_generation(spark: SparkSession, folder: str, schema: T.StructType, generation: int, key: str) -> DataFrame:
    """Rows of a generation; ``key`` is a column that is null in the marking row alone."""
    rows = spark.read.schema(T.StructType([*schema.fields, GENERATION])).parquet(slot(folder, generation))
    return rows.where((F.col("generation") == generation) & F.col(key).isNotNull()).drop("generation")
