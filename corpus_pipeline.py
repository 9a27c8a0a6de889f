"""A corpus, stage by stage: languages, near duplicates, repeated strings, a mix of sources, packed sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return the columns of ``docs``, further ones
(of any name, repeated rows, nulls) as they came.  Texts may be null, empty or very long; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.language import UNKNOWN, identify, learn
from tidegauge.llm.minhash import link_documents
from tidegauge.llm.mixing import mix, mixed_documents
from tidegauge.llm.packing import pack, tokenized_pieces
from tidegauge.llm.repeats import remove_repeats
from tidegauge.llm.shared import read_table, staged


#: Columns that stages read or set.
OWN = ("doc_id", "text", "lang", "source", "n_chars")


def _guarded(spark: SparkSession, docs: DataFrame) -> tuple[DataFrame, list[Column]]:
    """``docs`` with neutral names for further columns, as operators add columns of any name, and the columns of ``docs`` from these.

    Whole texts go to Python in batches of 1000 rows from here on: workers hold a few batches each, and stages follow each other
    in the same workers.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    names = [c if c in OWN else f"extra_{i}" for i, c in enumerate(docs.columns)]
    return docs.toDF(*names), [F.col(n).alias(c) for n, c in zip(names, docs.columns)]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language, with ``lang`` as predicted; texts without a letter and null texts go."""
    rows, columns = _guarded(spark, docs)
    found = identify(rows, learn(rows)).filter(F.col("lang_pred") != UNKNOWN)
    return found.withColumn("lang", F.col("lang_pred")).select(*columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group whose 5-word shingles agree to 80 % or more, repeated rows and rows without an id too."""
    rows, columns = _guarded(spark, docs)
    return link_documents(rows, by_row=True).filter("kept").select(*columns)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without 200-byte strings that occur twice; documents of which no word is left go."""
    rows, columns = _guarded(spark, docs)
    left = remove_repeats(rows).withColumn("text", F.col("kept_text"))
    if "n_chars" in rows.columns:
        left = left.withColumn("n_chars", F.length("text").cast(rows.schema["n_chars"].dataType))
    return left.filter(F.col("text").rlike(r"[^\x20\x09-\x0D]")).select(*columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, repeated and cut as their source's target asks."""
    rows, columns = _guarded(spark, docs)
    return mixed_documents(mix(rows), rows.columns).select(*columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 tokens."""
    import public_tokenizers

    docs, _ = _guarded(spark, docs)
    pieces = pack(tokenized_pieces(docs, public_tokenizers.path("word_bpe_49k.json")))
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeated_strings", repeated_strings),
    ("source_mix", source_mix),
    ("packing", packing),
]

#: No stage but the mix can be said in SQL; tests hold each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
