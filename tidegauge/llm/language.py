"""Language identification as a mixture: expectation-maximisation over the shares of languages in each document.

A language is a distribution of hashed character 3-grams, counted over all labelled documents.  A document's likelihood is
a mixture of those distributions.  From the best single language on, the language whose addition gains most likelihood
joins as long as the gain exceeds ``penalty`` times the logarithm of the number of 3-grams; expectation-maximisation gives
the shares.  The prediction is the language with the largest share, the score is that share.

The model has one number per language and bucket, whatever the corpus holds.

Defined results: null texts and texts without a letter are ``und`` with score 0, as is everything if nothing is labelled;
null languages and null ids teach nothing; a null id is not held out; ties go to the first language by code point; repeated
rows are counted and predicted each; an empty table gives an empty result.  Input columns may have any names; an added
column replaces one of the same name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, MapType, StringType

from tidegauge.llm.shared import shielded, unshielded

_LETTERS = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"


def grams(text: str | None, buckets: int) -> np.ndarray:
    """Buckets of the 3-grams of a text: its words in lower case, each between blanks; empty without a letter."""
    words = " ".join(_LETTERS.findall((text or "").lower()))
    if not any(map(str.isalpha, words)):
        return np.empty(0, np.int64)
    c = np.frombuffer(f" {words} ".encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    mixed = (c[:-2] * np.uint64(0x9E3779B97F4A7C15)) ^ (c[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (c[2:] * np.uint64(0x165667B19E3779F9))
    return ((mixed * np.uint64(0xFF51AFD7ED558CCD)) >> np.uint64(40)).astype(np.int64) % buckets


def held_out(doc_id: Column) -> Column:
    """Whether CRC-32 of the id as text leaves 2 by 4; false for null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _counter(buckets: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if lang not in counts:
                    counts[lang] = np.zeros(buckets, np.int64)
                counts[lang] += np.bincount(grams(text, buckets), minlength=buckets)
        for lang, total in counts.items():
            found = total.nonzero()[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(found), pa.string()), pa.array(found, pa.int32()), pa.array(total[found], pa.int64())],
                names=["lang", "bucket", "n"],
            )

    return count


def train(labelled: DataFrame, *, buckets: int = 1 << 15, smoothing: float = 0.5) -> tuple[list[str], np.ndarray]:
    """Languages by code point and their distributions (languages x buckets), from all rows ``lang, text``."""
    counts = labelled.select("lang", "text").mapInArrow(_counter(buckets), "lang string, bucket int, n bigint")
    counts = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    per = counts.groupBy("lang").agg(F.collect_list("bucket").alias("buckets"), F.collect_list("n").alias("n")).collect()
    per.sort(key=lambda r: r["lang"])
    table = np.full((len(per), buckets), smoothing)
    for row, r in zip(table, per):
        row[r["buckets"]] += r["n"]
    return [r["lang"] for r in per], table / table.sum(axis=1, keepdims=True)


def shares(p: np.ndarray, n: np.ndarray, rounds: int, start: np.ndarray) -> np.ndarray:
    """Mixing weights by expectation-maximisation: ``p`` languages x grams, ``n`` counts of the grams."""
    w = start
    for _ in range(rounds):
        joint = w[:, None] * p
        w = (joint / joint.sum(axis=0)) @ n / n.sum()
    return w


def mixture(p: np.ndarray, n: np.ndarray, penalty: float, rounds: int = 12) -> dict[int, float]:
    """Languages and their shares, by penalised likelihood."""
    total = n.sum()
    cost = penalty * np.log(total + 1.0)
    single = np.log(p) @ n
    chosen, weights, likelihood = [int(single.argmax())], np.ones(1), single.max()
    rest = [i for i in range(len(p)) if i != chosen[0]]
    while rest:
        now = weights @ p[chosen]
        # The likelihood is concave in the shares: no addition gains more than its slope at share 0.
        slope = (p[rest] / now) @ n - total
        rest = [i for i, s in zip(rest, slope) if s > cost]
        if not rest:
            break
        others, share = p[rest], np.full(len(rest), 0.1)
        for _ in range(rounds):
            part = share[:, None] * others
            share = (part / (part + (1 - share[:, None]) * now)) @ n / total
        gains = np.log(share[:, None] * others + (1 - share[:, None]) * now) @ n - likelihood
        best = int(gains.argmax())
        if gains[best] <= cost:
            break
        start = np.append(weights * (1 - share[best]), share[best])
        chosen.append(rest.pop(best))
        weights = shares(p[chosen], n, rounds, start)
        likelihood = np.log(weights @ p[chosen]) @ n
    return dict(zip(chosen, weights))


def _predictor(model, buckets: int, penalty: float):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, table = model.value
        for batch in batches:
            best: list[str] = []
            score: list[float] = []
            every: list[list[tuple[str, float]]] = []
            for text in batch.column("text").to_pylist():
                found = grams(text, buckets)
                if not len(found) or not langs:
                    best.append(UNKNOWN)
                    score.append(0.0)
                    every.append([])
                    continue
                n = np.bincount(found)
                at = n.nonzero()[0]
                mixed = sorted(((float(w), -i) for i, w in mixture(table[:, at], n[at].astype(float), penalty).items()), reverse=True)
                best.append(langs[-mixed[0][1]])
                score.append(min(1.0, mixed[0][0]))
                every.append([(langs[-i], w) for w, i in mixed])
            carried = [c for c in batch.schema.names if c.startswith("in_")]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in carried], pa.array(best, pa.string()), pa.array(score, pa.float64()), pa.array(every, pa.map_(pa.string(), pa.float64()))],
                names=[*carried, "lang_pred", "score", "lang_shares"],
            )

    return predict


def identify(
    documents: DataFrame, model: tuple[list[str], np.ndarray], *, text_col: str = "text", penalty: float = 4.0, carry: tuple[str, ...] | None = None
) -> DataFrame:
    """The input's columns (of these ``carry``, by default all), ``lang_pred``, ``score`` and ``lang_shares``."""
    spark: SparkSession = documents.sparkSession
    rows, inner = shielded(documents)
    carried = {name: i for name, i in inner.items() if carry is None or name in carry}
    rows = rows.select(*carried.values(), F.col(inner[text_col]).cast("string").alias("text"))
    added = ["lang_pred", "score", "lang_shares"]
    schema = rows.select(*carried.values()).schema.add("lang_pred", "string").add("score", "double").add("lang_shares", MapType(StringType(), DoubleType()))
    sent = spark.sparkContext.broadcast(model)
    return rows.mapInArrow(_predictor(sent, model[1].shape[1], penalty), schema).select(*unshielded(carried, added), *added)


def learn(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", buckets: int = 1 << 15) -> tuple[list[str], np.ndarray]:
    """The model of all labelled documents that are not held out."""
    ids, lang = F.col(id_col), F.col(lang_col)
    labelled = documents.filter(ids.isNotNull() & lang.isNotNull() & ~held_out(ids))
    return train(labelled.select(lang.cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")), buckets=buckets)
