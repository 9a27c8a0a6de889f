"""Hard negatives: for each anchor and positive, the best rows of other labels whose score lies in a band below the positive's.

Vectors become integers, ``floor(scale * x)``; a score is an integer inner product.  Every row is stored once with a one-bit
code: the unit vector, padded with zeros to ``spread`` bits a component, is rotated (three rounds of fixed signs and a
Hadamard transform) and only the signs are kept, with the code's alignment to its vector.  An anchor's rotated vector is cut into
eight bit planes, so that its product with a code is a sum of popcounts.  That gives an estimate of the cosine, and by
Cauchy-Schwarz on what the code does not hold an interval that is sure to hold it:

    cos(x, a) = g s + <x - g c, a>,    |<x - g c, a>| <= sqrt(1 - g^2) sqrt(1 - s^2)

for the code's unit vector c, g = <x, c> (stored) and s = <c, a> (popcounts, with the error of the planes added).  The best
estimates are scored first; only rows whose interval still reaches the worst of them, or the band, are scored too, in
integers.  The filter is lossless, so results are those of an exact search at any size.

Anchors meet all rows in blocks: a task holds ``block_rows`` rows and ``block_anchors`` anchors and returns at most the number
wanted for each anchor (and positive), so that whoever holds a third of all rows is spread over blocks like any other.

Defined results: rows with a null id, a null label, a null or empty vector, or a component that is null or not finite take no
part; rows equal in id, label and integers count once; a row with the anchor's id is never its partner; vectors of different length do not
meet; scaled components beyond 2^25 count as 2^25, so that sums of 4096 of them fit 64 bits.  Ties go to the smaller id, and for
rows of one id to the smaller label, then the smaller vector (as text).  A positive with a negative score has an empty band.
An empty table gives an empty result.  Input columns may have any names.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegauge.llm.shared import shielded, staged

#: Bits of an anchor's component in the popcount estimate.
PLANES = 8
LARGEST = 1 << 25


@lru_cache(maxsize=8)
def _signs(width: int) -> np.ndarray:
    return np.random.default_rng(20_11).choice([-1.0, 1.0], size=(3, width))


def _hadamard(x: np.ndarray) -> np.ndarray:
    """Rows times the orthonormal Hadamard matrix of their length, a power of two."""
    rows, width = x.shape
    half = 1
    while half < width:
        x = x.reshape(rows, width // (2 * half), 2, half)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(rows, width)
        half *= 2
    return x / np.sqrt(width)


def code_width(components: int, spread: int) -> int:
    """Bits of a code: a power of two, 64 at least."""
    return max(64, 1 << (components * spread - 1).bit_length())


def rotate(x: np.ndarray, width: int) -> np.ndarray:
    padded = np.zeros((len(x), width))
    padded[:, : x.shape[1]] = x
    for signs in _signs(width):
        padded = _hadamard(padded * signs)
    return padded


def rotate_back(y: np.ndarray, components: int) -> np.ndarray:
    for signs in _signs(y.shape[1])[::-1]:
        y = _hadamard(y) * signs
    return y[:, :components]


def encode(x: np.ndarray, spread: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes as 64-bit words, lengths of the vectors, alignments g, and lengths of the codes' part in the vectors' space."""
    length = np.sqrt((x * x).sum(axis=1))
    unit = x / np.where(length > 0, length, 1)[:, None]
    bits = rotate(unit, code_width(x.shape[1], spread)) >= 0
    code = rotate_back(np.where(bits, 1.0, -1.0) / np.sqrt(bits.shape[1]), x.shape[1])
    part = np.sqrt((code * code).sum(axis=1))
    aligned = (unit * code).sum(axis=1) / np.where(part > 0, part, 1)
    return np.packbits(bits, axis=1, bitorder="little").view("<u8"), length, aligned, part


def planes(anchors: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bit planes of rotated unit vectors, least value, step, sum of the rounded components, and length of the rounding error."""
    length = np.sqrt((anchors * anchors).sum(axis=1, keepdims=True))
    turned = rotate(anchors / np.where(length > 0, length, 1), width)
    least = turned.min(axis=1, keepdims=True)
    step = (turned.max(axis=1, keepdims=True) - least) / ((1 << PLANES) - 1)
    step[step == 0] = 1
    rounded = np.rint((turned - least) / step).astype(np.uint8)
    error = np.sqrt(((turned - least - step * rounded) ** 2).sum(axis=1))
    bits = (rounded[:, None, :] >> np.arange(PLANES, dtype=np.uint8)[None, :, None]) & 1
    packed = np.packbits(bits, axis=2, bitorder="little").view("<u8")
    return packed, least[:, 0], step[:, 0], (least + step * rounded).sum(axis=1), error


def intervals(code, aligned, part, anchor) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Estimate, lower and upper bound of the cosine of each coded row with an anchor, from its ``planes``."""
    packed, least, step, total, error = anchor
    inside = np.zeros(len(code))
    ones = np.zeros(len(code))
    for word in range(code.shape[1]):
        column = code[:, word]
        ones += np.bitwise_count(column)
        for plane in range(PLANES):
            inside += np.bitwise_count(column & packed[plane, word]) * float(1 << plane)
    product = (2 * (least * ones + step * inside) - total) / np.sqrt(64 * code.shape[1])
    part = np.where(part > 0, part, 1)
    s, off = product / part, error / part
    rest = np.sqrt(np.clip(1 - aligned * aligned, 0, 1)) * np.sqrt(np.clip(1 - np.clip(np.abs(s) - off, 0, 1) ** 2, 0, 1))
    about, wide = aligned * s, np.abs(aligned) * off + rest + 1e-9
    return about, about - wide, about + wide


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1) if len(flat) else np.zeros((0, 0))


def _words(column: pa.ChunkedArray) -> np.ndarray:
    raw = column.to_pylist()
    return np.frombuffer(b"".join(raw), "<u8").reshape(len(raw), -1)


def _array(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).combine_chunks().to_numpy(zero_copy_only=False)


def _summable(x: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as doubles where these hold every partial sum of a product exactly, else as the 64-bit integers that they are."""
    if float(np.abs(x).max()) * float(np.abs(anchors).max()) * x.shape[1] < 2.0**53:
        return x.astype(np.float64), anchors.astype(np.float64)
    return x, anchors


def _exact(x: np.ndarray, rows: np.ndarray, a: np.ndarray) -> np.ndarray:
    return (x[rows] @ a).astype(np.int64)


def scored(x, a, near, allowed, band, wanted) -> tuple[np.ndarray, np.ndarray]:
    """Rows and scores of the first ``wanted`` allowed rows with a score in the band; ``near`` are the intervals of scores."""
    about, low, high = near
    least, most = band
    slack = 1e-6
    open_ = np.flatnonzero(allowed & (high >= least - slack) & (low <= most + slack))
    if len(open_) > 4 * wanted:
        # Those with the best estimates inside the band set the bar that every other interval has to reach.
        inside = open_[about[open_] <= most]
        first = inside[np.argpartition(-about[inside], 2 * wanted)[: 2 * wanted]] if len(inside) > 2 * wanted else inside
        bar = _exact(x, first, a)
        bar = np.sort(bar[(bar >= least) & (bar <= most)])[::-1]
        if len(bar) >= wanted:
            open_ = open_[high[open_] >= bar[wanted - 1] - slack]
    found = _exact(x, open_, a)
    fits = (found >= least) & (found <= most)
    open_, found = open_[fits], found[fits]
    # Rows stand in the order of ties.
    best = np.argsort(-found, kind="stable")[:wanted]
    return open_[best], found[best]


def _block(table: pa.Table):
    """What a block of rows brings along, in the order of ties."""
    table = table.sort_by("tie")
    return (
        _matrix(table.column("x")),
        _words(table.column("code")),
        *(_array(table, name) for name in ("length", "aligned", "part", "id", "label", "tie")),
    )


_FAR = float(np.iinfo(np.int64).max)


def _positives(wanted: int):
    def search(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = {"anchor": [], "positive": [], "score": [], "tie": []}
        if rows.num_rows and anchors.num_rows:
            x, code, length, aligned, part, ids, label, tie = _block(rows)
            ax, alength = _matrix(anchors.column("a_x")), _array(anchors, "a_length")
            turned = planes(ax.astype(np.float64), 64 * code.shape[1])
            x, ax = _summable(x, ax)
            for k, (row, a_id, a_label) in enumerate(zip(*(_array(anchors, c) for c in ("a_row", "a_id", "a_label")))):
                near = [bound * length * alength[k] for bound in intervals(code, aligned, part, [t[k] for t in turned])]
                at, score = scored(x, ax[k], near, (label == a_label) & (ids != a_id), (-_FAR, _FAR), wanted)
                out["anchor"].append(np.repeat(row, len(at)))
                for name, values in (("positive", ids[at]), ("score", score), ("tie", tie[at])):
                    out[name].append(values)
        return _table(out, {"anchor": pa.string(), "positive": pa.int64(), "score": pa.int64(), "tie": pa.string()})

    return search


def _table(out: dict[str, list], types: dict[str, pa.DataType]) -> pa.Table:
    return pa.table({n: pa.array(np.concatenate(out[n]).tolist() if out[n] else [], t) for n, t in types.items()})


def _negatives(wanted: int, low: int, high: int):
    def search(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        names = {"anchor": pa.string(), "place": pa.int32(), "negative": pa.int64(), "score": pa.int64(), "tie": pa.string()}
        out = {n: [] for n in names}
        if rows.num_rows and anchors.num_rows:
            x, code, length, aligned, part, ids, label, tie = _block(rows)
            ax, alength = _matrix(anchors.column("a_x")), _array(anchors, "a_length")
            turned = planes(ax.astype(np.float64), 64 * code.shape[1])
            x, ax = _summable(x, ax)
            columns = [_array(anchors, c) for c in ("a_row", "a_id", "a_label")]
            for k, (row, a_id, a_label, scores) in enumerate(zip(*columns, anchors.column("a_scores").to_pylist())):
                near = [bound * length * alength[k] for bound in intervals(code, aligned, part, [t[k] for t in turned])]
                others = (label != a_label) & (ids != a_id)
                for place, score in enumerate(scores):
                    if score < 0:
                        continue
                    band = (-(-low * score // 100), high * score // 100)
                    at, found = scored(x, ax[k], near, others, band, wanted)
                    out["anchor"].append(np.repeat(row, len(at)))
                    out["place"].append(np.repeat(place, len(at)))
                    for name, values in (("negative", ids[at]), ("score", found), ("tie", tie[at])):
                        out[name].append(values)
        return _table(out, names)

    return search


def _coded(spread: int):
    def code(batches):
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes):
                part_of = batch.filter(pa.array(sizes == size))
                x = _matrix(pa.chunked_array([part_of.column("x")]))
                words, length, aligned, part = encode(x.astype(np.float64), spread)
                added = [pa.array([w.tobytes() for w in words], pa.binary()), pa.array(length), pa.array(aligned), pa.array(part)]
                yield pa.RecordBatch.from_arrays([*part_of.columns, *added], names=[*batch.schema.names, "code", "length", "aligned", "part"])

    return code


def mine_negatives(
    vectors: DataFrame,
    anchors: Column | None = None,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    spread: int = 4,
    block_rows: int = 8192,
    block_anchors: int = 2048,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``anchors`` is a condition over the input's columns (default: the id is divisible by 100).  A negative's score lies between
    ``low`` and ``high`` per cent of its positive's.
    """
    anchors = F.col(f"`{id_col}`") % 100 == 0 if anchors is None else anchors
    rows, inner = shielded(vectors.withColumn("__is_anchor", F.coalesce(anchors, F.lit(False))))
    vector, real = F.col(inner[vector_col]), F.col(inner[vector_col]).cast("array<double>")
    ok = F.forall(real, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))) & (F.size(vector) > 0)
    whole = F.transform(real, lambda v: F.greatest(F.least(F.floor(v * scale), F.lit(LARGEST)), F.lit(-LARGEST)).cast("long"))
    rows = rows.filter(F.col(inner[id_col]).isNotNull() & F.col(inner[label_col]).isNotNull() & ok).select(
        F.col(inner[id_col]).cast("long").alias("id"),
        F.col(inner[label_col]).cast("string").alias("label"),
        F.size(vector).alias("size"),
        whole.alias("x"),
        F.col(inner["__is_anchor"]).alias("is_anchor"),
    )
    # Rows equal in id, label and vector are one; the tie key orders by id, then label, then vector.
    number = F.lpad((F.col("id").cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")).cast("string"), 20, "0")
    tie = F.concat_ws("|", number, F.col("label"), F.md5(F.array_join(F.col("x").cast("array<string>"), ",")))
    rows = rows.withColumn("tie", tie).groupBy("tie").agg(
        *(F.first(c).alias(c) for c in ("id", "label", "size", "x")), F.max("is_anchor").alias("is_anchor")
    )
    schema = "tie string, id long, label string, size int, x array<long>, is_anchor boolean, code binary, length double, aligned double, part double"
    rows = staged(rows.mapInArrow(_coded(spread), schema), "negatives-coded")

    counts = rows.groupBy("size").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_anchor").alias("n_anchors"))
    counts = counts.select(
        F.col("size").alias("k_size"),
        F.ceil(F.col("n") / block_rows).cast("int").alias("row_blocks"),
        F.ceil(F.col("n_anchors") / block_anchors).cast("int").alias("anchor_blocks"),
    ).filter("anchor_blocks > 0")
    counts = staged(counts, "negatives-blocks")
    hashed = F.xxhash64("tie")
    dealt = rows.join(counts, F.col("size") == F.col("k_size"))
    blocks = dealt.select(
        "size", F.pmod(hashed, "row_blocks").cast("int").alias("row_block"),
        F.explode(F.sequence(F.lit(0), F.col("anchor_blocks") - 1)).alias("anchor_block"),
        "id", "label", "tie", "x", "code", "length", "aligned", "part",
    )
    queries = dealt.filter("is_anchor").select(
        F.col("size").alias("a_size"), F.pmod(hashed, "anchor_blocks").cast("int").alias("a_block"), "row_blocks",
        F.col("tie").alias("a_row"), F.col("id").alias("a_id"), F.col("label").alias("a_label"), F.col("x").alias("a_x"), F.col("length").alias("a_length"),
    )

    def meet(asked: DataFrame, search, schema: str) -> DataFrame:
        asked = asked.withColumn("a_row_block", F.explode(F.sequence(F.lit(0), F.col("row_blocks") - 1))).drop("row_blocks")
        left = blocks.groupBy("size", "row_block", "anchor_block")
        return left.cogroup(asked.groupBy("a_size", "a_row_block", "a_block")).applyInArrow(search, schema)

    def first(found: DataFrame, keys: list[str], wanted: int) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), "tie")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= wanted)

    found = meet(queries, _positives(positives), "anchor string, positive long, score long, tie string")
    found = first(found, ["anchor"], positives).groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "positive", "score"))).alias("list"))
    found = staged(found, "negatives-positives")
    asked = queries.join(found.select("anchor", F.col("list.score").alias("a_scores")), F.col("a_row") == F.col("anchor")).drop("anchor")
    hard = meet(asked, _negatives(negatives, low, high), "anchor string, place int, negative long, score long, tie string")
    hard = first(hard, ["anchor", "place"], negatives).withColumnRenamed("anchor", "n_anchor")
    out = hard.join(found, F.col("n_anchor") == F.col("anchor")).withColumn("positive", F.get("list", "place"))
    anchor_id = (F.substring("anchor", 1, 20).cast("decimal(20,0)") - F.lit(str(1 << 63)).cast("decimal(20,0)")).cast("long")
    return out.select(
        anchor_id.alias("anchor_id"), F.col("positive.positive").alias("positive_id"), "rank",
        F.col("negative").alias("negative_id"), F.col("positive.score").alias("positive_score"), F.col("score").alias("negative_score"),
    )
