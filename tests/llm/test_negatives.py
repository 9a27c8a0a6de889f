"""Hard negatives against an exact search, and the intervals of one-bit codes against the products that they bound."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import compare
from tidegauge.llm import negatives
from tidegauge.llm.queries import ORACLE_SQL, QUERIES


def brute(rows, positives=5, wanted=10, low=30, high=90):
    """``rows`` are id, label, vector; all of them real, none equal in all three."""
    scaled = [(i, str(label), [min(max(math.floor(256 * x), -negatives.LARGEST), negatives.LARGEST) for x in v]) for i, label, v in rows]
    out = []
    for i, label, v in scaled:
        if i % 100:
            continue
        scores = [(-sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in scaled if j != i and len(w) == len(v)]
        for score, j, _ in sorted(s for s in scores if s[2] == label)[:positives]:
            hard = sorted(s for s in scores if s[2] != label and low * -score <= 100 * -s[0] <= high * -score)
            out += [(i, j, rank, k, -score, -s) for rank, (s, k, _) in enumerate(hard[:wanted], 1)]
    return sorted(out)


def drawn(n, size, seed):
    """Clusters across labels, a third of all rows copies of one vector, ties."""
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(12, size))
    rows = []
    for i in range(n):
        vector = centres[i % 12] * draw.choice([0.5, 1.0]) + draw.normal(size=size) * draw.choice([0.0, 0.3])
        rows.append((i, int(draw.integers(0, 4)), [0.5] * size if i % 3 == 0 else vector.astype(np.float32).tolist()))
    return rows


def mined(spark, rows, **options):
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    return sorted(tuple(r) for r in negatives.mine_negatives(frame, **options).collect())


@pytest.mark.parametrize("size,options", [(16, {}), (3, {"block_rows": 100, "block_anchors": 2}), (40, {"block_rows": 64, "block_anchors": 3, "spread": 1})])
def test_against_exact_search(spark, size, options):
    rows = drawn(700, size, size)
    got = mined(spark, rows, **options)
    assert got == brute(rows) and len(got) > 50


@pytest.mark.parametrize("size", [1, 3, 17, 64, 200])
def test_intervals_hold_the_cosine(size):
    draw = np.random.default_rng(size)
    x = draw.normal(size=(300, size))
    x[:50] = x[0] + draw.normal(size=(50, size)) * 0.01
    x[50] = 0
    code, length, aligned, part = negatives.encode(x, 4)
    turned = negatives.planes(x[:20], 64 * code.shape[1])
    for k in range(20):
        about, low, high = negatives.intervals(code, aligned, part, [t[k] for t in turned])
        true = x @ x[k] / np.where(length > 0, length, 1) / length[k]
        assert (low <= true).all() and (true <= high).all()
        assert (about <= high).all() and (low <= about).all()
    # A filter that never shuts would hold them too.
    assert size < 17 or np.median(high - low) < 1.0


def test_filter_scores_fewer_rows(monkeypatch):
    draw, scored = np.random.default_rng(2), []
    x = np.floor(256 * (draw.normal(size=(20, 64))[draw.integers(0, 20, 4000)] + draw.normal(size=(4000, 64)) * 0.4))
    code, length, aligned, part = negatives.encode(x, 4)
    exact = negatives._exact
    monkeypatch.setattr(negatives, "_exact", lambda x, rows, a: scored.append(len(rows)) or exact(x, rows, a))
    turned = negatives.planes(x[:1], 64 * code.shape[1])
    near = [b * length * length[0] for b in negatives.intervals(code, aligned, part, [t[0] for t in turned])]
    at, score = negatives.scored(x, x[0], near, np.arange(4000) > 0, (-1e18, 1e18), 5)
    assert score.tolist() == sorted((x[1:] @ x[0]).astype(int).tolist(), reverse=True)[:5] and sum(scored) < 1000


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, i % 2, [1.0, i / 1000, 0.25]) for i in range(0, 60)]
    bad = [(100, None, [1.0, 1.0, 1.0]), (200, 1, None), (300, 1, [1.0, None, 1.0]), (400, 0, [nan, 1.0, 1.0]), (500, 0, [1.0, inf, 1.0]), (600, 1, []), (None, 1, [1.0, 1.0, 1.0])]
    other = [(700, 1, [1.0, 1.0]), (800, 1, [0.0, 0.0, 0.0]), (900, 0, [3e38, -3e38, 1.0])]
    rows = good + other
    assert mined(spark, rows + bad + good[:7]) == brute(rows)
    assert mined(spark, bad) == [] and mined(spark, []) == []
    # Rows of one id that differ are rows; none of them is another's partner.
    twice = mined(spark, [*rows, (0, 0, [1.0, 0.9, 0.0])])
    assert {r[0] for r in twice} == {r[0] for r in brute(rows)} and all(r[0] not in (r[1], r[3]) for r in twice)


def test_names_and_anchors(spark):
    rows = drawn(200, 8, 1)
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    clash = frame.withColumns({c: F.lit(1) for c in ("id", "x", "tie", "n", "size", "rank", "a_x", "in_0", "code")}).withColumnRenamed("label", "is_anchor")
    got = negatives.mine_negatives(clash, F.col("vec_id").isin(3, 4), label_col="is_anchor", positives=2, negatives=3, low=10, high=100)
    assert {r.anchor_id for r in got.collect()} == {3, 4} and max(r["rank"] for r in got.collect()) == 3


def test_registered_query(spark, sf_dir):
    assert compare(spark, sf_dir, QUERIES["op11_hard_negatives"], ORACLE_SQL["op11_hard_negatives"]) is None
