"""Periodic runs against an extension of every period at every place."""

from __future__ import annotations

import hashlib
import random
import zlib

import pyarrow as pa
import pytest
from brute_runs import WORD, collapsed, runs

from tidegauge.llm.queries import op13_runs
from tidegauge.llm.runs import _of_texts, periodic_runs


def drawn(seed: int, n: int) -> list[str]:
    draw = random.Random(seed)
    texts = []
    for _ in range(n):
        words = [f"w{draw.randrange(draw.choice([1, 2, 3, 20]))}" for _ in range(draw.randint(0, 80))]
        for _ in range(draw.randint(0, 3)):
            if words:
                at, period = draw.randrange(len(words)), draw.randint(1, 9)
                words[at:at] = (words[at : at + period] * draw.randint(2, 12))[draw.randint(0, 3) :]
        texts.append(draw.choice([" ", "\n", " \t"]).join(words))
    return texts


@pytest.mark.parametrize("least", [1, 2, 5, 7, 12, 30])
def test_runs_of_drawn_texts(least):
    texts = drawn(least, 400)
    counts, found, left = (x.to_pylist() for x in _of_texts(pa.array(texts), least))
    for text, n, got, rest in zip(texts, counts, found, left):
        words = WORD.findall(text)
        want = runs(words, least)
        assert (n, [tuple(r.values()) for r in got], rest) == (len(words), want, collapsed(words, want))


@pytest.mark.parametrize("kind", ["one word", "two words", "fibonacci", "boilerplate"])
def test_long_texts_take_no_square_time(kind):
    draw, n = random.Random(3), 60_000
    if kind == "one word":
        words = ["a"] * n
    elif kind == "two words":
        words = draw.choices("ab", k=n)
    elif kind == "fibonacci":
        words, longer = ["a"], ["a", "b"]
        while len(longer) < n:
            words, longer = longer, longer + words
        words = longer[:n]
    else:
        words = [w for i in range(n // 8) for w in (f"x{i}", "one", "same", "line", "of", "seven", "words", "here")]
    _, found, left = _of_texts(pa.array([" ".join(words)]), 12)
    got = [tuple(r.values()) for r in found[0].as_py()]
    assert {"one word": 1, "boilerplate": 0}.get(kind, len(got)) == len(got)
    for start, length, period in draw.sample(got, min(200, len(got))):
        inside = words[start : start + length]
        assert inside[period:] == inside[:-period] and length >= max(12, 2 * period)
        assert not start or words[start - 1] != words[start - 1 + period]
        assert start + length == n or words[start + length] != words[start + length - period]
    assert left[0].as_py() == collapsed(words, got)


def test_messy(messy, nothing):
    rows = periodic_runs(messy, batch_words=100).collect()
    assert len(rows) == messy.count() and {"size", "kept", "n words", "in_0"} <= set(rows[0].asDict())
    for row in rows:
        words = WORD.findall(row.text or "")
        want = runs(words) if len(words) < 2000 or row.doc_id == 13 else [tuple(r) for r in row.runs]
        assert row.n_words == len(words) and [tuple(r) for r in row.runs] == want and row.collapsed == collapsed(words, want)
    assert [tuple(r) for r in next(r.runs for r in rows if r.doc_id == 13)] == [(0, 900, 1)]
    assert periodic_runs(nothing).collect() == []
    clash = messy.withColumnRenamed("kept", "runs").withColumnRenamed("digest", "collapsed")
    assert [f.dataType.simpleString() for f in periodic_runs(clash).schema if f.name == "runs"] == ["array<struct<start:bigint,length:bigint,period:bigint>>"]


def test_registered_query(spark, sf_dir, real):
    got = {r.doc_id: r for r in op13_runs(spark, sf_dir).collect()}
    changed = 0
    for doc in real.collect():
        words = WORD.findall(doc.text or "")
        h = zlib.crc32(str(doc.doc_id).encode())
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
            changed += 1
        row = got[doc.doc_id]
        want = runs(words) if len(words) < 1500 else None
        if want is None:
            continue
        best = min(want, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        assert (row.n_runs, row.start, row.length, row.period) == (len(want), *best)
        assert row.exponent_milli == (None if best[1] is None else 1000 * best[1] // best[2])
        assert row.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in want).encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(collapsed(words, want).encode()).hexdigest()
    assert len(got) == real.count() and changed > 5
