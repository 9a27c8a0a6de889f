"""Licence phrases against a search at every word, and expressions by hand."""

from __future__ import annotations

import re

import pytest

from tidegauge.llm.licenses import BASE_PHRASES, PHRASES, TAGS, automaton, evaluate, postfix, scan, scan_licenses
from tidegauge.llm.queries import op12_licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text: str | None, phrases: dict[str, str]) -> list[tuple[str, str, int]]:
    words = words_of(text)
    cut = {p: p.split(" ") for p in phrases}
    found = [(phrases[p], p, i) for i in range(len(words)) for p, ws in cut.items() if words[i : i + len(ws)] == ws]
    return sorted(found, key=lambda f: (f[2], f[1]))


@pytest.mark.parametrize(
    "line,valid,labels,value",
    [
        ("MIT", True, ["mit"], 0.1),
        ("MIT OR GPL-3.0-only", True, ["gpl-3.0-only", "mit"], 0.1),
        ("MIT and GPL-3.0-only", True, ["gpl-3.0-only", "mit"], 0.6),
        ("MIT OR Apache-2.0 AND CC-BY-NC-4.0", True, ["apache-2.0", "cc-by-nc-4.0", "mit"], 0.1),
        ("(MIT OR Apache-2.0) AND CC-BY-NC-4.0", True, ["apache-2.0", "cc-by-nc-4.0", "mit"], 0.8),
        ("GPL-2.0-or-later WITH Classpath-exception-2.0", True, ["gpl-2.0-or-later with classpath-exception-2.0"], 0.4),
        ("GPL-2.0+ with x AND MIT", True, ["gpl-2.0+ with x", "mit"], 0.4),
        ("LicenseRef-house", True, ["licenseref-house"], 0.9),
        ("(MIT OR) Apache-2.0", False, ["apache-2.0", "mit"], 0.1),
        ("((MIT)", False, ["mit"], 0.1),
        ("MIT)", False, ["mit"], 0.1),
        ("MIT Apache-2.0 and house", False, ["apache-2.0", "mit"], 0.1),
        ("(MIT OR ISC) WITH x", False, ["isc", "mit"], 0.1),
        ("a with b with c", False, [], 0.0),
        ("is what this line has", False, [], 0.0),
        ("", False, [], 0.0),
        ("(" * 50_000 + "mit" + ")" * 50_000, True, ["mit"], 0.1),
    ],
)
def test_expressions(line, valid, labels, value):
    _, ok, named, score = evaluate(line.lower())
    assert (ok, named, score) == (valid, labels, value)


def test_postfix():
    assert postfix("a or b and c with d".split()) == ["a", "b", "c", "d", "with", "and", "or"]
    assert postfix("( a or b ) and c".split()) == ["a", "b", "or", "c", "and"]
    assert postfix("a and b and c".split()) == ["a", "b", "and", "c", "and"]


def test_tags():
    found = automaton({**BASE_PHRASES, **PHRASES}, TAGS)
    text = "\u00e9 x\n/* SPDX-License-Identifier: (MIT OR GPL-2.0) */ MIT License\n# spdx-license-identifier: Apache-2.0 AND\n<License-Expression>: \"BSD-3-Clause\", 'x'\nthe license expression of it"
    n, places, expressions = scan(text, found)
    assert n == len(words_of(text)) and places == brute(text, {**BASE_PHRASES, **PHRASES})
    assert [(e[1], e[2], e[3]) for e in expressions] == [("( mit or gpl-2.0 )", True, ["gpl-2.0", "mit"]), ("apache-2.0 and", False, ["apache-2.0"])]
    assert [words_of(text)[e[0]] for e in expressions] == ["identifier"] * 2
    assert scan('"license expression": "BSD-3-Clause"', found)[2][0][3] == ["bsd-3-clause"]


def test_overlaps_and_places(spark):
    # Phrases that start, end and lie within each other; words of one letter more do not match.
    phrases = {"a b": "ab", "b a": "ba", "a b a": "aba", "a": "a", "cc by": "cc-by"}
    texts = ["a b a b a", "A,B;a\x00b", "aa b a", "cc by cc\u00a0by cc\u2003 by CC--BY", "\u00c0 b \u00e0", None, "", "a " * 5000]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for row in scan_licenses(frame, phrases=phrases, tags=()).collect():
        assert [tuple(p) for p in row.places] == brute(row.text, phrases) and row.n_words == len(words_of(row.text))


def test_messy(spark, messy, nothing):
    rows = scan_licenses(messy).collect()
    assert len(rows) == messy.count() and all(r.labels == [] and r.score == 0 and r.n_words == len(words_of(r.text)) for r in rows)
    assert scan_licenses(nothing).collect() == [] and scan_licenses(messy, phrases={}, tags=()).count() == len(rows)
    clash = messy.withColumnRenamed("kept", "labels").withColumnRenamed("size", "score")
    assert sorted(scan_licenses(clash).columns) == sorted({*clash.columns, "n_words", "places", "expressions", "labels", "score"})


def test_registered_query(spark, sf_dir, real):
    got = {r.doc_id: r for r in op12_licenses(spark, sf_dir).collect()}
    named = 0
    for doc in real.collect():
        row, places = got[doc.doc_id], brute(doc.text, BASE_PHRASES)
        starts = [p[2] for p in places]
        labels = {p[0] for p in places}
        assert (row.n_words, row.n_base, row.first_word, row.last_word) == (len(words_of(doc.text)), len(places), min(starts, default=None), max(starts, default=None))
        assert row.base_labels == ",".join(sorted(labels)) and labels <= set(row.labels.split(",")) | {""} and 0 <= row.score <= 1
        assert row.labels == ",".join(sorted({p[0] for p in brute(doc.text, {**BASE_PHRASES, **PHRASES})}))
        named += bool(row.labels)
    assert len(got) == real.count() and named
