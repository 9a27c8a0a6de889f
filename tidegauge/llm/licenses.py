"""Licences that texts name: notice phrases and identifier tags, with the expressions behind the tags.

A text is cut into words (runs of ASCII letters and digits and of all characters beyond ASCII, A-Z lower-cased) and becomes one line
with a blank before, between and after them.  One Aho-Corasick automaton over such lines finds all phrases and tags,
overlapping ones too; a place is the number of its first word.  Behind a tag stands an expression, up to the end of the line: names, joined by
``or``, ``and`` and ``with`` in rising strength, and parentheses.  A shunting-yard parser turns it into postfix and evaluates it:

* the labels it names, those of exceptions as ``licence with exception``;
* its restriction from 0 (public domain) to 1 (all rights reserved): the licensee may choose between alternatives, so
  ``or`` takes the lesser of its sides; ``and`` takes the greater; an exception lowers a copyleft licence to that of a library.

A tag counts where ``:`` or ``=`` follows it.  A line that is no expression (unbalanced, an operator without a side, nothing at
all, prose) is not valid: those names in it that the table of restrictions lists are labels all the same and hold together
like ``and``.  The score of a text is the greatest restriction that it states, notices and expressions
together; 0 if it states none.  Labels that the table of restrictions does not list count as ``UNLISTED``.

Defined results: null and empty texts have no words, places or labels, and score 0; texts of any length are scanned whole, and a
line behind a tag is parsed whole, without recursion; repeated rows and rows without an id are rows like others; an empty table
gives an empty result.  Input columns may have any names; an added column replaces one of the same name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.shared import shielded, unshielded

#: Phrases that every scan reports, and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Further phrases.
PHRASES = {
    "gnu general public license version 2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0",
    "gnu lesser general public license": "lgpl",
    "gnu library general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "gnu free documentation license": "gfdl",
    "apache license version 2 0": "apache-2.0",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "european union public licence": "eupl",
    "bsd license": "bsd",
    "bsd 2 clause license": "bsd-2-clause",
    "bsd 3 clause license": "bsd-3-clause",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "isc license": "isc",
    "boost software license": "bsl-1.0",
    "the unlicense": "unlicense",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "cc0 1 0": "cc0-1.0",
    "cc by 4 0": "cc-by-4.0",
    "cc by sa": "cc-by-sa",
    "cc by sa 4 0": "cc-by-sa-4.0",
    "cc by nd": "cc-by-nd",
    "cc by nc": "cc-by-nc",
    "cc by nc 4 0": "cc-by-nc-4.0",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "dedicated to the public domain": "public-domain",
    "released into the public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
    "proprietary and confidential": "proprietary",
}
#: Words of tags with an expression behind them.
TAGS = ("spdx license identifier", "license expression", "licence expression")

#: Restriction of a licence by the longest start of its label that ends with the label or at a hyphen.
RESTRICTION = {
    "public-domain": 0.0, "cc0": 0.0, "unlicense": 0.0, "0bsd": 0.0,
    "mit": 0.1, "isc": 0.1, "bsd": 0.1, "bsl": 0.1, "zlib": 0.1, "apache": 0.1, "cc-by": 0.2,
    "mpl": 0.4, "epl": 0.4, "lgpl": 0.4, "eupl": 0.4, "cc-by-sa": 0.5,
    "gpl": 0.6, "gfdl": 0.6, "agpl": 0.7,
    "cc-by-nd": 0.8, "cc-by-nc": 0.8, "cc-by-nc-sa": 0.8, "cc-by-nc-nd": 0.9,
    "proprietary": 1.0, "all-rights-reserved": 1.0,
}
UNLISTED = 0.9
#: What a copyleft licence with an exception comes to.
WITH_EXCEPTION = 0.4

#: Bytes to words: A-Z lower-cased, digits, a-z and bytes beyond ASCII kept, all others blank.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_BINDS = {"or": 1, "and": 2, "with": 3}
_TOKEN = re.compile(r"[()]|[0-9a-z][0-9a-z.+:_-]*")


def listed(label: str) -> str | None:
    """The entry of the table of restrictions that a label falls under."""
    start = label.partition(" ")[0].rstrip("+")
    while start not in RESTRICTION:
        start, hyphen, _ = start.rpartition("-")
        if not hyphen:
            return None
    return start


def restriction(label: str) -> float:
    return RESTRICTION.get(listed(label), UNLISTED)


def postfix(tokens: list[str]) -> list[str] | None:
    """Shunting-yard: names and operators in the order of evaluation; None where the tokens are no expression."""
    out, waiting, operand_next = [], [], True
    for token in tokens:
        if token in _BINDS or token == ")":
            if operand_next:
                return None
            while waiting and waiting[-1] != "(" and (token == ")" or _BINDS[waiting[-1]] >= _BINDS[token]):
                out.append(waiting.pop())
            if token == ")":
                if not waiting:
                    return None
                waiting.pop()
            else:
                waiting.append(token)
                operand_next = True
        elif not operand_next:
            return None
        elif token == "(":
            waiting.append(token)
        else:
            out.append(token)
            operand_next = False
    if operand_next or "(" in waiting:
        return None
    return out + waiting[::-1]


def evaluate(line: str) -> tuple[str, bool, list[str], float]:
    """The expression with one blank between its tokens, whether it is valid, its labels, and its restriction."""
    tokens = [t.rstrip(".:") for t in _TOKEN.findall(line)]
    steps, labels, values = postfix(tokens), [], []
    if steps is not None:
        for step in steps:
            if step not in _BINDS:
                values.append((step, restriction(step)))
                continue
            (right, over), (left, value) = values.pop(), values.pop()
            if step == "with":
                # Both sides are names: an operand of several names has none.
                if not left or not right or " " in left:
                    steps = None
                    break
                values.append((f"{left} with {right}", min(value, WITH_EXCEPTION) if 0.4 < value < 0.8 else value))
                continue
            labels += [name for name in (left, right) if name]
            values.append(("", min(value, over) if step == "or" else max(value, over)))
    if steps is not None:
        name, value = values[0]
        return " ".join(tokens), True, sorted({*labels, *([name] if name else [])}), value
    names = sorted({t for t in tokens if t not in _BINDS and t not in "()" and listed(t)})
    return " ".join(tokens), False, names, max(map(restriction, names), default=0.0)


def automaton(phrases: dict[str, str], tags: tuple[str, ...]) -> ahocorasick.Automaton:
    """Phrases and tags with a blank on both sides; each gives its label (none for a tag), itself and its number of words."""
    found = ahocorasick.Automaton()
    for phrase in {**phrases, **dict.fromkeys(tags)}:
        found.add_word(f" {phrase} ", (phrases.get(phrase), phrase, phrase.count(" ") + 1, phrase in tags))
    if len(found):
        found.make_automaton()
    return found


_ASSIGNED = re.compile(r"[\s'\"]*[:=][\s'\":=]*")
_STOP = re.compile(r"\*/|-->|[\"'<>;,]")


def _line_behind(raw: bytes, words: Iterator[re.Match], skip: int) -> str | None:
    """What is assigned to the word ``skip`` places further on: up to the end of the line, of a comment or a quotation."""
    end = next(islice(words, skip, None)).end()
    stop = raw.find(b"\n", end)
    line = raw[end : stop if stop >= 0 else len(raw)].decode("latin-1").lower()
    assigned = _ASSIGNED.match(line)
    return _STOP.split(line[assigned.end() :], maxsplit=1)[0] if assigned else None


def scan(text: str | None, found: ahocorasick.Automaton) -> tuple[int, list[tuple], list[tuple]]:
    """Words of a text, places as (label, phrase, word), and expressions as (word, expression, valid, labels, restriction)."""
    raw = (text or "").encode("utf-8", "surrogatepass").translate(_TABLE)
    words = raw.split()
    places, expressions = [], []
    if not words or not len(found):
        return len(words), places, expressions
    line = (b" " + b" ".join(words) + b" ").decode("latin-1")
    count, seen, tagged = 0, 0, []
    for end, (label, phrase, n, is_tag) in found.iter(line):
        # Ends rise; the blank at the end closes word ``count - 1``.
        count += line.count(" ", seen, end + 1)
        seen = end + 1
        start = count - 1 - n
        if label is not None:
            places.append((label, phrase, start))
        if is_tag:
            tagged.append(start + n - 1)
    if tagged:
        lowered = text.encode("utf-8", "surrogatepass").lower()
        matches, passed = _WORD.finditer(lowered), 0
        for last in sorted(set(tagged)):
            expression = _line_behind(lowered, matches, last - passed)
            passed = last + 1
            if expression is not None:
                expressions.append((last, *evaluate(expression)))
    return len(words), sorted(places, key=lambda p: (p[2], p[1])), expressions


_PLACE = pa.struct([("label", pa.string()), ("phrase", pa.string()), ("word", pa.int64())])
_EXPRESSION = pa.struct(
    [("word", pa.int64()), ("expression", pa.string()), ("valid", pa.bool_()), ("labels", pa.list_(pa.string())), ("restriction", pa.float64())]
)


def _scan_batches(phrases: dict[str, str], tags: tuple[str, ...]):
    def scan_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = automaton(phrases, tags)
        for batch in batches:
            counts, places, expressions, labels, scores = [], [], [], [], []
            for text in batch.column("the_text").to_pylist():
                n, at, stated = scan(text, found)
                named = {p[0] for p in at} | {label for e in stated for label in e[3]}
                counts.append(n)
                places.append([dict(zip(("label", "phrase", "word"), p)) for p in at])
                expressions.append([dict(zip(("word", "expression", "valid", "labels", "restriction"), e)) for e in stated])
                labels.append(sorted(named))
                scores.append(max([restriction(p[0]) for p in at] + [e[4] for e in stated], default=0.0))
            added = [
                pa.array(counts, pa.int64()), pa.array(places, pa.list_(_PLACE)), pa.array(expressions, pa.list_(_EXPRESSION)),
                pa.array(labels, pa.list_(pa.string())), pa.array(scores, pa.float64()),
            ]
            kept = batch.drop_columns(["the_text"])
            yield pa.RecordBatch.from_arrays([*kept.columns, *added], names=[*kept.schema.names, *ADDED])

    return scan_all


ADDED = ["n_words", "places", "expressions", "labels", "score"]


def scan_licenses(
    documents: DataFrame,
    *,
    text_col: str = "text",
    phrases: dict[str, str] | None = None,
    tags: tuple[str, ...] = TAGS,
    carry: tuple[str, ...] | None = None,
) -> DataFrame:
    """The input's columns (or those of ``carry``) with ``n_words``, ``places``, ``expressions``, ``labels`` and ``score``.

    ``places`` are ``label, phrase, word`` of each phrase found; ``expressions`` are ``word, expression, valid, labels,
    restriction`` behind each tag, whose last word has the number ``word``; ``labels`` are those of both.
    """
    phrases = {**BASE_PHRASES, **PHRASES} if phrases is None else phrases
    rows, inner = shielded(documents)
    carried = {name: inner[name] for name in (documents.columns if carry is None else carry)}
    rows = rows.select(*carried.values(), F.col(inner[text_col]).cast("string").alias("the_text"))
    given = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in rows.schema if f.name != "the_text")
    schema = (
        f"{given}n_words long, places array<struct<label: string, phrase: string, word: long>>, "
        "expressions array<struct<word: long, expression: string, valid: boolean, labels: array<string>, restriction: double>>, "
        "labels array<string>, score double"
    )
    return rows.mapInArrow(_scan_batches(phrases, tags), schema).select(*unshielded(carried, ADDED), *ADDED)
