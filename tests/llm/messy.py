"""Awkward documents."""

from __future__ import annotations

import random

_draw = random.Random(5)
VOCABULARY = ["".join(_draw.choices("aeioubcdfglmnrst", k=_draw.randint(2, 8))) for _ in range(400)]


def prose(n: int, seed: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choices(VOCABULARY, k=n))


def edited(text: str, share: float, seed: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(VOCABULARY) if draw.random() < share else w for w in text.split(" "))


_BASE = prose(160, 1)
#: doc_id, text, lang, source
DOCUMENTS = [
    (1, _BASE, "en", "a"),
    (2, edited(_BASE, 0.04, 2), "en", "a"),
    (3, edited(_BASE, 0.04, 3), "en", None),
    (4, edited(_BASE, 0.3, 4), None, "b"),
    (5, prose(90, 5).upper() + "\u00c9\u00e8 \U0001f600\n\n" + _BASE[:300], "en", "b"),
    (6, None, "en", "b"),
    (7, "", "fr", "c"),
    (8, " \t\n\x0b\x0c\r ", "fr", None),
    (9, "word", "fr", "c"),
    (10, "word", "fr", "c"),
    (11, "12 34 !!", "de", "c"),
    (12, prose(30_000, 12), "de", "b"),
    (12, prose(30_000, 12), "de", "b"),
    (13, "ab " * 900, None, "d"),
    (14, "\u65e5\u672c\u8a9e " * 120 + "\n# $ % & | < > *\n# $ % & | < > *", "ja", "d"),
    (None, _BASE, "en", "a"),
    (None, None, None, None),
    (15, "line one\nline one\n\n  \nline two\nline one", "en", ""),
    (16, prose(60, 16), "en", "a"),
    (16, prose(60, 17), "en", "a"),
]


def documents(spark, rows):
    """Rows with further columns that operators use as names of their own."""
    extra = "size long, target string, kept string, class int, text_a string, `digest` string, in_0 string, shard int, bucket int, `n words` int, host string"
    wide = [(*r, len(r[1] or ""), 1, "x", "y", 2, "z", "d", "i", 3, 4, 5, "h") for r in rows]
    return spark.createDataFrame(wide, f"doc_id long, text string, lang string, source string, n_chars int, {extra}")
