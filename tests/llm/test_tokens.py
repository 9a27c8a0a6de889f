"""Token ids against the tokenizer on whole texts."""

from __future__ import annotations

import random
import sys

import numpy as np
import pyarrow as pa
import pytest

from tidegauge.llm.packing import WordTokens, _in_pieces

public_tokenizers = pytest.importorskip("public_tokenizers")

#: Letters that normalise to marks, marks, letters of many scripts, white space of all kinds, special tokens.
SIGNS = list("abcXYZ'’.!?|<>-012 \n\t\r\x0b\x0c\x1c\x85 　̸̇́İıßŉǰΣςéÉñ日本ـ٣½²ªǅ\U0001f600ﬁͅµ​­АЯẞÅʼ")
SIGNS += ["'s", "'ll", "<|endoftext|>", "<|ENDOFTEXT|>", "İ!", "word", "Word,", "café."]


@pytest.fixture(scope="module")
def path():
    return public_tokenizers.path("word_bpe_49k.json")


def whole(path, texts):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [np.asarray(f.ids, "<u4").tobytes() for f in found]


@pytest.mark.parametrize("remembered", [0, 2_000, 6_000_000])
def test_ids_of_drawn_texts(path, remembered):
    draw, tokens = random.Random(remembered), WordTokens(path, remembered=remembered)
    for _ in range(20):
        texts = ["".join(draw.choices(SIGNS, k=draw.choice([1, 2, 3, 5, 12, 60]))) for _ in range(100)] + [None, "", " "]
        assert [bytes(ids) for ids in tokens(pa.array(texts))] == whole(path, texts)


def test_slices_and_nulls(path):
    texts = pa.array([None, "Skip this", "Été <|x", None, "", "Last One!"]).slice(2, 4)
    assert [bytes(ids) for ids in WordTokens(path)(texts)] == whole(path, texts.to_pylist())
    assert [bytes(i) for i in WordTokens(path)(pa.array([None, None], pa.string()))] == [b"", b""]


def test_what_is_remembered_is_bounded_by_bytes(path):
    draw, tokens = random.Random(1), WordTokens(path, remembered=50_000)
    for n in range(40):
        texts = ["".join(draw.choices("abcdef", k=20_000)) for _ in range(3)] + [" ".join("".join(draw.choices("abcdef", k=8)) for _ in range(2_000))]
        tokens(pa.array(texts))
        held = [*tokens.known.items(), *tokens.before.items()]
        assert sum(len(w) + len(i) for w, i in held) <= 2 * (50_000 + 2_000 * 40) and max(len(w) for w, _ in held) <= tokens.SHORT
        assert sum(sys.getsizeof(w) + sys.getsizeof(i) for w, i in held) < 3_000_000


def test_pieces_of_a_batch():
    draw = random.Random(2)
    texts = [None if draw.random() < 0.2 else "x" * draw.choice([0, 1, 5, 500]) for _ in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(300)), pa.array(texts)], names=["doc_id", "text"])
    for part in (batch, batch.slice(17, 200), batch.slice(0, 0)):
        cut = list(_in_pieces(part, most=600))
        assert [x for c in cut for x in c.column(0).to_pylist()] == part.column(0).to_pylist()
        assert all(c.num_rows for c in cut) and (not part.num_rows or len(cut) > 5)
