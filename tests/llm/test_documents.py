"""Operators on documents against brute force, one document at a time."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from brute_quality import measures
from pyspark.sql import functions as F
from messy import DOCUMENTS, documents, edited, prose
from tokenizers import Tokenizer

from tidegauge.llm import language, minhash, mixing, packing, quality, repeats

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def size(text):
    return len(WORDS.findall(text or ""))


# Packing


def check_packed(rows, texts, capacity=4096):
    """Every id in one piece, sequences without gaps; returns padding and tokens."""
    tokenizer = Tokenizer.from_file(TOKENIZER)
    pieces = sorted(tuple(r) for r in rows)
    ids = [np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4") for _, t in texts]
    by_doc = defaultdict(list)
    for doc_id, start, length, crc, total in [p[:5] for p in pieces]:
        by_doc[doc_id, total].append((start, length, crc))
    want = defaultdict(list)
    for (doc_id, _), own in zip(texts, ids):
        at = 0
        for length in packing.piece_lengths(len(own), capacity, 2, 64):
            want[doc_id, len(own)].append((at, length, zlib.crc32(own[at : at + length].tobytes())))
            at += length
        assert at == len(own)
    assert {k: sorted(v) for k, v in by_doc.items()} == {k: sorted(v) for k, v in want.items()}
    filled = defaultdict(list)
    for p in pieces:
        filled[p[5]].append((p[6], p[2]))
    assert sorted(filled) == list(range(len(filled)))
    padding = 0
    for inside in filled.values():
        at = 0
        for offset, length in sorted(inside):
            assert offset == at
            at += length
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding, sum(map(len, ids))


def packed(frame):
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    pieces = packing.pack(packing.tokenized_pieces(frame, TOKENIZER), group_pieces=50)
    return [tuple(-1 if v is None else v for v in r) for r in pieces.select(*columns).collect()]


def test_packing_holds_every_id_once(messy, real, nothing):
    check_packed(packed(messy), [(-1 if r[0] is None else r[0], r[1]) for r in DOCUMENTS])
    padding, tokens = check_packed(packed(real), [tuple(r) for r in real.select("doc_id", "text").collect()])
    assert padding < 0.05 * tokens
    assert packed(nothing) == []


def test_harmonic_classes():
    for n in (1, 63, 64, 100, 4095, 4096, 4097, 9000, 100_000):
        lengths = packing.piece_lengths(n, 4096, 2, 64)
        assert sum(lengths) == n and max(lengths) <= 4096 and min(lengths) > 0


@pytest.mark.parametrize("text", ["A\u0301b \u0301x", "It's I'LL don't", "<|endoftext|>x<|endof text|>", "a\x1c\x85c \u03a3\u0391\u03a3", "\r\n\t  ", "\u65e5\u672c\uff11\uff12 \u0130I", "Stra\u00dfe, \u0130stanbul! don't. x's* (a) b\u0301. \u01c4 \ufb01", "a-b c_d e&f, 'll. 12. \u0f0b\u0e01\u0e33"])
def test_words_are_tokenized_as_whole_texts(text):
    tokens, want = packing.WordTokens(TOKENIZER, remembered=2), Tokenizer.from_file(TOKENIZER).encode(text, add_special_tokens=False).ids
    for texts in ([text], ["other Words, here.", text], [text, text]):
        assert np.frombuffer(tokens(texts)[-1], "<u4").tolist() == want


# Mixing


def targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    """Sharing out by weight, again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    want, capped, left = {}, set(), share * sum(sizes.values())
    while True:
        open_ = [s for s in order if s not in capped]
        level = left / sum(weight[s] for s in open_) if open_ else 0
        over = [s for s in open_ if weight[s] * level > cap * sizes[s]]
        if not over:
            return want | {s: weight[s] * level for s in open_}
        for s in over:
            capped.add(s)
            want[s] = cap * sizes[s]
            left -= want[s]


@pytest.mark.parametrize("shard_words", [1_000_000, 2_000])
def test_mix(messy, real, nothing, shard_words):
    for frame, key in ((messy, "messy"), (real, "real")):
        rows = mixing.mix(frame, shard_words=shard_words).collect()
        assert sorted((r.text or "", r["size"]) for r in rows) == sorted((r.text or "", size(r.text)) for r in frame.collect())
        total = Counter()
        for r in rows:
            total[r.source] += r["size"]
            assert 0 <= r.taken <= 2 * r["size"]
        want, got = targets(total), Counter()
        for r in rows:
            assert r.source_size == total[r.source] and r.target == pytest.approx(want[r.source])
            got[r.source] += r.taken
        for s in total:
            # Half a block per cell, and the blocks that cells smaller than half a block leave to others.
            assert abs(got[s] - want[s]) <= 64 * (len(total) + total[s] // shard_words + 1), (key, s)
    again = mixing.mix(real, shard_words=shard_words).collect()
    assert Counter((r.doc_id, r.taken) for r in again) == Counter((r.doc_id, r.taken) for r in rows)
    assert mixing.mix(nothing).collect() == []


def test_mix_of_rows_without_ids_does_not_hang_on_their_order(spark):
    # Targets: all of a twice, parts of b and c.
    rows = [(None if s == "b" else 7, prose(40, at + i), "en", s) for s, at, n in (("a", 1000, 200), ("b", 2000, 200), ("c", 3000, 100)) for i in range(n)]
    for shard_words in (1_000_000, 1_000):
        taken = [
            sorted((r.text, r.taken) for r in mixing.mix(documents(spark, given), shard_words=shard_words).collect())
            for given in (rows, rows[::-1])
        ]
        assert taken[0] == taken[1] and len({t for _, t in taken[0]}) > 1


def test_quotas_are_sainte_lague(spark):
    import random

    draw = random.Random(3)
    for n in (1, 2, 7, 40):
        votes = [draw.choice([1, 10, 1000, 50_000]) * draw.random() for _ in range(n)]
        cells = spark.createDataFrame([(f"s{i:02}", 0, 10**9, v) for i, v in enumerate(votes)], "source string, shard long, cell_size long, votes double")
        got = {r.source: r.seats for r in mixing.quotas(cells, 64).collect()}
        seats = int(sum(votes) / 64 + 0.5)
        heap = [(v / (2 * k + 1), -i) for i, v in enumerate(votes) for k in range(seats)]
        want = Counter(-i for _, i in sorted(heap, reverse=True)[:seats])
        assert sum(got.values()) == seats
        assert got == {f"s{i:02}": want[i] for i in range(n)}


def test_mixed_documents_hold_the_words_taken(messy):
    mixed = mixing.mix(messy).cache()
    rows = mixing.mixed_documents(mixed, messy.columns)
    assert rows.columns == messy.columns
    taken = Counter()
    for r in mixed.collect():
        taken[r.doc_id] += r.taken
    got = Counter()
    for r in rows.collect():
        got[r.doc_id] += size(r.text)
        assert r.n_chars == len(r.text)
    assert got == +taken


# Quality


def test_quality(messy, real, nothing):
    for frame in (messy, real):
        rows = quality.judge(frame).collect()
        assert len(rows) == frame.count()
        for r in rows:
            m = measures(r.text)
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == m
            assert r.base_failed == (m[0] < 50 or 100 * m[4] > 50 * m[0])
            assert r.kept == (not r.base_failed and r.host_kept)
    assert {"target", "n words", "class"} <= set(quality.judge(messy).columns)
    assert quality.judge(nothing).collect() == []


def test_bad_hosts_lose_their_documents(spark):
    rows = [(i, "spam " * 60, "en", "bad") for i in range(200)] + [(200, prose(80, 1), "en", "bad"), (201, "spam " * 60, "en", "rare")]
    rows += [(300 + i, prose(80, i), "en", f"good{i % 7}") for i in range(700)]
    got = {r.doc_id: r for r in quality.judge(documents(spark, rows)).collect()}
    assert not got[200].base_failed and not got[200].host_kept and not got[200].kept
    assert all(got[300 + i].kept for i in range(700))


def test_host_rates_are_shrunk(spark):
    rows = [("a", 1)] * 90 + [("a", 0)] * 10 + [("b", 1)] + [("c", 0)] * 400
    got = {r.host: r for r in quality.host_verdicts(spark.createDataFrame(rows, "host string, x int"), {"x": 0.8}).collect()}
    m = 91 / 501
    v = (100 * (0.9 - m) ** 2 + (1 - m) ** 2 + 400 * m**2) / 501
    strength = min(max(m * (1 - m) / v - 1, 1), 1000)
    for host, x, n in (("a", 90, 100), ("b", 1, 1), ("c", 0, 400)):
        assert got[host].x_rate == pytest.approx((x + strength * m) / (n + strength))
    assert not got["a"].host_kept and got["b"].host_kept and got["c"].host_kept


# Near documents


def shingles(text, words):
    found = (text or "").encode().lower().split()
    if len(found) < words:
        return frozenset([tuple(found)] if found else [])
    return frozenset(zip(*(found[i:] for i in range(words))))


def brute_components(rows, words, percent=80):
    """component of each row ``(doc_id, text)``, by comparing all sets that share a shingle."""
    sets = [shingles(t, words) for _, t in rows]
    classes = defaultdict(list)
    for i, s in enumerate(sets):
        if s:
            classes[s].append(i)
    reps = [s for s in classes if any(rows[i][0] is not None for i in classes[s])]
    root = {s: s for s in reps}

    def find(s):
        while root[s] is not s:
            s = root[s]
        return s

    holders = defaultdict(list)
    for s in reps:
        for other in {o for x in s for o in holders[x]}:
            common = len(s & other)
            if 100 * common >= percent * (len(s) + len(other) - common):
                root[find(s)] = find(other)
        for x in s:
            holders[x].append(s)
    least = {}
    for s in reps:
        ids = [rows[i][0] for i in classes[s] if rows[i][0] is not None]
        least[find(s)] = min([least.get(find(s), ids[0]), *ids])
    return [rows[i][0] if not s or s not in root else least[find(s)] for i, s in enumerate(sets)], list(map(len, sets))


@pytest.mark.parametrize("words,block", [(2, 200_000), (5, 200_000), (2, 3_000)])
def test_near_documents(spark, messy, real, nothing, words, block):
    base = prose(150, 77)
    group = [(100 + i, edited(base, (i % 12) / 60, i), "en", "a") for i in range(150)]
    for frame in (messy, real, documents(spark, group)):
        rows = minhash.link_documents(frame, words=words, block_shingles=block).collect()
        want, sizes = brute_components([(r.doc_id, r.text) for r in rows], words)
        assert [r.n_shingles for r in rows] == sizes
        assert [r.component_id for r in rows] == want
        assert [r.kept for r in rows] == [r.doc_id == c for r, c in zip(rows, want)]
    assert minhash.link_documents(nothing).collect() == []


def test_pipeline_keeps_one_row_of_each_group(spark, messy):
    import corpus_pipeline

    lost, edge = prose(120, 91), prose(150, 92)
    rows = [*DOCUMENTS, *[(None, lost, "en", "a")] * 3, (None, lost + " end", "en", "b"), (30, edge, "en", "a"), (30, edge, "en", "b"), (None, edge + " end", "en", "c")]
    frame = documents(spark, rows)
    # Every row an id of its own, in the order that a group keeps: null ids last.
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    want, _ = brute_components([(rank, rows[i][1]) for rank, i in enumerate(order)], 5)
    assert len(set(want)) < len(rows)
    once = corpus_pipeline.near_duplicates(spark, frame, "")
    kept = Counter(r.doc_id for r in once.collect())
    assert kept == Counter(rows[order[c]][0] for c in set(want))
    assert kept[12] == 1 and kept[30] == 1
    left = [r.text for r in corpus_pipeline.repeated_strings(spark, once, "").collect()]
    assert left.count(prose(30_000, 12)) == 1 and left.count(edge) == 1
    assert sum(t in (lost, lost + " end") for t in left) == 1


# Repeated strings


def brute_repeats(texts, window):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + window] for r in raws for i in range(len(r) - window + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r) + 1, int)
        for i in range(len(r) - window + 1):
            if seen[r[i : i + window]] > 1:
                gone[i : i + window] = 1
        gone = gone[: len(r)]
        starts = int((np.diff(np.append(0, gone)) == 1).sum())
        out.append((len(r), int(gone.sum()), starts, hashlib.sha256(np.frombuffer(r, np.uint8)[gone == 0].tobytes()).hexdigest()))
    return out


@pytest.mark.parametrize("options", [{}, {"group_bytes": 2_000, "collection_bytes": 4_096}])
def test_repeats(messy, real, nothing, options):
    for frame in (messy, real):
        rows = repeats.remove_repeats(frame, **options).collect()
        want = brute_repeats([r.text for r in rows], 200)
        assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows] == want
        for r in rows:
            assert (r.kept_text is None) == (r.text is None)
    assert repeats.remove_repeats(nothing).collect() == []


def test_transform_finds_every_repeated_window(tmp_path):
    import random

    draw = random.Random(9)
    for _ in range(30):
        base = bytes(draw.choices(b"ab", k=500))
        strings = []
        for _ in range(draw.randint(1, 10)):
            n, a = draw.randint(16, 120), draw.randint(0, 300)
            x = bytearray(base[a : a + n]) if draw.random() < 0.6 else bytearray(draw.choices(b"a", k=n))
            if draw.random() < 0.5:
                x[draw.randrange(len(x))] = 99
            strings.append(bytes(x))
        seen = Counter(s[i : i + 16] for s in strings for i in range(len(s) - 15))
        for s, got in zip(strings, repeats.repeated_windows(strings, 16, str(tmp_path))):
            assert got.tolist() == [i for i in range(len(s) - 15) if seen[s[i : i + 16]] > 1]


# Languages


def test_languages(real, messy, nothing):
    model = language.learn(real)
    rows = language.identify(real, model).withColumn("out", language.held_out(F.col("doc_id"))).collect()
    tested = [r for r in rows if r.out]
    assert all(r.out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang == r.lang_pred for r in tested) >= 0.97 * len(tested)
    got = language.identify(messy, model).collect()
    for r in got:
        letter = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letter) and 0 <= r.score <= 1
    assert {r.lang_pred for r in language.identify(messy, language.learn(nothing)).collect()} == {"und"}
    assert language.identify(nothing, model).collect() == []


def test_mixtures_of_languages(spark, real):
    model = language.learn(real)
    texts = {r.lang: r.text for r in real.filter("n_chars > 2000 and lang is not null").collect()}
    langs = sorted(texts)[:2]
    both = documents(spark, [(1, texts[langs[0]][:1500] + "\n" + texts[langs[1]][:500], None, None)])
    (r,) = language.identify(both, model).collect()
    assert r.lang_pred == langs[0] and set(langs) <= set(r.lang_shares) and 0.6 < r.score < 0.9


def test_em_shares_rise_in_likelihood():
    draw = np.random.default_rng(1)
    p = draw.dirichlet(np.ones(50), 3)
    n = draw.multinomial(5000, 0.7 * p[0] + 0.3 * p[2]).astype(float)
    found = language.mixture(p, n, 4.0, rounds=60)
    assert set(found) == {0, 2} and abs(found[0] - 0.7) < 0.1
