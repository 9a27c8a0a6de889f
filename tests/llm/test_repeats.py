"""Work of the repeated strings: files of the transform, symbols that take part, tasks, texts hashed together."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np

from tidegauge.llm import repeats


def brute_windows(strings, window):
    seen = Counter(s[i : i + window] for s in strings for i in range(len(s) - window + 1))
    return [[i for i in range(len(s) - window + 1) if seen[s[i : i + window]] > 1] for s in strings]


def test_rounds_write_their_files_in_place(tmp_path):
    draw = random.Random(3)
    names = [f"{name}{turn}" for name in ("bwt", "lcp") for turn in (0, 1)]
    for name in names:
        (tmp_path / name).write_bytes(b"x" * 100_000)
    base = bytes(draw.choices(b"abc", k=399))
    strings = [base, base[50:], base[:300], bytes(draw.choices(b"abc", k=250))]
    for _ in range(2):
        found = repeats.repeated_windows(strings, 200, str(tmp_path))
        assert [x.tolist() for x in found] == brute_windows(strings, 200)
        assert [(tmp_path / name).stat().st_size for name in names] == [100_000] * 4


def test_symbols_that_come_once_take_no_part(tmp_path):
    draw = random.Random(4)
    alone = [draw.randbytes(300) for _ in range(200)]
    assert not any(map(len, repeats.repeated_windows(alone, 200, str(tmp_path))))
    assert sum(p.stat().st_size for p in tmp_path.iterdir()) == 0
    shared = draw.randbytes(230)
    strings = [*alone, b"left" + shared, shared + b"right", shared[:199] + b"x"]
    assert [x.tolist() for x in repeats.repeated_windows(strings, 200, str(tmp_path))] == brute_windows(strings, 200)
    assert sum(p.stat().st_size for p in tmp_path.iterdir()) < 20_000


def test_whole_and_covered_strings(tmp_path):
    draw = random.Random(5)
    base = draw.randbytes(399)
    strings = [base, base[:220], draw.randbytes(250), base[120:], draw.randbytes(240), base[:210] + b"-" + base[:205]]
    copies = np.array([1, 1, 3, 1, 1, 2])
    lengths = np.array(list(map(len, strings)))
    found = repeats._spans(*repeats._repeated(strings, 200, str(tmp_path)), 200, lengths, copies > 1).to_pylist()
    for s, n, starts, spans in zip(strings, copies, brute_windows(strings, 200), found):
        want = {i for a in starts for i in range(a, a + 200)} if n == 1 else set(range(len(s)))
        assert {i for x in spans for i in range(x["from"], x["to"])} == want
        assert all(a["to"] < b["from"] for a, b in zip(spans, spans[1:]))


def test_tasks_grow_slower_than_collections():
    mb = 1 << 20
    assert repeats._build_tasks(0, 1 << 17, 600) == 1
    assert repeats._build_tasks(20 * mb, 1 << 17, 600) == 41
    assert repeats._build_tasks(4_800 * mb, 1 << 17, 600) == 601
    assert repeats._build_tasks(480_000 * mb, 1 << 17, 600) == 60_001


def test_texts_hashed_together_have_the_runs_that_they_have_alone(monkeypatch):
    draw = random.Random(6)
    texts = [bytes(draw.choices(draw.choice([b"a", b"ab", b"abcdefgh"]), k=draw.choice([0, 15, 16, 17, 60, 700]))) for _ in range(300)]
    data, lengths = np.frombuffer(b"".join(texts), np.uint8), np.array(list(map(len, texts)))
    hashes = repeats.LeastHashes(5, 16, 1)
    alone = [
        (i, *run) for i, t in enumerate(texts) for _, *run in zip(*(x.tolist() for x in hashes.runs(np.frombuffer(t, np.uint8), np.array([len(t)]), weighed=True)))
    ]
    assert any(run[-1] == 2 for run in alone) and any(run[-1] == 1 for run in alone)
    for stretch in (1, 100, 2_000, 1 << 20):
        monkeypatch.setattr(repeats, "STRETCH_BYTES", stretch)
        assert list(zip(*(x.tolist() for x in hashes.runs(data, lengths, weighed=True)))) == alone
    # Runs are neighbouring windows with one least hash, and hold each window of each text once.
    for i, t in enumerate(texts):
        covered = [w for j, _, first, n, _ in alone if j == i for w in range(first, first + n)]
        assert covered == list(range(len(t) - 15))
