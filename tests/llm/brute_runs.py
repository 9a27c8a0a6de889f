"""All runs of a text, by extending every period at every place."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def runs(words: list[str], least: int = 12) -> list[tuple[int, int, int]]:
    shortest: dict[tuple[int, int], int] = {}
    n = len(words)
    for period in range(1, n // 2 + 1):
        i = 0
        while i + period < n:
            if words[i] != words[i + period]:
                i += 1
                continue
            start = i
            while i + period < n and words[i] == words[i + period]:
                i += 1
            length = i + period - start
            if length >= max(least, 2 * period):
                shortest.setdefault((start, length), period)
    return sorted(((s, n, p) for (s, n), p in shortest.items()), key=lambda r: (r[0], r[2]))


def collapsed(words: list[str], found: list[tuple[int, int, int]]) -> str:
    gone = {i for start, length, period in found for i in range(start + period, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)
