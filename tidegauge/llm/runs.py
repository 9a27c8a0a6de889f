"""Periodic runs of words: stretches that repeat with a period and cannot be extended, and texts without the repetitions.

Two equal strings of words are a maximal pair when neither the words before them nor those after them are equal.  A run of period p,
start s and length L is the maximal pair (s, s + p) of strings of L - p words; so the maximal pairs whose distance is at most
their length are exactly the runs, once the multiples of a period, which give the same stretch, are left out.  Pairs come
from the tree of LCP intervals, walked bottom-up: an interval holds its places in lists by the word to their left, and where two
children of an interval meet, each place of the smaller one looks for its partners in the larger.  Two occurrences of a string
that lie within its length to the right of a third one have equal words to their left, and so a place has at most one partner to its left, the first
place in reach, and to its right all places of one list, or none.  The work is O(n log n) and one step for each pair.

Only places whose first words (as many as the shortest pair has) occur again in the text can take part, so the suffix array holds
just these, and the places behind those words.  Suffixes are sorted by prefix doubling in numpy, for the texts of a batch of
``batch_words`` words together; texts never share a rank.  A text is one row in one task, whatever its length.

Defined results: words are runs of characters other than ASCII white space; null and empty texts, and texts without a run, have no
runs, and keep their words, joined by one space; repeated rows and rows without an id are rows like others; an empty table
gives an empty result.  Input columns may have any names; an added column replaces one of the same name.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.shared import shielded, unshielded

_MIX = np.uint64(0x9E3779B97F4A7C15)


def repeated_places(words: np.ndarray, text: np.ndarray, width: int) -> np.ndarray:
    """Rising places where ``width`` words start that may start elsewhere in the same text too.  Equal hashes only cost time."""
    n = len(words) - width + 1
    if n <= 1:
        return np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        key = text[:n].astype(np.uint64) * _MIX
        for k in range(width):
            key = (key ^ words[k : k + n].astype(np.uint64)) * _MIX
            key ^= key >> np.uint64(29)
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return np.flatnonzero(twice)


def sort_suffixes(words: np.ndarray, text: np.ndarray, places: np.ndarray, width: int) -> np.ndarray:
    """The places by text, then by the words from there to the text's end.

    Two suffixes that agree in d words, a multiple of ``width``, are told apart by the order of the places d further on.  So
    wherever places share ``width`` words, the places behind these words have to be among ``places`` too.
    """
    m = len(places)
    padded = np.append(words, np.zeros(width, words.dtype))
    order = places[np.lexsort([padded[places + k] for k in reversed(range(width))] + [text[places]])]
    changed = np.zeros(m, bool)
    changed[0] = True
    for row in (*(padded[order + k] for k in range(width)), text[order]):
        changed[1:] |= row[1:] != row[:-1]
    # A rank is the slot of the first place with the same prefix.
    rank = np.zeros(len(words), np.int64)
    head = np.maximum.accumulate(np.where(changed, np.arange(m), 0))
    rank[order] = head
    depth = width
    while True:
        alone = changed & np.append(changed[1:], True)
        slots = np.flatnonzero(~alone)
        if not len(slots):
            return order
        here, group = order[slots], head[slots]
        after = rank[here + depth]
        by = np.lexsort((after, group))
        order[slots], after = here[by], after[by]
        changed[slots[1:]] |= (after[1:] != after[:-1]) | (group[1:] != group[:-1])
        head = np.maximum.accumulate(np.where(changed, np.arange(m), 0))
        rank[order[slots]] = head[slots]
        depth *= 2


def common_prefixes(words: list[int], order: np.ndarray, text: np.ndarray, width: int) -> list[int]:
    """Words that each place of ``order`` shares with the one before it in the same text; 0 where these are fewer than ``width``."""
    shared = np.zeros(len(order), np.int64)
    slots = np.flatnonzero(text[order][1:] == text[order][:-1]) + 1
    by_place = np.argsort(order[slots])
    length, last = 0, -2
    for slot, place, other in zip(*(x[by_place].tolist() for x in (slots, order[slots], order[slots - 1]))):
        length = length - 1 if place == last + 1 and length > width else 0
        last = place
        while words[place + length] == words[other + length]:
            length += 1
        if length >= width:
            shared[slot] = length
    return shared.tolist()


class Interval:
    """Places of an LCP interval: all, and in lists by the word to their left."""

    __slots__ = ("shared", "places", "by_left")

    def __init__(self, shared: int, place: int, left: int):
        self.shared, self.places, self.by_left = shared, [place], {left: [place]}

    def add(self, place: int, left: int) -> None:
        insort(self.places, place)
        listed = self.by_left.get(left)
        if listed is None:
            self.by_left[left] = [place]
        else:
            insort(listed, place)


def join_child(parent: Interval, child: Interval, words: list[int], least: int, found: dict) -> None:
    """Maximal pairs of a place of each, ``parent.shared`` words long and no further apart; then the child's places are the parent's."""
    shared = parent.shared
    if len(child.places) > len(parent.places):
        parent.places, child.places = child.places, parent.places
        parent.by_left, child.by_left = child.by_left, parent.by_left
    places, by_left = parent.places, parent.by_left
    for left, listed in child.by_left.items():
        for place in listed:
            right = bisect_right(places, place)
            if right < len(places) and places[right] - place <= shared:
                other = words[places[right] - 1]
                if other != left:
                    partners = by_left[other]
                    for k in range(bisect_right(partners, place), len(partners)):
                        apart = partners[k] - place
                        if apart > shared:
                            break
                        note(found, place, apart, shared, least)
            first = bisect_left(places, place - shared)
            if first < right and words[places[first] - 1] != left:
                note(found, places[first], place - places[first], shared, least)
    for left, listed in child.by_left.items():
        for place in listed:
            parent.add(place, left)


def note(found: dict, start: int, period: int, shared: int, least: int) -> None:
    """The shortest period of a stretch is the run's; longer ones are its multiples."""
    if shared + period >= least:
        key = (start, shared + period)
        if period < found.get(key, period + 1):
            found[key] = period


def maximal_pairs(words: list[int], order: list[int], shared: list[int], least: int) -> dict[tuple[int, int], int]:
    """Shortest period by start and length, of all maximal pairs that overlap or touch and span ``least`` words."""
    found: dict[tuple[int, int], int] = {}
    open_: list[Interval] = []
    for k, length in enumerate([*shared[1:], 0]):
        node = Interval(0, order[k], words[order[k] - 1])
        while open_ and open_[-1].shared > length:
            top = open_.pop()
            join_child(top, node, words, least, found)
            node = top
        if not length:
            continue
        if open_ and open_[-1].shared == length:
            join_child(open_[-1], node, words, least, found)
        else:
            node.shared = length
            open_.append(node)
    return found


def find_runs(words: np.ndarray, text: np.ndarray, least: int) -> np.ndarray:
    """Rows of start, length, period of all runs.

    ``words`` are numbers of words with a word of its own before the first text and after each one; ``text`` numbers the texts.
    A pair of strings of l words at distance p <= l spans ``least`` words only if l is at least half of that.
    """
    width = max(1, (least + 1) // 2)
    places = repeated_places(words, text, width)
    if not len(places):
        return np.zeros((0, 3), np.int64)
    behind = places + width
    order = sort_suffixes(words, text, np.union1d(places, behind[behind < len(words)]), width)
    numbers = words.tolist()
    found = maximal_pairs(numbers, order.tolist(), common_prefixes(numbers, order, text, width), least)
    runs = np.array([(start, length, period) for (start, length), period in found.items()], np.int64).reshape(-1, 3)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _of_texts(texts: pa.Array, least: int) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Words, runs and what is left of each text."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.string()), ""))
    flat, owner = pc.list_flatten(split), pc.list_parent_indices(split).to_numpy()
    full = pc.greater(pc.binary_length(flat), 0)
    flat, owner = flat.filter(full), owner[full.to_numpy(zero_copy_only=False)]
    coded = flat.dictionary_encode()
    counts = np.bincount(owner, minlength=len(texts))
    ends = np.cumsum(counts)
    # One place more before the first text and after each: a word that occurs nowhere else.
    at = np.arange(len(flat)) + owner + 1
    words = np.empty(len(flat) + len(texts) + 1, np.int64)
    text = np.empty(len(words), np.int64)
    words[at], text[at] = coded.indices.to_numpy(), owner
    borders = np.append(0, ends + np.arange(1, len(texts) + 1))
    words[borders], text[borders] = len(coded.dictionary) + np.arange(len(borders)), len(texts) + np.arange(len(borders))
    runs = find_runs(words, text, least)
    of = text[runs[:, 0]] if len(runs) else np.zeros(0, np.int64)
    begin = np.append(0, ends)[:-1]
    gone = np.zeros(len(flat) + 1, np.int64)
    first = runs[:, 0] - of - 1
    np.add.at(gone, first + runs[:, 2], 1)
    np.add.at(gone, first + runs[:, 1], -1)
    kept = np.cumsum(gone[:-1]) == 0
    kept_ends = np.append(0, np.cumsum(np.bincount(owner[kept], minlength=len(texts))))
    left = pc.binary_join(pa.ListArray.from_arrays(pa.array(kept_ends, pa.int32()), flat.filter(pa.array(kept))), " ")
    structs = pa.StructArray.from_arrays(
        [pa.array(first - begin[of], pa.int64()), pa.array(runs[:, 1], pa.int64()), pa.array(runs[:, 2], pa.int64())], ["start", "length", "period"]
    )
    run_ends = np.append(0, np.cumsum(np.bincount(of, minlength=len(texts)))).astype(np.int32)
    return pa.array(counts, pa.int64()), pa.ListArray.from_arrays(pa.array(run_ends), structs), left


def _search(text_at: str, least: int, batch_words: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column(text_at)), 0).to_numpy(zero_copy_only=False)
            # A word and the blank after it take about six bytes; a text is never cut.
            part = np.cumsum(size) // (6 * batch_words)
            for number in np.unique(part):
                some = batch.slice(int(np.searchsorted(part, number)), int((part == number).sum()))
                found = _of_texts(some.column(text_at), least)
                yield pa.RecordBatch.from_arrays([*some.columns, *found], names=[*some.schema.names, "n_words", "runs", "collapsed"])

    return search


def periodic_runs(
    documents: DataFrame, *, text_col: str = "text", least: int = 12, carry: tuple[str, ...] | None = None, batch_words: int = 400_000
) -> DataFrame:
    """The input's columns (or those of ``carry``) with ``n_words``, ``runs`` and ``collapsed``.

    ``runs`` is an array of ``start, length, period`` by start and period, of all runs of at least ``least`` words and two periods.
    ``collapsed`` is the text without the words that lie in a run behind its first period.
    """
    rows, inner = shielded(documents)
    carried = {name: inner[name] for name in (documents.columns if carry is None else carry)}
    rows = rows.select(*carried.values(), F.col(inner[text_col]).cast("string").alias("the_text"))
    given = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    schema = f"{given}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    added = ["n_words", "runs", "collapsed"]
    return rows.mapInArrow(_search("the_text", least, batch_words), schema).select(*unshielded(carried, added), *added)
