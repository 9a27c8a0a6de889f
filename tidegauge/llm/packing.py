"""Harmonic packing of token sequences.

Lengths up to the capacity C fall into reciprocal classes: class j holds lengths in (C / (j + 1), C / j], and each of its
bins takes exactly j pieces, whichever they are.  Bins of a class therefore fill independently on all workers; only the
number of pieces per (class, group) is summed to number them.  Long documents are cut into whole sequences, and a rest is
cut at most ``cuts`` times at the upper end of its class, where j pieces fill a bin (to within j tokens), so padding is
left to the last, small piece.  What does not fill a bin of its class, fewer than j pieces of class j whatever the
corpus holds, goes to bins by decreasing length, first fit.

Defined results: a null or empty text has only the closing id; a null id is a document like another; repeated rows are
packed each; an empty table gives an empty result.  Input columns may have any names, as only id and text are used.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.shared import staged

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def piece_lengths(n: int, capacity: int, cuts: int, least: int) -> list[int]:
    """Lengths of a document's pieces: whole sequences, then the rest cut at the ends of its classes, down to ``least``."""
    lengths = [capacity] * (n // capacity)
    rest = n % capacity
    for _ in range(cuts):
        if rest < least:
            break
        full = capacity // -(-capacity // rest)
        lengths.append(full)
        rest -= full
    if rest:
        lengths.append(rest)
    return lengths


#: Letters beyond these may be letters to one Unicode table and none to another.
_PLAIN = "\u0530"
#: Small letters that every normal form leaves as they are.
_LATIN = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")


def _all_letters(word: str) -> bool:
    """Whether the tokenizer's normal form of a word is nothing but letters: some letters become a letter and a mark there."""
    if word.isascii():
        return word.isalpha()
    if _LATIN.fullmatch(word):
        return True
    if max(word) >= _PLAIN:
        return False
    return "".join(c.lower() for c in unicodedata.normalize("NFC", word)).isalpha()


class WordTokens:
    """Ids of texts as little-endian unsigned 32-bit integers.

    The tokenizer's rules never join what white space parts, so texts are split there, and every distinct part of some texts is
    tokenized once.  Its ids are remembered for texts to come, up to ``remembered`` bytes of short parts and as many of the
    generation before.  New words of letters are tokenized together, as a token tells whether it ends a word.
    """

    #: Marks that the tokenizer parts from letters before them (not the apostrophe, which it may join to letters).
    MARKS = ".,;:!?*$%&#|<>()[]{}-_=+/@~^\""
    #: Longer parts are not remembered.
    SHORT = 40

    def __init__(self, path: str, remembered: int = 6_000_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.remembered = Tokenizer.from_file(path), remembered
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.held = 0
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def __call__(self, texts: pa.Array | list[str]) -> list[bytes]:
        texts = pa.concat_arrays([pc.fill_null(pa.array(texts, pa.string()) if isinstance(texts, list) else texts, "")])
        # The marks of special tokens have no capitals.
        plain = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        split = pc.ascii_split_whitespace(plain)
        parts = split.flatten().dictionary_encode()
        ids = pa.array(self._of_words(parts.dictionary.to_pylist()), pa.large_binary())
        joined = ids.take(parts.indices)
        ends = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset :][split.offsets.to_numpy() - split.offsets[0].as_py()]
        raw = memoryview(joined.buffers()[2] or b"")
        return [bytes(raw[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]

    def _of_words(self, words: list[str]) -> list[bytes]:
        found = list(map(self.known.get, words))
        lost = [i for i, ids in enumerate(found) if ids is None]
        missing = [words[i] for i in lost if words[i] not in self.before]
        learnt = self._learn(missing) if missing else {}
        for i in lost:
            word = words[i]
            found[i] = ids = self.before[word] if word in self.before else learnt[word]
            if len(word) <= self.SHORT:
                self.known[word] = ids
                self.held += len(word) + len(ids)
        if self.held > self.remembered:
            self.before, self.known, self.held = self.known, {}, 0
        return found

    def _learn(self, missing: list[str]) -> dict[str, bytes]:
        marks, learnt = self.MARKS, {"": b""}
        letters, rest, two = set(), [], []
        for part in missing:
            word = part.rstrip(marks)
            if not word or not _all_letters(word):
                rest.append(part)
            elif len(word) == len(part):
                letters.add(part)
            else:
                letters.add(word)
                two.append((part, word, part[len(word) :]))
        letters = list(letters)
        ids = np.asarray(self.tokenizer.encode_batch_fast([" ".join(letters)], add_special_tokens=False)[0].ids, "<u4")
        stops = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
        if len(stops) == len(letters):
            raw = ids.tobytes()
            learnt.update(zip(letters, map(raw.__getitem__, map(slice, [0, *stops], stops))))
        else:  # some letter is not one to the tokenizer
            rest += letters
        rest += {end for _, _, end in two}.difference(rest)
        for part, got in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
            learnt[part] = np.asarray(got.ids, "<u4").tobytes()
        for part, word, end in two:
            learnt[part] = learnt[word] + learnt[end]
        return learnt


def _in_pieces(batch: pa.RecordBatch, most: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about so many bytes of text, or one row."""
    size = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(size) // most
    starts = np.flatnonzero(np.diff(part, prepend=-1)).tolist()
    for a, b in zip(starts, [*starts[1:], batch.num_rows]):
        yield batch.slice(a, b - a)


def _cutter(path: str, end_id: int, capacity: int, cuts: int, least: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, end = WordTokens(path), np.asarray([end_id], "<u4").tobytes()
        for batch in batches:
            for some in _in_pieces(batch):
                out: list[list[int | None]] = [[], [], [], [], []]
                for doc_id, ids in zip(some.column(0).to_pylist(), tokens(some.column(1))):
                    ids += end
                    n, start = len(ids) // 4, 0
                    for length in piece_lengths(n, capacity, cuts, least):
                        crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                        for column, value in zip(out, (doc_id, start, length, crc, n)):
                            column.append(value)
                        start += length
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return cut


def tokenized_pieces(
    documents: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, capacity: int = 4096, cuts: int = 2, least: int = 64
) -> DataFrame:
    """PIECES of all documents, each closed by ``end_id``."""
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_cutter(tokenizer_path, end_id, capacity, cuts, least), PIECES)


def pack(pieces: DataFrame, *, capacity: int = 4096, group_pieces: int = 20_000) -> DataFrame:
    """``pieces`` (with ``length`` from 1 to ``capacity``) plus ``class``, ``sequence_id`` and ``offset``.

    Pieces are dealt to groups by hash, about ``group_pieces`` to a group, so a class may hold any share of them.
    """
    pieces = staged(pieces.withColumn("class", F.expr(f"{capacity} div length")), "packing-pieces")
    groups = max(1, -(-pieces.count() // group_pieces))
    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(groups)))
    # Where each group's pieces of a class start among all pieces of that class, and how many bins the classes before need.
    counts = dealt.groupBy("class", "group").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("class").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))
    counts = staged(counts.withColumn("in_class", F.sum("n").over(Window.partitionBy("class"))), "packing-counts")
    bins = counts.groupBy("class").agg(F.expr("first(in_class) div class").alias("bins"))
    smaller = Window.orderBy("class").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("first_bin", F.coalesce(F.sum("bins").over(smaller), F.lit(0)))  # one row a class: 2 sqrt(C) at most
    starts = counts.join(bins, "class").select("class", "group", "first", "bins", "first_bin")

    order = Window.partitionBy("class", "group").orderBy("doc_id", "start", "ids_crc32")
    ranked = dealt.join(starts, ["class", "group"]).withColumn("rank", F.col("first") + F.row_number().over(order) - 1)
    ranked = ranked.withColumn("bin", F.expr("rank div class"))
    columns = pieces.columns
    # Bins may have pieces of two groups, so bins are numbered first and filled by a window of j pieces each.
    full = ranked.filter("bin < bins").withColumn("sequence_id", F.col("first_bin") + F.col("bin"))
    inside = Window.partitionBy("sequence_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    full = full.withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0))).select(*columns, "sequence_id", "offset")

    full_bins = bins.agg(F.coalesce(F.sum("bins"), F.lit(0))).first()[0]
    rest = ranked.filter("bin >= bins").select(*columns).withColumn("full_bins", F.lit(full_bins))
    schema = pieces.select(*columns).schema.add("sequence_id", "long").add("offset", "long")
    packed = rest.withColumn("one", F.lit(1)).groupBy("one").applyInPandas(_first_fit(capacity, [f.name for f in schema]), schema)
    return full.unionByName(packed)


def _first_fit(capacity: int, columns: list[str]):
    def fit(rest):
        rest = rest.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
        room: list[int] = []
        at, offsets = [], []
        first_open = 0
        for length in rest["length"]:
            while first_open < len(room) and room[first_open] == 0:
                first_open += 1
            k = next((i for i in range(first_open, len(room)) if room[i] >= length), len(room))
            if k == len(room):
                room.append(capacity)
            at.append(k)
            offsets.append(capacity - room[k])
            room[k] -= length
        return rest.assign(sequence_id=rest["full_bins"] + at, offset=offsets)[columns]

    return fit
