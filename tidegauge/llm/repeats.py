"""Removal of long repeated byte strings, by Burrows-Wheeler transforms of collections built column by column.

A window is ``window`` bytes of one document.  Every byte of a window that occurs anywhere else, in any document, goes.

*Who meets whom.*  Each window is assigned to the least hash of its ``seed_bytes``-byte strings, so equal windows go to one
group.  Neighbouring windows with the same least hash are a run, and the bytes of a run are one string of the collection.
Groups of a single run cannot hold a repeated window and end here; for the others, equal strings become one with a count.

*Construction.*  A task takes whole groups until ``collection_bytes`` and builds one collection's transform: each round
inserts the next symbol, from the right, of every string at once, and carries the common prefixes of neighbours along.  Rounds
read the transform and the prefixes from one pair of files in order and write the next pair, each in the place of the pair
before it: some file systems send a file that is cut and written anew to the disk when it is closed.  A symbol is ``symbol`` bytes
(40 for windows of 200, told apart by 64-bit hashes); a string takes part once for each way to align it, so all suffixes are in the transform
that a repeated window can start: what lies between symbols that come once, if it is as long as a window.  Windows are repeated
where a neighbour shares a prefix of their length, or the whole string occurs twice.

*Groups of any size.*  A group of more than ``group_bytes`` of distinct strings is dealt again by another hash, within each
run, at last by whole windows, where equal strings are one: no task holds more than bounded groups.

Defined results: a null or empty text has no bytes; texts shorter than a window lose nothing; repeated rows are copies of each
other and lose everything if long enough; null ids count like others; an empty table gives an empty result.  Input columns
may have any names; an added column replaces one of the same name.
"""

from __future__ import annotations

import contextlib
import hashlib
import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.shared import shielded, staged, unshielded

#: Bytes of a symbol: the first of these that divides the window.
SYMBOLS = (40, 20, 16, 8)
#: Longest run in windows; longer ones, which only periodic text has, are cut.
RUN_WINDOWS = 200
#: Bytes of texts that are hashed at once.
STRETCH_BYTES = 1 << 15
#: Bytes of strings in a task, where there are more of them than Spark's number of partitions takes in small tasks.
TASK_BYTES = 8 << 20


class LeastHashes:
    """Least hash of the ``k``-byte strings in each window, from a rolling polynomial."""

    def __init__(self, k: int, window: int, salt: int):
        base = 0x9E3779B97F4A7C15 + 2 * salt
        self.k, self.window = k, window
        self.base, self.inverse = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            n = max(n, 2 * len(self.powers))
            one = np.ones(1, np.uint64)
            self.powers = np.multiply.accumulate(np.concatenate([one, np.full(n, self.base)]))
            self.inverses = np.multiply.accumulate(np.concatenate([one, np.full(n, self.inverse)]))

    def __call__(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least hash of each window, and the hash of each k-byte string."""
        n = len(data)
        self._grow(n + 1)
        s = data.astype(np.uint64)
        s += np.uint64(1)
        s *= self.powers[:n]
        sums = np.empty(n + 1, np.uint64)
        sums[0] = 0
        np.cumsum(s, out=sums[1:])
        x = sums[self.k :] - sums[: -self.k]
        x *= self.inverses[: n - self.k + 1]
        high = s[: len(x)]
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
            x ^= np.right_shift(x, np.uint64(shift), out=high)
            if factor > 1:
                x *= np.uint64(factor)
        wide, least, span = self.window - self.k + 1, x, 1
        while 2 * span <= wide:
            least, span = np.minimum(least[:-span], least[span:]), 2 * span
        if span < wide:
            least = np.minimum(least[: span - wide], least[wide - span :])
        return least, x

    def runs(self, data: np.ndarray, lengths: np.ndarray, weighed: bool = False) -> tuple[np.ndarray, ...]:
        """Text, hash, first window, number of windows and weight of each run of the texts, which lie one behind another.

        The weight, if asked for, is 2 where the text has the least k-byte string twice: a run may then hold a window twice.
        """
        edges = np.append(0, np.cumsum(lengths))
        found, a = [], 0
        while a < len(lengths):
            b = max(a + 1, int(np.searchsorted(edges, edges[a] + STRETCH_BYTES, "right")) - 1)
            text, *rest = self._runs_of_stretch(data[edges[a] : edges[b]], lengths[a:b], weighed)
            found.append((text + a, *rest))
            a = b
        text, key, cut, length, weight = map(np.concatenate, zip(*found)) if found else [np.empty(0, np.int64)] * 5
        if (length > RUN_WINDOWS).any():
            parts = -(-length // RUN_WINDOWS)
            at = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            text, key, weight = (np.repeat(x, parts) for x in (text, key, weight))
            cut, length, whole = np.repeat(cut, parts) + RUN_WINDOWS * at, np.repeat(length, parts), np.repeat(parts, parts)
            length = np.where(at < whole - 1, RUN_WINDOWS, length - RUN_WINDOWS * (whole - 1))
        return text, key, cut, length, weight

    def _runs_of_stretch(self, data: np.ndarray, lengths: np.ndarray, weighed: bool) -> tuple[np.ndarray, ...]:
        if len(data) < self.window:
            return (np.empty(0, np.int64),) * 5
        least, own = self(data)
        start = np.cumsum(lengths) - lengths
        stop = start + np.maximum(lengths - self.window + 1, 0)
        new = np.empty(len(least), bool)
        new[0] = True
        np.not_equal(least[1:], least[:-1], out=new[1:])
        new[start[start < len(least)]] = True
        cut = np.flatnonzero(new)
        text = np.searchsorted(start, cut, "right") - 1
        length = np.minimum(np.append(cut[1:], len(least)), stop[text]) - cut
        whole = length > 0  # windows that reach into the next text are none
        cut, text, length = cut[whole], text[whole], length[whole]
        key = least[cut]
        weight = np.ones(len(key), np.int64)
        if weighed and len(key):
            # Only strings up to the largest of the least hashes can be least ones.
            at = np.flatnonzero(own <= key.max())
            of = np.searchsorted(start, at, "right") - 1
            inside = at + self.k <= start[of] + lengths[of]
            twice = np.sort(_of_text(own[at[inside]], of[inside]))
            weight += np.isin(_of_text(key, text), twice[1:][twice[1:] == twice[:-1]])
        return text, key.view(np.int64), cut - start[text], length, weight


def _of_text(hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Hashes of a string and the text that it is in."""
    return hashes + text.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)


def _order(values: np.ndarray) -> np.ndarray:
    """Stable order, by 16 bits at a time."""
    order = np.argsort(values.astype(np.uint16), kind="stable")
    for shift in range(16, 8 * values.itemsize, 16):
        order = order[np.argsort((values >> values.dtype.type(shift)).astype(np.uint16)[order], kind="stable")]
    return order


def _range_minima(values: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Least value of each range, from tables of the least values of 1, 2, 4, ... neighbours."""
    out = np.empty(len(start), values.dtype)
    level = np.frexp((stop - start).astype(np.float64))[1] - 1
    table = values
    for k in range(int(level.max()) + 1):
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(table[start[at]], table[stop[at] - (1 << k)])
        table = np.minimum(table[: -(1 << k)], table[1 << k :])
    return out


def _names(text: bytes, width: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers for the ``width``-byte strings of the text that start ``at``, and how often each number comes.

    Strings are told apart by 64-bit hashes of their bytes, eight at a time; a last part may overlap the one before.
    """
    eight = np.ndarray(len(text), "<u8", text + bytes(8), strides=(1,)).astype(np.uint64)
    value = np.zeros(len(text) - width + 1, np.uint64)
    for i in [*range(0, width - 7, 8), *([width - 8] if width % 8 else [])]:
        value += eight[i : i + len(value)]
        value *= np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(29)
    del eight
    value = value[at]
    order = _order(value)
    value = value[order]
    number = np.empty(len(at), np.int64)
    number[order] = np.cumsum(np.append(False, value[1:] != value[:-1]))
    return number, np.bincount(number)


def _shared_pieces(number: np.ndarray, times: np.ndarray, sizes: np.ndarray, depth: int) -> tuple[np.ndarray, ...]:
    """Row, first column and size of the pieces, ``depth`` symbols at least, without symbols that come once; and their symbols.

    Each place of a string is in one row, so a symbol that comes once is in no window that comes twice.
    """
    shared = times > 1
    row = np.repeat(np.arange(len(sizes)), sizes)
    inside = shared[number]
    edge = np.empty(len(inside), bool)  # the first symbol of a piece, or of what is between two
    edge[0] = True
    edge[1:] = (inside[1:] != inside[:-1]) | (row[1:] != row[:-1])
    cut = np.flatnonzero(edge)
    length = np.diff(np.append(cut, len(inside)))
    kept = inside[cut] & (length >= depth)
    cut, length = cut[kept], length[kept]
    first = np.cumsum(length) - length
    at = np.arange(length.sum()) + np.repeat(cut - first, length)
    # 0 ends a document; few symbols sort faster as 16 bits.
    names = np.cumsum(shared)
    symbols = names[number[at]].astype(np.uint16 if names[-1] <= 0xFFFF else np.uint32)
    return row[cut], cut - (np.cumsum(sizes) - sizes)[row[cut]], length, symbols


def _opened(path: str):
    """A file to be written in place; what it held before stays behind the end of what is written."""
    return open(os.open(path, os.O_RDWR | os.O_CREAT, 0o600), "r+b", buffering=0)


def _write(file, *parts: np.ndarray) -> None:
    file.seek(0)
    for part in parts:
        left = memoryview(np.ascontiguousarray(part)).cast("B") if len(part) else b""
        while len(left):
            left = left[file.write(left) :]


def _read(file, kind: np.dtype, n: int) -> np.ndarray:
    out = np.empty(n, kind)
    left = memoryview(out).cast("B") if n else b""
    file.seek(0)
    while len(left):
        if not (got := file.readinto(left)):
            raise EOFError(f"{len(left)} bytes are missing")
        left = left[got:]
    return out


def _transform(symbols: np.ndarray, first: np.ndarray, sizes: np.ndarray, depth: int, files: list[list]) -> tuple[np.ndarray, np.ndarray]:
    """The transform, and the common prefix of each suffix with the one before, in symbols and up to ``depth``."""
    kind, m = symbols.dtype, len(sizes)
    _write(files[0][0], symbols[first])
    _write(files[0][1], np.zeros(m, np.uint8))
    n = m
    place = np.arange(m)
    for j in range(1, sizes.max() + 1):
        read, write = files[(j - 1) % 2], files[j % 2]
        bwt, lcp = _read(read[0], kind, n), _read(read[1], np.uint8, n)
        order = _order(bwt)
        ended = int(np.searchsorted(bwt, 0, "right", sorter=order))
        rank = np.empty(n, np.int64)
        rank[order] = np.arange(n)
        active = np.flatnonzero(sizes >= j)
        new = rank[place[active]] - ended  # places among the suffixes that have a symbol
        is_new = np.zeros(n - ended, bool)
        is_new[new] = True
        bwt_after, lcp_after = np.empty(n - ended, kind), np.empty(n - ended, np.uint8)
        bwt_after[~is_new], lcp_after[~is_new] = bwt[m:], lcp[m:]
        follows = sizes[active] > j
        bwt_after[new] = np.where(follows, symbols[np.minimum(first[active] + j, len(symbols) - 1)], 0)
        # Common prefixes change only at the new suffixes and right after them.
        near = np.zeros(n - ended, bool)
        near[new] = True
        near[1:] |= is_new[:-1]
        at = np.flatnonzero(near)
        at = at[at > 0]
        here, before = order[at + ended], order[at + ended - 1]
        same = bwt[here] == bwt[before]
        value = np.zeros(len(at), np.uint8)
        if same.any():
            value[same] = np.minimum(_range_minima(lcp, before[same] + 1, here[same] + 1) + np.uint8(1), depth)
        lcp_after[at] = value
        lcp_after[:1] = 0
        _write(write[0], bwt[:m], bwt_after)
        _write(write[1], lcp[:m], lcp_after)
        n = m + len(bwt_after)
        place[active] = m + new
    read = files[sizes.max() % 2]
    return _read(read[0], kind, n), _read(read[1], np.uint8, n)


def repeated_windows(strings: list[bytes], window: int, folder: str) -> list[np.ndarray]:
    """For each string, the starts of windows that also start elsewhere in the collection (any string, itself included)."""
    owner, start = _repeated(strings, window, folder)
    edges = np.searchsorted(owner, np.arange(len(strings) + 1))
    return [start[a:b] for a, b in zip(edges, edges[1:])]


def _repeated(strings: list[bytes], window: int, folder: str) -> tuple[np.ndarray, np.ndarray]:
    """String and start of each repeated window, in order."""
    symbol = next(q for q in SYMBOLS if window % q == 0)
    depth = window // symbol
    lengths = np.array(list(map(len, strings)))
    offsets = np.cumsum(lengths) - lengths
    # A string takes part once for each alignment that can hold a window; a document's symbols are read right to left.
    aligned = np.clip(lengths - window + 1, 0, symbol)
    owner = np.repeat(np.arange(len(strings)), aligned)
    shift = np.arange(len(owner)) - np.repeat(np.cumsum(aligned) - aligned, aligned)
    ends = lengths[owner] - shift
    sizes = ends // symbol
    if not len(sizes):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    # Symbol j of a row starts j + 1 symbols before its end.
    last = offsets[owner] + ends + symbol * (np.cumsum(sizes) - sizes - 1)
    names = _names(b"".join(strings), symbol, np.repeat(last, sizes) - symbol * np.arange(sizes.sum()))
    row, skipped, sizes, symbols = _shared_pieces(*names, sizes, depth)
    if not len(sizes):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    owner, ends, first, m = owner[row], ends[row] - symbol * skipped, np.cumsum(sizes) - sizes, len(sizes)
    with contextlib.ExitStack() as held:
        files = [[held.enter_context(_opened(os.path.join(folder, f"{name}{turn}"))) for name in ("bwt", "lcp")] for turn in (0, 1)]
        bwt, lcp = _transform(symbols, first, sizes, depth, files)
    found = lcp >= depth
    found[:-1] |= found[1:].copy()
    order = _order(bwt)
    rank = np.empty(len(bwt), np.int64)
    rank[order] = np.arange(len(bwt))
    ended = int((bwt == 0).sum())
    place = np.arange(m)
    hits_owner, hits_start = [], []
    for j in range(1, sizes.max() + 1):
        active = np.flatnonzero(sizes >= j)
        place[active] = m + rank[place[active]] - ended
        hit = active[found[place[active]]]
        hits_owner.append(owner[hit])
        hits_start.append(ends[hit] - symbol * j)
    hits_owner, hits_start = np.concatenate(hits_owner), np.concatenate(hits_start)
    sort = np.argsort(offsets[hits_owner] + hits_start)
    return hits_owner[sort], hits_start[sort]


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column of texts or byte strings, one behind another, and the length of each; a null has none."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    edges = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset) if len(column) else np.zeros(1, np.int64)
    held = column.buffers()[2] if edges[-1] > edges[0] else None
    return np.frombuffer(held, np.uint8)[edges[0] : edges[-1]] if held else np.empty(0, np.uint8), np.diff(edges)


def _fields(column: pa.Array, *names: str) -> tuple[np.ndarray, ...]:
    """Row and fields of all structs in a column of lists; a null has none."""
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    inner = column.flatten()
    return np.repeat(np.arange(len(column)), sizes), *(pc.struct_field(inner, name).to_numpy(zero_copy_only=False) for name in names)


def _count_runs(k: int, window: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = LeastHashes(k, window, 0)
        for batch in batches:
            _, keys, _, _, weights = hashes.runs(*_bytes(batch.column(0)), weighed=True)
            keys, at = np.unique(keys, return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.bincount(at, weights, len(keys)).astype(np.int64))], names=["group", "n"])

    return count


def _emit_runs(k: int, window: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = LeastHashes(k, window, 0)
        for batch in batches:
            text, keys, first, windows, _ = hashes.runs(*_bytes(batch.column("text")))
            arrays = [pa.array(keys), batch.column("digest").take(pa.array(text)), *[pa.array(x.astype(np.int32)) for x in (first, windows)]]
            yield pa.RecordBatch.from_arrays(arrays, names=["group", "digest", "first", "windows"])

    return emit


def _strings(data: np.ndarray, lengths: np.ndarray, parents: pa.Array, runs: tuple[np.ndarray, ...], window: int) -> Iterator[pa.RecordBatch]:
    """The strings of runs ``text, group, first, windows`` of the texts, about 8 MB at a time."""
    text, group, first, windows = runs
    start = (np.cumsum(lengths) - lengths)[text] + first
    stop = start + windows + window - 1
    raw = memoryview(data)
    part = np.cumsum(stop - start) >> 23
    edges = [*np.flatnonzero(np.diff(part, prepend=-1)), len(part)]
    for a, b in zip(edges, edges[1:]):
        strings = [bytes(raw[i:j]) for i, j in zip(start[a:b].tolist(), stop[a:b].tolist())]
        arrays = [
            pa.array(group[a:b]),
            pa.array([hashlib.md5(x).digest() for x in strings], pa.binary()),
            parents.take(pa.array(text[a:b])),
            pa.array(first[a:b].astype(np.int32)),
            pa.array(strings, pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(arrays, names=["group", "id", "digest", "first", "string"])


def _cut_strings(window: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = _fields(batch.column("runs"), "group", "first", "windows")
            yield from _strings(*_bytes(batch.column("text")), batch.column("digest"), runs, window)

    return cut


def _split_strings(k: int, window: int, salt: int):
    """Strings of heavy groups by another hash, at last (``k`` a whole window) window by window."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = LeastHashes(k, window, salt)
        for batch in batches:
            data, lengths = _bytes(batch.column("string"))
            yield from _strings(data, lengths, batch.column("id"), hashes.runs(data, lengths)[:4], window)

    return split


def _spans(owner: np.ndarray, start: np.ndarray, window: int, lengths: np.ndarray, whole: np.ndarray) -> pa.Array:
    """For each string the maximal byte runs that its windows cover, or that it is covered as a whole."""
    some = ~whole[owner]
    owner, start = owner[some], start[some]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (np.diff(start) > window)
    last = np.append(new[1:], True)[: len(new)]
    of = np.append(owner[new], np.flatnonzero(whole))
    begin = np.append(start[new], np.zeros(whole.sum(), np.int64))
    end = np.append(start[last] + window, lengths[whole])
    sort = np.argsort(of, kind="stable")
    edges = np.append(0, np.cumsum(np.bincount(of, minlength=len(lengths))))
    spans = pa.StructArray.from_arrays([pa.array(x[sort].astype(np.int32)) for x in (begin, end)], names=["from", "to"])
    return pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), spans)


def _build(window: int, collection_bytes: int):
    """Covered spans of the strings; equal groups come together, as rows are sorted by group."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings: list[bytes] = []
        ids: list[bytes] = []
        copies: list[int] = []
        size, last = 0, None

        def spans(folder: str) -> pa.RecordBatch:
            lengths = np.array(list(map(len, strings)))
            found = _spans(*_repeated(strings, window, folder), window, lengths, np.array(copies) > 1)
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), found], names=["id", "spans"])

        with tempfile.TemporaryDirectory(prefix="collection-") as folder:
            for batch in batches:
                for group, i, string, n in zip(*(batch.column(c).to_pylist() for c in ("group", "id", "string", "copies"))):
                    if size > collection_bytes and group != last:
                        yield spans(folder)
                        strings, ids, copies, size = [], [], [], 0
                    strings.append(string)
                    ids.append(i)
                    copies.append(n)
                    size, last = size + len(string), group
            if strings:
                yield spans(folder)

    return build


def _build_tasks(total: int, collection_bytes: int, partitions: int) -> int:
    """Tasks of a few collections as long as they are no more than ``partitions``, larger ones beyond that."""
    return max(total // TASK_BYTES, min(total // (4 * collection_bytes), partitions)) + 1


def _repeated_spans(occurrences: DataFrame, window: int, seed_bytes: int, collection_bytes: int, group_bytes: int, level: int = 0) -> DataFrame:
    """``digest, spans`` from occurrences ``group, id, digest, first, string`` of strings in texts (or in longer strings)."""
    strings = occurrences.groupBy("group", "id").agg(F.first("string").alias("string"), F.count(F.lit(1)).alias("copies"))
    strings = staged(strings, "repeats-strings")
    sizes = strings.groupBy(F.col("group").alias("s_group")).agg(F.sum(F.length("string")).alias("bytes"))
    heavy = staged(sizes.filter(F.col("bytes") > group_bytes).select("s_group"), "repeats-heavy")
    of_heavy = F.col("group") == F.col("s_group")
    any_heavy = level < 3 and not heavy.isEmpty()
    light = strings.join(heavy, of_heavy, "left_anti") if any_heavy else strings
    total = strings.agg(F.sum(F.length("string"))).first()[0] or 0
    tasks = _build_tasks(total, collection_bytes, int(strings.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    light = light.repartition(tasks, "group").sortWithinPartitions("group", "id")
    schema = "id binary, spans array<struct<from:int,to:int>>"
    found = light.mapInArrow(_build(window, collection_bytes), schema)
    if any_heavy:
        k = window if level == 2 else seed_bytes
        parts = strings.join(heavy, of_heavy, "left_semi").select("id", "string").distinct()
        parts = staged(parts.mapInArrow(_split_strings(k, window, level + 1), occurrences.schema), "repeats-parts")
        below = _repeated_spans(parts, window, seed_bytes, collection_bytes, group_bytes, level + 1).withColumnRenamed("digest", "id")
        whole = strings.join(heavy, of_heavy, "left_semi").filter("copies > 1")
        whole = whole.select("id", F.array(F.struct(F.lit(0).alias("from"), F.length("string").alias("to"))).alias("spans"))
        found = found.unionByName(below).unionByName(whole)
    found = staged(found.filter(F.size("spans") > 0), "repeats-found").withColumnRenamed("id", "f_id")
    placed = occurrences.select("digest", "id", "first").join(found, F.col("id") == F.col("f_id")).distinct()
    moved = F.transform("spans", lambda s: F.struct((s["from"] + F.col("first")).alias("from"), (s["to"] + F.col("first")).alias("to")))
    return placed.groupBy("digest").agg(F.flatten(F.collect_list(moved)).alias("spans"))


def _merged(lengths: np.ndarray, owner: np.ndarray, begin: np.ndarray, end: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, ...]:
    """Text, begin and end of the spans' unions, in order; a ``whole`` text is one span."""
    some = ~whole[owner]
    owner = np.append(owner[some], np.flatnonzero(whole))
    begin = np.append(begin[some], np.zeros(whole.sum(), np.int64)).astype(np.int64)
    end = np.append(end[some], lengths[whole]).astype(np.int64)
    sort = np.lexsort((begin, owner))
    owner, begin, end = owner[sort], begin[sort], end[sort]
    at = (np.cumsum(lengths) - lengths)[owner]
    reach = np.maximum.accumulate(at + end) - at if len(at) else end
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (begin[1:] > reach[:-1])
    last = np.append(new[1:], True)[: len(new)]
    return owner[new], begin[new], reach[last]


def _whole_characters(raw: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans without the characters that they hold only in part."""
    out = []
    for a, b in spans:
        while a < b and raw[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(raw) and raw[b] & 0xC0 == 0x80:
            b -= 1
        if b > a:
            out.append((a, b))
    return out


def _apply(window: int, with_text: bool):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            data, lengths = _bytes(column)
            whole = (batch.column("copies").fill_null(1).to_numpy(zero_copy_only=False) > 1) & (lengths >= window)
            owner, begin, end = _merged(lengths, *_fields(batch.column("spans"), "from", "to"), whole)
            n_spans = np.bincount(owner, minlength=len(lengths))
            n_removed = np.bincount(owner, end - begin, len(lengths)).astype(np.int64)
            last = np.cumsum(n_spans).tolist()
            pairs = list(zip(begin.tolist(), end.tolist()))
            view, at, digests, texts = memoryview(data), 0, [], []
            for n, spans_to, spans_from, there in zip(lengths.tolist(), last, [0, *last], column.is_valid().to_pylist()):
                raw, spans, at = view[at : at + n], pairs[spans_from:spans_to], at + n
                edges = [0, *[x for s in spans for x in s], n]
                digest = hashlib.sha256()
                for a, b in zip(edges[::2], edges[1::2]):
                    digest.update(raw[a:b])
                digests.append(digest.hexdigest())
                if with_text:
                    edges = [0, *[x for s in _whole_characters(raw, spans) for x in s], n]
                    texts.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])).decode("utf-8", "surrogatepass") if there else None)
            carried = [c for c in batch.schema.names if c.startswith("in_")]
            arrays = [*[batch.column(c) for c in carried], *[pa.array(x, pa.int64()) for x in (lengths, n_removed, n_spans)], pa.array(digests, pa.string())]
            names = [*carried, "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            yield pa.RecordBatch.from_arrays([*arrays, *([pa.array(texts, pa.string())] if with_text else [])], names=[*names, *(["kept_text"] if with_text else [])])

    return apply


def remove_repeats(
    documents: DataFrame,
    *,
    text_col: str = "text",
    window: int = 200,
    seed_bytes: int = 48,
    collection_bytes: int = 1 << 17,
    group_bytes: int = 16 << 20,
    carry: tuple[str, ...] | None = None,
    with_text: bool = True,
) -> DataFrame:
    """The input's columns (of these ``carry``, by default all), ``n_bytes, n_removed, n_spans, kept_sha256`` and ``kept_text``.

    ``kept_text`` keeps characters that a span covers only in part; the other columns are exact in bytes.  ``window`` is a
    multiple of eight.
    """
    if window % 8 or seed_bytes > window:
        raise ValueError("window must be a multiple of eight and at least seed_bytes")
    rows, inner = shielded(documents)
    carried = {name: i for name, i in inner.items() if carry is None or name in carry}
    rows = rows.select(*carried.values(), F.col(inner[text_col]).cast("string").alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.md5(F.col("text").cast("binary"))))
    long_rows = rows.filter(F.octet_length("text") >= window).select("digest", "text")
    copies = staged(long_rows.groupBy("digest").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1"), "repeats-copies")

    counts = long_rows.select("text").mapInArrow(_count_runs(seed_bytes, window), "group bigint, n bigint")
    shared = staged(counts.groupBy("group").agg(F.sum("n").alias("n")).filter("n > 1").select(F.col("group").alias("g")), "repeats-groups")
    runs = long_rows.mapInArrow(_emit_runs(seed_bytes, window), "group bigint, digest binary, first int, windows int")
    runs = runs.join(shared, F.col("group") == F.col("g"), "left_semi").distinct()
    runs = runs.groupBy(F.col("digest").alias("r_digest")).agg(F.collect_list(F.struct("group", "first", "windows")).alias("runs"))
    runs = staged(runs, "repeats-runs")
    occurrences = long_rows.join(runs, F.col("digest") == F.col("r_digest")).select("digest", "text", "runs")
    occurrences = occurrences.mapInArrow(_cut_strings(window), "group bigint, id binary, digest binary, first int, string binary")
    occurrences = staged(occurrences, "repeats-occurrences")
    spans = _repeated_spans(occurrences, window, seed_bytes, collection_bytes, group_bytes)
    spans = staged(spans.join(copies, "digest", "full"), "repeats-spans").withColumnRenamed("digest", "s_digest")
    out = rows.join(spans, F.col("digest") == F.col("s_digest"), "left").drop("digest", "s_digest")
    added = ["n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept_text"] if with_text else [])]
    schema = out.select(*carried.values()).schema
    for name in added:
        schema = schema.add(name, "string" if name in ("kept_sha256", "kept_text") else "long")
    return out.mapInArrow(_apply(window, with_text), schema).select(*unshielded(carried, added), *added)
