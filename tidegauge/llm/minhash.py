"""Near-duplicate documents by MinHash with tensored banding.

A document's set of word shingles gives a small collection of ``collection`` sub-keys, each of ``rows`` minima.  A table key
is a pair of sub-keys, so c sub-keys serve c (c - 1) / 2 tables: the minima needed grow with the square root of the tables.
Two documents of similarity s meet in some table with the probability that two sub-keys of c agree, each with s ** rows:
0.9996 for c = 20, rows = 4 at s = 0.8, more above.  Pairs are formed only from sub-keys that at least two documents have,
which leaves out most documents without a near copy before the tables.

Documents with equal sets are one class first.  In each bucket the members are compared with one of them, the hub; the links
join components, and only hubs whose buckets still hold several components go on: there the members of different components
are compared in blocks of about ``block_shingles``, pairs of blocks by tasks of their own that return a spanning forest.  So a
bucket of thousands of copies needs one comparison each, no pair of different components is left out, and no link is taken
without its whole sets.

Defined results: a null text, or one without words, has an empty set and links with nothing; documents with a null id belong
to the class of their set, but a class without any id is linked with no other; repeated rows are one class; an empty table
gives an empty result.  Input columns may have any names; an added column replaces one of the same name.  With ``by_row`` rows
count by themselves: equal and null ids are rows like others, and exactly one row of a component is kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from tidegauge.llm.components import connected_components
from tidegauge.llm.shared import drop_staged, shielded, staged, unshielded

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingles:
    """Distinct shingles of texts as sorted 64-bit hashes; A-Z count as a-z, words part at ASCII white space."""

    def __init__(self, words: int, remembered: int = 500_000):
        self.words, self.remembered, self.known = words, remembered, {}

    def __call__(self, text: str | None) -> np.ndarray:
        parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if len(self.known) > self.remembered:
            self.known.clear()
        known, digest = self.known, xxhash.xxh64_intdigest
        for part in set(parts).difference(known):
            known[part] = digest(part)
        h = np.fromiter(map(known.__getitem__, parts), np.uint64, len(parts))
        n = min(self.words, len(h))
        if not n:
            return h
        out = np.full(len(h) - n + 1, n, np.uint64)
        for i in range(n):
            out = _mixed(out * _M1 + h[i : len(h) - n + 1 + i] * _M2)
        return np.unique(out)


class SubKeys:
    """The collection of sub-keys of a set: ``collection`` hashes of ``rows`` minima each."""

    def __init__(self, collection: int, rows: int, seed: int = 8):
        draw = np.random.default_rng(seed)
        self.collection, self.rows = collection, rows
        self.factors = draw.integers(1, 1 << 63, collection * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.shifts = draw.integers(0, 1 << 63, collection * rows, dtype=np.uint64)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        least = np.full(len(self.factors), np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(hashes), 4096):
            part = hashes[None, at : at + 4096] * self.factors[:, None] + self.shifts[:, None]
            np.minimum(least, part.min(axis=1), out=least)
        keys = np.arange(self.collection, dtype=np.uint64)
        for row in least.reshape(self.collection, self.rows).T:
            keys = _mixed(keys * _M1 + row * _M2)
        return keys.view(np.int64)


def _signer(words: int, collection: int, rows: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, sub_keys = Shingles(words), SubKeys(collection, rows)
        for batch in batches:
            sizes, digests, keys = [], [], []
            for text in batch.column("text").to_pylist():
                found = shingles(text)
                sizes.append(len(found))
                digests.append(hashlib.md5(found.tobytes()).digest() if len(found) else None)
                keys.append(sub_keys(found) if len(found) else None)
            carried = [c for c in batch.schema.names if c.startswith("in_")]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in carried], batch.column("id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                names=[*carried, "id", "n_shingles", "digest", "keys"],
            )

    return sign


def _texts_of(words: int):
    """Texts whose set is that of the class: an id may stand for several texts."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(words)
        for batch in batches:
            wanted = zip(batch.column("text").to_pylist(), batch.column("digest").to_pylist())
            same = [hashlib.md5(shingles(text).tobytes()).digest() == digest for text, digest in wanted]
            yield batch.select(["class", "text"]).filter(pa.array(same, pa.bool_()))

    return keep


def _confirmer(words: int, percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(words)
        last, hub = None, None
        for batch in batches:
            a, b, keep = batch.column("a").to_pylist(), batch.column("b").to_pylist(), []
            texts_a = batch.column("text_a")
            for i, text in enumerate(batch.column("text_b").to_pylist()):
                if a[i] != last:
                    last, hub = a[i], shingles(texts_a[i].as_py())
                own = shingles(text)
                common = len(np.intersect1d(hub, own, assume_unique=True))
                keep.append(100 * common >= percent * (len(hub) + len(own) - common))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return confirm


def _block_links(words: int, percent: int):
    """A spanning forest of the links between different components of a block, or between two blocks."""

    def bits(rows: list[np.ndarray], every: np.ndarray) -> np.ndarray:
        out = np.zeros((len(rows), -(-len(every) // 64) * 64), bool)
        for line, own in zip(out, rows):
            line[np.searchsorted(every, own)] = True
        return np.packbits(out, axis=1).view(np.uint64)

    def compare(block: pd.DataFrame) -> pd.DataFrame:
        shingles = Shingles(words)
        sets = [shingles(text) for text in block["text"]]
        size, names, side = np.array(list(map(len, sets))), block["class"].to_numpy(), block["side"].to_numpy()
        root = dict(zip(block["component"], block["component"]))

        def find(x):
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        every, counts = np.unique(np.concatenate(sets), return_counts=True)
        every = every[counts > 1]  # shingles of one member only are in no intersection
        table = bits([own[np.isin(own, every, assume_unique=True)] for own in sets], every)
        component = block["component"].to_numpy()
        within = not side.any()
        found: list[tuple[int, int]] = []
        for x in np.flatnonzero(side == 0):
            others = np.flatnonzero((component != component[x]) & (size * 100 >= percent * size[x]) & (size[x] * 100 >= percent * size) & ((side == 1) | within))
            if within:
                others = others[others > x]
            common = np.bitwise_count(table[others] & table[x]).sum(axis=1, dtype=np.int64)
            for y in others[100 * common >= percent * (size[others] + size[x] - common)]:
                a, b = find(component[x]), find(component[y])
                if a != b:
                    root[max(a, b)] = min(a, b)
                    found.append((names[x], names[y]))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return compare


def _buckets(classes: DataFrame) -> DataFrame:
    """``bucket, class, n`` for buckets of two classes or more; buckets with the same members are one."""
    single = classes.select("class", "n", F.explode("keys").alias("sub_key"))
    shared = single.groupBy(F.col("sub_key").alias("key")).agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("key")
    own = single.join(shared, F.col("sub_key") == F.col("key")).groupBy("class").agg(F.first("n").alias("n"), F.collect_list("sub_key").alias("own"))
    own = own.withColumn("own", F.sort_array("own"))
    # Sub-keys hold their number in the collection, so a pair of values is a table and its key.
    tensored = F.flatten(F.transform("own", lambda x, i: F.transform(F.slice("own", i + 2, F.size("own")), lambda y: F.xxhash64(x, y))))
    rows = staged(own.filter(F.size("own") > 1).select("class", "n", F.explode(tensored).alias("bucket")), "minhash-tables")
    h = F.xxhash64("class")
    members = [F.count(F.lit(1)).alias("m"), F.min("class").alias("least"), F.max("class").alias("most"), F.bit_xor(h).alias("x"), F.sum(h.cast("decimal(38,0)")).alias("s")]
    alike = rows.groupBy(F.col("bucket").alias("key")).agg(*members).filter("m > 1").groupBy("m", "least", "most", "x", "s").agg(F.min("key").alias("key"))
    found = staged(rows.join(alike.select("key", "m"), F.col("bucket") == F.col("key")).select("bucket", "class", "n", "m"), "minhash-buckets")
    drop_staged(rows)
    return found


def link_documents(
    documents: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    percent: int = 80,
    collection: int = 20,
    rows: int = 4,
    block_shingles: int = 200_000,
    carry: tuple[str, ...] | None = None,
    by_row: bool = False,
) -> DataFrame:
    """The input's columns (of these ``carry``, by default all), ``n_shingles, component_id, kept``.

    Links are pairs whose shingle sets have ``percent`` of their union in common; a component keeps its smallest id.
    ``by_row`` keeps one row of it, and links rows without an id too: of the smallest id the row of the least text hash.
    """
    frame, inner = shielded(documents)
    carried = {name: i for name, i in inner.items() if carry is None or name in carry}
    base = frame.withColumns({"id": F.col(inner[id_col]), "text": F.col(inner[text_col]).cast("string")})
    held = {**carried, text_col: inner[text_col]} if by_row else carried
    base = base.select(*held.values(), "id", "text")
    schema = base.drop("text").schema.add("n_shingles", "long").add("digest", "binary").add("keys", ArrayType(LongType()))
    signed = base.mapInArrow(_signer(words, collection, rows), schema)
    if by_row:
        text = F.col(inner[text_col]).cast("string")
        row = [F.col("id").isNull().alias("no_id"), "id", F.xxhash64(text).alias("hash"), F.monotonically_increasing_id().alias("row")]
        signed = signed.withColumn("id", F.struct(*row))
    signed = staged(signed, "minhash-signed")
    if by_row:  # row numbers hold from here on
        base = signed.select("id", text.alias("text"))

    classes = signed.filter("digest is not null").groupBy("digest").agg(
        F.first("n_shingles").alias("n"), F.min("id").alias("least_id"), F.count(F.lit(1)).alias("copies"), F.first("keys").alias("keys")
    )
    classes = staged(classes.withColumn("class", F.monotonically_increasing_id()), "minhash-classes")
    members = _buckets(classes.filter("least_id is not null"))
    wanted = members.select("class").distinct().join(classes.select("class", "least_id", "digest"), "class")
    texts = base.select("id", "text").join(wanted, F.col("id") == F.col("least_id")).select("class", "digest", "text")
    texts = texts.mapInArrow(_texts_of(words), "class bigint, text string").dropDuplicates(["class"])
    texts = staged(texts, "minhash-texts")

    def confirmed(pairs: DataFrame) -> DataFrame:
        """Those of the pairs ``a, b`` that are links."""
        near = pairs.join(texts.withColumnsRenamed({"class": "class_b", "text": "text_b"}), F.col("b") == F.col("class_b"))
        near = near.join(texts.withColumnsRenamed({"class": "class_a", "text": "text_a"}), F.col("a") == F.col("class_a"))
        return near.select("a", "b", "text_a", "text_b").mapInArrow(_confirmer(words, percent), "a bigint, b bigint")

    def near_in_size(n_a: str, n_b: str):
        return 100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)

    # First each bucket's smallest class with all others.
    hubs = members.groupBy(F.col("bucket").alias("hub_bucket")).agg(F.min(F.struct("class", "n")).alias("hub"))
    around = members.join(hubs, F.col("bucket") == F.col("hub_bucket")).select(F.col("hub.class").alias("hub"), F.col("hub.n").alias("hub_n"), "class", "n")
    around = staged(around.distinct(), "minhash-hubs")
    pairs = around.filter((F.col("hub") != F.col("class")) & near_in_size("hub_n", "n")).select(F.col("hub").alias("a"), F.col("class").alias("b"))
    links = staged(confirmed(pairs), "minhash-links")
    groups = connected_components(links)
    # Then, where the members of a hub's buckets are still of several components, those of different ones, block by block.
    # All buckets with one hub are one group, so a class that meets a hub in many tables is there once.
    live = around.join(groups, F.col("class") == F.col("node"), "left").select("hub", "class", "n", F.coalesce("component", "class").alias("component"))
    weight = F.sum(F.col("n") + block_shingles // 2000)
    several = live.groupBy(F.col("hub").alias("live_hub")).agg(
        F.min("component").alias("c0"), F.max("component").alias("c1"), F.ceil(weight / block_shingles).cast("int").alias("blocks")
    )
    live = live.join(several.filter("c0 <> c1").select("live_hub", "blocks"), F.col("hub") == F.col("live_hub"))
    live = staged(live.withColumn("own", F.pmod(F.xxhash64("class", "hub"), F.col("blocks")).cast("int")).drop("live_hub"), "minhash-live")
    as_first = F.transform(F.sequence("own", F.col("blocks") - 1), lambda j: F.struct(F.col("own").alias("i"), j.alias("j"), F.lit(0).alias("side")))
    as_second = F.transform(F.sequence(F.lit(0), F.col("own") - 1), lambda i: F.struct(i.alias("i"), F.col("own").alias("j"), F.lit(1).alias("side")))
    paired = live.withColumn("pair", F.explode(F.when(F.col("own") > 0, F.concat(as_first, as_second)).otherwise(as_first)))
    paired = paired.select("hub", "pair.*", "class", "component").join(texts.withColumnRenamed("class", "t_class"), F.col("class") == F.col("t_class"))
    more = paired.groupBy("hub", "i", "j").applyInPandas(_block_links(words, percent), "a bigint, b bigint")
    more = staged(more.distinct(), "minhash-links")
    stars = groups.select(F.col("node").alias("a"), F.col("component").alias("b"))
    groups = connected_components(stars.unionByName(more))

    linked = classes.filter("least_id is not null").join(groups, F.col("class") == F.col("node"), "left")
    linked = linked.withColumn("component", F.coalesce("component", "class")).filter("copies > 1 or node is not null")
    least = linked.groupBy(F.col("component").alias("k_component")).agg(F.min("least_id").alias("component_id"))
    linked = linked.join(least, F.col("component") == F.col("k_component")).select(F.col("digest").alias("k_digest"), "component_id")
    linked = staged(linked, "minhash-linked")
    out = signed.drop("keys").join(linked, F.col("digest") == F.col("k_digest"), "left")
    out = out.withColumn("component_id", F.coalesce("component_id", "id")).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
    if by_row:
        out = out.withColumn("component_id", F.col("component_id.id"))
    added = ["n_shingles", "component_id", "kept"]
    return out.select(*unshielded(carried, added), *added)
