"""Near-duplicate vectors: cells by spherical k-means, blocked cosine products within them.

Vectors are compared when their labels are equal.  Equal vectors are one class first.  Each label's classes are dealt to
cells by the nearest centroid.  No link is lost at a cell's border: a vector also visits every later cell that could be the
home of a vector within the angle, which holds unless ``x . (c - a) < -sin(angle) |c - a|`` for its own centroid a and
the other centroid c.  A cell of any size is cut into blocks, and pairs of blocks are compared by tasks of their own; a
task returns the number of links per class and a spanning forest, not the pairs.

Centroids are fitted on a sample of about ``sample`` classes per cell and number at most ``max_cells`` per label.  All
classes are compared.  Where vectors have no clusters, most cells are visited by most vectors and the work is that of all
pairs of a label, block by block.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and null labels, link with nothing;
vectors of different length link with nothing; repeated rows are copies of each other; null ids are never the smallest, and
a component of null ids only has a null id; an empty table gives an empty result.  Input columns may have any names; an
added column replaces one of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.components import connected_components
from tidegauge.llm.shared import shielded, staged, unshielded


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """``k`` unit centroids of unit vectors; the first vectors, which are in hash order, are the seeds."""
    c = x[:k].copy()
    for _ in range(rounds):
        home = (x @ c.T).argmax(axis=1)
        new = np.zeros_like(c)
        np.add.at(new, home, x)
        size = np.linalg.norm(new, axis=1)
        new[size > 0] /= size[size > 0, None]
        new[size == 0] = c[size == 0]
        if np.allclose(new, c):
            break
        c = new
    return c


def _unit(column) -> np.ndarray:
    x = np.array(column.tolist(), np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _fit(sample: pd.DataFrame) -> pd.DataFrame:
    sample = sample.sort_values("class")
    cells = int(sample["cells"].iloc[0])
    centroids = spherical_kmeans(_unit(sample["vector"]), min(cells, len(sample)))
    return pd.DataFrame({"c_label": sample["label"].iloc[:1], "c_size": sample["size"].iloc[:1], "centroids": [centroids.ravel()]})


def _deal(angle_sin: float):
    """Home cell of each class, and the later cells that it has to visit."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frame = batch.to_pandas()
            rows, cells, visits = [], [], []
            for _, group in frame.groupby(["label", "size"], sort=False):
                x, at = _unit(group["vector"]), group.index.to_numpy()
                flat = group["centroids"].iloc[0]
                if flat is None:
                    home = np.zeros(len(x), np.int64)
                else:
                    c = np.asarray(flat, np.float64).reshape(-1, x.shape[1])
                    near = x @ c.T
                    home = near.argmax(axis=1)
                    apart = np.linalg.norm(c[:, None, :] - c[None, :, :], axis=2)
                    near -= near[np.arange(len(x)), home][:, None]
                    visited = near >= -angle_sin * apart[home] - 1e-9
                    visited &= np.arange(len(c))[None, :] > home[:, None]
                    who, where = visited.nonzero()
                    rows.append(at[who])
                    cells.append(where)
                    visits.append(np.ones(len(who), bool))
                rows.append(at)
                cells.append(home)
                visits.append(np.zeros(len(x), bool))
            if rows:
                taken = batch.select(["label", "size", "class", "copies", "vector"]).take(pa.array(np.concatenate(rows)))
                yield pa.RecordBatch.from_arrays(
                    [*taken.columns, pa.array(np.concatenate(cells).astype(np.int32)), pa.array(np.concatenate(visits))],
                    names=[*taken.schema.names, "cell", "visitor"],
                )

    return deal


def _roots(linked: np.ndarray) -> np.ndarray:
    """Smallest index of each node's component, from a symmetric matrix of links."""
    n = len(linked)
    label = np.arange(n)
    while True:
        new = np.minimum(label, np.where(linked, label[None, :], n).min(axis=1))
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compare(cosine: float):
    def compare(block: pd.DataFrame) -> pd.DataFrame:
        left, right = block[block["side"] == 0], block[block["side"] == 1]
        same = not len(right)
        right = left if same else right
        if not len(left):
            return pd.DataFrame({"class": [], "links": [], "root": []})
        linked = _unit(left["vector"]) @ _unit(right["vector"]).T >= cosine
        if same:
            np.fill_diagonal(linked, False)
        lines, columns = linked.any(axis=1).nonzero()[0], linked.any(axis=0).nonzero()[0]
        linked = linked[np.ix_(lines, columns)]
        left, right = left.iloc[lines], right.iloc[columns]
        names = left["class"].to_numpy()
        links = linked @ right["copies"].to_numpy()
        if same:
            whole = linked
        else:
            names = np.concatenate([names, right["class"].to_numpy()])
            links = np.concatenate([links, linked.T @ left["copies"].to_numpy()])
            a, b = linked.shape
            whole = np.zeros((a + b, a + b), bool)
            whole[:a, a:], whole[a:, :a] = linked, linked.T
        return pd.DataFrame({"class": names, "links": links, "root": names[_roots(whole)] if len(names) else names})

    return compare


def link_vectors(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    cosine: float = 0.93,
    cell_rows: int = 2048,
    max_cells: int = 256,
    sample: int = 128,
    block_rows: int = 2048,
) -> DataFrame:
    """All input columns plus ``n_links, component_id, kept``: one representative, with the smallest id, of each component."""
    rows, inner = shielded(vectors)
    vector = F.col(inner[vector_col]).cast("array<double>")
    label = F.col(inner[label_col]).cast("string")
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(vector, lambda x: x != 0)
    key = F.md5(F.concat_ws("|", label, F.array_join(vector.cast("array<string>"), ",")))
    rows = rows.withColumns(
        {"id": F.col(inner[id_col]), "label": label, "vector": F.when(label.isNotNull() & ok, vector), "class": F.when(label.isNotNull() & ok, key)}
    )
    # Equal vectors of a label become one class; whoever holds a third of all rows is one row from here on.
    classes = rows.filter("class is not null").groupBy("class").agg(
        F.first("label").alias("label"), F.first("vector").alias("vector"), F.min("id").alias("least_id"), F.count(F.lit(1)).alias("copies")
    )
    classes = staged(classes.withColumn("size", F.size("vector")), "vector-classes")
    cells = F.least(F.ceil(F.col("n") / cell_rows), F.lit(max_cells)).cast("int")
    counts = classes.groupBy(F.col("label").alias("n_label"), F.col("size").alias("n_size")).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("cells", cells).filter("cells > 1")
    drawn = F.conv(F.substring("class", 1, 12), 16, 10).cast("double") / float(1 << 48) < F.col("cells") * sample / F.col("n")
    fitted = (
        classes.select("label", "size", "class", "vector")
        .join(counts, (F.col("label") == F.col("n_label")) & (F.col("size") == F.col("n_size")))
        .filter(drawn)
        .groupBy("label", "size")
        .applyInPandas(_fit, "c_label string, c_size int, centroids array<double>")
    )
    fitted = staged(fitted, "vector-centroids")
    on_label = (F.col("label") == F.col("c_label")) & (F.col("size") == F.col("c_size"))
    dealt = classes.drop("least_id").join(fitted, on_label, "left").drop("c_label", "c_size")
    schema = "label string, size int, class string, copies bigint, vector array<double>, cell int, visitor boolean"
    dealt = staged(dealt.mapInArrow(_deal(float(np.sqrt(1 - cosine * cosine))), schema), "vector-cells")

    def blocks(visitor: bool, name: str) -> DataFrame:
        number = F.ceil(F.count(F.lit(1)) / block_rows).cast("int")
        keys = [F.col(k).alias(f"{name}_{k}") for k in ("label", "size", "cell")]
        return dealt.filter(F.col("visitor") == visitor).groupBy(*keys).agg(number.alias(name))

    def at(name: str):
        return (F.col("label") == F.col(f"{name}_label")) & (F.col("size") == F.col(f"{name}_size")) & (F.col("cell") == F.col(f"{name}_cell"))

    counted = blocks(False, "homes").join(
        blocks(True, "guests").withColumnsRenamed({"guests_label": "g_label", "guests_size": "g_size", "guests_cell": "g_cell"}),
        (F.col("homes_label") == F.col("g_label")) & (F.col("homes_size") == F.col("g_size")) & (F.col("homes_cell") == F.col("g_cell")),
        "left",
    )
    counted = staged(counted.select("homes_label", "homes_size", "homes_cell", "homes", F.coalesce("guests", F.lit(0)).alias("guests")), "vector-blocks")
    placed = dealt.join(counted, at("homes"))
    own = F.pmod(F.xxhash64("class"), F.when(F.col("visitor"), F.col("guests")).otherwise(F.col("homes"))).cast("int")
    placed = placed.withColumn("own", own)
    # A pair of blocks is (home i, home j) with i <= j, or (home i, guest homes + j); side 0 is the first block.
    last = F.col("homes") + F.col("guests") - 1
    as_first = F.transform(F.sequence("own", last), lambda j: F.struct(F.col("own").alias("i"), j.alias("j"), F.lit(0).alias("side")))
    as_second = F.transform(F.sequence(F.lit(0), F.col("own") - 1), lambda i: F.struct(i.alias("i"), F.col("own").alias("j"), F.lit(1).alias("side")))
    as_guest = F.transform(
        F.sequence(F.lit(0), F.col("homes") - 1), lambda i: F.struct(i.alias("i"), (F.col("homes") + F.col("own")).alias("j"), F.lit(1).alias("side"))
    )
    at_home = F.when(F.col("own") > 0, F.concat(as_first, as_second)).otherwise(as_first)
    pairs = placed.withColumn("pair", F.explode(F.when(F.col("visitor"), as_guest).otherwise(at_home)))
    pairs = pairs.select("label", "size", "cell", F.col("pair.i").alias("i"), F.col("pair.j").alias("j"), F.col("pair.side").alias("side"), "class", "copies", "vector")
    found = pairs.groupBy("label", "size", "cell", "i", "j").applyInPandas(_compare(cosine), "class string, links bigint, root string")
    found = staged(found, "vector-links")

    links = found.groupBy(F.col("class").alias("l_class")).agg(F.sum("links").alias("links"))
    groups = connected_components(found.select(F.col("class").alias("a"), F.col("root").alias("b")))
    linked = classes.select("class", "least_id", "copies").join(links, F.col("class") == F.col("l_class"), "left")
    linked = linked.filter("links is not null or copies > 1").join(groups, F.col("class") == F.col("node"), "left")
    linked = linked.withColumn("component", F.coalesce("component", "class"))
    least = linked.groupBy(F.col("component").alias("k_component")).agg(F.min("least_id").alias("component_id"))
    linked = linked.join(least, F.col("component") == F.col("k_component")).select(
        F.col("class").alias("k_class"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    linked = staged(linked, "vector-linked")
    out = rows.drop("vector").join(linked, F.col("class") == F.col("k_class"), "left")
    out = out.withColumns(
        {"n_links": F.coalesce("n_links", F.lit(0)).cast("long"), "component_id": F.when(F.col("k_class").isNull(), F.col("id")).otherwise(F.col("component_id"))}
    ).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
    added = ["n_links", "component_id", "kept"]
    return out.select(*unshielded(inner, added), *added)
