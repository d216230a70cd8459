"""Embedding near-dedup by products of int8 tiles with rigorous error bounds.

A unit vector is ``scale * codes + error`` with int8 codes. For two of them the exact cosine differs from the
product of the coded parts by at most ``|coded part| * |other's error| + |error|``, both known per vector. So
a tile of products decides almost all pairs; only those within the bound of the threshold are computed in
double precision.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.session import materialize

#: Room for rounding in the arithmetic of the bound itself, far above what it needs.
SLACK = 1e-5
_ROWS = 1024


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes, scale, norm of the coded part and norm of the error of each row."""
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    coded = codes * scale[:, None]
    return codes, scale, np.linalg.norm(coded, axis=1), np.linalg.norm(unit - coded, axis=1)


def linked(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of unit rows have cosine ``threshold`` or more."""
    ca, sa, na, ea = quantised(a)
    cb, sb, _, eb = quantised(b)
    # Sums of 127^2 per component stay exact in single precision up to 1,000 components.
    kind = np.float32 if a.shape[1] <= 1000 else np.float64
    about = (ca.astype(kind) @ cb.astype(kind).T) * (sa[:, None] * sb[None, :])
    bound = na[:, None] * eb[None, :] + ea[:, None] + SLACK
    links = about - bound >= threshold
    rows, columns = np.nonzero(np.abs(about - threshold) <= bound)
    for i in range(0, len(rows), 1 << 16):
        r, c = rows[i : i + (1 << 16)], columns[i : i + (1 << 16)]
        links[r, c] = np.einsum("ij,ij->i", a[r], b[c]) >= threshold
    return links


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges from nodes to the least node they reach: at most ``n`` for any number of links."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if np.array_equal(new, label):
            node = np.flatnonzero(label != np.arange(n))
            return node, label[node]
        label = new


def _tile_pair(threshold: float):
    def links(table: pa.Table) -> pa.Table:
        side = table.column("tile").to_numpy() != table.column("low").to_numpy()
        same = bool((table.column("low").to_numpy() == table.column("high").to_numpy())[0])
        unit = table.column("v").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)
        # Divided by the largest component first: squares of very large or small ones would leave the range.
        unit = unit / np.abs(unit).max(axis=1)[:, None]
        unit /= np.linalg.norm(unit, axis=1)[:, None]
        weight = table.column("copies").to_numpy().astype(np.float64)
        node = table.column("c").to_numpy()
        first = np.flatnonzero(~side)
        second = first if same else np.flatnonzero(side)
        count = np.zeros(len(node))
        edges = []
        for i in range(0, len(first) if len(second) else 0, _ROWS):
            rows = first[i : i + _ROWS]
            found = linked(unit[rows], unit[second], threshold)
            if same:
                found[np.arange(len(rows)), np.arange(i, i + len(rows))] = False
            count[rows] += found @ weight[second]
            if not same:
                count[second] += weight[rows] @ found
            x, y = np.nonzero(found)
            edges.append(_forest(rows[x], second[y], len(node)))
        some = np.flatnonzero(count)
        a = np.concatenate([e[0] for e in edges]) if edges else some[:0]
        b = np.concatenate([e[1] for e in edges]) if edges else some[:0]
        none = pa.nulls(len(some), pa.int64())
        return pa.table(
            {
                "a": pa.concat_arrays([pa.array(node[some]), pa.array(node[a])]),
                "b": pa.concat_arrays([none, pa.array(node[b])]),
                "n": pa.concat_arrays([pa.array(count[some].astype(np.int64)), pa.nulls(len(a), pa.int64())]),
            }
        )

    return links


def near_duplicates(df: DataFrame, threshold: float = 0.9, tile: int = 4096, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per row of ``df``: ``id_col, n_links, component_id, kept``.

    Vectors link at cosine ``threshold`` (above 0) or more. ``n_links`` counts the other rows linked directly,
    ``component_id`` is the least id that links reach, ``kept`` says whether that is the row's own. Vectors
    that are null, empty, zero, or hold null or non-finite components link with nothing, nor do vectors of
    different lengths. Equal vectors are one class with a weight, so copies make no pairs; near copies are
    counted in the task and leave a spanning forest, not all their links. Rows that share an id are rows of
    their own. Other columns are ignored.

    Work is one product per pair of classes, in blocks of ``tile`` by ``tile``: the square of the number of
    different vectors, as any comparison of all with all. Rows moved are classes times tiles.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must lie above 0 and not above 1")
    fine = F.coalesce(
        F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0), F.lit(False)
    )
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.select("id", F.when(fine, F.col("v")).alias("v"))
    classes = rows.where("v IS NOT NULL").groupBy("v").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
    # Numbered as it is written: a file's numbers don't change when it is read again.
    classes = materialize(classes.withColumn("c", F.monotonically_increasing_id()), "vectors")
    tiles = max(1, math.ceil(classes.count() / tile))
    own = F.pmod(F.xxhash64("c"), F.lit(tiles)).cast("int")
    dealt = classes.select("c", "copies", "v", F.size("v").alias("length"), own.alias("tile"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))))
    dealt = dealt.select("c", "copies", "v", "length", "tile", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"))
    found = materialize(dealt.groupBy("length", "low", "high").applyInArrow(_tile_pair(threshold), "a long, b long, n long"), "tiles")
    roots = components(found.where("b IS NOT NULL").select("a", "b"))
    counts = found.where("n IS NOT NULL").groupBy("a").agg(F.sum("n").alias("n"))
    rooted = (
        classes.join(counts, classes["c"] == counts["a"], "left")
        .join(roots, classes["c"] == roots["node"], "left")
        .select("v", "least", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "c").alias("root"))
    )
    rooted = materialize(rooted, "classes")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = materialize(rooted.join(least, "root").select("v", "n_links", "component_id"), "components")
    out = rows.where("v IS NOT NULL").join(of_class, "v").select("id", "n_links", "component_id")
    alone = rows.where("v IS NULL").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return out.unionByName(alone).select(
        F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )
