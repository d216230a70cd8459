"""Hard negatives by inner product, found by cover trees over norm-augmented vectors.

With one more component, ``sqrt(M^2 - |x|^2)`` for the largest norm ``M``, all candidates have norm ``M``, and
an anchor's inner product falls with its distance: ``2 <q, x> = M^2 + |q|^2 - |q - x|^2``. Candidates are dealt
to blocks of bounded size, near ones together. In a block centres are taken farthest first; those still apart
by half the radius, a quarter and so on are the levels of a cover tree. Each node keeps, for each level, the
radius that covers all below it, and so bounds the inner products of what it holds. Nodes whose bounds lie
outside an anchor's window are skipped with all below them; leaves are read best bound first, and their inner
products computed exactly, until no unread bound reaches the worst of those kept.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.session import materialize

#: Rows of a block and searches of a batch, on average: what a task holds at once.
BLOCK_ROWS, BATCH_SEARCHES = 4096, 4096
#: Rows from which block centres are taken, and their largest number; every row is then dealt to one.
SAMPLE_ROWS, PIVOTS = 4096, 256
#: Rows of a tree's leaf, on average.
LEAF_ROWS = 32
#: Integers up to here are exact in double precision.
EXACT = 2.0**53


def augmented(x: np.ndarray, top: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(top - np.einsum("ij,ij->i", x, x), 0))
    return np.hstack([x, rest[:, None]])


def farthest_first(x: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of at most ``most`` centres, how far each was from those before it, and each row's nearest centre."""
    centres, gaps = [0], [np.inf]
    squares = np.einsum("ij,ij->i", x, x)
    near = np.zeros(len(x), np.int64)
    far = np.full(len(x), np.inf)
    while True:
        c = x[centres[-1]]
        d = np.maximum(squares - 2 * (x @ c) + c @ c, 0)
        closer = d < far
        near[closer] = len(centres) - 1
        far[closer] = d[closer]
        far[centres[-1]] = 0
        i = int(far.argmax())
        if len(centres) == most or far[i] <= 1e-9 * squares[0]:
            return np.array(centres), np.sqrt(np.array(gaps)), near
        centres.append(i)
        gaps.append(far[i])


class CoverTree:
    """Levels of centres; rows hang at the nearest centre of the last level."""

    def __init__(self, x: np.ndarray, leaf_rows: int = LEAF_ROWS):
        centres, gaps, leaf = farthest_first(x, max(1, math.ceil(len(x) / leaf_rows)))
        self.centres = x[centres]
        span = gaps[1] if len(gaps) > 1 else 1.0
        level = np.zeros(len(gaps), np.int64)
        level[1:] = 1 + np.floor(np.log2(span / gaps[1:])).astype(np.int64)
        #: Centres of each level are the first ones: a net that halves its mesh from level to level.
        self.sizes = [int((level <= j).sum()) for j in np.unique(level)]
        apart = np.sqrt(np.maximum(self._squared(self.centres), 0))
        self.parents, self.radii = [], []
        above = leaf
        for j in range(len(self.sizes) - 1, -1, -1):
            if j < len(self.sizes) - 1:
                wide, narrow = self.sizes[j], self.sizes[j + 1]
                parent = np.arange(narrow)
                parent[wide:] = apart[wide:narrow, :wide].argmin(axis=1)
                self.parents.insert(0, parent)
                above = parent[above]
            radius = np.zeros(self.sizes[j])
            np.maximum.at(radius, above, np.linalg.norm(x - self.centres[above], axis=1))
            self.radii.insert(0, radius)
        order = np.argsort(leaf, kind="stable")
        self.members = np.split(order, np.searchsorted(leaf[order], np.arange(1, len(gaps))))

    @staticmethod
    def _squared(c: np.ndarray) -> np.ndarray:
        n = np.einsum("ij,ij->i", c, c)
        return n[:, None] + n[None, :] - 2 * c @ c.T

    def bounds(self, q: np.ndarray, low: np.ndarray, high: np.ndarray, top: float) -> np.ndarray:
        """Largest inner product each leaf may hold for each query; -inf for leaves outside its window.

        ``q`` has a last component of 0. A subtree is passed over at the highest level that shows it outside.
        """
        norms = np.einsum("ij,ij->i", q, q)
        slack = 1e-9 * (top + norms) + 1e-6
        far = np.sqrt(np.maximum(norms[:, None] + top - 2 * (q @ self.centres.T), 0))
        alive = np.ones((len(q), 1), bool)
        for j, size in enumerate(self.sizes):
            if j:
                alive = alive[:, self.parents[j - 1]]
            else:
                alive = np.repeat(alive, size, axis=1)
            d, r = far[:, :size], self.radii[j][None, :]
            upper = (top + norms[:, None] - np.maximum(d - r, 0) ** 2) / 2 + slack[:, None]
            lower = (top + norms[:, None] - (d + r) ** 2) / 2 - slack[:, None]
            alive &= (upper >= low[:, None]) & (lower <= high[:, None])
            if not alive.any():
                break
        if alive.shape[1] < len(self.centres):
            return np.full((len(q), len(self.centres)), -np.inf)
        return np.where(alive, upper, -np.inf)

    def best(self, x: np.ndarray, q: np.ndarray, low: np.ndarray, high: np.ndarray, top: float, k: int, allowed, order: np.ndarray):
        """Of each query, the ``k`` rows with the largest products within its window, ties by ``order``.

        Gives rows (-1: none) and products. ``allowed(queries, rows)`` tells which pairs count at all.
        """
        n = len(q)
        rows, score = np.full((n, k), -1), np.full((n, k), -np.inf)
        upper = self.bounds(q, low, high, top)
        turn = np.argsort(-upper, axis=1, kind="stable")
        upper = np.take_along_axis(upper, turn, axis=1)
        begin, wave = 0, 2
        while begin < turn.shape[1]:
            # Equal bounds are read too: a tie may go to the row not yet read.
            open_ = upper[:, begin : begin + wave] >= np.maximum(score[:, -1], low)[:, None]
            open_ &= np.isfinite(upper[:, begin : begin + wave])
            if not open_.any():
                break
            which, at = np.nonzero(open_)
            leaf = turn[which, begin + at]
            by = np.argsort(leaf, kind="stable")
            which, leaf = which[by], leaf[by]
            cuts = np.flatnonzero(np.diff(leaf)) + 1
            for mine in np.split(np.arange(len(leaf)), cuts):
                asking, member = which[mine], self.members[leaf[mine[0]]]
                s = q[asking, :-1] @ x[member, :-1].T
                s[~allowed(asking, member) | (s < low[asking][:, None]) | (s > high[asking][:, None])] = -np.inf
                all_s = np.hstack([score[asking], s])
                all_r = np.hstack([rows[asking], np.broadcast_to(member, s.shape)])
                first = np.lexsort((np.where(all_r < 0, len(x), order[all_r]), -all_s), axis=1)[:, :k]
                score[asking] = np.take_along_axis(all_s, first, axis=1)
                rows[asking] = np.take_along_axis(all_r, first, axis=1)
            begin += wave
            wave *= 2
        return np.where(np.isfinite(score), rows, -1), score


def _matrix(lists: pa.Array, n: int) -> np.ndarray:
    values = lists.flatten().to_numpy().astype(np.float64)
    return values.reshape(n, len(values) // max(1, n))


def _searched(top: float, k: int, same_label: bool):
    """Of one block, the ``k`` best rows for each search of one batch."""

    def search(block: pa.Table, asked: pa.Table) -> pa.Table:
        out = {c: np.zeros(0, np.int64) for c in ("search", "row", "id", "score")}
        if block.num_rows and asked.num_rows:
            block = block.sort_by("row")
            x, q = (_matrix(t.column("v").combine_chunks(), t.num_rows) for t in (block, asked))
            x, q = augmented(x, top), np.hstack([q, np.zeros((len(q), 1))])
            ids, own = block.column("id").to_numpy(), asked.column("id").to_numpy()
            labels, own_label = block.column("label").to_numpy(), asked.column("label").to_numpy()
            order = np.empty(len(x), np.int64)
            order[np.lexsort((block.column("row").to_numpy(), ids))] = np.arange(len(x))

            def allowed(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
                alike = own_label[queries][:, None] == labels[rows][None, :]
                return (alike == same_label) & (own[queries][:, None] != ids[rows][None, :])

            low, high = asked.column("low").to_numpy(), asked.column("high").to_numpy()
            rows, score = CoverTree(x).best(x, q, low, high, top, k, allowed, order)
            a, b = np.nonzero(rows >= 0)
            place = rows[a, b]
            out = {"search": asked.column("search").to_numpy()[a], "row": block.column("row").to_numpy()[place], "id": ids[place], "score": score[a, b].astype(np.int64)}
        return pa.table(out)

    return search


def _nearest_pivot(pivots: np.ndarray, top: float):
    def rows(batches):
        for batch in batches:
            v = batch.column("v")
            fits = (batch.column("length").to_numpy() == pivots.shape[1] - 1) & (len(pivots) > 0)
            out = np.full(batch.num_rows, -1, np.int32)
            if fits.any():
                x = _matrix(v.filter(pa.array(fits)), int(fits.sum()))
                out[fits] = (augmented(x, top) @ pivots.T - np.einsum("ij,ij->i", pivots, pivots) / 2).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=[*batch.schema.names, "pivot"])

    return rows


def _indexed(rows: DataFrame, top: float, n: int, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """All rows with their block, and the blocks with the length of their vectors."""
    pivots = np.zeros((0, 1))
    if n > block_rows:
        sample = rows.orderBy(F.xxhash64("row"), "row").limit(SAMPLE_ROWS).select("v").collect()
        lengths = [len(r.v) for r in sample]
        usual = max(set(lengths), key=lambda i: (lengths.count(i), i))
        x = augmented(np.array([r.v for r in sample if len(r.v) == usual], np.float64), top)
        pivots = x[farthest_first(x, min(PIVOTS, math.ceil(n / block_rows)))[0]]
    dealt = materialize(rows.mapInArrow(_nearest_pivot(pivots, top), f"{_ROW}, pivot int"), "dealt")
    # A row per pivot and length; a pivot with very many rows has as many blocks as they need.
    sizes = dealt.groupBy("length", "pivot").agg(F.ceil(F.count("*") / block_rows).cast("long").alias("parts"))
    parts = F.coalesce(F.col("parts"), F.lit(1))
    part = F.pmod(F.xxhash64("row"), parts)
    blocked = dealt.join(sizes, ["length", "pivot"]).withColumn("block", F.xxhash64("length", "pivot", part))
    blocked = materialize(blocked.select("row", "id", "label", "v", "length", "block"), "blocks")
    return blocked, blocked.select("length", "block").distinct()


_ROW = "row long, id long, label long, v array<long>, length int"


def _search(blocked: DataFrame, blocks: DataFrame, asked: DataFrame, n_asked: int, top: float, k: int, same_label: bool, batch: int) -> DataFrame:
    """``search, row, id, score, rank``: the ``k`` best rows of all blocks for each search."""
    batches = max(1, math.ceil(n_asked / batch))
    each = asked.withColumn("batch", F.pmod(F.xxhash64("search"), F.lit(batches)).cast("int"))
    each = each.join(blocks, "length").select("block", "batch", "search", "id", "label", "v", "low", "high")
    each = each.toDF(*each.columns)  # columns of its own, though it comes from the same table as the rows
    rows = blocked.withColumn("batch", F.explode(F.sequence(F.lit(0), F.lit(batches - 1)))).select("block", "batch", "row", "id", "label", "v")
    found = (
        rows.groupBy("block", "batch")
        .cogroup(each.groupBy("block", "batch"))
        .applyInArrow(_searched(top, k, same_label), "search long, row long, id long, score long")
    )
    best = Window.partitionBy("search").orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def hard_negatives(
    df: DataFrame,
    every: int = 50,
    positives: int = 5,
    negatives: int = 3,
    low_percent: int = 50,
    high_percent: int = 95,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    block_rows: int = BLOCK_ROWS,
    batch_searches: int = BATCH_SEARCHES,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components become ``floor(scale * x)``; a score is the integer inner product with the anchor; higher ones
    come first, then smaller ids. Anchors are the rows whose id ``every`` divides. An anchor's positives are
    its first ``positives`` other rows of its label; of each, the negatives are the first ``negatives`` rows of
    other labels whose score is from ``low_percent`` to ``high_percent`` per cent of the positive's, which a
    negative score never is.

    Rows with a null id, label or vector, or with a null or non-finite component, take no part. Equal rows
    count once; rows that share an id but not the rest are rows of their own, though never "other" rows of each
    other. Vectors of different lengths are not compared; empty ones score 0 with each other. Scores above
    2^53 are refused. Other columns are ignored.

    Every row is dealt to a block and every search reads every block's tree: work grows with anchors times
    rows, less what the trees let it skip. Moved are searches times blocks and rows times batches of searches.
    """
    if min(every, positives, negatives, low_percent) < 1 or not low_percent <= high_percent:
        raise ValueError("counts and percentages must be positive, the lower one first")
    whole = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("x"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(whole, F.lit(False)))
    scaled = rows.select("id", "label", F.transform("x", lambda c: F.floor(c * scale).cast("long")).alias("v"), F.aggregate("x", F.lit(0.0), lambda a, c: F.greatest(a, F.abs(c))).alias("peak"))
    scaled = scaled.groupBy("id", "label", "v").agg(F.max("peak").alias("peak"))
    square = F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
    numbered = materialize(scaled.select(F.monotonically_increasing_id().alias("row"), "id", "label", "v", F.size("v").alias("length"), square.alias("square"), "peak"), "vectors")
    n, top, peak = numbered.agg(F.count("*"), F.coalesce(F.max("square"), F.lit(0.0)), F.coalesce(F.max("peak"), F.lit(0.0))).first()
    if max(top * high_percent, (peak * scale) ** 2) >= EXACT * 100:
        raise ValueError("scores are too large to be exact")
    blocked, blocks = _indexed(numbered.drop("square", "peak"), top, n, block_rows)
    anchors = blocked.where(F.col("id") % every == 0)
    unbounded = anchors.select(F.col("row").alias("search"), "id", "label", "v", "length", F.lit(float("-inf")).alias("low"), F.lit(float("inf")).alias("high"))
    near = materialize(_search(blocked, blocks, unbounded, anchors.count(), top, positives, True, batch_searches).drop("rank"), "positives")

    low = F.ceil(F.col("score") * low_percent / 100.0).cast("long")
    high = F.floor(F.col("score") * high_percent / 100.0).cast("long")
    found = near.select(F.col("search").alias("anchor"), F.col("id").alias("positive_id"), F.col("score"), low.alias("low"), high.alias("high"))
    found = found.where("low <= high").withColumn("search", F.monotonically_increasing_id())
    searches = materialize(found.join(anchors.withColumnRenamed("row", "anchor"), "anchor").select("search", "id", "label", "v", "length", F.col("low").cast("double").alias("low"), F.col("high").cast("double").alias("high"), "positive_id", "score"), "windows")
    hard = _search(blocked, blocks, searches, searches.count(), top, negatives, False, batch_searches)
    hard = hard.select("search", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = searches.select("search", F.col("id").alias("anchor_id"), "positive_id", F.col("score").alias("positive_score"))
    return named.join(hard, "search").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
