"""Ranked lexical search without random access: lists are read by falling impact only.

A pass over the texts leaves one narrow row per document: its length and how often it holds the words that
any query has. Documents are dealt to blocks of bounded size, and each block is searched for each batch of
queries: a word's postings are read by falling impact, in step with the query's other words. What has been
read bounds a document's score from below; that and the impacts at which the lists stand bound it from
above. Reading ends when no document outside the leaders can reach them and all leaders' scores are whole.
Blocks' leaders are then ranked against each other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm import flat
from millrace.session import materialize

#: Bits of the filter of query words that a task holds: 512 KB, whatever the number of queries.
FILTER_BITS = 1 << 22
#: Documents of a block and queries of a batch, on average: what a task holds at once.
BLOCK_DOCS, BATCH_ITEMS = 4096, 256


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """What parts words, and bytes with A-Z in lower case."""
    parts = np.ones(256, bool)
    parts[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
    lower = np.arange(256, dtype=np.uint8)
    lower[0x41:0x5B] += 0x20
    return parts, lower


def _profiles(bits: bytes | None):
    """``row, id, n, terms, tfs, slots`` of each text; only words in the filter ``bits``, if there is one."""
    kept = None if bits is None else np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little").view(bool)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, lower = flat.per_process("search_tables", _tables)
        for batch, body, at in flat.chunks(batches):
            body = lower[body]
            starts, ends, offsets = flat.words(body, at, parts)
            slots = (flat.word_hashes(body, starts, ends) & np.uint64(FILTER_BITS - 1)).astype(np.int64)
            own = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            if kept is not None:
                some = np.flatnonzero(kept[slots])
                starts, ends, slots, own = starts[some], ends[some], slots[some], own[some]
            coded = flat.strings(body, starts, ends).dictionary_encode()
            code = coded.indices.to_numpy().astype(np.int64)
            width = max(1, len(coded.dictionary))
            keys, first, tf = np.unique(own * width + code, return_index=True, return_counts=True)
            lists = pa.array(np.searchsorted(keys, np.arange(batch.num_rows + 1) * width).astype(np.int32))
            terms = coded.dictionary.take(pa.array(keys % width)).cast(pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("id"),
                    pa.array(np.diff(offsets)),
                    pa.ListArray.from_arrays(lists, terms),
                    pa.ListArray.from_arrays(lists, pa.array(tf)),
                    pa.ListArray.from_arrays(lists, pa.array(slots[first])),
                ],
                names=["row", "id", "n", "terms", "tfs", "slots"],
            )

    return rows


_PROFILE = "row long, id long, n long, terms array<string>, tfs array<long>, slots array<long>"


def _numbered(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), text.alias("text"))


def leaders(lists: list[tuple[np.ndarray, np.ndarray]], ids: np.ndarray, k: int, step: int = 32) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` documents with the largest sums above 0 (ties: by place in ``ids``'s order), and the sums.

    Each of ``lists`` has documents and their impacts, by falling impact. Rounds read ``step`` postings of
    each list, then twice as many. ``lower`` is what was read of a document, ``upper`` adds the impact at
    which each list stands that has not shown it. Once few documents can still lead, the rest of each list
    is read for them alone.
    """
    n = len(ids)
    lower, seen = np.zeros(n, np.int64), np.zeros((len(lists), n), bool)
    place = np.zeros(len(lists), np.int64)
    while True:
        front = np.zeros(len(lists), np.int64)
        for t, (docs, impact) in enumerate(lists):
            new = docs[place[t] : place[t] + step]
            lower[new] += impact[place[t] : place[t] + step]
            seen[t, new] = True
            place[t] += len(new)
            front[t] = impact[place[t]] if place[t] < len(docs) else 0
        step *= 2
        upper = lower + front.sum() - front @ seen
        bar = np.partition(lower, n - k)[n - k] if n > k else 0
        alive = upper >= max(1, bar)
        if not front.any() or alive.sum() <= 4 * k:
            break
    for t, (docs, impact) in enumerate(lists):
        rest = alive[docs[place[t] :]]
        lower[docs[place[t] :][rest]] += impact[place[t] :][rest]
    found = np.flatnonzero(alive & (lower > 0))
    found = found[np.lexsort((ids[found], -lower[found]))[:k]]
    return found, lower[found]


def _searched(n_docs: int, n_words: int, k: int):
    def search(docs: pa.Table, items: pa.Table) -> pa.Table:
        out = {"item": [], "row": [], "id": [], "score": []}
        if docs.num_rows and items.num_rows:
            docs = docs.combine_chunks()
            coded = pc.list_flatten(docs.column("terms")).combine_chunks().dictionary_encode()
            own = pc.list_parent_indices(docs.column("terms")).to_numpy()
            tf = pc.list_flatten(docs.column("tfs")).to_numpy()
            lengths, length_of = np.unique(docs.column("n").to_numpy(), return_inverse=True)
            # Python's integers: the product of three counts may leave 64 bits.
            norms = np.array([10 + 90 * int(x) * n_docs // n_words for x in lengths], np.int64)[length_of]
            base = (1_000_000_000 * tf) // (1000 * tf + 8 * norms[own])
            code = coded.indices.to_numpy()
            order = np.lexsort((-base, code))
            cuts = np.searchsorted(code[order], np.arange(len(coded.dictionary) + 1))
            # Null ids come last among equals.
            empty = docs.column("id").is_null().to_numpy()
            rank = np.empty(docs.num_rows, np.int64)
            ids = pc.fill_null(docs.column("id"), 0).to_numpy()
            rank[np.lexsort((ids, empty))] = np.arange(docs.num_rows)
            for item, terms, weights in zip(items.column("item").to_pylist(), items.column("terms"), items.column("weights"), strict=True):
                known = pc.index_in(terms.values, coded.dictionary)
                lists = []
                for c, w in zip(known.to_pylist(), weights.as_py(), strict=True):
                    if c is not None and w > 0:
                        mine = order[cuts[c] : cuts[c + 1]]
                        lists.append((own[mine], w * base[mine]))
                if lists:
                    found, scores = leaders(lists, rank, k)
                    out["item"] += [item] * len(found)
                    out["row"] += docs.column("row").take(found).to_pylist()
                    out["id"] += docs.column("id").take(found).to_pylist()
                    out["score"] += scores.tolist()
        return pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()})

    return search


def ranked(
    df: DataFrame,
    queries: DataFrame,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_docs: int = BLOCK_DOCS,
    batch_items: int = BATCH_ITEMS,
) -> DataFrame:
    """``item_col, rank, id_col, score``: the ``k`` best documents above score 0 for each query.

    Words are maximal runs of letters, digits and non-ASCII characters, A-Z in lower case. A query's words
    count once. A document's score is the sum, over the query's words, of ``w * ((10^9 * tf) div (1000 * tf
    + 8 * m))`` with ``w = floor(1000 * ln((2N + 2) / (2 df + 1)))`` and ``m = 10 + (90 * n * N) div L``; ``N``
    counts documents with a word, ``L`` all words, ``n`` the document's. Higher scores come first, then
    smaller ids, null ids last.

    Null and empty texts have no words: such documents are never found and don't count, such queries find
    nothing. Every row is a document or a query of its own, equal ones too, which rank side by side. Words of any
    length are compared as they are. Other columns are ignored. Ids are integers.

    The whole tables are read once each. Moved are one narrow row per document and batch of queries, one row
    per query and block of documents, and ``k`` rows per query and block.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    spark = df.sparkSession
    flat.small_batches(df)
    asked = materialize(_numbered(queries, item_col, item_text_col).mapInArrow(_profiles(None), _PROFILE), "queries")
    # One long per 64 bits that have any: at most FILTER_BITS / 64 rows, put together by the executors.
    slot = asked.select(F.explode("slots").alias("s"))
    masks = slot.groupBy(F.shiftright("s", 6).cast("int").alias("i")).agg(F.expr("bit_or(shiftleft(1L, cast(s % 64 as int)))").alias("m"))
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    for r in masks.collect():
        bits[r.i] = r.m
    profiles = materialize(_numbered(df, id_col, text_col).mapInArrow(_profiles(bits.tobytes()), _PROFILE).drop("slots"), "profiles")
    n_docs, n_words = profiles.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()

    words = asked.select(F.col("row").alias("item"), F.explode("terms").alias("term"))
    counted = profiles.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1).cast("double"))).cast("long")
    weighed = words.join(counted, "term").select("item", "term", weight.alias("w"))
    items = weighed.groupBy("item").agg(F.collect_list(F.struct("term", "w")).alias("words"))
    n_batches = max(1, math.ceil(asked.count() / batch_items))
    n_blocks = max(1, math.ceil(n_docs / block_docs))
    items = items.select(
        F.pmod(F.xxhash64("item"), F.lit(n_batches)).cast("int").alias("batch"),
        F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"),
        "item",
        F.col("words.term").alias("terms"),
        F.col("words.w").alias("weights"),
    )
    dealt = profiles.where(F.size("terms") > 0).select(
        F.pmod(F.xxhash64("row"), F.lit(n_blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(n_batches - 1))).alias("batch"),
        "row", "id", "n", "terms", "tfs",
    )
    found = (
        dealt.groupBy("block", "batch")
        .cogroup(items.groupBy("block", "batch"))
        .applyInArrow(_searched(n_docs, max(1, n_words), k), "item long, row long, id long, score long")
    )
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    top = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    named = asked.select(F.col("row").alias("item"), F.col("id").alias("asked"))
    return top.join(named, "item").select(F.col("asked").alias(item_col), "rank", F.col("id").alias(id_col), "score")
