"""Windows of a fixed length whose content stands in more than one place, found in parts of linear size.

Units are words or bytes. Each window is named by an *anchor*: its leftmost smallest ``k``-unit piece by
hash. Equal windows have equal anchors at equal places, so only windows of one anchor need comparing.
Consecutive windows with the same anchor form a *run*; a run is one row, not one row per window.

1. Anchors are counted over the whole corpus. One that stands once names no repeated window.
2. An anchor all of whose runs have the same content is a path without branches: its runs are repeated
   whole.
3. Where contents differ, each different content is fetched once from its source coordinates and cut into
   blocks of windows. A block whose common part stands once is unique; one with one content is repeated.
4. What is left is compared window by window.

Every step is an aggregation with map-side combination or a join of two exchanged sides that adaptive
execution can split, so neither copies nor a common passage gather in one task. Contents are compared by
64-bit digests within one anchor's rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import flat
from millrace.session import materialize

POSITION_BITS = 31
RUN_BITS = 16


def _units(body: np.ndarray, at: np.ndarray, by_words: bool) -> tuple[np.ndarray, np.ndarray]:
    """Units as they are compared, and offsets of texts among them."""
    if not by_words:
        return body, at
    starts, ends, offsets = flat.words(body, at)
    return flat.word_hashes(body, starts, ends), offsets


def _runs(units: np.ndarray, at: np.ndarray, window: int, k: int):
    """First window, number of windows, anchor's unit and anchor's hash of each run, in order."""
    n = len(units)
    if n < window:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    total = flat.running(units if units.dtype == np.uint64 else flat.byte_table()[units])
    first = np.arange(n - k + 1)
    hashes = flat.stretch(total, first, first + k)
    low = (hashes >> np.uint64(POSITION_BITS) << np.uint64(POSITION_BITS)) | first.astype(np.uint64)
    width, size = window - k + 1, 1
    while size * 2 <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < width:
        low = np.minimum(low[: len(low) - (width - size)], low[width - size :])
    anchor = (low & np.uint64((1 << POSITION_BITS) - 1)).astype(np.int64)
    marks = np.zeros(len(anchor) + 1, np.int32)
    long_enough = at[1:] - at[:-1] >= window
    np.add.at(marks, at[:-1][long_enough], 1)
    np.add.at(marks, at[1:][long_enough] - window + 1, -1)
    inside = np.cumsum(marks[:-1]) > 0
    joined = inside[1:] & inside[:-1] & (anchor[1:] == anchor[:-1])
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~joined
    ends[:-1] &= ~joined
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1 - starts, anchor[starts], hashes[anchor[starts]]


def _digests(units: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    view, size, digest = memoryview(units.view(np.uint8)), units.itemsize, xxhash.xxh3_64_intdigest
    spans = zip((starts * size).tolist(), (ends * size).tolist(), strict=True)
    return np.fromiter((digest(view[a:b], seed) for a, b in spans), np.uint64, len(starts))


def _run_rows(window: int, k: int, by_words: bool) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, body, at in flat.chunks(batches):
            units, offsets = _units(body, at, by_words)
            starts, count, _, anchor = _runs(units, offsets, window, k)
            if not len(starts):
                continue
            doc = np.searchsorted(offsets, starts, "right") - 1
            span = _digests(units, starts, starts + count + window - 1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(doc)),
                    batch.column("h").take(pa.array(doc)),
                    pa.array(((starts - offsets[doc]) << RUN_BITS) | count),
                    pa.array(anchor.view(np.int64)),
                    pa.array(span.view(np.int64)),
                ],
                names=["id", "h", "place", "anchor", "span"],
            )

    return rows


def _content_rows(window: int, k: int, by_words: bool) -> Callable:
    """Contents of the runs that a row lists by place, and where their anchor stands."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed, wanted in zip(batch.column("packed"), batch.column("wanted"), strict=True):
                body = np.frombuffer(zstandard.decompress(packed.as_py()), np.uint8)
                units, offsets = _units(body, np.array([0, len(body)]), by_words)
                starts, count, at, _ = _runs(units, offsets, window, k)
                wanted = wanted.as_py()
                places = np.array([w["place"] >> RUN_BITS for w in wanted])
                run = np.searchsorted(starts, places)
                first, last = starts[run], starts[run] + count[run] + window - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([w["anchor"] for w in wanted], pa.int64()),
                        pa.array([w["span"] for w in wanted], pa.int64()),
                        pa.array([w["copies"] for w in wanted], pa.int64()),
                        pa.array(at[run] - first),
                        pa.array([units[a:b].tobytes() for a, b in zip(first.tolist(), last.tolist(), strict=True)], pa.binary()),
                    ],
                    names=["anchor", "span", "copies", "reach", "content"],
                )

    return rows


def _block_rows(window: int, block: int, itemsize: int, whole: bool) -> Callable:
    """Blocks of windows of each content (``whole``), or windows of the blocks that rows list.

    A window is known by how far before the anchor it starts, ``reach - window's start``; blocks are
    aligned to that distance, so the blocks of different contents can be compared.
    """
    kind = np.uint8 if itemsize == 1 else np.uint64

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            anchor, span, copies, far, near, key, content_key = [], [], [], [], [], [], []
            columns = [batch.column(c).to_pylist() for c in ("anchor", "span", "copies", "reach")]
            blocks = [None] * batch.num_rows if whole else batch.column("blocks").to_pylist()
            for a, s, c, reach, wanted, content in zip(*columns, blocks, batch.column("content"), strict=True):
                units = np.frombuffer(content.as_buffer(), kind)
                most, least = reach, reach - (len(units) - window)
                numbers = range(least // block, most // block + 1) if whole else wanted
                parts = [(b, max(least, b * block), min(most, b * block + block - 1)) for b in numbers]
                if not whole:
                    parts = [(0, d, d) for _, lo, hi in parts for d in range(lo, hi + 1)]
                d0 = np.array([p[1] for p in parts])
                d1 = np.array([p[2] for p in parts])
                outer = _digests(units, reach - d1, reach - d0 + window)
                if whole:
                    b = np.array([p[0] for p in parts]) * block
                    inner = _digests(units, reach - b, reach - b - block + 1 + window)
                else:
                    inner = outer
                anchor += [a] * len(parts)
                span += [s] * len(parts)
                copies += [c] * len(parts)
                far.append(d1)
                near.append(d0)
                key.append(inner)
                content_key.append(outer)
            if anchor:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor, pa.int64()),
                        pa.array(span, pa.int64()),
                        pa.array(copies, pa.int64()),
                        pa.array(np.concatenate(near), pa.int32()),
                        pa.array(np.concatenate(far), pa.int32()),
                        pa.array(np.concatenate(key).view(np.int64)),
                        pa.array(np.concatenate(content_key).view(np.int64)),
                    ],
                    names=["anchor", "span", "copies", "near", "far", "key", "inner"],
                )

    return rows


_PARTS = "anchor long, span long, copies long, near int, far int, key long, inner long"


def _packed(docs: DataFrame) -> DataFrame:
    """Texts as they are moved: compressed one by one."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch, body, at in flat.chunks(batches):
            view = memoryview(body)
            texts = [packer.compress(view[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("h"), pa.array(texts, pa.binary())], names=["id", "h", "packed"])

    return docs.mapInArrow(rows, "id long, h long, packed binary")


def repeated_runs(docs: DataFrame, window: int, k: int, by_words: bool, block: int) -> DataFrame:
    """``id, h, place``: windows whose content starts elsewhere too, as first window and number of windows.

    ``docs`` has ``id, h, text`` as :func:`flat.keyed_texts` gives them.
    """
    runs = docs.mapInArrow(_run_rows(window, k, by_words), "id long, h long, place long, anchor long, span long")
    seen = (
        runs.groupBy("anchor")
        .agg(F.count("*").alias("n"), F.min("span").alias("lowest"), F.max("span").alias("highest"))
        .where("n > 1")
        .select("anchor", (F.col("lowest") != F.col("highest")).alias("branches"))
    )
    seen = materialize(seen, "anchors")
    hits = materialize(runs.join(seen, "anchor"), "runs")
    branches = hits.where("branches").drop("branches")

    contents = branches.groupBy("anchor", "span").agg(F.count("*").alias("copies"), F.min(F.struct("id", "h", "place")).alias("at"))
    wanted = (
        contents.select("at.id", "at.h", F.struct("at.place", "anchor", "span", "copies").alias("run"))
        .groupBy("id", "h")
        .agg(F.collect_list("run").alias("wanted"))
    )
    wanted = materialize(wanted, "wanted")
    texts = _packed(docs)
    fetched = texts.join(wanted.hint("shuffle_hash"), same_rows(texts, wanted)).select(texts["packed"], "wanted")
    fetched = fetched.mapInArrow(_content_rows(window, k, by_words), "anchor long, span long, copies long, reach long, content binary")
    # Rows with equal id and text list the same run once each.
    fetched = materialize(fetched.dropDuplicates(["anchor", "span"]), "contents")

    itemsize = 8 if by_words else 1
    blocks = materialize(fetched.mapInArrow(_block_rows(window, block, itemsize, True), _PARTS), "blocks")
    # The block's number belongs to the key: its distance from the anchor is part of what is compared.
    named = blocks.withColumn("b", F.floor(F.col("far") / block).cast("int"))
    blocks_seen = (
        named.groupBy("anchor", "b", "key")
        .agg(F.sum("copies").alias("n"), F.min("inner").alias("lowest"), F.max("inner").alias("highest"))
        .where("n > 1")
        .select("anchor", "b", "key", (F.col("lowest") != F.col("highest")).alias("open"))
    )
    blocks_seen = materialize(blocks_seen, "blocks-seen")
    decided = named.join(blocks_seen, ["anchor", "b", "key"])
    whole = decided.where("copies > 1 OR NOT open").select("anchor", "span", "near", "far")

    undecided = decided.where("open").groupBy("anchor", "span").agg(F.collect_list("b").alias("blocks"))
    single = fetched.join(undecided, ["anchor", "span"]).select("anchor", "span", "copies", "reach", "blocks", "content")
    single = materialize(single.mapInArrow(_block_rows(window, block, itemsize, False), _PARTS), "windows")
    windows_seen = single.groupBy("anchor", "near", "key").agg(F.sum("copies").alias("n")).where("n > 1").select("anchor", "near", "key")
    found = single.where("copies = 1").join(windows_seen, ["anchor", "near", "key"]).select("anchor", "span", "near", "far")

    parts = (
        whole.unionByName(found)
        .groupBy("anchor", "span")
        .agg(F.collect_set(F.struct("near", "far")).alias("parts"))
        .join(fetched.select("anchor", "span", "reach"), ["anchor", "span"])
    )
    parts = materialize(parts, "parts")
    placed = branches.join(parts, ["anchor", "span"]).select("id", "h", "place", "reach", F.explode("parts").alias("part"))
    start = F.shiftright("place", RUN_BITS) + F.col("reach") - F.col("part.far")
    placed = placed.select("id", "h", (F.shiftleft(start, RUN_BITS) + F.col("part.far") - F.col("part.near") + 1).alias("place"))
    return hits.where("NOT branches").select("id", "h", "place").unionByName(placed)


def same_rows(a: DataFrame, b: DataFrame):
    return flat.same_row(a, b)


def with_repeats_removed(docs: DataFrame, window: int, k: int, by_words: bool, block: int) -> DataFrame:
    """``id, n_units, n_removed, n_spans, kept``: ``kept`` is what no repeated window covers, as bytes.

    Kept words are joined by one space; kept bytes stand as they were.
    """
    repeated = repeated_runs(docs, window, k, by_words, block).groupBy("id", "h").agg(F.collect_set("place").alias("places"))
    repeated = materialize(repeated, "repeated")
    texts = _packed(docs)
    joined = texts.join(repeated.hint("shuffle_hash"), same_rows(texts, repeated), "left").select(texts["id"], texts["packed"], "places")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out, held = batch.column("id"), [], 0
            first = 0
            for i, (packed, places) in enumerate(zip(batch.column("packed"), batch.column("places").to_pylist(), strict=True)):
                text = zstandard.decompress(packed.as_py())
                units = text.split() if by_words else text
                kept, removed, spans, end = [], 0, 0, 0
                reach = None
                for p in sorted(places or ()):
                    start = p >> RUN_BITS
                    stop = start + (p & ((1 << RUN_BITS) - 1)) + window - 1
                    if reach is None or start > reach:
                        if reach is not None:
                            end = reach
                        kept.append(units[end:start])
                        spans += 1
                        removed += stop - start
                        reach = stop
                    elif stop > reach:
                        removed += stop - reach
                        reach = stop
                kept.append(units[(reach or 0) :])
                left = b" ".join(w for part in kept for w in part) if by_words else b"".join(kept)
                out.append((len(units), removed, spans, left))
                held += len(left)
                if held > 4 << 20 or i + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [ids.slice(first, len(out)), *(pa.array([r[c] for r in out], t) for c, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.binary())))],
                        names=["id", "n_units", "n_removed", "n_spans", "kept"],
                    )
                    first, out, held = i + 1, [], 0

    return joined.mapInArrow(rows, "id long, n_units long, n_removed long, n_spans long, kept binary")
