"""Sharding by a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import bisect
import hashlib
from collections import defaultdict

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import flat
from millrace.session import materialize

RING = 1 << 32
#: Rows of an arc are counted and numbered in so many parts, so a key with many rows is spread over tasks.
PARTS = 64


def ring(shards: int, points: int) -> list[tuple[int, int]]:
    """Position and shard of every virtual node, in order. A shard's own points stay when others come."""
    nodes = {}
    for shard in range(shards):
        for p in range(points):
            at = int.from_bytes(hashlib.blake2b(f"{shard}/{p}".encode(), digest_size=4).digest(), "big")
            nodes[at] = min(shard, nodes.get(at, shard))
    return sorted(nodes.items())


def _placed(counts: dict[tuple[int, int], int], nodes: list[tuple[int, int]], shards: int) -> list[tuple[int, int, int, int, int]]:
    """``arc, part, first row, shard, slot of that row``: which rows of each part go where.

    Every shard holds the rows of its own arcs as far as it has room for; what a full shard can't take goes
    clockwise, arc by arc, to the next shard with room. Room is the mean, rounded up for the first shards.
    """
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    used = [0] * shards
    by_arc = defaultdict(list)
    for (arc, part), n in sorted(counts.items()):
        by_arc[arc].append((part, n))
    out = []

    def give(pieces, shard):
        """Put rows into ``shard`` while it has room; returns what is left."""
        left = []
        for arc, part, first, n in pieces:
            take = min(n, room[shard] - used[shard])
            if take:
                out.append((arc, part, first, shard, used[shard]))
                used[shard] += take
            if n > take:
                left.append((arc, part, first + take, n - take))
        return left

    waiting = {}
    for arc, parts in sorted(by_arc.items()):
        left = give([(arc, part, 0, n) for part, n in parts], nodes[arc][1])
        if left:
            waiting[arc] = left
    # Clockwise from the overflowing arc; full shards are passed over.
    open_nodes = [i for i, (_, s) in enumerate(nodes) if used[s] < room[s]]
    for arc, left in waiting.items():
        at = bisect.bisect_right(open_nodes, arc)
        while left:
            if not open_nodes:
                raise AssertionError("room equals rows")
            at %= len(open_nodes)
            shard = nodes[open_nodes[at]][1]
            left = give(left, shard)
            if used[shard] == room[shard]:
                node = open_nodes[at]
                open_nodes = [i for i in open_nodes if nodes[i][1] != shard]
                at = bisect.bisect_right(open_nodes, node)
            else:
                at += 1
    return out


def bounded_ring(df: DataFrame, shards: int = 24, points: int = 128, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: ``id_col, size, text_crc32, law, shard, slot, grown_shard``.

    A row's key is its text's hash, so equal texts meet on the ring and share a shard as long as that has
    room. Loads are bounded by rows at the tightest bound there is: the law is ``rows``, shards differ by one
    row at most, and ``grown_shard`` is null, since a bounded load depends on all rows. ``slot`` counts a
    shard's rows from 0 without gaps. ``size`` is the text's UTF-8 length plus 8. Null texts count as empty;
    repeated rows and null ids are rows like any other; other columns are ignored.

    The driver holds counts of ``shards * points * PARTS`` cells at most, whatever the number of rows.
    """
    if shards < 1 or points < 1:
        raise ValueError("a ring needs a shard and a point")
    nodes = ring(shards, points)
    spark = df.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = df.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("crc"),
        F.xxhash64(text).alias("key"),
        F.pmod(F.xxhash64(F.col(id_col), F.lit("part")), F.lit(PARTS)).cast("int").alias("part"),
    )
    # Arc i ends at node i; keys beyond the last node belong to node 0. The ring is shards * points numbers.
    rows = rows.withColumn("at", F.pmod("key", F.lit(RING)))
    arcs = spark.createDataFrame(
        [(i, nodes[i - 1][0] + 1 if i else 0, at) for i, (at, _) in enumerate(nodes)] + [(0, nodes[-1][0] + 1, RING - 1)],
        "arc int, low long, high long",
    )
    rows = rows.join(F.broadcast(_stretches(arcs)), (F.shiftright("at", 20) == F.col("slice")) & F.col("at").between(F.col("low"), F.col("high")))
    rows = materialize(rows.select("id", "size", "crc", "key", "arc", "part"), "ring")
    counts = {(r.arc, r.part): r.n for r in rows.groupBy("arc", "part").agg(F.count("*").alias("n")).collect()}
    pieces = defaultdict(list)
    for arc, part, first, shard, slot in _placed(counts, nodes, shards):
        pieces[arc, part].append((first, shard, slot))
    # One row per cell, its pieces in order: at most shards * points * PARTS rows and as many pieces, plus one per shard.
    table = spark.createDataFrame(
        [(a, p, [(f, s, k) for f, s, k in sorted(x)]) for (a, p), x in pieces.items()],
        "arc int, part int, pieces array<struct<first:long,shard:int,slot:long>>",
    )
    numbered = rows.withColumn("n", F.row_number().over(Window.partitionBy("arc", "part").orderBy("key", "id", "size", "crc")) - 1)
    placed = numbered.join(F.broadcast(table), ["arc", "part"])
    piece = F.element_at(F.filter("pieces", lambda p: p["first"] <= F.col("n")), -1)
    return placed.select("id", "size", "crc", "n", piece.alias("piece")).select(
        F.col("id").alias(id_col),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("piece.shard").alias("shard"),
        (F.col("piece.slot") + F.col("n") - F.col("piece.first")).alias("slot"),
        F.lit(None).cast(T.IntegerType()).alias("grown_shard"),
    )


def _stretches(arcs: DataFrame) -> DataFrame:
    """Arcs once for each of the ring's 4,096 slices they touch, so they can be found by equality."""
    return arcs.withColumn("slice", F.explode(F.sequence(F.shiftright("low", 20), F.shiftright("high", 20))))
