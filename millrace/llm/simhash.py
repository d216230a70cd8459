"""SimHash near-dedup by an embedding of fingerprints into segment bit counts.

A 64-bit fingerprint becomes 32 bit counts, one for each 2-bit segment. Flipping a bit changes one count by
one, so the Manhattan distance of the counts is a lower bound of the bit distance. Within distance 3 one
half (16 counts) is within 1. So each fingerprint is kept in the grid cell of either half, and looks in its
own cell and those one step away: about 25 of 3^16. What meets there is verified by its bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import flat
from millrace.llm.components import components
from millrace.session import materialize

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """``id, h, fp`` of ``id, h, text``: SimHash over all ``words``-word shingles, repeats included."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_digest
        for batch, body, at in flat.chunks(batches):
            text, found, counts = body.tobytes().translate(_LOWER), [], []
            for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                own = text[a:b].split()
                found += own
                counts.append(len(own))
            joined = b" ".join(found)
            blanks = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
            starts, ends = np.concatenate(([0], blanks + 1)), np.concatenate((blanks, [len(joined)]))
            n = np.array(counts)
            shingles = np.where(n > 0, np.maximum(n - words + 1, 1), 0)
            offsets = np.concatenate(([0], np.cumsum(shingles)))
            doc = np.repeat(np.arange(len(n)), shingles)
            first = np.arange(len(doc)) - offsets[doc] + np.concatenate(([0], np.cumsum(n)))[doc]
            last = first + np.minimum(n, words)[doc] - 1
            spans = zip(starts[first].tolist(), ends[last].tolist(), strict=True)
            hashed = np.frombuffer(b"".join([digest(joined[a:b], 42) for a, b in spans]), np.uint8).reshape(-1, 8)
            prints = np.zeros((len(n), 8), np.uint8)
            some = np.flatnonzero(shingles)
            if len(some):
                ones = np.add.reduceat(np.unpackbits(hashed, axis=1), offsets[some], axis=0, dtype=np.int32)
                prints[some] = np.packbits(ones * 2 > shingles[some][:, None], axis=1)
            values = prints.reshape(-1).view(">i8").astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("h"), pa.array(values)], names=["id", "h", "fp"])

    return docs.mapInArrow(rows, "id long, h long, fp long")


def _cell(half: Column) -> Column:
    """Bit counts of the 2-bit segments of 32 bits, each in its two bits."""
    return half - F.shiftright(half, 1).bitwiseAND(F.lit(0x55555555))


def _cells(fp: Column) -> Column:
    """The cells of both halves; a bit above them tells the halves apart."""
    low = fp.bitwiseAND(F.lit(0xFFFFFFFF))
    high = F.shiftrightunsigned(fp, 32)
    return F.array(_cell(low), _cell(high).bitwiseOR(F.lit(1 << 40)))


def _near(cell: Column) -> Column:
    """``cell`` and the cells at Manhattan distance 1."""

    def steps(j: int) -> list[Column]:
        count = F.shiftright(cell, 2 * j).bitwiseAND(F.lit(3))
        return [F.when(count < 2, cell + F.lit(1 << 2 * j)), F.when(count > 0, cell - F.lit(1 << 2 * j))]

    return F.array_compact(F.array(cell, *(s for j in range(16) for s in steps(j))))


def links(prints: DataFrame, bits: int) -> DataFrame:
    """``a, b``: different fingerprints (column ``fp``, distinct) at ``bits`` or fewer differing bits, for bits up to 3."""
    if not 0 <= bits <= 3:
        raise ValueError("one half is within 1 of the other's counts only up to 3 bits")
    kept = prints.select(F.col("fp").alias("b"), F.explode(_cells(F.col("fp"))).alias("cell"))
    asking = prints.select(F.col("fp").alias("a"), F.explode(_cells(F.col("fp"))).alias("own"))
    asking = asking.select("a", F.explode(_near(F.col("own"))).alias("cell"))
    met = asking.join(kept, (asking["cell"] == kept["cell"]) & (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits))
    return met.select("a", "b").distinct()


def near_duplicates(df: DataFrame, words: int = 3, bits: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: ``id_col, h, fingerprint, component_id, component``.

    ``component`` is some fingerprint of the group, the same for all of it. ``h`` is the text's hash, which tells rows apart that share an id. Texts are lower-cased (A-Z), cut into
    words at white space, and hashed in ``words``-word shingles; shorter texts are one shingle; null and empty
    ones have fingerprint zero and link like any other. ``component_id`` is the least id that links of
    ``bits`` or fewer differing bits reach; null only if all ids there are null. Equal fingerprints are one
    class from the start, so copies make no pairs. Other columns are ignored.
    """
    prints = materialize(fingerprints(flat.keyed_texts(df, id_col, text_col), words), "fingerprints")
    classes = materialize(prints.groupBy("fp").agg(F.min("id").alias("least")), "classes")
    roots = components(materialize(links(classes, bits), "pairs"))
    rooted = classes.join(roots, classes["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = materialize(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = materialize(rooted.join(least, "root").select("fp", "root", "component_id"), "components")
    return prints.join(by_print, "fp").select(
        F.col("id").alias(id_col),
        "h",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
        F.col("root").alias("component"),
    )


def keep_one(df: DataFrame, words: int = 3, bits: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with one row of each group of near duplicates: that of the least id, then text hash.

    Rows equal in id and text are one row; the others' further columns come from any of them.
    """
    marked = near_duplicates(df, words, bits, id_col, text_col)
    row = marked.groupBy("component", F.col(id_col).alias("id"), "h").agg(F.count("*").alias("copies"))
    chosen = row.groupBy("component").agg(F.min(F.struct(F.isnull("id"), "id", "h", "copies")).alias("row")).select("row.id", "row.h", "row.copies")
    id_, h, copies = flat.fresh(df, "id", "h", "copies")
    chosen = materialize(chosen, "chosen").toDF(id_, h, copies)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    same = F.col(id_col).cast("long").eqNullSafe(F.col(id_)) & (F.xxhash64(text) == F.col(h))
    kept = df.join(chosen.hint("shuffle_hash"), same)
    once = kept.where(F.col(copies) == 1).select(*df.columns)
    folded = kept.where(F.col(copies) > 1).groupBy(id_, h).agg(*(F.any_value(c).alias(c) for c in df.columns)).select(*df.columns)
    return once.unionByName(folded)
