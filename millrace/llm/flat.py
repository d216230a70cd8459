"""Arrow text columns as flat numpy arrays, taken a few rows at a time."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 1 << 18

#: Rows that Spark hands to a Python worker at once; its own default makes batches of long texts large.
BATCH_ROWS = 1000


def small_batches(df: DataFrame) -> None:
    """Bound the memory of Python workers: a session setting, since Spark has none for one query."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def keyed_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, h, text``: rows by id and text hash, so rows that share an id stay apart; null texts are empty."""
    small_batches(df)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return df.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("h"), text.alias("text"))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names`` lengthened until none is a column of ``df``."""
    taken = {c.lower() for c in df.columns}
    lead = "_"
    while any((lead + n).lower() in taken for n in names):
        lead += "_"
    return [lead + n for n in names]


def same_row(a: DataFrame, b: DataFrame) -> Column:
    return a["id"].eqNullSafe(b["id"]) & (a["h"] == b["h"])


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all values, and the offsets between them; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    binary = pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = pc.fill_null(column, b"" if binary else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return body[at[0] : at[-1]], at - at[0]


def chunks(batches: Iterator[pa.RecordBatch], limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Pieces of ``batches`` with at most ``limit`` bytes of column ``text``, or one row: rows, bytes, offsets."""
    for batch in batches:
        body, at = flat(batch.column("text"))
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
            yield batch.slice(first, last - first), body[at[first] : at[last]], at[first : last + 1] - at[first]
            first = last


def pieces(body: np.ndarray, at: np.ndarray) -> list[bytes]:
    whole = body.tobytes()
    return [whole[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def per_process(key: str, build: Callable):
    """``build()`` once in each Python worker: functions travel by value, so their own globals don't last."""
    kept = sys.modules.setdefault("_millrace_kept", types.ModuleType("_millrace_kept"))
    if not hasattr(kept, key):
        setattr(kept, key, build())
    return getattr(kept, key)


# Sums of hashed units times powers of an odd base, modulo 2^64; the inverse power moves any stretch to 0.
_BASE = 0x9E3779B97F4A7C15


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(18, int(n).bit_length())
    up = per_process(f"up{size}", lambda: _powers(_BASE, size))
    down = per_process(f"down{size}", lambda: _powers(pow(_BASE, -1, 1 << 64), size))
    return up, down


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def byte_table() -> np.ndarray:
    return per_process("bytes", lambda: mixed(np.arange(1, 257, dtype=np.uint64)))


def running(units: np.ndarray) -> np.ndarray:
    """Prefix sums (one longer than ``units``) from which :func:`stretch` takes hashes."""
    total = np.zeros(len(units) + 1, np.uint64)
    np.cumsum(units * powers(len(units))[0][: len(units)], out=total[1:])
    return total


def stretch(total: np.ndarray, first, last) -> np.ndarray:
    """Hash of units ``first`` to before ``last``, wherever they stand."""
    return mixed((total[last] - total[first]) * powers(len(total))[1][first])


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def words(body: np.ndarray, at: np.ndarray, separator: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and end byte of each word, and the offsets of texts among the words."""
    inside = ~separator[body]
    first, last = inside.copy(), inside.copy()
    first[1:] &= separator[body[:-1]]
    last[:-1] &= separator[body[1:]]
    cuts = at[(at > 0) & (at < len(body))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, at)


def strings(body: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The words at these places, as one Arrow array of bytes."""
    offsets = np.concatenate(([0], np.cumsum(ends - starts)))
    places = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], ends - starts)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(body[places])])


def word_hashes(body: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """XXH3 of each word's bytes, computed once for words that come again. Sums of powers would not do here:
    modulo 2^64 long words can be made that differ and share any such sum."""
    coded = strings(body, starts, ends).dictionary_encode()
    known = np.array([xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
    return known[coded.indices.to_numpy()] if len(known) else np.zeros(0, np.uint64)
