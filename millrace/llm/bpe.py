"""Byte-level BPE encoding and decoding in linear time.

A piece of text has one encoding that merging byte pairs by rank yields, and it is the only sequence of
tokens whose neighbours are all compatible: two tokens are, when merging the bytes of both gives them back.
So the encoder takes the longest match, checks it with its neighbour (each pair of tokens once, the answer is
kept), goes to shorter ones, and steps back where none fits; a place once given up is never tried again.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from itertools import chain, repeat

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import flat

#: Pieces of text whose ids a worker keeps at once, the longest that it keeps, and the pairs of tokens.
KEPT_PIECES = 300_000
KEPT_LENGTH = 64
KEPT_PAIRS = 1_000_000


class _Pieces(dict):
    """Ids of pieces, made when they are first asked for."""

    def __init__(self, encode: Callable[[bytes], list[int]]):
        self.encode = encode

    def __missing__(self, piece: str) -> tuple[int, ...]:
        found = tuple(self.encode(piece.encode()))
        if len(piece) <= KEPT_LENGTH:
            if len(self) >= KEPT_PIECES:
                self.clear()
            self[piece] = found
        return found


class Encoder:
    """Encodes pieces of text by the ranks of a tiktoken file, as merging pairs in order of rank would."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {i: t for t, i in ranks.items()}
        self.above = max(self.token) + 1
        self.size = {i: len(t) for t, i in ranks.items()}
        self.longest_token = max(map(len, ranks))
        #: The automaton's trie knows how far a text follows some token; ``begun``, the longest token up to there.
        matcher = ahocorasick.Automaton()
        for t, i in ranks.items():
            matcher.add_word(t.decode("latin-1"), i)
        matcher.make_automaton()
        self.follow = matcher.longest_prefix
        self.begun: dict[str, int] = {}
        for t in map(bytes.decode, ranks, repeat("latin-1")):
            for n in range(1, len(t) + 1):
                own = ranks.get(t[:n].encode("latin-1"))
                self.begun[t[:n]] = self.begun[t[: n - 1]] if own is None else own
        self.merged: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.compatible: dict[tuple[int, int], bool] = {}
        #: The longest token that begins a token.
        self.shorter = {i: next((ranks[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in ranks), None) for t, i in ranks.items()}
        self.pieces = _Pieces(self.encode_piece)
        #: Ids of a piece of text.
        self.ids = self.pieces.__getitem__
        for t, i in sorted(ranks.items(), key=lambda x: x[1]):
            self.parts[i] = (i, i)
            left = self.shorter[i]
            while left is not None:
                right = ranks.get(t[self.size[left] :])
                if right is not None and left < i and right < i and self._fits(left, right):
                    self.parts[i] = (left, right)
                    self.merged[left, right] = i
                    break
                left = self.shorter[left]
        self.compatible.clear()

    def _fits(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both tokens yields the two: no merge across their border comes first.

        Undoes the merges inside both, latest first, and looks whether the tokens at the border would have
        merged before those that were undone.
        """
        limit = self.above
        while True:
            across = self.merged.get((left, right))
            if across is not None and across < limit:
                return False
            if left > right:
                order = ((True, left), (False, right))
            else:
                order = ((False, right), (True, left))
            for is_left, token in order:
                part = self.parts[token][1 if is_left else 0]
                if part != token:
                    break
            else:
                return True
            if is_left:
                limit, left = left, part
            else:
                limit, right = right + 1, part

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        text, reach, follow, begun = piece.decode("latin-1"), self.longest_token, self.follow, self.begun
        tokens: list[int] = []
        given_up = bytearray(len(piece) + 1)
        size, compatible, shorter = self.size, self.compatible, self.shorter
        if len(compatible) > KEPT_PAIRS:
            compatible.clear()
        at, token = 0, begun[text[: follow(text[:reach])]]
        while at < len(piece):
            last = tokens[-1] if tokens else None
            while token is not None:
                if not given_up[at + size[token]]:
                    if last is None:
                        break
                    fits = compatible.get((last, token))
                    if fits is None:
                        fits = compatible[last, token] = self._fits(last, token)
                    if fits:
                        break
                token = shorter[token]
            if token is not None:
                tokens.append(token)
                at += size[token]
                if at < len(piece):
                    token = begun[text[at : at + follow(text[at : at + reach])]]
            else:
                given_up[at] = 1
                tokens.pop()
                at -= size[last]
                token = shorter[last]
        return tokens


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def encode(df: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, ids``: the text's token ids (``array<int>``) by the rank file at ``vocabulary``.

    ``pattern`` cuts a text into pieces, each encoded by itself; special tokens are ordinary text. Null and
    empty texts have no ids. One row per input row; other columns are ignored. The file is read on the
    driver and travels with the plan, so executors need no copy.
    """
    ranks = read_ranks(vocabulary)
    flat.small_batches(df)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = flat.per_process(f"bpe {vocabulary}", lambda: Encoder(ranks))
        pieces, ids = regex.compile(pattern).findall, encoder.ids
        for batch, body, at in flat.chunks(batches):
            text = body.tobytes()
            found = [np.fromiter(chain.from_iterable(map(ids, pieces(text[a:b].decode()))), np.int32) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in found]))).astype(np.int32)
            values = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), values], names=["id", "ids"])

    texts = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kind = texts.schema["id"].dataType.simpleString()
    return texts.mapInArrow(rows, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode(df: DataFrame, vocabulary: str, ids_col: str = "ids", to: str = "decoded") -> DataFrame:
    """``df`` with column ``to`` (binary, replacing one of that name): the bytes of the tokens in ``ids_col``.

    Null ids give null, no ids no bytes; an id that the file lacks, or a null among ids, is an error.
    """
    tokens = {i: t for t, i in read_ranks(vocabulary).items()}
    df = df.drop(to)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = tokens.__getitem__
        for batch in batches:
            # A few rows at a time, so that long texts don't meet in one batch.
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                lists = part.column(ids_col)
                out = [b"".join(map(token, x.values.to_numpy(zero_copy_only=False).tolist())) if x.is_valid else None for x in lists]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.binary())], names=[*part.schema.names, to])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + f", `{to}` binary"
    return df.mapInArrow(rows, schema)
