"""Licence scan by a positional index of rare words.

Every template is a word sequence with mandatory key phrases. The index maps each licence word to its
postings (template, position) and knows its inverse document frequency over the corpus. A file is looked up
by its rarest licence words only: for a key phrase that is its one rarest word, so each occurrence of that
word proposes a place, and the phrase's other words must stand at their relative positions. For a whole
template its rarest words vote for a shift; a template is present when enough of its words agree on one
shift and its key phrases stand in the file.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import flat

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SEPARATOR = np.ones(256, bool)
_SEPARATOR[0x30:0x3A] = _SEPARATOR[0x61:0x7B] = _SEPARATOR[0x80:] = False

#: Phrases whose places are counted, with their labels.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)


@dataclass(frozen=True)
class Template:
    """A licence notice: its label, its words, and the phrases without which it is not that licence."""

    label: str
    words: str
    keys: tuple[str, ...]


#: Short notices as they are written into files.
TEMPLATES = (
    Template("mit", "released under the mit license", ("mit license",)),
    Template("apache-2", "licensed under the apache license version 2 0", ("apache license", "version 2")),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by", "licensed under cc by 4 0", ("cc by 4",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("gpl-3", "under the terms of the gnu general public license version 3", ("gnu general public license", "version 3")),
    Template("lgpl-3", "under the terms of the gnu lesser general public license version 3", ("gnu lesser general public license", "version 3")),
    Template("mpl-2", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template("bsd-3", "redistribution and use in source and binary forms with or without modification are permitted", ("redistribution and use", "source and binary forms")),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software", "public domain")),
)


def _hashes(words: Sequence[str]) -> np.ndarray:
    body = np.frombuffer(" ".join(words).encode(), np.uint8)
    starts, ends, _ = flat.words(body, np.array([0, len(body)]), _SEPARATOR)
    return flat.word_hashes(body, starts, ends)


def _word_rows(batch_text: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    body = _LOWER[batch_text]
    starts, ends, offsets = flat.words(body, at, _SEPARATOR)
    return flat.word_hashes(body, starts, ends), offsets


def word_idf(df: DataFrame, words: Sequence[str], text_col: str = "text") -> dict[str, float]:
    """Inverse document frequency of each of ``words`` over all rows of ``df``; null texts have no words."""
    flat.small_batches(df)
    known = sorted(set(words))
    hashes = _hashes(known)
    order = np.argsort(hashes)
    ranked = hashes[order]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, total = np.zeros(len(known), np.int64), 0
        for batch, body, at in flat.chunks(batches):
            own, offsets = _word_rows(body, at)
            place = np.minimum(np.searchsorted(ranked, own), len(ranked) - 1)
            hit = np.flatnonzero(ranked[place] == own)
            doc = np.searchsorted(offsets, hit, "right") - 1
            found[order] += np.bincount(np.unique(doc * len(known) + place[hit]) % len(known), minlength=len(known))
            total += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(range(len(known) + 1), pa.int32()), pa.array([*found.tolist(), total])], names=["word", "n"])

    texts = df.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # One row per licence word and task, then one per word.
    counts = {r.word: r.n for r in texts.mapInArrow(rows, "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()}
    total = counts.get(len(known), 0)
    return {w: float(np.log((total + 1) / (counts.get(i, 0) + 1))) for i, w in enumerate(known)}


def scan(df: DataFrame, phrases: Sequence[tuple[str, str]] = PHRASES, templates: Sequence[Template] = TEMPLATES, rare: int = 4, agree: float = 0.75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_words, n_base, first_word, last_word, base_labels, labels, score``, one row per row of ``df``.

    Words are runs of digits, letters and bytes above 0x7F, with A-Z lower-cased. ``n_base`` counts all places
    where the words of one of ``phrases`` stand one after the other; ``first_word`` and ``last_word`` are the
    smallest and largest such place (null without). ``labels`` adds the templates found: those whose
    ``rare`` rarest words agree on a shift at which ``agree`` of all its words stand, and whose key phrases all
    stand somewhere in the text. ``score`` is the best share of a template's words found at one shift, 1 with
    a base phrase. Label columns are distinct, sorted and comma-joined. Null and empty texts have no words;
    repeated rows and null ids are rows of their own; other columns are ignored.
    """
    flat.small_batches(df)
    split = [(p.split(), label) for p, label in phrases]
    keyed = [(t.label, t.words.split(), [k.split() for k in t.keys]) for t in templates]
    idf = word_idf(df, [w for p, _ in split for w in p] + [w for _, ws, ks in keyed for w in ws + [x for k in ks for x in k]], text_col)

    def rarest(words: list[str], n: int) -> list[int]:
        first = {w: i for i, w in reversed(list(enumerate(words)))}
        return sorted(first.values(), key=lambda i: (-idf[words[i]], i))[:n]

    def phrase(words: list[str]) -> tuple[np.ndarray, int]:
        return _hashes(words), rarest(words, 1)[0]

    base = [(*phrase(p), label) for p, label in split]
    known = [(label, _hashes(ws), rarest(ws, rare), [phrase(k) for k in ks]) for label, ws, ks in keyed]

    def places(own: np.ndarray, doc: np.ndarray, postings, words: np.ndarray, anchor: int) -> np.ndarray:
        """Where ``words`` stand one after the other within one text, from the places of their rarest word."""
        start = postings(words[anchor]) - anchor
        start = start[(start >= 0) & (start + len(words) <= len(own))]
        for i, w in enumerate(words):
            start = start[own[start + i] == w]
        return start[doc(start) == doc(start + len(words) - 1)]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unique(np.concatenate([w[[a]] for w, a, _ in base] + [ws[r] for _, ws, r, _ in known] + [k[[a]] for *_, ks in known for k, a in ks]))
        for batch, body, at in flat.chunks(batches):
            own, offsets = _word_rows(body, at)
            rank = np.minimum(np.searchsorted(wanted, own), len(wanted) - 1)
            hit = np.flatnonzero(wanted[rank] == own)
            lists = {}
            if len(hit):
                by_word = np.argsort(rank[hit], kind="stable")
                cuts = np.searchsorted(rank[hit][by_word], np.arange(len(wanted) + 1))
                lists = {int(w): hit[by_word[cuts[i] : cuts[i + 1]]] for i, w in enumerate(wanted)}
            none = np.zeros(0, np.int64)
            postings = lambda w: lists.get(int(w), none)
            doc = lambda place: np.searchsorted(offsets, place, "right") - 1
            n = batch.num_rows
            count, least, most = np.zeros(n, np.int64), np.full(n, 1 << 62), np.full(n, -1)
            score = np.zeros(n)
            base_labels, labels = [set() for _ in range(n)], [set() for _ in range(n)]
            for words, anchor, label in base:
                start = places(own, doc, postings, words, anchor)
                d = doc(start)
                np.add.at(count, d, 1)
                np.minimum.at(least, d, start - offsets[d])
                np.maximum.at(most, d, start - offsets[d])
                score[d] = 1
                for i in np.unique(d):
                    base_labels[i].add(label)
                    labels[i].add(label)
            for label, words, anchors, keys in known:
                # Each occurrence of a rare word proposes (text, shift of the template); proposals are judged once.
                proposals = [(doc(p), p - a) for a in anchors for p in [postings(words[a])]]
                d = np.concatenate([p[0] for p in proposals])
                shift = np.concatenate([p[1] for p in proposals])
                pair, votes = np.unique(np.column_stack([d, shift]), axis=0, return_counts=True)
                pair = pair[votes * 2 >= len(anchors)]
                d, shift = pair[:, 0], pair[:, 1]
                same = np.zeros(len(d), np.int64)
                for i, w in enumerate(words):
                    place = shift + i
                    within = (place >= offsets[d]) & (place < offsets[d + 1])
                    same[within] += own[place[within]] == w
                share = same / len(words)
                fits = share >= agree
                for key, anchor in keys:
                    fits &= np.isin(d, doc(places(own, doc, postings, key, anchor)))
                np.maximum.at(score, d[fits], share[fits])
                for i in np.unique(d[fits]):
                    labels[i].add(label)
            missing = count == 0
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(np.diff(offsets)),
                    pa.array(count),
                    pa.array(least, mask=missing),
                    pa.array(most.astype(np.int64), mask=missing),
                    pa.array([",".join(sorted(x)) for x in base_labels], pa.string()),
                    pa.array([",".join(sorted(x)) for x in labels], pa.string()),
                    pa.array(score),
                ],
                names=["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
            )

    texts = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kind = texts.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    return texts.mapInArrow(rows, schema).withColumnRenamed("id", id_col)
