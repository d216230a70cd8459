"""Suffix-array dedup: equal prefixes of suffixes, through a difference cover, its names, and the rest.

A suffix array finds a repeated string of ``length`` bytes as two suffixes, adjacent in order, that share
``length`` bytes. The difference-cover way sorts a sample of suffixes that is sure to meet any two equal
strings at the same distance, names their beginnings, goes on with the names, and places all other suffixes
by their distance to the next sampled one. Here:

* The sample is a synchronizing set, not fixed residues: the anchor of each window of ``length`` bytes
  (:mod:`millrace.llm.repeats`). Any two equal strings have a sampled position at the same distance, which is
  the property of a cover that the method needs, while 1 suffix in 85 is sampled rather than 2 in 3.
* Names are digests of the bytes that decide: first whole runs, then, where one name has several contents,
  blocks of suffixes, then single suffixes by their distance to the sampled one.
* Two suffixes share ``length`` bytes when their last names are equal; which of them comes first in
  alphabetical order decides nothing, so equal names are brought together by hash, not by a total sort.

The README says why the sample and the order differ from the textbook, with figures.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import flat, repeats


def remove_repeated_bytes(df: DataFrame, length: int = 200, k: int = 32, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove each byte that lies in a string of ``length`` bytes which also starts elsewhere.

    Texts are taken as UTF-8; strings are judged on the input and never cross rows. Returns
    ``id_col, n_bytes, n_removed, n_spans, kept``, one row per input row; ``kept`` is binary, since a cut may
    fall within a letter. Null and empty texts have no bytes. Rows that share an id are judged each by
    itself; null ids are kept. Other columns are ignored.
    """
    if not 1 <= k < length:
        raise ValueError("k must be at least 1 and below length")
    docs = flat.keyed_texts(df, id_col, text_col)
    out = repeats.with_repeats_removed(docs, length, k, by_words=False, block=16)
    return out.select(F.col("id").alias(id_col), F.col("n_units").alias("n_bytes"), "n_removed", "n_spans", "kept")
