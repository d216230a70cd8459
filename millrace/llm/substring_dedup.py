"""Substring dedup by compaction of a De Bruijn graph over word k-mers.

The edges are the ``k``-word pieces that anchor windows of ``window`` words (:mod:`millrace.llm.repeats`):
each edge is a path of consecutive windows and is one row. Edges seen once are not in the graph of repeats.
An edge with one content wherever it stands lies on a path without branches, which compacts to one decision
by a join on the edge. Where contents branch, each content is read at its source coordinates once and
compared window by window; the result goes back to every place by a join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import flat, repeats


def remove_repeated_passages(df: DataFrame, window: int = 35, k: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove each word that lies in a passage of ``window`` words which also starts elsewhere.

    Words are what white space (blank, ``\\t`` to ``\\r``) parts. Passages are judged on the input, in the
    same row or another. Returns ``id_col, n_words, n_removed, n_spans, kept``, one row per input row, where
    ``kept`` has the remaining words joined by one space. Null and empty texts have no words. Rows that share
    an id are judged each by itself; null ids are kept. Other columns are ignored.
    """
    if not 1 <= k < window:
        raise ValueError("k must be at least 1 and below window")
    docs = flat.keyed_texts(df, id_col, text_col)
    out = repeats.with_repeats_removed(docs, window, k, by_words=True, block=4)
    return out.select(
        F.col("id").alias(id_col),
        F.col("n_units").alias("n_words"),
        "n_removed",
        "n_spans",
        F.col("kept").cast("string").alias("kept"),
    )
