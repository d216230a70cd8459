import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.llm.queries import QUERIES
from millrace.llm.substring_dedup import remove_repeated_passages
from millrace.llm.suffix_dedup import remove_repeated_bytes

SF = "/root/testdata/sf0.001"


def brute(texts, window, by_words):
    units = [(t or "").encode() for t in texts]
    if by_words:
        units = [u.split() for u in units]
    seen = Counter(tuple(u[i : i + window]) if by_words else u[i : i + window] for u in units for i in range(len(u) - window + 1))
    for u in units:
        gone = bytearray(len(u))
        for i in range(len(u) - window + 1):
            w = u[i : i + window]
            if seen[tuple(w) if by_words else w] > 1:
                gone[i : i + window] = b"\1" * window
        kept = [u[i] for i in range(len(u)) if not gone[i]]
        yield len(u), sum(gone), bytes(gone).lstrip(b"\0").split(b"\0").__len__() and sum(1 for p in bytes(gone).split(b"\0") if p), b" ".join(kept) if by_words else bytes(kept)


def check(spark, texts, window, k, by_words, ids=None):
    df = spark.createDataFrame([(i if ids is None else ids[i], t, "x", "y") for i, t in enumerate(texts)], "doc_id long, text string, h string, id string")
    f = remove_repeated_passages if by_words else remove_repeated_bytes
    got = Counter((r[0], r[1], r[2], r[3], r[4].encode() if by_words else bytes(r[4])) for r in f(df, window, k).collect())
    want = Counter((i if ids is None else ids[i], *row) for i, row in enumerate(brute(texts, window, by_words)))
    assert got == want


def corpus(seed, letters, n):
    rng = random.Random(seed)
    def prose(m):
        return "".join(rng.choice(letters) + rng.choice(["", "", " ", "  ", "\n"]) for _ in range(m))
    shared = [prose(rng.randint(20, 120)) for _ in range(4)]
    out = [None, "", " ", "a"]
    for _ in range(n):
        parts = [prose(rng.randint(0, 80)) for _ in range(rng.randint(1, 4))]
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            cut = rng.randint(0, len(s))
            parts.insert(rng.randint(0, len(parts)), s[cut // 3 : len(s) - cut // 4])
        out.append("".join(parts))
    return out + out[-5:] + ["a" * 300, "a" * 280 + "b", "ab " * 90, "ü" * 90]


@pytest.mark.parametrize("by_words,window,k", [(True, 7, 3), (True, 6, 2), (False, 40, 8), (False, 25, 4)])
@pytest.mark.parametrize("letters", ["abcdefghijklmnopqrstuvwxyzüé", "ab"])
def test_random_texts(spark, by_words, window, k, letters):
    check(spark, corpus(window, letters, 60), window, k, by_words)


@pytest.mark.parametrize("by_words", [True, False])
def test_repeated_and_null_ids(spark, by_words):
    texts = ["one two three four five six seven eight"] * 3 + ["x one two three four five six y", None, None, ""]
    check(spark, texts, 5, 2, by_words, ids=[1, 1, None, None, None, 2, 2])


@pytest.mark.parametrize("by_words", [True, False])
def test_empty_table(spark, by_words):
    df = spark.createDataFrame([], "doc_id long, text string")
    f = remove_repeated_passages if by_words else remove_repeated_bytes
    assert f(df, 5, 2).count() == 0


@pytest.mark.parametrize("name,window,by_words", [("op1_substring_dedup", 35, True), ("op9_suffix_dedup", 200, False)])
def test_query(spark, name, window, by_words):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: (r[1], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in QUERIES[name](spark, SF).collect()}
    want = brute([r["text"] for r in rows], window, by_words)
    assert got == {r["doc_id"]: (*w[:3], hashlib.sha256(w[3]).hexdigest()) for r, w in zip(rows, want, strict=True)}
    assert any(v[1] for v in got.values())


def test_words_made_to_share_sums_of_powers(spark):
    odd = ["".join("ab"[bin(i).count("1") % 2 ^ turn] for i in range(1024)) for turn in (0, 1)]
    words = [f"w{i}" for i in range(34)]
    texts = [" ".join([*words, w]) for w in odd] + [" ".join([w, *words[::-1]]) for w in odd]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.n_removed for r in remove_repeated_passages(df).collect()] == [0] * 4


def test_bad_sizes():
    with pytest.raises(ValueError):
        remove_repeated_passages(None, 5, 5)
