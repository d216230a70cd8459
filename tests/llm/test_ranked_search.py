import math
import re

import numpy as np
import pytest

from millrace.llm.ranked_search import leaders, ranked

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return WORD.findall((text or "").translate(LOWER))


def expected(docs, items, k=10):
    texts = [terms(t) for _, t in docs]
    n_docs, n_words = sum(1 for t in texts if t), sum(map(len, texts))
    df = {}
    for t in texts:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in items:
        scored = []
        for (doc, _), t in zip(docs, texts, strict=True):
            score = 0
            for x in set(terms(text)) & set(t):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1)))
                score += w * ((1_000_000_000 * t.count(x)) // (1000 * t.count(x) + 8 * (10 + 90 * len(t) * n_docs // n_words)))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, i + 1, doc, -s) for i, (s, _, _, doc) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def got(spark, docs, items, **kw):
    left = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, terms string, row int")
    right = spark.createDataFrame([(i, t, 2.0) for i, t in items], "item_id long, text string, score double")
    return sorted(map(tuple, ranked(left, right, **kw).collect()), key=str)


@pytest.mark.parametrize("block, batch", [(4096, 256), (7, 3)])
def test_against_brute_force(spark, block, batch):
    rng = np.random.default_rng(block)
    vocabulary = [f"w{i}" for i in range(60)] + ["é", "Ünter", "a1", "ÀB"]
    weights = 1 / np.arange(1, len(vocabulary) + 1)
    pick = lambda n: " ".join(rng.choice(vocabulary, n, p=weights / weights.sum()))
    docs = [(int(i), pick(rng.integers(0, 40))) for i in rng.permutation(120)]
    docs += [(200, docs[3][1]), (3, docs[5][1]), (200, docs[3][1]), (None, docs[4][1]), (201, None), (202, ""), (203, "-_. !"), (204, "W1,w1;é\x00É w2")]
    docs += [(205, "w1 " * 30_000 + "rare " + "x" * 50_000)]
    items = [(i, pick(rng.integers(1, 30))) for i in range(12)] + [(3, "W1 w1 unknown"), (20, None), (21, ""), (None, "w2 É"), (22, "rare " + "x" * 50_000), (23, "-")]
    assert got(spark, docs, items, block_docs=block, batch_items=batch) == expected(docs, items)


def test_empty_tables(spark):
    some = [(1, "a b")]
    assert got(spark, [], some) == got(spark, some, []) == got(spark, [(1, None)], some) == []
    with pytest.raises(ValueError):
        got(spark, some, some, k=0)


@pytest.mark.parametrize("seed", range(8))
def test_leaders_resolve_ties_and_sums(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 400))
    lists, total = [], np.zeros(n, np.int64)
    for _ in range(rng.integers(1, 9)):
        docs = rng.choice(n, rng.integers(1, n + 1), replace=False)
        impact = -np.sort(-rng.integers(1, rng.choice([3, 1000]), len(docs)))
        lists.append((docs, impact))
        total[docs] += impact
    ids = rng.permutation(n)
    want = sorted((-total[i], ids[i]) for i in range(n) if total[i] > 0)[:10]
    found, scores = leaders(lists, ids, 10, step=int(rng.integers(1, 5)))
    assert [(-s, ids[i]) for i, s in zip(found, scores, strict=True)] == want
