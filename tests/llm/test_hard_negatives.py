import numpy as np
import pytest

from millrace.llm.hard_negatives import CoverTree, augmented, hard_negatives


def expected(rows, every=50, positives=5, negatives=3):
    kept = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or not all(x is not None and np.isfinite(x) for x in v):
            continue
        kept[i, label, tuple(int(np.floor(256 * float(x))) for x in v)] = None
    out = []
    for a, la, va in kept:
        if a % every:
            continue
        others = sorted((-sum(x * y for x, y in zip(va, v, strict=True)), i, label) for i, label, v in kept if i != a and len(v) == len(va))
        for s, p, _ in [x for x in others if x[2] == la][:positives]:
            fit = [x for x in others if x[2] != la and 50 * -s <= 100 * -x[0] <= 95 * -s]
            out += [(a, p, r + 1, i, -s, -t) for r, (t, i, _) in enumerate(fit[:negatives])]
    return sorted(out)


def got(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, label, "x", 1) for i, v, label in rows], "vec_id long, embedding array<float>, label int, score string, block int")
    return sorted(map(tuple, hard_negatives(df, **kw).collect()))


@pytest.mark.parametrize("block, batch", [(4096, 4096), (40, 5)])
def test_against_brute_force(spark, block, batch):
    rng = np.random.default_rng(block)
    base = rng.normal(size=(9, 8))
    rows = [(int(i), (base[i % 9] + rng.normal(size=8) * rng.uniform(0, 0.9)).astype(np.float32).tolist(), int(rng.integers(0, 4))) for i in range(240)]
    rows += [(300 + i, rows[9][1], i % 3) for i in range(30)]  # one vector often, with several labels
    rows += rows[:6] + [(50, rows[7][1], 1), (100, rows[8][1], rows[100][2])]  # repeated rows and ids
    rows += [(400, None, 1), (450, rows[1][1], None), (401, [], 1), (500, [], 2), (402, [0.0] * 8, 1), (403, [1.0] * 7, 1), (550, [1.0] * 7, 1), (405, [0.6] * 7, 2)]
    rows += [(None, rows[1][1], 1), (406, [float("nan")] * 8, 1), (407, [float("inf")] + [1.0] * 7, 1), (408, [None] + [1.0] * 7, 1), (-50, rows[2][1], 3)]
    assert got(spark, rows, block_rows=block, batch_searches=batch) == expected(rows)


def test_odd_tables(spark):
    assert got(spark, []) == []
    assert got(spark, [(0, [1.0, 0.0], 1)]) == []
    with pytest.raises(ValueError):
        got(spark, [(0, [1e9, 0.0], 1)])
    with pytest.raises(ValueError):
        got(spark, [], low_percent=96)


@pytest.mark.parametrize("seed", range(4))
def test_tree_skips_only_what_lies_outside(seed):
    rng = np.random.default_rng(seed)
    v = np.floor(rng.normal(size=(500, 5)) * 40 + rng.integers(-3, 4, size=(500, 1)) * 100)
    top = float((v * v).sum(axis=1).max())
    x, q = augmented(v, top), np.hstack([v[:40], np.zeros((40, 1))])
    tree = CoverTree(x, leaf_rows=4)
    s = v[:40] @ v.T
    low, high = np.sort(rng.choice(s.ravel(), (2, 40)), axis=0)
    upper = tree.bounds(q, low, high, top)
    leaf = np.empty(500, int)
    for i, m in enumerate(tree.members):
        leaf[m] = i
    inside = (s >= low[:, None]) & (s <= high[:, None])
    assert (upper[:, leaf] >= np.where(inside, s, -np.inf)).all()
    assert np.isinf(upper).any()
    rows, score = tree.best(x, q, low, high, top, 3, lambda a, b: np.ones((len(a), len(b)), bool), np.arange(500))
    for i in range(40):
        want = sorted((-s[i, j], j) for j in range(500) if inside[i, j])[:3]
        assert [(-a, b) for a, b in zip(score[i], rows[i], strict=True) if b >= 0] == want
