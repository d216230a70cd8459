import numpy as np
import pytest

from millrace.llm.queries import QUERIES
from millrace.llm.vectors import linked, near_duplicates

SF = "/root/testdata/sf0.01"


def expected(rows, threshold=0.9):
    n = len(rows)
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    links = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(n):
            if i != j and ok[i] and ok[j] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
                links[i, j] = a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold
    out = []
    for i in range(n):
        reach, todo = {i}, [i]
        while todo:
            for j in np.flatnonzero(links[todo.pop()]):
                if j not in reach:
                    reach.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in reach if rows[j][0] is not None]
        least = min(ids, default=None)
        out.append((rows[i][0], int(links[i].sum()), least, rows[i][0] == least))
    return sorted(out, key=str)


def got(df, **kw):
    return sorted(map(tuple, near_duplicates(df, **kw).collect()), key=str)


@pytest.mark.parametrize("tile", [7, 64])
def test_random_and_odd_vectors(spark, tile):
    rng = np.random.default_rng(tile)
    base = rng.normal(size=(12, 8))
    rows = [(i, (base[i % 12] * rng.uniform(0.1, 9) + rng.normal(size=8) * rng.uniform(0, 0.4)).astype(np.float32).tolist()) for i in range(90)]
    rows += [(i + 50, rows[i][1]) for i in range(5)] + [(200, None), (201, []), (202, [0.0] * 8), (203, [1.0] * 7), (204, [float("nan")] * 8)]
    rows += [(205, [float("inf")] + [1.0] * 7), (206, [None] + [1.0] * 7), (None, rows[3][1]), (None, None), (208, [2.0] * 7)]
    df = spark.createDataFrame([(i, v, "a", 1) for i, v in rows], "vec_id long, embedding array<float>, c string, least int")
    assert got(df, tile=tile) == expected(rows)
    assert near_duplicates(df.limit(0)).count() == 0


def test_bound_decides_like_double_precision():
    rng = np.random.default_rng(0)
    a = rng.normal(size=(300, 16))
    b = np.concatenate([a + rng.normal(size=a.shape) * s for s in (0.3, 0.45, 0.6)])
    a, b = (x / np.linalg.norm(x, axis=1)[:, None] for x in (a, b))
    for t in (0.5, 0.9, 0.99):
        assert (linked(a, b, t) == (np.einsum("ik,jk->ij", a, b) >= t)).all()


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    out = sorted(map(tuple, QUERIES["op6_embedding_near_dedup"](spark, SF).select("vec_id", "n_links", "component_id", "kept").collect()), key=str)
    assert out == expected(rows)
