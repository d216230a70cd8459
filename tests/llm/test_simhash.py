import random
from itertools import combinations

import pytest
import xxhash

from millrace.llm.components import components
from millrace.llm.queries import QUERIES
from millrace.llm.simhash import keep_one, links, near_duplicates

SF = "/root/testdata/sf0.001"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def fingerprint(text, n=3):
    words = lower(text).encode().split()
    shingles = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def expected(rows):
    prints = {i: fingerprint(t) for i, t in rows}
    edges = [(a, b) for a, b in combinations(prints, 2) if bin(prints[a] ^ prints[b]).count("1") <= 3]
    found = roots(prints, edges)
    return {i: (f"{prints[i]:016x}", found[i]) for i in prints}


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op2_simhash_near_dedup"](spark, SF).collect()}
    assert got == expected(rows)


def test_edge_texts(spark):
    texts = [None, "", " \t", "A b", "a  B", "é ü ß", "x", "A B C D", "a b\nc\x0bd", "one two three four five six"]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(texts)], "doc_id long, text string, h int, _id int")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in near_duplicates(df).collect()}
    assert got == expected(list(enumerate(texts)))
    kept = keep_one(df).collect()
    assert {r.doc_id for r in kept} == {c for _, c in got.values()} and kept[0].asDict().keys() == {"doc_id", "text", "h", "_id"}


def test_repeated_rows_and_null_ids(spark):
    df = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (1, "other words here"), (None, "a b c"), (None, "z"), (None, "z"), (None, "y")], "doc_id long, text string")
    assert near_duplicates(df).count() == 7
    assert sorted(map(tuple, keep_one(df).collect()), key=str) == sorted([(1, "a b c"), (1, "other words here"), (None, "z"), (None, "y")], key=str)
    assert keep_one(df.limit(0)).count() == 0


@pytest.mark.parametrize("bits", [0, 1, 3])
def test_links(spark, bits):
    rng = random.Random(bits)
    base = [rng.getrandbits(64) for _ in range(40)]
    near = [b ^ sum(1 << x for x in rng.sample(range(64), rng.randint(1, 5))) for b in base for _ in range(6)]
    prints = [p - (1 << 64) if p >> 63 else p for p in {*base, *near}]
    got = {tuple(sorted(r)) for r in links(spark.createDataFrame([(p,) for p in prints], "fp long"), bits).collect()}
    assert got == {tuple(sorted(e)) for e in combinations(prints, 2) if bin((e[0] ^ e[1]) & (1 << 64) - 1).count("1") <= bits}


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randint(-300, 300), rng.randint(-300, 300)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1200)] + [(5000, i) for i in range(5000, 5400)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {n for e in edges if e[0] != e[1] for n in e}
    assert got == roots(nodes, [e for e in edges if e[0] != e[1]])
