import random
import zlib
from itertools import combinations

import numpy as np
import pytest

from millrace.llm import toxicity
from millrace.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def kernel(s, t):
    """Gap-weighted triples of two words of plain letters, start mark included, by enumeration."""

    def triples(w):
        out = {}
        w = "^" + w
        for i, j, k in combinations(range(len(w)), 3):
            if k - i < toxicity.SPAN:
                out[w[i], w[j], w[k]] = out.get((w[i], w[j], w[k]), 0) + toxicity.DECAY ** (k - i + 1)
        return out

    a, b = triples(s), triples(t)
    return sum(v * b.get(u, 0) for u, v in a.items())


def test_features_give_the_kernel():
    words = ["idiot", "idioot", "banana", "ab", "a", "abcabcabcabc"]
    rows, _ = toxicity._features(words)
    scale = toxicity._scale(np.array([len(w) + 1 for w in words]))
    got = (rows @ rows.T) * scale[:, None] * scale[None, :]
    want = np.array([[kernel(s, t) for t in words] for s in words])
    assert np.allclose(got, want, rtol=1e-4)


def test_words_of_texts_score_as_alone():
    rng = np.random.default_rng(1)
    table = rng.normal(size=64**3).astype(np.float32)
    texts = ["one two", "", "  ", "three", "i d i o t x yes", "É ñandú\tß"]
    margins, firsts = toxicity.word_margins(table, 0.5, [t.encode() for t in texts])
    assert list(np.diff(firsts)) == [2, 0, 0, 1, 2, 3]
    for word, m in zip(["one", "two", "three", "i d i o t x", "yes", "é", "ÑANDÚ"], margins, strict=False):
        assert toxicity.word_margins(table, 0.5, [word.encode()])[0][0] == pytest.approx(m, abs=1e-4)


def made_up(spark, toxic_words):
    rng = random.Random(3)
    clean = ["".join(rng.choice("bdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(400)]
    docs, labels = [], []
    for i in range(900):
        text = rng.choices(clean, k=rng.randint(4, 30))
        toxic = i % 4 == 0
        if toxic:
            text.insert(rng.randint(0, len(text)), rng.choice(toxic_words))
        docs.append((i, " ".join(text), "x"))
        labels.append((i, 1, int(toxic)))
    return spark.createDataFrame(docs, "doc_id long, text string, toxic string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_gaps_and_odd_rows(spark):
    docs, labels = made_up(spark, ["wretchling", "scumbucket", "dumbhead"])
    odd = spark.createDataFrame([(None, None), (1, None), (None, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels.drop("quality").unionByName(odd))
    texts = [None, "", " ", "banana potato", "you wretchling!", "wretch-ling", "scum.bucket", "w r e t c h l i n g", "SCUMBUUCKET", "dumbhead " + "fine words " * 3000, "a" * 50_000]
    df = spark.createDataFrame([(i, t, 0.5) for i, t in enumerate(texts)] + [(None, "scumbucket", 0.1), (3, texts[3], 0.5)], "doc_id long, text string, score double")
    rows = toxicity.score(df, model).collect()
    assert len(rows) == len(texts) + 2
    got = {r.doc_id: r for r in rows}
    assert [got[i].predicted for i in range(len(texts))] == [0, 0, 0, 0, 1, 1, 1, 1, 1, 1, 0]
    assert got[None].predicted == 1 and got[None].held_out is False
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows if r.doc_id is not None)
    kept = toxicity.drop_toxic(df, model)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [0, 1, 2, 3, 3, 10]
    assert toxicity.score(df.limit(0), model).count() == 0


@pytest.mark.parametrize("condition", ["false", "toxic = 0", "toxic = 1"])
def test_nothing_to_learn(spark, condition):
    docs, labels = made_up(spark, ["scumbucket"])
    model = toxicity.fit(docs, labels.where(condition))
    assert {(r.score, r.predicted) for r in toxicity.score(docs, model).collect()} == {(0.0, 0)}
    assert toxicity.drop_toxic(docs, model).count() == 900


def test_held_out_labels_are_not_learnt(spark):
    docs, labels = made_up(spark, ["scumbucket", "dumbhead"])
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 3 = 1 THEN 1 - toxic ELSE toxic END AS toxic")
    a, b = toxicity.fit(docs, labels), toxicity.fit(docs, flipped)
    assert np.array_equal(a.table, b.table) and (a.bias, a.line) == (b.bias, b.line)


def test_query_on_held_out_texts(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op8_toxicity"](spark, SF).collect() if r.held_out and r.doc_id in labels]
    right = sum(r.predicted == labels[r.doc_id] for r in rows)
    toxic = [r for r in rows if labels[r.doc_id]]
    assert len(toxic) > 30 and right / len(rows) > 0.98 and sum(r.predicted for r in toxic) / len(toxic) > 0.9
