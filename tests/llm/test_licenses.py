import random
import re

from millrace.llm.licenses import PHRASES, TEMPLATES, scan
from millrace.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    words = WORD.findall((text or "").encode().lower())
    found = []
    for phrase, label in PHRASES:
        p = phrase.encode().split()
        found += [(i, label) for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
    at = [i for i, _ in found]
    return len(words), len(found), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))


def key(r):
    return r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels


TEXTS = [
    None,
    "",
    "Released under the MIT License. under the mit license",
    "under the\nMIT-license; APACHE LICENSE, version 2.0",
    "apache license version 20",
    "cc by nc cc by nc cc by-nc",
    "cc by",
    "under the mit",
    "license under the mit license",
    "É under the mitlicense ü cc BY nc",
    "Licensed under the GNU terms: under the terms of the GNU General Public License version 3",
    "under the terms of the GNU Gener Public License version 3",
    "word " * 30_000 + "cc by nc",
]


def test_texts(spark):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(TEXTS)] + [(None, TEXTS[2], 1, "x"), (2, TEXTS[2], 1, "x")], "doc_id long, text string, score int, word string")
    rows = scan(df).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        text = TEXTS[2] if r.doc_id is None else TEXTS[r.doc_id]
        assert key(r) == brute(text), text
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    got = {r.doc_id: r for r in rows}
    assert got[10].labels == "gpl-3" and got[11].labels == "" and got[2].score == 1
    assert scan(df.limit(0)).count() == 0


def test_random_texts(spark):
    rng = random.Random(2)
    vocabulary = sorted({w for p, _ in PHRASES for w in p.split()}) + ["x", "é"]
    texts = [(i, "".join(rng.choice(vocabulary) + rng.choice([" ", " ", "-", ". ", ""]) for _ in range(rng.randint(0, 60)))) for i in range(300)]
    texts += [(400 + i, " ".join([p for p, _ in rng.choices(PHRASES, k=3)] + ["under the"])) for i in range(50)]
    for r in scan(spark.createDataFrame(texts, "doc_id long, text string")).collect():
        assert key(r) == brute(dict(texts)[r.doc_id])


def test_templates_are_found_whole(spark):
    df = spark.createDataFrame([(i, f"intro words {t.words.upper()} and more") for i, t in enumerate(TEMPLATES)], "doc_id long, text string")
    for r in scan(df).collect():
        assert TEMPLATES[r.doc_id].label in r.labels.split(",")


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op3_license_scan"](spark, SF).collect()
    assert {r.doc_id: key(r) for r in rows} == {i: brute(t) for i, t in texts.items()}
    assert any(r.n_base for r in rows)
