import hashlib

import public_tokenizers
import pytest
import tiktoken
from test_decontaminate import brute as leaks
from test_pii import rewrite
from test_simhash import expected as groups

import __spark_entry__ as contract
import corpus_pipeline
from millrace.llm import bpe, queries

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's rows, written and read again as the next one's input."""
    root = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {"input": docs}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(root / name))
        docs = out[name] = spark.read.parquet(str(root / name))
    return out


def rows(df):
    return {r.doc_id: tuple(r) for r in df.collect()}


def test_columns(stages):
    names = list(stages)
    assert all(stages[n].columns == COLUMNS for n in names[:-1])
    assert names[1:] == ["toxicity", "simhash_near_dedup", "decontamination", "pii", "byte_bpe"]


def test_toxic_documents_go_and_clean_ones_stay(spark, stages):
    before, after = rows(stages["input"]), rows(stages["toxicity"])
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert after.items() <= before.items()
    gone = before.keys() - after.keys()
    clean = [i for i, t in labels.items() if not t]
    assert sum(i in gone for i in clean) < 0.03 * len(clean)
    assert gone


def test_one_of_each_group_stays(stages):
    before, after = rows(stages["toxicity"]), rows(stages["simhash_near_dedup"])
    assert after.items() <= before.items()
    assert after.keys() == {c for _, c in groups([(i, r[1]) for i, r in before.items()]).values()}


def test_documents_with_items_go(spark, stages):
    before, after = rows(stages["simhash_near_dedup"]), rows(stages["decontamination"])
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {d for d, _ in leaks([(i, r[1]) for i, r in before.items()], items)}
    assert after == {i: r for i, r in before.items() if i not in bad}


def test_personal_values_are_replaced(stages):
    before, after = rows(stages["decontamination"]), rows(stages["pii"])
    want = {}
    for i, (_, text, lang, source, _) in before.items():
        text = rewrite(queries.PSEUDONYM_KEY, text)[0]
        want[i] = (i, text, lang, source, len(text))
    assert after == want


def test_ids_decode(stages):
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(queries.VOCABULARY), special_tokens={})
    texts = {i: r[1] for i, r in rows(stages["pii"]).items()}
    got = {r.doc_id: r for r in stages["byte_bpe"].collect()}
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        assert list(got[i].ids) == own.encode_ordinary(text) and got[i].n_tokens == len(got[i].ids)
        assert got[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_run_gives_the_last_stage(spark, stages):
    out = contract.queries()["pipeline"](spark, SF)
    assert {(r.doc_id, r.ids_sha256) for r in out.collect()} == {(r.doc_id, r.ids_sha256) for r in stages["byte_bpe"].collect()}


def test_empty_and_null_documents(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(None, None, None, None, None), (1, "", None, "a", 0), (1, "", None, "a", 0), (2, "word", "en", None, 4), (2, "word", "en", None, 4)], schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == COLUMNS
    assert sorted((r.doc_id, r.text) for r in docs.collect()) == [(1, ""), (2, "word")]
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF) if stage is not corpus_pipeline.encoded else empty
    assert empty.count() == 0
