import hashlib
import random
import sys

import public_tokenizers
import pytest
import regex
import tiktoken

from millrace.llm import bpe
from millrace.llm.queries import QUERIES, VOCABULARY

SF = "/root/testdata/sf0.001"
RANKS = bpe.read_ranks(VOCABULARY)


@pytest.fixture(scope="module")
def own():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def texts():
    rng = random.Random(1)
    letters = [chr(c) for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    yield from ["", None, "a" * 20_000, " " * 3_000, "ab" * 5_000, "<|endoftext|>", "don't  stop\n\n\t x", "\x1c\x1d\x1e\x1f\x85   　z"]
    for _ in range(300):
        yield "".join(rng.choices(letters, k=30))
        yield "".join(rng.choices("abcdefghij  éñ\n'st1", k=200))
        yield "".join(rng.choices("ab", k=100)) + " " * rng.randint(0, 30)


def test_texts(spark, own):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, ids string")
    got = {r.doc_id: r for r in bpe.decode(bpe.encode(df, VOCABULARY, public_tokenizers.PATTERN), VOCABULARY).collect()}
    for i, t in rows:
        assert list(got[i].ids) == own.encode_ordinary(t or ""), repr(t)
        assert bytes(got[i].decoded) == (t or "").encode()


def test_every_letter_is_cut_alike(own):
    """The pattern's classes mean the same to both regular expression engines, for every letter."""
    encoder = bpe.Encoder(RANKS)
    pieces = regex.compile(public_tokenizers.PATTERN).findall
    odd = []
    for c in [*range(0x32000), *range(0xE0000, 0xE0200), sys.maxunicode]:
        if 0xD800 <= c < 0xE000:
            continue
        text = f"a{chr(c)}1 {chr(c)}  {chr(c)}"
        if [i for p in pieces(text) for i in encoder.ids(p)] != own.encode_ordinary(text):
            odd.append(hex(c))
    assert odd == []


def test_every_token(own):
    encoder = bpe.Encoder(RANKS)
    for token, i in RANKS.items():
        assert encoder.encode_piece(token) == [i]
        for other in (b"a", b" ", b"\xc3"):
            # As merging by rank would, also where no text could give the bytes.
            assert encoder.encode_piece(token + other) == own._core_bpe.encode_single_piece(token + other)


def test_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b")], "doc_id long, text string")
    out = bpe.encode(df, VOCABULARY, public_tokenizers.PATTERN)
    assert out.count() == 3 and bpe.decode(out.limit(0), VOCABULARY).count() == 0
    assert bpe.decode(spark.createDataFrame([(1, None)], "a int, ids array<int>"), VOCABULARY).first().decoded is None


def test_query(spark, own):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op7_byte_bpe"](spark, SF).collect()}
    for r in rows:
        ids = own.encode_ordinary(r.text or "")
        assert got[r.doc_id] == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())
