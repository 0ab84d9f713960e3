import base64

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyweir.llm.tokenizer import PATTERN, VOCABULARY, Encoder, byte_characters, decode, encode, model_bytes, read_ranks
from tests.oracle import SF


@pytest.fixture(scope="module")
def encoder():
    return Encoder(model_bytes(read_ranks()))


@pytest.fixture(scope="module")
def plain():
    """The vocabulary in its own library."""
    import tiktoken

    with open(VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def ids(encoder, *texts):
    flat, ends = encoder.encode_batch(list(texts))
    return [list(flat[a:b]) for a, b in zip(ends, ends[1:])]


def test_bytes_have_each_their_character():
    assert len(set(byte_characters())) == 256


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(), st.text("ab '\n\t .,0١éß🙂", max_size=60)))
def test_like_the_library(encoder, plain, text):
    assert ids(encoder, text) == [plain(text)]


def test_odd_texts(encoder, plain):
    texts = ["", None, "<|endoftext|> <unk>", "a" * 20_000, " " * 5_000, "\u0000\u0001", "漢字かな", "‮‍👩‍🔧", "it's\r\n\r\n x  y"]
    assert ids(encoder, *texts) == [plain(t or "") for t in texts]


def test_the_corpus(spark, plain):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    got = encode(docs).collect()
    assert len(got) == docs.count() and all(r.ids == plain(texts[r.doc_id] or "") for r in got)


def test_round_trip_and_edges(spark):
    data = [(1, "héllo\r\nسلام"), (2, None), (3, ""), (1, "again"), (None, "x")]
    df = spark.createDataFrame(data, "doc_id bigint, text string").selectExpr("*", "0 AS ids", "'' AS tokens")
    assert sorted(map(tuple, decode(encode(df)).collect()), key=str) == sorted([(i, t or "") for i, t in data], key=str)
    assert encode(df.limit(0)).count() == 0
    odd = spark.createDataFrame([(1, None), (2, []), (3, [-1, 99_999, None])], "doc_id bigint, ids array<int>")
    assert [r.text for r in decode(odd).collect()] == ["", "", "���"]
