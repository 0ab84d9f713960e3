"""The index holds everything, is read in part and serves more than one set of items."""

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyweir.llm import leakage
from tallyweir.llm.words import _WORD, fold, words


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("aé-_<>&; \n­­١أة½™ﬁＡ́"))))
def test_words_are_those_of_the_folded_text(text):
    assert words(text) == _WORD.findall(fold(text)) == words(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "ü", "w1"]), min_size=1, max_size=9), min_size=1, max_size=5))
def test_a_block_holds_every_position(texts):
    *rows, block = leakage.inverted(texts, [*range(10, 10 + len(texts))], 7, None, 3).to_pylist()
    found = {(r["term"], d): r["positions"][a:b] for r in rows for d, a, b in zip(r["docs"], [0, *r["ends"]], r["ends"])}
    expected = {(w, d): [i for i, x in enumerate(ws) if x == w] for d, ws in enumerate(texts) for w in ws}
    assert found == expected and all(r["n"] == len(r["docs"]) and r["bucket"] == leakage.bucket_of(r["term"], 3) and r["ends"][-1] == len(r["positions"]) for r in rows)
    assert block["ids"] == [*range(10, 10 + len(texts))] and block["bucket"] == -1 and {r["block"] for r in rows} == {7}


def corpus(spark):
    rng = random.Random(2)
    item = [f"w{i}" for i in range(40)]
    rows = [(k, " ".join(rng.choices(["the", "of"], k=30) + [f"n{rng.randrange(90)}" for _ in range(20)])) for k in range(200)] + [(900, " ".join(["the"] * 9 + item)), (901, " ".join(item[:24])), (901, " ".join(item[24:])), (902, None)]
    return spark.createDataFrame(rows, "doc_id bigint, text string"), item


def test_a_second_set_of_items_needs_no_corpus(spark, tmp_path):
    docs, item = corpus(spark)
    path = str(tmp_path / "index")
    leakage.build_index(docs, None, path, 7)
    gone = docs.where("raise_error('the corpus is read again') is null")
    first = spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string")
    second = spark.createDataFrame([(2, "nobody wrote this"), (3, " ".join(item[5:35]))], "item_id bigint, text string")
    assert sorted((r.doc_id, r.item_id) for r in leakage.leaked_spans(gone, first, index=path).collect()) == [(900, 1), (901, 1)]
    assert {(r.doc_id, r.item_id): r.matched for r in leakage.leaked_spans(gone, second, index=path).collect()} == {(900, 3): 30, (901, 3): 19}
    read = leakage.leaked_spans(gone, first, index=path)
    assert not any("text" in f for f in read.columns)


def test_texts_of_one_id_are_not_laid_over_each_other(spark):
    """Two halves under one doc_id hold 24 and 16 words; laid over each other they would hold more of a mixed item."""
    docs, item = corpus(spark)
    mixed = spark.createDataFrame([(1, " ".join(item[:12] + item[24:36]))], "item_id bigint, text string")
    assert [r.doc_id for r in leakage.leaked_spans(docs, mixed).collect()] == [900]


def test_items_in_parts_give_the_same(spark, monkeypatch):
    docs, item = corpus(spark)
    items = spark.createDataFrame([(i, " ".join(item[i : i + 30])) for i in range(8)], "item_id bigint, text string")
    whole = sorted(map(tuple, leakage.leaked_spans(docs, items).collect()))
    assert whole and len([*leakage.item_parts(items, 300)]) > 2
    monkeypatch.setattr(leakage, "item_parts", lambda d, f=leakage.item_parts: f(d, 300))
    assert sorted(map(tuple, leakage.leaked_spans(docs, items).collect())) == whole


def test_counts_stand_beside_the_index(spark, tmp_path):
    docs, _ = corpus(spark)
    leakage.build_index(docs, None, str(tmp_path / "ix"), 3)
    n = {r.term: r.n for r in spark.read.parquet(str(tmp_path / "ix/terms")).collect()}
    expected = {}
    for r in docs.where("text is not null").collect():
        for w in {*r.text.split()}:
            expected[w] = expected.get(w, 0) + 1
    assert n == expected and np.all(np.array([*n.values()]) > 0)
