import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyweir.llm.leakage import build_index, item_words, leaked_spans, leaks, longest_in_order, probes
from tallyweir.llm.words import words
from tests.oracle import SF


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def best_window(item, doc, span):
    return max((lcs(item, doc[i : i + span]) for i in range(len(doc))), default=0)


WORDS = st.lists(st.sampled_from("abcdef"), max_size=30)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abcde"), min_size=1, max_size=8), WORDS, st.integers(1, 12), st.integers(1, 5))
def test_longest_in_order(item, doc, span, least):
    hits = [(i, w) for i, w in enumerate(doc) if w in item]
    met, first, last = longest_in_order(item, hits, span, least)
    want = best_window(item, doc, span)
    assert met == (want if want >= least else 0)
    assert not met or lcs(item, doc[first : last + 1]) == met and last - first < span


def test_words():
    assert words("The <b>mill-\ner's</b> &ldquo;Café&rdquo; ﬁne") == ["the", "miller", "s", "cafe", "fine"]
    assert words("cou­ncil ١٢ ＡＢ") == ["council", "12", "ab"] and words("القَديمةُ إلى") == words("القديمه الي")
    assert words(None) == words("") == words("--- !") == []


def test_against_all_pairs(spark):
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/eval_item.parquet")
    texts = item_words(items)
    expected = set()
    for r in docs.where("text is not null").collect():
        doc = words(r.text)
        for i, ws in texts.items():
            if len({*ws} & {*doc}) >= 0.4 * len({*ws}):
                hits = [(p, w) for p, w in enumerate(doc) if w in {*ws}]
                if longest_in_order(ws, hits, -(-3 * len(ws) // 2))[0] >= 0.55 * len(ws):
                    expected.add((r.doc_id, i))
    got = [tuple(r) for r in leaks(docs, items).collect()]
    assert len(got) == len(set(got)) and set(got) == expected and expected


@pytest.fixture
def case(spark):
    rng = random.Random(1)
    item = [f"w{i}" for i in range(40)]
    noise = lambda n: [f"n{rng.randrange(300)}" for _ in range(n)]
    altered = [x for i, w in enumerate(item) for x in ([w, "extra"] if i % 7 == 0 else [] if i % 9 == 0 else [w])]
    shuffled = item[:]
    rng.shuffle(shuffled)
    docs = {
        1: noise(50) + item + noise(50), 2: noise(5) + altered, 3: noise(9) + item[10:33], 4: noise(9) + item[:20], 5: shuffled, 6: noise(200), 7: [x for w in item for x in [w, *noise(4)]], 8: item * 200,
    }
    data = [(k, " ".join(v)) for k, v in docs.items()] + [(9, None), (10, ""), (11, "..."), (None, " ".join(item)), (1, " ".join(docs[1]))]
    return spark.createDataFrame(data, "doc_id bigint, text string").selectExpr("*", "'x' AS term", "1 AS item_id"), spark.createDataFrame([(5, " ".join(item)), (6, None), (7, ""), (8, "lone")], "item_id bigint, text string")


def test_cases(case):
    got = {r.doc_id: r for r in leaked_spans(*case).where("item_id = 5").collect()}
    assert sorted(got) == [1, 2, 3, 8] and got[1].kind == "phrase" and (got[1].first_word, got[1].last_word) == (50, 89) and got[2].kind == "proximity" and got[3].matched == 23


def test_empty_tables(case):
    docs, items = case
    assert leaks(docs.limit(0), items).count() == 0 and leaks(docs, items.limit(0)).count() == 0 and leaks(docs, items.where("item_id = 6")).count() == 0


def test_index_holds_positions(spark, case, tmp_path):
    rows = build_index(case[0], None, str(tmp_path / "ix")).where("doc_id = 3 and term = 'w10'").collect()
    assert [r.positions for r in rows] == [[9]]


def test_probes_promise():
    texts = {1: [f"w{i}" for i in range(20)]}
    p = probes(texts, {}, 0.55)
    n, k, need = 20, len(p), p[0][4]
    assert k - need == int(0.45 * n)  # a text with 11 of 20 words lacks at most 9 of any k
