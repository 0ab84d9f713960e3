from tallyweir.llm.leakage import leaked_spans, least_of, probes


def test_share_is_exact():
    for n in range(1, 2001):
        least = -(-11 * n // 20)
        assert least_of(0.55, n) == least
        (_, _, _, _, need), *rest = probes({1: [f"w{i}" for i in range(n)]}, {}, 0.55)
        assert len(rest) + 1 - need == n - least  # as many as a text with the least share may lack


def test_just_the_share_is_a_case(spark):
    item = [f"w{i}" for i in range(100)]
    docs = spark.createDataFrame([(1, " ".join(item[:55])), (2, " ".join(item[:54])), (3, " ".join(item[45:]))], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, " ".join(item))], "item_id bigint, text string")
    assert sorted((r.doc_id, r.matched) for r in leaked_spans(docs, items).collect()) == [(1, 55), (3, 55)]
