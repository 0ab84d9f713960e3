import numpy as np
import pytest

from tallyweir.llm.language import LANGUAGES, Fit, cases, fit, forward_backward, judge, label_lines, label_of, lines_of, relabel, sample_of, words_of

HOW = Fit(per_label=60, epochs=6)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def field(docs):
    return fit(sample_of(docs, HOW), HOW)


def test_forward_backward_against_all_paths():
    from itertools import product

    rng = np.random.default_rng(0)
    e, a, start = rng.random((1, 4, 3)) + 0.1, rng.random((3, 3)) + 0.1, rng.random(3) + 0.1
    want, pairs, total = np.zeros((4, 3)), np.zeros((3, 3)), 0.0
    for path in product(range(3), repeat=4):
        p = start[path[0]] * np.prod([e[0, i, y] for i, y in enumerate(path)]) * np.prod([a[x, y] for x, y in zip(path, path[1:])])
        total += p
        for i, y in enumerate(path):
            want[i, y] += p
        for x, y in zip(path, path[1:]):
            pairs[x, y] += p
    mask = np.ones((1, 4), dtype=bool)
    post, seen = forward_backward(e, mask, a, start)
    assert np.allclose(post[0], want / total) and np.allclose(seen, pairs / total)
    padded = np.concatenate([e, np.ones((1, 3, 3))], 1)
    post, seen = forward_backward(padded, np.array([[True] * 4 + [False] * 3]), a, start)
    assert np.allclose(post[0, :4], want / total) and np.allclose(seen, pairs / total)


def test_labels(spark):
    from pyspark.sql import functions as F

    said = [" EN-qa ", "fr_FR", "xx", "und", "", None, "ar"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(said)], "i int, l string")
    assert [r.v for r in df.select("i", label_of(F.col("l")).alias("v")).orderBy("i").collect()] == ["en", "fr", None, None, None, None, "ar"]


def test_lines_and_words():
    assert lines_of("a\r\n\r\n \nb") == ["a\r", "b"] and words_of("L'été s’ouvre: 12 الَقديمةُ می‌ماند") == ["l'été", "s’ouvre", "القديمة", "میماند"]


def test_held_out_accuracy(spark, field):
    """The evaluation passages carry right labels, speak of other things than the documents and are no part of the sample."""
    items = spark.read.parquet("/root/testdata/sf0.01/eval_item.parquet").select("text", "lang").collect()
    found = [j[0] for j in judge(field, [r.text for r in items])]
    assert len(items) > 100 and np.mean([a == r.lang for a, r in zip(found, items)]) > 0.97


def test_wrong_labels_do_not_matter(docs):
    sample = sample_of(docs, HOW)
    wrong = [(t, LANGUAGES[(LANGUAGES.index(y) + 1) % 7] if i % 8 == 0 else y) for i, (t, y) in enumerate(sample)]
    a, b = judge(fit(sample, HOW), [t for t, _ in sample]), judge(fit(wrong, HOW), [t for t, _ in sample])
    assert np.mean([x[0] == y[0] for x, y in zip(a, b)]) > 0.98


def test_cases_by_hand(spark, field):
    en = "The opening took place in public on 26/03/2025, with 72 companies present."
    fr = "La garantie couvre les pièces et la main-d'œuvre pendant 15 mois."
    ar = "يحق لجهة الطرح إلغاء المناقصة في أي وقت دون إبداء الأسباب."
    main, sure, lines, mixed = judge(field, [f"{en}\r\n\r\n{en}\n{fr}\n12/2024 | 3"])[0]
    assert main == "en" and mixed and [x for x, _ in lines] == ["en", "en", "fr", "en"] and sure > 0.9
    assert [j[0] for j in judge(field, [None, "", " \n", "328/2020 674.58", "Xqz Vvk", ar, ar + " Tasunir Dajal W.L.L.", en.upper(), en * 300])] == [None] * 5 + ["ar", "ar", "en", "en"]


def test_rows(spark, docs):
    labelled = label_lines(docs, HOW).cache()
    found = cases(labelled)
    assert found.count() == found.distinct().count() > 0
    zero = found.where("line_no = 0").select("doc_id")
    assert found.join(zero, "doc_id", "left_anti").count() == 0
    assert label_lines(docs.limit(0), HOW).count() == 0
    odd = spark.createDataFrame([(1, None, "en"), (2, "", None), (None, "x", "en"), (3, "12", "fr")], "doc_id bigint, text string, lang string").selectExpr("*", "0 AS line_no", "1 AS confidence")
    assert label_lines(odd, HOW).count() == 0


def test_sample_is_bounded_and_fixed(docs):
    a = sample_of(docs, Fit(per_label=5))
    assert a == sample_of(docs.repartition(7), Fit(per_label=5)) and len(a) <= 35
    assert relabel([], 2) == [] and fit([]).lexicon == {}
