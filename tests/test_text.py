import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyweir.functions import dates, similarity, text


def values(spark, f, cases):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, c string")
    return [r.v for r in df.select("i", f(F.col("c")).alias("v")).orderBy("i").collect()]


def test_cr_roots(spark):
    same = ["29309", "29309/1", "CR-29309", "CR 29309", "029309", "29,309", "29309.0", "٢٩٣٠٩", "۲۹۳۰۹", "  29309  ", "29309, 29310"]
    assert values(spark, text.cr_root, same) == ["29309"] * len(same)
    assert values(spark, text.cr_root, [None, "", "N/A", "0", "-"]) == [None] * 5
    qfc = lambda c: text.cr_root(c, qfc=True)
    assert values(spark, qfc, ["QFC/00326", "QFC00326", "qfc-326", "QFC 326", "QFC/", "326"]) == ["QFC326"] * 4 + [None, "326"]
    assert values(spark, lambda c: text.split_cr(c)["secondary"], ["1/1 | 10497", "1", None]) == ["10497", None, None]


def test_names(spark):
    cases = {
        "AL RAYYAN TRADING W L L": "rayyan trading", "Al-Rayan Trading Co. WLL": "rayan trading", "MARINA CONSTR CO WLL": "marina construction", "Payment to Café Déjà Vu W.L.L. ref: AB12": "cafe deja vu", "refrigeration works": "works",
        "": "", None: "", "the of and": "", "WLL": "", "Gulf (Qatar) 1234567 Ltd": "gulf qatar", "A B C Trdg": "abc trading",
        "شركة الريان للتجارة ذ.م.م": "ريان تجاره", "مؤسسة الرّيان للتجارة": "ريان تجاره", "الريان للتجاره": "ريان تجاره",
    }
    assert dict(zip(cases, values(spark, text.normalize_name, list(cases)))) == cases
    assert values(spark, text.canonical_key, ["GULF PACKAGING INDUSTRIES", "Industries Packaging Gulf Gulf"]) == ["gulf industries packaging"] * 2
    assert values(spark, text.match_keys, ["bb aa", "aa bb", None]) == [["bb aa", "aa bb"], ["aa bb"], []]
    assert values(spark, text.consonant_skeleton, ["AL RAYYAN TRADING", "الريان للتجارة", None]) == ["ryn trdng", "ryn trdng", ""]
    assert values(spark, text.skeleton_forms, ["AL RAYYAN TRADING", "كيروي للمقاولات", None, "!"]) == [["ryntrdng"], ["kyrwycntrctng", "kyrwylmqwlt"], [], []]
    assert values(spark, lambda c: text.arabic_to_latin(c, "letters"), ["كيروي للمقاولات ١٢"]) == ["kyrwy llmqawlat 12"]
    assert values(spark, text.is_arabic, ["x ، y", "اب", None]) == [False, True, False]


def test_dates_money_labels(spark):
    assert [str(v) for v in values(spark, dates.parse_date, ["21/06/2026", "31/02/2026", "on 1/2/2026.", "text", None])] == ["2026-06-21", "None", "2026-02-01", "None", "None"]
    assert [str(v) for v in values(spark, dates.iso_date, ["2026-06-21T10:00", "2026-02-31", "21/06/2026", None])] == ["2026-06-21", "None", "None", "None"]
    assert values(spark, text.parse_money, ["1,481,863.33 QAR", "", None, "QAR -5", ","]) == [1481863.33, None, None, -5.0, None]
    assert values(spark, text.norm_label, ["  Award  Date :", None, "::"]) == ["award date ", "", ""]
    assert values(spark, text.clean_cell, ["12345.0", " x ", None, "1.5"]) == ["12345", "x", "", "1.5"]
    assert values(spark, text.direction, ["Buyers", "VENDOR", "?", None, "seller"]) == ["buyer", "supplier", "counterparty", "counterparty", "buyer"]
    assert values(spark, text.stage_for_heading, ["Technical/Financial Opened", "Financially  opened:", "x", None]) == ["technical_financial", "financial", "unknown", "unknown"]
    assert values(spark, text.kind_from_url, ["https://s/AwardedTenders/3", "https://s/ClosedBids/", "https://s/x", None]) == ["awarded", "bids-closed", None, None]
    assert values(spark, lambda c: text.last_listing_page(c, "AwardedTenders"), ["<a href='/AwardedTenders/2'><a href='/AwardedTenders/12'>", "x"]) == [12, None]
    assert values(spark, text.looks_rejected, ["The requested URL was rejected.", "fine", None]) == [True, False, False]


def test_fingerprint(spark):
    a, b, c = values(spark, text.html_fingerprint, ["<p>x <script>1</script> y</p>", "<p>x\n<SCRIPT a='1'>2</SCRIPT><!-- n --> y</p>", "<p>x z</p>"])
    assert a == b != c


def test_similarity(spark):
    pairs = [("najm al farid trading", "najm alfarid trading"), ("a b", "b a"), ("", "x"), (None, "x"), ("abc", "abc")]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    got = df.select("i", similarity.token_sort_similarity(F.col("a"), F.col("b")).alias("v"), similarity.indel_ratio("a", "b").alias("w")).orderBy("i").collect()
    assert [round(r.w, 4) for r in got] == [0.9756, 0.3333, 0.0, 0.0, 1.0] and [round(r.v, 2) for r in got][1:] == [1.0, 0.0, 0.0, 1.0]
    cross = spark.createDataFrame([("AL RAYYAN TRADING", "الريان للتجارة"), ("x", "y"), ("Rn", "رن")], "a string, b string")
    assert [r.v for r in cross.select(similarity.translit_similarity(F.col("a"), F.col("b")).alias("v")).collect()] == [1.0, 0.0, 0.0]
    assert cross.select(similarity.similarity(F.col("a"), F.col("b")).alias("v")).first().v == 1.0


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.text("abc", max_size=12), st.text("abc", max_size=12))
def test_common_length(a, b):
    assert similarity.common_length(a, b) == lcs(a, b)


@pytest.mark.parametrize("a, b, months", [("2025-01-31", "2025-02-28", 1), ("2024-12-01", "2026-01-31", 13)])
def test_months(spark, a, b, months):
    r = spark.range(1).select(dates.months_between(F.to_date(F.lit(a)), F.to_date(F.lit(b))).alias("m"), dates.month_grid(F.to_date(F.lit(a)), F.to_date(F.lit(b))).alias("g"), dates.month_grid(F.to_date(F.lit(b)), F.to_date(F.lit(a))).alias("n")).first()
    assert r.m == months and len(r.g) == months + 1 and r.n == []
