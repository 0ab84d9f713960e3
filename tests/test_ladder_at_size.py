import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyweir.functions import text
from tallyweir.functions.similarity import plain_ratio
from tallyweir.operators import blocks, resolve


@pytest.mark.parametrize("many", [0, 1 << 20])
@pytest.mark.parametrize("least", [0.92, 0.3])
def test_pairs_of_many_keys_are_those_of_each_alone_listed_or_by_cells(monkeypatch, many, least):
    monkeypatch.setattr(blocks, "MANY_PAIRS", many)
    monkeypatch.setattr(blocks, "STEP", 50)
    rng = random.Random(4)
    name = lambda: "".join(rng.choice("abdfgوبد ") for _ in range(rng.choice([1, 6, 12, 64, 70])))
    b = [name() for _ in range(150)] + [""]
    a = [s[:3] + s[4:] if k % 2 else s for k, s in enumerate(b[:100])] + [name(), ""]
    a_slot, b_slot = (np.array([rng.randrange(9) for _ in x]) for x in (a, b))
    i, j, s = blocks._of_slots(a, b, a_slot, b_slot, least, blocks._all_rounded())
    got = {(x, y): z for x, y, z in zip(i.tolist(), j.tolist(), s.tolist())}
    assert got == {(x, y): blocks.rounded(r) for x in range(len(a)) for y in range(len(b)) if a_slot[x] == b_slot[y] and (r := plain_ratio(a[x], b[y])) >= least}
    assert len(got) == len(i) > 0


def test_pairs_of_a_rare_word_are_not_compared_one_by_one(monkeypatch):
    """Up to 256 pairs under a word were, and most words are rare."""
    asked = []
    monkeypatch.setattr(blocks, "plain_ratio", lambda a, b: asked.append(a) or plain_ratio(a, b))
    a, b = ["gama trading", "delta", "beta works"], ["gamma trading", "delta", "betta works", "x"]
    i, j, _ = blocks._of_key(a, b, 0.92, blocks._all_rounded())
    assert set(zip(i.tolist(), j.tolist())) == {(0, 0), (1, 1), (2, 2)} and not asked


@pytest.mark.parametrize("most", [0, 1 << 24])
def test_what_a_rarer_word_takes_is_left_out_by_table_or_search(monkeypatch, most):
    monkeypatch.setattr(blocks, "MOST_HELD", most)
    a, b, unless = ["x y", "p q", "x y", "z"], ["x y", "q r", "y r"], ["x", None, "q", "r"]
    i, j = (x.ravel() for x in np.indices((4, 3)))
    assert blocks._allowed(a, b, unless, i, j).tolist() == [a[p] != b[q] and unless[p] not in b[q].split(" ") for p, q in zip(i, j)]


def test_names_are_normalised_once_and_written(spark):
    """The test for empty forms normalised each name a second time."""
    rows = spark.createDataFrame([(1, "Al Rayyan Trading WLL", None), (2, "WLL", "")], "l int, name string, name_ar string")
    df = resolve.name_table(rows, "l", ["name", "name_ar"], False)
    assert [(r.l, r.norm, r.arabic) for r in df.collect()] == [(1, "rayyan trading", False)]
    assert "regexp_replace" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_names_that_are_not_searched_for_noise_have_none(spark):
    said = ["Réf 12 Doha", "REF: a1 Doha", "payıment from", "payment from Doha", "Doha 123456 x", "Doha 12345", "١٢٣٤٥٦٧ Doha", "Ｒｅｆ 12 x", "salary", "inv no. 7 Doha", "Transfer\nto x", "qa12abcdefghijkl Doha", "A.B. Trdg. Co.\n", "value date", "Kufic", "trf  to Doha", "cheque no x", "CHQ x", "", None]
    rows = spark.createDataFrame([(s,) for s in said], "s string").select("s", text.normalize_latin(F.col("s")).alias("slow"), text.normalize_latin(F.col("s"), True).alias("quick"))
    assert all(r.slow == r.quick for r in rows.collect())


def test_two_arabic_letters_anywhere_make_a_name_arabic(spark):
    said = {"ا": False, "ا x ب": True, "اب": True, "x\nا\nب": True, "x": False, "": False, "١٢": False, None: False}
    rows = spark.createDataFrame([(s,) for s in said], "s string").select("s", text.is_arabic(F.col("s")).alias("a"))
    assert {r.s: r.a for r in rows.collect()} == said


def test_rows_are_one_class_only_with_equal_texts(spark):
    said = [("a", "b"), ("a", None), (None, "a"), ("", None), (None, ""), (None, None), ("1:a", ""), ("a", ""), ("a1:b", None)]
    rows = spark.createDataFrame(said * 2, "x string, y string").select(resolve.class_digest(["x", "y"]).alias("c"))
    assert rows.distinct().count() == len(said)


def test_the_summary_counts_each_pair_once_by_its_best_evidence(spark, monkeypatch):
    """By cells and in small blocks, with repeated rows, keys of several rows, and names in both orders of words; no class is numbered and joined back."""
    monkeypatch.setattr(resolve, "SIDE", 3)
    monkeypatch.setattr(blocks, "MANY_PAIRS", 0)
    monkeypatch.setattr(resolve, "numbered", None)
    left = [("1", "Gama Beta Trading", None, "5"), ("1", "Gama Beta Trading", None, "5"), ("1", "Delta Works", None, None), ("2", "Trading Gamma Beta", None, None), ("3", "", None, None), (None, None, None, None)]
    right = [("a", "Gamma Beta Trading WLL", "5"), ("a", "Gamma Beta Trading", None), ("b", "Gamma Beta Trading", None), ("c", "Deltta Works", None), ("d", None, None)]
    frames = spark.createDataFrame(left, "customer_id string, name string, name_ar string, cr_number string"), spark.createDataFrame(right, "rid string, name string, cr_number string")
    m = resolve.match(*frames, ["customer_id"], ["rid"], ["name", "name_ar"], ["name"], translit=1.0)
    assert {(r.customer_id, r.rid): (r.method, r.score) for r in m.collect()} == {("1", "a"): ("cr", 1.0), ("1", "b"): ("name_fuzzy", 0.971), ("1", "c"): ("name_fuzzy", 0.957), ("2", "a"): ("name_exact", 0.99), ("2", "b"): ("name_exact", 0.99)}
    assert resolve.match_summary(m, "customer_id").first().asDict() == {"matches": 5, "entities": 2, "cr": 1, "name_exact": 2, "name_fuzzy": 2, "name_translit": 0, "needs_review": 2}
