import random

import numpy as np
from pyspark.sql import functions as F

from tallyweir import session
from tallyweir.operators import blocks, resolve


def test_what_may_be_among_keys_is_kept_and_most_else_left_out(spark):
    keys = spark.createDataFrame([(True, f"k{i}") for i in range(300)] + [(False, None)], "arabic boolean, word string")
    rows = spark.createDataFrame([(i, True, f"k{i}") for i in range(3000)] + [(-1, False, None), (-2, False, "k1")], "n int, arabic boolean, word string")
    got = [r.n for r in session.among(rows, ["arabic", "word"], keys).collect()]
    assert len(got) == len(set(got)) and {*range(300), -1} <= set(got) and len(got) < 330
    assert session.among(rows, ["word"], keys.where(F.lit(False)).select("word")).collect() == []


def test_few_marks_lose_no_row(spark, monkeypatch):
    monkeypatch.setattr(session, "MARKS", 64)
    rows = spark.range(500).select(F.col("id").cast("string").alias("k"))
    assert session.among(rows, ["k"], rows).count() == 500


def test_a_side_is_read_once(spark, tmp_path):
    """Each was read, shuffled and made distinct twice, and joined back to its classes at the end."""
    left = [("1", "Gama Beta Trading", None, "5"), ("1", "Gama Beta Trading", None, "5"), ("2", None, "", "7"), (None, "Delta Works", None, None)]
    right = [("a", "x", "Gamma Beta Trading WLL", "9"), ("a", "y", None, "7"), ("b", None, "Delta Works", None)]
    spark.createDataFrame(left, "customer_id string, name string, name_ar string, cr_number string").write.parquet(str(tmp_path / "l"))
    spark.createDataFrame(right, "rid string, part string, name string, cr_number string").write.parquet(str(tmp_path / "r"))
    m = resolve.match(spark.read.parquet(str(tmp_path / "l")), spark.read.parquet(str(tmp_path / "r")), ["customer_id"], ["rid", "part"], ["name", "name_ar"], ["name"], translit=1.0)
    assert {(r.customer_id, r.rid, r.part): (r.method, r.score) for r in m.collect()} == {("1", "a", "x"): ("name_fuzzy", 0.971), ("2", "a", "y"): ("cr", 1.0), (None, "b", None): ("name_exact", 1.0)}
    plan = m._jdf.queryExecution().optimizedPlan().toString()
    assert not any(said in plan for said in ("md5", "LogicalRDD"))


def test_a_letter_more_or_less_changes_three_pairs_of_neighbours_at_most():
    rng = random.Random(6)
    for _ in range(2000):
        a = b = [rng.randrange(1, 30) for _ in range(rng.randrange(1, 30))]
        slips = rng.randrange(0, 5)
        for _ in range(slips):
            i = rng.randrange(len(b) + 1)
            b = rng.choice([b[:i] + b[i + 1 :] if len(b) > 1 else b, b[:i] + [rng.randrange(1, 30)] + b[i:]])
        x, y = (blocks._grams(np.array([s + [0] * (40 - len(s))], np.int32))[0] for s in (a, b))
        assert int(x ^ y).bit_count() <= 3 * slips
