import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from tallyweir.operators import asof


def test_latest_before_against_brute_force(spark):
    rng = random.Random(5)
    day = lambda: date(2026, 1, 1) + timedelta(rng.randrange(200))
    history = [(rng.choice("aab"), day(), i % 5, i) for i in range(60)]
    points = [(rng.choice("aabc"), day(), i) for i in range(150)]
    points += points[:3] + [(None, day(), 900), ("a", None, 901)]
    h = spark.createDataFrame(history + [("a", None, 0, 999), (None, day(), 0, 998)], "k string, w date, o int, v int")
    p = spark.createDataFrame(points, "k string, d date, i int")
    def want(k, d):
        rows = [(w, o, v) for x, w, o, v in history if x == k and d and w <= d]
        return max(rows)[2] if rows else None
    expected = sorted((i, want(k, d)) for k, d, i in points)
    key = lambda r: (r[0], r[1] is None, r[1])
    for slot in (1, 16, 1000):
        got = asof.latest_before(p, h, "k", "d", "w", ["o", "v"], ["v"], slot)
        assert sorted(((r.i, r.v) for r in got.collect()), key=key) == sorted(expected, key=key)
    assert asof.latest_before(p.limit(0), h, "k", "d", "w", ["o"], ["v"]).count() == 0


def test_latest_and_period_at(spark):
    h = spark.createDataFrame([("a", date(2026, 1, 1), 1), ("a", date(2026, 1, 5), 2), ("a", date(2026, 2, 1), 3), ("b", None, 4)], "k string, w date, v int")
    assert [tuple(r) for r in asof.latest_at(h, "k", "w", F.lit(date(2026, 1, 5)), ["v"], ["v"]).collect()] == [("a", 2)]
    p = spark.createDataFrame([("a", "1", "5", "x"), ("a", "5", None, "y"), ("b", "6", None, "z")], "k string, from_date string, to_date string, s string")
    assert [tuple(r) for r in asof.period_at(p, "k", F.lit("5"), ["s"]).collect()] == [("a", "y")]
