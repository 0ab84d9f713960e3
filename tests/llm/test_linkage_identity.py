"""Identities of profiles, placeholder numbers, the recall of the candidates as filtered, and the confidence's calibration."""

import random

import numpy as np
from pyspark.sql import functions as F

from tallyweir.llm.linkage import LabelModel, candidates, link, orders, parsed, placeholders, profiles, ratio

BOOK, REGISTER = "customer_id string, name string, cr_number string, name_ar string", "profile_number string, name string, cr_number string"


def test_null_is_a_value_of_a_profile(spark):
    """The same letters as Latin and as Arabic name, or as a number, are different profiles."""
    book = spark.createDataFrame([("1", "zubaz", None), ("2", None, "zubaz"), ("3", None, None), ("4", "zubaz", None)], "customer_id string, name string, name_ar string").withColumn("number", F.lit(None).cast("string"))
    rows, found = profiles(book, ["name", "name_ar"], "left")
    at = {r.customer_id: r.left for r in rows.collect()}
    assert len(at) == 4 and at["1"] == at["4"] and len({at["1"], at["2"], at["3"]}) == 3 and found.count() == 3


def test_placeholders_are_no_evidence(spark):
    """A number that a third of all customers bear under many names links none of them; their names still do."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("bdfgklmnrstz") + rng.choice("aiu") for _ in range(4))
    names = [f"{word()} {word()}" for _ in range(60)]
    book = [(f"c{i}", n, "999999" if i < 30 else str(1000 + i), None) for i, n in enumerate(names)]
    register = [(f"p{i}", n + " trading", "999999" if i in (50, 51) else str(1000 + i)) for i, n in enumerate(names)]
    a, b = spark.createDataFrame(book, BOOK), spark.createDataFrame(register, REGISTER)
    got = {(r.customer_id[1:], r.profile_number[1:]) for r in link(a, b).collect()}
    assert got == {(str(i), str(i)) for i in range(60)}
    left = profiles(a.select("customer_id", "name", "name_ar", F.col("cr_number").alias("number")), ["name", "name_ar"], "left")[1]
    right = profiles(b.select("profile_number", "name", F.col("cr_number").alias("number")), ["name"], "right")[1]
    assert [r.number for r in placeholders(left, right).collect()] == ["999999"]


def spelled(name: str, rng: random.Random) -> str:
    """The name shortened, reordered or with one slip."""
    words = name.split()
    how = rng.randrange(3)
    if how == 0 and len(words) > 1:
        return " ".join(words[1:] + words[:1])
    at = rng.randrange(len(name))
    return name[:at] + name[at + 1 :] if how == 1 else name[:at] + rng.choice("aeiklmnrst") + name[at + 1 :]


def test_recall_of_the_candidates_as_filtered(spark):
    """Against all pairs: of those whose names are alike, nearly all are candidates by name alone, filter included."""
    rng = random.Random(11)
    real = [r.name for r in spark.read.parquet("/root/testdata/sf0.01/classified_company.parquet").select("name").distinct().collect()]
    asked = [r.n for r in spark.read.parquet("/root/testdata/sf0.01/customers.parquet").select(F.explode(F.array("name", "name_ar")).alias("n")).where("n is not null").distinct().collect()]
    asked += [spelled(n, rng) for n in real]
    a = profiles(spark.createDataFrame([(str(i), n, None, None) for i, n in enumerate(asked)], "customer_id string, name string, name_ar string, number string"), ["name", "name_ar"], "left")
    b = profiles(spark.createDataFrame([(str(i), n, None) for i, n in enumerate(real)], "profile_number string, name string, number string"), ["name"], "right")
    met = candidates(a[1], b[1]).join(a[0].select("customer_id", "left"), "left").join(b[0].select("profile_number", "right"), "right")
    got = {(int(r.customer_id), int(r.profile_number)) for r in met.select("customer_id", "profile_number").collect()}
    left, right = [parsed(n)[0] for n in asked], [parsed(n)[0] for n in real]
    close = {(i, j) for i, x in enumerate(left) if x for j, y in enumerate(right) if y and abs(len("".join(x)) - len("".join(y))) < 6 and max(ratio(p, q) for p in orders(x) for q in orders(y)) >= 0.86}
    assert len(close) > 500 and len(close & got) >= 0.99 * len(close)


def test_confidence_is_calibrated():
    """Of the pairs with a posterior in a bin, about that share are the same."""
    rng = np.random.default_rng(8)
    y = rng.random(60_000) < 0.3
    draw = lambda right: np.where(rng.random(len(y)) < 0.3, 0, np.where(rng.random(len(y)) < right, 1, -1) * np.where(y, 1, -1))
    v = np.stack([draw(p) for p in (0.97, 0.7, 0.8, 0.85, 0.75, 0.9, 0.7, 0.7)], 1)
    patterns, at, counts = np.unique(v, axis=0, return_inverse=True, return_counts=True)
    post = LabelModel(patterns, counts.astype(float)).post[at.ravel()]
    for low in np.arange(0, 1, 0.2):
        inside = (post >= low) & (post < low + 0.2 + (low > 0.7))
        assert inside.sum() < 300 or abs(post[inside].mean() - y[inside].mean()) < 0.12, (low, inside.sum(), post[inside].mean(), y[inside].mean())
