import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyweir.llm.linkage import LabelModel, ends, link, number_root, one_slip, orders, parsed, ratio, same_companies, votes
from tests.oracle import SF

BOOK, REGISTER = "customer_id string, name string, cr_number string, name_ar string", "profile_number string, name string, cr_number string"


def test_parts():
    assert parsed("AL-Kumijulun  Thashud Svcs & Trdg W.L.L.") == (["kumijulun", "thashud"], ["services", "trading"])
    assert parsed("شركة كانيكوروم راشيغود للاستشارات وللتجارة ش.م.ق") == (["kanikurum", "rashigud"], ["consulting", "trading"])
    assert parsed("Rashighud (Branch 2)") == (["rashigud"], []) and parsed(None) == parsed("") == ([], [])
    assert orders(["a", "b"]) == ["ab", "ba"] and orders([]) == []
    assert one_slip("1234", "1243") and one_slip("1234", "1224") and one_slip("123", "1234") and not one_slip("1234", "1234") and not one_slip("1234", "4321")
    assert ends(["abcdefghij"]) & ends(["abxdefghij"]) and ends(["abcd", "efgh"]) & ends(["efghabcd"])


def test_numbers(spark):
    said = ["CR-0123", "1,234", "123.0", "١٢٣/٢", "123 | 9", "QFC123", "qfc-123", "N/A", "", None, " CR No. 123 "]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(said)], "i int, c string")
    assert [r.v for r in df.select("i", number_root(F.col("c")).alias("v")).orderBy("i").collect()] == ["123", "1234", "123", "123", "123", None, None, None, None, None, "123"]


def test_votes():
    same = votes("1", [(["abcdefgh", "ijkl"], ["trading"])], "1", (["ijkl", "abcdefgh"], ["trading", "supplies"]))
    assert same[:3] == [1, 0, 1] and same[5:7] == [1, 0]
    assert votes("123", [(["abcdefgh"], [])], "987", (["zzzz"], []))[0] == -1
    assert votes(None, [], None, ([], [])) == [0] * 8


def test_the_model_learns_whom_to_trust():
    """Votes drawn from a known truth, two voters being copies: the posterior finds the classes, the tree the copies."""
    rng = np.random.default_rng(3)
    y = rng.random(20_000) < 0.4
    draw = lambda right: np.where(rng.random(len(y)) < right, np.where(y, 1, -1), np.where(rng.random(len(y)) < 0.5, 0, np.where(y, -1, 1)))
    v = np.stack([draw(p) for p in (0.95, 0.6, 0.8, 0.8, 0.7, 0.85, 0.6, 0.6)], 1)
    v[:, 3] = v[:, 2]
    patterns, at, counts = np.unique(v, axis=0, return_inverse=True, return_counts=True)
    m = LabelModel(patterns, counts.astype(float))
    assert ((m.post[at.ravel()] >= 0.5) == y).mean() > 0.97 and abs(m.share - 0.4) < 0.03
    assert m.parents[3] == 2 or m.parents[2] == 3


@pytest.fixture
def books(spark):
    real = [(r.customer_id, r.name, r.cr_number, r.name_ar) for r in spark.read.parquet("/root/testdata/sf0.01/customers.parquet").collect()]
    reg = [(r.profile_number, r.name, r.cr_number) for r in spark.read.parquet("/root/testdata/sf0.01/classified_company.parquet").collect()]
    own = [("x1", "Zubazulim Kathiruf Contg", None, None), ("x2", "Zubazulim Kathiruf Trading", "8123456", None), ("x3", "Transport", "7,000,001.0", None), ("x4", "kathirufzubazulim contracting", "7000010", None), ("x5", None, None, None), ("x6", "", "", ""), (None, "Zubazulim Kathiruf Contracting", "7000001", None), ("x7", "A" * 5000, None, None), ("x1", "Zubazulim Kathiruf Contg", None, None)]
    rows = [("p1", "ZUBAZULIM KATHIRUF CONTRACTING & TRANSPORT WLL", "7000001"), ("p2", "Zubazulim Kathiruf Contracting & Transport (Branch 2)", "7000001/2 | 55"), ("p3", None, None), ("p4", "", ""), (None, "Zubazulim Kathiruf Contracting", "7000001"), ("p1", "ZUBAZULIM KATHIRUF CONTRACTING & TRANSPORT WLL", "7000001"), ("p5", "شركة زوبازوليم كاثيروف للمقاولات وللنقليات", None)]
    extra = lambda d: d.withColumn("left", F.lit(1)).withColumn("number", F.lit("")).withColumn("keys", F.lit(""))
    return extra(spark.createDataFrame(real + own, BOOK)), extra(spark.createDataFrame(reg + rows, REGISTER))


def test_linkage(books):
    got = {(r.customer_id, r.profile_number): r.confidence for r in link(*books).collect()}
    mine = {k: v for k, v in got.items() if k[0][0] == "x"}
    assert set(mine) == {(c, p) for c in ("x1", "x3", "x4") for p in ("p1", "p2", "p5")} and min(mine.values()) > 0.5
    assert all(0.5 <= v <= 1 for v in got.values()) and len(got) > 150


def test_no_row_twice_and_empty_books(books):
    found = same_companies(*books)
    assert found.count() == found.distinct().count()
    a, b = books
    assert link(a.limit(0), b).count() == 0 and link(a, b.limit(0)).count() == 0


def test_blocking_against_all_pairs(spark):
    """Pairs that the ends' keys bring together hold all that are alike."""
    names = [parsed(r.name) for r in spark.read.parquet(f"{SF}/classified_company.parquet").select("name").distinct().collect()]
    asked = [parsed(r.name) for r in spark.read.parquet(f"{SF}/customers.parquet").select("name").where("name is not null").distinct().collect()]
    likely = {(i, j) for i, a in enumerate(asked) for j, b in enumerate(names) if max((ratio(x, y) for x in orders(a[0]) for y in orders(b[0])), default=0) >= 0.86}
    assert likely and sum(bool(ends(asked[i][0]) & ends(names[j][0])) for i, j in likely) >= 0.97 * len(likely)
