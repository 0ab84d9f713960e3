"""What the plans promise: scans, exchanges, no cap on amounts, no folder made up."""

import re
from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException

from tallyweir import session
from tallyweir.operators import wide
from tallyweir.operators.rolling import trailing_awards

T0 = datetime(2026, 1, 1)


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("blocks", [1, 2, 7, 50])
def test_wide_rows_are_read_and_laid_out_once(spark, no_broadcast, tmp_path, monkeypatch, blocks):
    names = [f"a{i}" for i in range(100)]
    path = str(tmp_path / "rows")
    spark.createDataFrame([("e%d" % (i % 7), T0, names[i % 100], str(i)) for i in range(700)], "e string, t timestamp, n string, v string").write.parquet(path)
    stored, kept = [], wide.laid_out
    monkeypatch.setattr(wide, "laid_out", lambda df, *more: (stored.append(final_plan(df)), kept(df, *more))[1])
    df = wide.widen(spark.read.parquet(path), "e", "t", "n", ["v"], [wide.Attribute(n, n, "number") for n in names], -(-100 // blocks))
    plan = final_plan(df)
    first, *later = [*stored, plan]
    assert len(re.findall("FileScan", first)) == 1  # the input
    assert len(re.findall(r"(?m)^\W*Exchange ", first)) == 2  # cells combined, then laid out by entity
    for p in later:  # the pivots and joins
        assert "Exchange" not in p and p.count("FileScan") == p.count("Bucketed: true") <= wide.JOINED + 1
    if blocks > 1:
        assert not any("/rows/" in f for f in df.inputFiles())
        assert sum(p.count("FileScan") for p in later) == blocks + (1 if blocks <= wide.JOINED else 2 * -(-blocks // wide.JOINED) + 1)  # each block once
    got = {r["e"]: r for r in df.collect()}
    assert len(got) == 7 and got["e3"]["a3"] == max(i for i in range(700) if i % 7 == 3 and i % 100 == 3)


AWARDS = "tender_id string, awarded_date string, awarded_amount double, parsed_at timestamp"


def totals(spark, *amounts):
    t = spark.createDataFrame([(str(i), day, a, T0) for i, (day, a) in enumerate(amounts)], AWARDS)
    c = spark.createDataFrame([(str(i), "awarded", "A") for i in range(len(amounts))], "tender_id string, role string, cr_root string")
    rows = trailing_awards(t, c, spark.createDataFrame([("A",)], "cr_root string"), date(2026, 1, 1), date(2026, 3, 31)).collect()
    return {r.day: (r.total_7, r.avg_7, r.total_30, r.avg_30) for r in rows}


def test_large_awards_count(spark):
    got = totals(spark, ("2026-01-10", 1e15), ("2026-01-11", 9e16), ("2026-03-01", -9e16), ("2026-03-02", float("inf")), ("2020-01-01", 1e300))
    assert got["2026-01-10"][0] == 10**17
    assert got["2026-01-11"] == (9_100_000_000_000_000_000, 1_300_000_000_000_000_000, 9_100_000_000_000_000_000, 303_333_333_333_333_333)
    assert got["2026-03-02"][2] == -9_000_000_000_000_000_000


@pytest.mark.parametrize("amounts", [[("2026-01-10", 1e17)], [("2026-01-10", 9e16), ("2026-01-11", 9e16)], [("2026-01-10", 1e300)]])
def test_totals_beyond_a_bigint_are_an_error(spark, amounts):
    with pytest.raises(PySparkException):
        totals(spark, *amounts)


def test_no_folder_is_made_up(spark, monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "local[2]"
        getConf = lambda self: Conf()
        getCheckpointDir = lambda self: None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        session.shared_dir(Session())


def test_small_sides_are_measured_in_rows_and_bytes(spark):
    hinted = lambda df: "broadcast" in df._jdf.queryExecution().logical().toString().lower()
    rows = spark.createDataFrame([(i, "x" * 100) for i in range(50)], "i int, s string")
    assert hinted(session.small_side(rows)) and not hinted(session.small_side(rows, rows=49)) and not hinted(session.small_side(rows, size=4000))
    assert hinted(session.small_side(rows.limit(0)))


def test_scratch_tables_go(spark, tmp_path):
    import os

    df = session.written(spark.range(10).toDF("id"), "numbers", ["id"])
    path = df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert df.count() == 10 and os.path.isdir(path)
    session.clean()
    assert not os.path.exists(path)
