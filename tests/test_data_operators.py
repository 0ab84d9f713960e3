"""Small fixtures and brute force for history, wide rows, snapshot diffs, trailing totals and event-time attributes."""

import random
from collections import defaultdict
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyweir.operators.event_time import as_known_at, scores_with_state
from tallyweir.operators.history import status_periods
from tallyweir.operators.rolling import banded, rolling_totals, trailing_awards
from tallyweir.operators.snapshot_diff import snapshot_changes
from tallyweir.operators.wide import ACCOUNT, Attribute, account_rows, widen

SWEEP = "sweep_no int, sweep_date string, finished boolean"
READING = "sweep_date string, read_at timestamp, id string, status string, certificate_no string"
T0 = datetime(2026, 1, 1)


def periods_by_walking(readings, sweeps):
    """The statement walked sweep by sweep."""
    days = sorted(d for _, d, _ in sweeps)
    done = {d for _, d, f in sweeps if f}
    norm = lambda v: ((v or "").strip("  ").lower()) or None
    seen = defaultdict(dict)
    for d, t, i, s, c in readings:
        if i:
            k = i.strip().strip("{}").lower()
            if d not in seen[k] or seen[k][d][0] < t:
                seen[k][d] = (t, norm(s), norm(c))
    out = []
    for k, by in seen.items():
        open_, misses = None, 0
        for d in days:
            if d in by:
                if open_ and open_[1] != by[d][1:]:
                    out.append((k, open_[0], d))
                    open_ = None
                open_, misses = open_ or (d, by[d][1:]), 0
            elif d in done and open_:
                misses += 1
                if misses == 2:
                    out.append((k, open_[0], d))
                    open_ = None
        if open_:
            out.append((k, open_[0], ""))
    return sorted(out)


@pytest.mark.parametrize("bits", [1, 2, 6])
def test_history_against_a_walk(spark, bits):
    rng = random.Random(bits)
    sweeps = [(i, (date(2026, 1, 1) + timedelta(7 * i)).isoformat(), rng.random() < 0.75) for i in range(19)]
    readings = []
    for k in ("a", "B", "c", "d", "e"):
        for _, d, _ in sweeps:
            for r in range(rng.choice([0, 0, 1, 1, 1, 2])):
                readings.append((d, T0 + timedelta(seconds=len(readings)), rng.choice([k, k.upper(), "{%s}" % k]), rng.choice(["Valid", " valid", "Expired"]), rng.choice(["1", "", None])))
    got = status_periods(spark.createDataFrame(readings, READING), spark.createDataFrame(sweeps, SWEEP), bits)
    assert sorted(map(tuple, got.collect())) == periods_by_walking(readings, sweeps)


def test_history_edges(spark):
    sweeps = spark.createDataFrame([(1, "2026-01-01", True)], SWEEP)
    none = spark.createDataFrame([], READING)
    assert status_periods(none, sweeps).count() == 0
    assert status_periods(none, sweeps.limit(0)).count() == 0
    odd = spark.createDataFrame([("2026-01-01", None, "a", None, None), ("2026-01-01", None, "a", None, None), (None, T0, "a", "x", "1"), ("2026-01-01", T0, None, "x", "1"), ("2026-01-09", T0, "b", "x" * 100_000, "1")], READING).withColumn("pos", F.lit(9)).withColumn("runs", F.lit(""))
    assert sorted(map(tuple, status_periods(odd, sweeps).collect())) == [("a", "2026-01-01", ""), ("b", "2026-01-09", "")]


ATTR = "attr_id bigint, record_id string, entity_name string, read_at timestamp, attr_name string, attr_value string, display_value string, formatted_value string"


def attr(rec, name, value, display=None, formatted=None, t=0, entity="account"):
    return (0, rec, entity, T0 + timedelta(days=t), name, value, display, formatted)


@pytest.mark.parametrize("size", [1, 2, 4, 64])
def test_wide_rows(spark, size):
    data = [
        attr("r1", "Name", "  Old  ", t=0), attr("r1", "NAME", " New ", t=1), attr("r1", "icv_totalscore", " ", "1,234.5", t=1), attr("r1", "cert.StatusCode", '{"Value": 100000005}', t=1),
        attr("r1", "icv_mainactivity", '{"Id": "x", "Name": " Marine "}', t=1), attr("r1", "icv_ismanufacturer", None, None, "نعم", t=1), attr("r1", "icv_latestcertificate", '{"Name": ""}', "  ", "77", t=1),
        attr("r2", "icv_commercialregistrationnumber", "1", t=0), attr("r2", "accountid", "g", t=3), attr("r3", "cert.statuscode", "", "Suspended"), attr("r3", "icv_totalscore", "٢٥٫٨"), attr("r3", "icv_ismanufacturer", "maybe"),
        attr("r4", None, None), attr(None, "name", "x"), attr("r5", "name", "n", entity="other"), attr("r6", "name", "b"), attr("r6", "name", "b"), attr("r6", "Name", None),
    ]
    got = {r.record_id: tuple(r)[1:] for r in account_rows(spark.createDataFrame(data, ATTR), size).collect()}
    assert got == {
        "r1": ("New", "", "Marine", 123450, 100000005, "77", 1), "r2": ("", "", "", -1, -1, "", -1), "r3": ("", "", "", 2580, 100000007, "", -1), "r4": ("", "", "", -1, -1, "", -1), "r6": ("b", "", "", -1, -1, "", -1),
    }


def test_many_attributes_in_blocks(spark):
    names = [f"a{i}" for i in range(150)]
    rows = spark.createDataFrame([("e%d" % (i % 7), T0, names[i % 150], str(i)) for i in range(1000)], "e string, t timestamp, n string, v string")
    got = widen(rows, "e", "t", "n", ["v"], [Attribute(n, n, "number") for n in names], 20)
    assert len(got.columns) == 151 and got.count() == 7
    assert got.where("e = 'e3'").first()["a3"] == max(i for i in range(1000) if i % 7 == 3 and i % 150 == 3)
    assert widen(rows.limit(0), "e", "t", "n", ["v"], ACCOUNT).count() == 0


COMPANY = "snapshot_date string, loaded_at timestamp, id string, name string, cr_number string, industry string, misses int, gone_at string"


def test_snapshot_changes(spark):
    d = ["2026-01-01", "2026-01-08", "2026-01-15"]
    sweeps = spark.createDataFrame([(1, d[0], True), (2, d[1], False), (3, d[2], True), (4, "2026-02-01", True)], SWEEP)
    row = lambda day, i, name="N", cr=None, ind="x", m=0, gone=None, t=0: (day, T0 + timedelta(seconds=t), i, name, cr, ind, m, gone)
    data = [
        row(d[0], "same"), row(d[2], "{SAME}", " n "), row(d[0], "name"), row(d[2], "name", "M"), row(d[0], "cr", cr=""), row(d[2], "cr", cr=None), row(d[0], "cr2", cr="1"), row(d[2], "cr2", cr="2"), row(d[0], "gone"), row(d[2], "gone", gone=d[2]),
        row(d[0], "lost"), row(d[2], "new"), row(d[0], "late", m=1), row(d[0], "late", m=0, t=5), row(d[2], "late", m=0), row(d[1], "part"), row(d[0], "nil", None, None, None, None), row(d[2], "nil", None, None, None, None), row(d[0], None), row(d[2], "new"),
    ]
    df = spark.createDataFrame(data, COMPANY).withColumn("pos", F.lit(1)).withColumn("leaf", F.lit(""))
    for depth in (0, 1, 3):
        got = sorted((r.snapshot_date, r.id, r.change) for r in snapshot_changes(df, sweeps, depth).collect())
        assert got == sorted([(d[2], "name", "changed"), (d[2], "cr2", "changed"), (d[2], "gone", "removed"), (d[2], "lost", "removed"), (d[2], "new", "added")])
    assert snapshot_changes(df.limit(0), sweeps).count() == 0
    assert snapshot_changes(df.where("snapshot_date = '2026-01-01'"), sweeps).count() == 0


def test_banded_operator():
    x = np.arange(1, 41)
    for w in (1, 7, 30):
        op = banded(10, 30, w)
        assert list(x @ op) == [x[max(0, j + 31 - w) : j + 31].sum() for j in range(10)]


def test_rolling_against_brute_force(spark):
    rng = random.Random(4)
    first, last = date(2026, 1, 1), date(2026, 3, 31)
    start = (first - date(1970, 1, 1)).days
    facts = {(e, start + rng.randrange(-60, 120)): rng.randrange(-500, 10**9) for e in "abcdef" for _ in range(40)}
    daily = spark.createDataFrame([(e, d, v) for (e, d), v in facts.items()] + [("zz", start, 1)], "entity string, day int, total bigint")
    entities = spark.createDataFrame([(e,) for e in "abcdefg"], "entity string")
    for tile, block in ((32, 512), (7, 2), (200, 1)):
        got = {(r.entity, r.day): (r.total_7, r.avg_7, r.total_30) for r in rolling_totals(daily, entities, first, last, (7, 30), tile, block).collect()}
        assert len(got) == 7 * 90
        for e in "abcdefg":
            for i in range(0, 90, 13):
                t7, t30 = (sum(facts.get((e, start + i - k), 0) for k in range(w)) for w in (7, 30))
                assert got[e, (first + timedelta(i)).isoformat()] == (t7, t7 // 7, t30)


def test_awards_edges(spark):
    t = spark.createDataFrame([("1", "2026-01-10", 1.005, T0), ("1", "TBA", 9.0, T0 - timedelta(1)), ("2", "11/01/2026", float("nan"), T0), ("3", None, 5.0, T0), ("4", "2020-01-01T00:00:00", 7.0, T0), (None, "2026-01-01", 1.0, T0)], "tender_id string, awarded_date string, awarded_amount double, parsed_at timestamp").withColumn("total", F.lit(1))
    c = spark.createDataFrame([("1", "awarded", "A"), ("1", "awarded", "A"), ("1", "bidder", "B"), ("2", "awarded", "A"), ("4", "awarded", "B"), ("1", "awarded", None), ("1", "awarded", "C")], "tender_id string, role string, cr_root string")
    reg = spark.createDataFrame([("A",), ("A",), ("B",), (None,)], "cr_root string")
    got = {(r.cr_root, r.day): r.total_30 for r in trailing_awards(t, c, reg, date(2026, 1, 1), date(2026, 3, 31)).collect()}
    assert len(got) == 180 and got["A", "2026-01-10"] == 100 and got["A", "2026-01-09"] == 0 and got["A", "2026-02-08"] == 100 and got["A", "2026-02-09"] == 0 and got["B", "2026-01-01"] == 0
    assert trailing_awards(t.limit(0), c, reg, date(2026, 1, 1), date(2026, 3, 31)).count() == 0


def test_event_time_against_brute_force(spark):
    rng = random.Random(9)
    base = datetime(2026, 1, 1)
    history = [(rng.choice("aab"), (base + timedelta(rng.randrange(60))).date(), base + timedelta(hours=rng.randrange(2000)), f"s{i}") for i in range(120)]
    history += history[:10]
    events = [(i, rng.choice("aaabc"), base + timedelta(minutes=rng.randrange(120_000))) for i in range(300)]
    at = lambda t: int((t - datetime(1970, 1, 1)).total_seconds()) * 1_000_000
    e = spark.createDataFrame([(i, k, at(t)) for i, k, t in events] + [(999, None, 1), (998, "a", None)], "event_id int, entity string, at bigint")
    h = spark.createDataFrame(history, "entity string, from_date date, recorded_at timestamp, status string").withColumn("number", F.lit(1)).withColumn("k", F.lit(""))
    got = {r.event_id: (r.from_date, r.recorded_at) for r in as_known_at(e, h, ["status"]).collect()}
    expected = {}
    for i, k, t in events:
        known = [(f, r) for n, f, r, _ in history if n == k and f <= t.date() and r <= t]
        if known:
            expected[i] = max(known)
    assert got == expected


def test_event_time_edges(spark):
    obs = "id string, company_id string, posted_at string, posted_date string, first_seen string"
    state = "company_id string, from_date string, recorded_at timestamp, status string"
    h = spark.createDataFrame([("c", "2026-01-01", T0, " under review "), ("c", "bad", T0, "Valid"), ("c", None, T0, "Valid"), (None, "2026-01-01", T0, "Valid")], state)
    o = spark.createDataFrame([("1", "C", "2026-01-01T00:00:00Z", "2026-01-01", "x"), ("1", "C", "2026-01-01T00:00:00Z", "2026-01-01", "y"), ("2", "c", "2025-12-31T23:59:59Z", "2025-12-31", "x"), ("3", "c", None, None, "x"), (None, "c", "2026-02-01T00:00:00Z", "2026-02-01", "x")], obs)
    assert [tuple(r) for r in scores_with_state(o, h).collect()] == [("1", "2026-01-01", "Under Review")]
    assert scores_with_state(o.limit(0), h).count() == 0 and scores_with_state(o, h.limit(0)).count() == 0
