from datetime import date

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyweir.operators import features, lifecycle

COMPANIES = "tender_id string, role string, seq int, name string, cr_root string, value double"
TENDERS = "tender_id string, ministry string, awarded_date string, closing_date string, publish_date string"
REGISTER = "cr_root string, size string, evaluation string, certificate_end string, parsed_at string"


def test_company_month_by_hand(spark):
    c = [("t1", "awarded", 0, "A", "1", 600000.0), ("t1", "awarded", 1, "A", "1", 400000.0), ("t1", "bidder", 0, "B", "2", None), ("t2", "awarded", 0, "A", "1", 10.0), ("t3", "bidder", 0, "A", "1", 5.0), ("t3", "awarded", 0, "X", None, 5.0), ("t4", "bidder", 0, "A", "1", None), ("t5", "bidder", 0, "A", "1", None), ("t6", "bidder", 0, "A", "1", None)]
    t = [("t1", "M1", "2026-01-10", None, None), ("t2", "M2", "2025-06-30", None, None), ("t3", "", "2025-12-31", None, None), ("t4", "M1", None, "2026-01-31", None), ("t5", "M1", "bad", None, None), ("t6", "M1", "2026-02-01", None, None)]
    args = spark.createDataFrame(c, COMPANIES), spark.createDataFrame(t, TENDERS), spark.createDataFrame([("1", "Large", "A", "2027-01-01", "x")], REGISTER)
    rows = {(r.cr_root, str(r.as_of_month)): r for r in features.company_months(*args, date(2026, 1, 15), 3).collect()}
    r = rows["1", "2026-01-31"]
    assert (r.awards_12m_count, r.awards_12m_value, r.largest_award_12m, r.bids_12m_count, r.decided_12m_count, r.win_rate_12m) == (2, 1000010.0, 1000000.0, 4, 3, 0.6667)
    assert (r.distinct_buyers_12m, r.months_since_last_award, r.months_since_first_seen, r.classified_size) == (2, 0, 7, "Large")
    assert r.top_buyer_share_12m == 1.0 and rows["1", "2025-12-31"].classified_size is None and ("2", "2025-12-31") not in rows
    later = args[0].unionByName(spark.createDataFrame([("t6", "awarded", 9, "A", "1", 1e9)], COMPANIES))
    again = {(x.cr_root, str(x.as_of_month)): x for x in features.company_months(later, *args[1:], date(2026, 1, 15), 3).collect()}
    assert again == rows  # nothing after the month end enters
    assert features.company_months(args[0].limit(0), *args[1:], date(2026, 1, 15), 3).count() == 0


def test_score_profile_by_hand(spark):
    o = [("1", "c", "2024-03-10T00:00:00Z", "2024-03-10", 10.84, None, "New", "x"), ("2", "c", "2024-09-01T00:00:00Z", "2024-09-01", 11.91, 1.07, "Sub", "x"), ("3", "c", "2025-02-01T00:00:00Z", "2025-02-01", 18.91, 7.0, " Transitional Percentage Added ", "x"), ("4", "c", "2025-07-01T00:00:00Z", "2025-07-01", 99.0, 1.0, "Late", "x"), ("5", "c", None, "bad", 1.0, None, None, "x"), ("1", "c", "2024-03-10T00:00:00Z", "2024-03-10", 10.84, None, "New", "y")]
    df = spark.createDataFrame(o, "id string, company_id string, posted_at string, posted_date string, score double, change double, reason string, first_seen string")
    r = features.score_profile_months(df, [date(2025, 6, 30)]).first()
    assert (r.score, r.score_12m_ago, r.score_change_12m, r.policy_change_12m, r.organic_change_12m, r.months_certified, r.observations) == (18.91, 10.84, 8.07, 7.0, 1.07, 15, 3)


LOG = st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 50), st.one_of(st.none(), st.integers(0, 3))), max_size=25)


@settings(max_examples=8, deadline=None)
@given(LOG)
def test_upsert_fold(spark, log):
    df = spark.createDataFrame([(k, t, v, i) for i, (k, t, v) in enumerate(log)], "k string, t int, v int, i int")
    got = {r.k: r.v for r in lifecycle.upsert_fold(df, "k", ["t", "i"]).collect()}
    expected = {}
    for k, _, _, v in sorted((k, t, i, v) for i, (k, t, v) in enumerate(log)):
        expected[k] = v if v is not None else expected.get(k)
    assert got == expected


@settings(max_examples=8, deadline=None)
@given(LOG)
def test_periods_never_overlap_and_change(spark, log):
    df = spark.createDataFrame([(k, f"{t:03d}", i, v) for i, (k, t, v) in enumerate(log)], "k string, t string, i int, v int")
    rows = sorted(map(tuple, lifecycle.tracked_periods(df, "k", "t", ["i"], ["v"]).collect()), key=lambda r: r[:2])
    for a, b in zip(rows, rows[1:]):
        if a[0] == b[0]:
            assert a[1] < b[1] == a[2] and a[3] != b[3]
    assert {r[0] for r in rows} == {k for k, _, _ in log} and all(r[2] is None for r in rows if r[1] == max(x[1] for x in rows if x[0] == r[0]))


def test_folds(spark):
    make = spark.createDataFrame
    stored = make([("u1", "old", "d0"), ("u2", None, "d0")], "url string, content_sha256 string, first_seen_at string")
    out = {r.url: (r.outcome, r.first_seen_at) for r in lifecycle.page_changes(stored, make([("u1", "<p>a", "d1"), ("u3", "<p>b", "d1"), ("u3", "<p>c", "d2")], "url string, html string, fetched_at string")).collect()}
    assert out == {"u1": ("changed", "d0"), "u3": ("new", "d2")}
    dead = {r.ref: (r.attempts, r.error, r.given_up) for r in lifecycle.dead_letters(make([("missing:x", "1", "e%d" % i, str(i)) for i in range(3)] + [("d", "2", "e", "1")], "kind string, ref string, error string, failed_at string")).collect()}
    assert dead == {"1": (3, "e2", True), "2": (1, "e", False)}
    old, new = make([("a", 1), ("b", 2)], "p string, v int"), make([("a", 3), ("c", 4)], "p string, v int")
    assert sorted(map(tuple, lifecycle.replace_children(old, new, "p").collect())) == [("a", 3), ("b", 2), ("c", 4)]
    assert sorted(map(tuple, lifecycle.append_absent(old, new, "p", ["v"]).collect())) == [("a", 1), ("b", 2), ("c", 4)]
    assert sorted(map(tuple, lifecycle.scoped_replace(old, new, ["p"]).collect())) == [("a", 3), ("b", 2), ("c", 4)]
    assert sorted(map(tuple, lifecycle.merge_rows(old, make([("a", None), ("c", 9)], "p string, v int"), "p").collect())) == [("a", 1), ("b", 2), ("c", 9)]
    late = lifecycle.on_time(make([("k", "2026-01-01"), ("k", "2026-02-01"), ("z", "2020-01-01")], "k string, d string"), make([("k", "2026-02-03")], "k string, watermark string"), "k", F.to_date("d"))
    assert sorted((r.d, r.late) for r in late.collect()) == [("2020-01-01", False), ("2026-01-01", True), ("2026-02-01", False)]
    assert lifecycle.slice_pages(100, 2, 30, 5) == 7 and lifecycle.slice_pages(0, 2, 30, 5) == 5 and lifecycle.slice_pages(100, 99, 30, 5) == 100
    assert lifecycle.add_missing_columns(old, {"v": "int", "w": "date"}).columns == ["p", "v", "w"]
    assert lifecycle.run_summary(make([("c", "1", 2), ("c", "2", None)], "command string, finished_at string, pages int")).first().asDict() == {"command": "c", "runs": 2, "last_finished": "2", "pages": 2}
    orphan = lifecycle.orphans(make([("1", "closed"), ("2", "awarded"), ("3", None), ("4", "closed")], "t string, state string"), make([("1", "x"), ("2", "x"), ("3", "x"), ("4", None)], "t string, gone_at string"), "t", ["awarded"])
    assert [r.t for r in orphan.collect()] == ["1"]
