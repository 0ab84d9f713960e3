"""Jobs of the stores: upsert rules, register passes, sweeps, run gaps, migrations, cohorts, exports, pages parsed again, SQL functions."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tallyweir.functions import sql, text
from tallyweir.operators import lifecycle, reports
from tallyweir.sinks import exports
from tallyweir.sources import outline, pages, reparse


def test_upsert_rules(spark):
    log = spark.createDataFrame([("1", 1, "tender", "awarded", None, "x"), ("1", 2, "bid", "closed", "s", None), ("1", 3, None, None, None, None), ("2", 1, None, "odd", None, None), (None, 1, "a", "b", "c", "d")], "k string, at int, family string, state string, subject string, seen string")
    got = {r.k: tuple(r)[2:] for r in lifecycle.upsert_fold(log, "k", ["at"], ("family",), ("seen",), {"state": text.state_rank(F.col("state"))}).select("k", "at", "family", "state", "subject", "seen").collect()}
    assert got == {"1": ("tender", "awarded", "s", None), "2": (None, "odd", None, None)}


def test_register_passes(spark):
    """A key that a pass lacks is missed, in two it is delisted; a page read again changes neither; a later pass clears both."""
    log = "k string, pass_id int, at int, name string"
    rows = [("seen", 1, 1, "a"), ("seen", 3, 9, "b"), ("missed", 2, 2, "c"), ("gone", 1, 1, "d"), ("gone", None, 8, "e"), ("never", None, 5, "f"), (None, 1, 1, "g"), ("seen", 3, 9, "b")]
    passes = spark.createDataFrame([(1, "p1"), (2, "p2"), (3, "p3"), (3, "p3")], "pass_id int, finished_at string")
    got = {r.k: (r.name, r.last_pass, r.missed, r.delisted_at) for r in lifecycle.register_upsert(spark.createDataFrame(rows, log), passes, "k", ["at"]).collect()}
    assert got == {"seen": ("b", 3, 0, None), "missed": ("c", 2, 1, None), "gone": ("e", 1, 2, "p3"), "never": ("f", None, 2, "p2")}
    none = lifecycle.register_upsert(spark.createDataFrame(rows, log), passes.limit(0), "k", ["at"])
    assert {r.missed for r in none.collect()} == {0} and lifecycle.register_upsert(spark.createDataFrame([], log), passes, "k", ["at"]).count() == 0


def test_sweep_stops(spark):
    rows = spark.createDataFrame([(1, "a", True), (1, "b", True), (2, "b", True), (2, "c", True), (3, "a", True), (3, None, True), (4, "d", True)], "page int, id string, more boolean")
    assert sorted(map(tuple, lifecycle.sweep_rows(rows, "page", "id", "more").collect())) == [("a", 1), ("b", 1), ("c", 2)]  # page 3 brings nothing new
    ends = rows.withColumn("more", F.col("page") < 2)
    assert lifecycle.sweep_rows(ends, "page", "id", "more").count() == 3 and lifecycle.sweep_rows(rows.limit(0), "page", "id", "more").count() == 0


def test_run_gap(spark):
    runs = spark.createDataFrame([(1, "crawl", "2026-06-28T00:00:00+00:00"), (2, "crawl", "2026-06-30 12:00:00"), (3, "other", None), (4, "odd", "yesterday")], "run_id int, command string, started_at string")
    days = lambda *a: lifecycle.days_since_last_run(runs, datetime(2026, 7, 1), *a).first().days
    assert (days(), days("crawl"), days("crawl", 2), days("other"), days("odd"), days("none")) == (0.5, 0.5, 3.0, 1.0, 1.0, 1.0)


def test_migration(spark):
    t = {"tender": spark.createDataFrame([("1", "05/2")], "tender_id string, cr_number string")}
    steps = {2: {"tender": ({"state": "string"}, {})}, 3: {"tender": ({}, {"cr_root": text.cr_root(F.col("cr_number"))}), "absent": ({"x": "int"}, {})}}
    new, version = lifecycle.migrate(t, 1, steps)
    assert version == 3 and new["tender"].first().asDict() == {"tender_id": "1", "cr_number": "05/2", "state": None, "cr_root": "5"}
    again, version = lifecycle.migrate(new, 3, steps)
    assert version == 3 and again["tender"].columns == new["tender"].columns


def test_cohorts_and_register_of_matches(spark):
    scores = spark.createDataFrame([("a", date(2026, 1, 1), "t1", "1", 5.0), ("a", date(2026, 2, 1), "t2", "2", 6.0), ("a", date(2027, 1, 1), "t3", "3", 9.0), ("b", date(2026, 1, 1), "t1", "4", 7.0), ("c", date(2026, 1, 1), "t1", "5", 1.0)], "company_id string, day date, posted_at string, id string, score double")
    industries = spark.createDataFrame([("a", "marine"), ("b", "marine"), ("c", None)], "company_id string, industry string")
    assert sorted(map(tuple, reports.cohort_scores(scores, industries, F.lit(date(2026, 6, 30))).collect())) == [("marine", "a", 6.0), ("marine", "b", 7.0)]
    register = spark.createDataFrame([("p2", "n2", None, None, "5"), ("p1", "n1", "s", "e", "5"), ("p0", "n0", None, None, "7"), ("p9", "n9", None, None, None)], "profile_number string, name string, size string, evaluation string, cr_root string")
    matches = spark.createDataFrame([("x", "5"), ("x", "5"), ("x", "7"), ("y", "5"), ("z", "8"), ("w", None)], "client_id string, matched_cr string")
    assert sorted((r.client_id, r.profile_number) for r in reports.register_of_matches(matches, register, "client_id").collect()) == [("x", "p0"), ("y", "p1")]


def test_named_exports(spark, tmp_path):
    tables = {"tender": spark.createDataFrame([("1", "tender", "s", "d", "m", 1.0)], "tender_id string, family string, state string, awarded_date string, ministry string, awarded_amount double"), "company": spark.createDataFrame([("1", "n")], "tender_id string, name string"), "listing_state": spark.createDataFrame([("b", "1"), ("a", "2")], "company_id string, from_date string")}
    built = exports.exports_of(tables)
    assert {*built} == {"tenders", "awards"} and built["awards"]().columns == ["tender_id", "name", "family", "state", "awarded_date", "ministry", "awarded_amount"]
    scores = exports.exports_of(tables, scores=True)
    assert {*scores} == {"companies", "listing"} and [r.company_id for r in scores["listing"]().collect()] == ["a", "b"]
    with pytest.raises(KeyError):
        exports.export("unknown", built, str(tmp_path / "x"))


def test_reparse_order(spark):
    """Terms fill what the listing lacks, the tender page has the last word; the latest stored page counts."""
    card = "<div class='row custom-cards'><div class='col-header'><span class='card-label'>9/2026</span></div><a href='/x/TenderDetails/55'>Pipes</a><div class='cards-row'><span class='card-label'>Ministry</span><span class='card-title'>Old</span></div></div>"
    terms = "<table><tr><th>Subject</th><th>Tender Bond</th></tr><tr><td>Long pipes</td><td>5,000</td></tr></table><table><tr><th>Activity code</th><th>Activity name</th></tr><tr><td>4.1</td><td>Pumps</td></tr></table>"
    detail = "<span id='lblRequesterEntity'>New</span><span id='lbl_award'>7 QAR</span><table><tr><th>Company name</th><th>Commercial Registration Number</th><th>Approved value</th></tr><tr><td>Gulf Contg W.L.L.</td><td>CR-5/1</td><td>7</td></tr></table>"
    raw = [("listing", "awarded", card, "1"), ("terms", "55", terms, "1"), ("detail", "55", "<span id='lblRequesterEntity'>Stale</span>", "1"), ("detail", "55", detail, "2"), ("detail", "56", None, "1"), ("other", "x", "<p>", "1")]
    got = reparse.reparse(spark.createDataFrame(raw, "kind string, key string, html string, fetched_at string"))
    t = got["tender"].collect()
    assert [(r.tender_id, r.tender_number, r.subject, r.ministry, r.tender_bond, r.awarded_amount, r.state) for r in t] == [("55", "9/2026", "Long pipes", "New", 5000.0, 7.0, "awarded")]
    assert [(r.name_normalised, r.cr_root, r.value) for r in got["company"].collect()] == [("gulf contracting", "5", 7.0)]
    assert got["tender_activity"].count() == 1 and got["classified_company"].count() == 0


def test_outline_of_odd_markup(spark):
    """Open rows and cells end where the next begin, nested tables keep their own rows, scripts say nothing; null, empty and very long pages hold what they hold."""
    page = outline.outline("<table id=a><tr><th>H<tr><td>1<td>2 <table><tr><td>in</table><tr><td>3</table><script>x</script></b><p id='q'>a<p>b &amp; c")
    outer, inner = page["grids"]
    assert [line["cells"] for line in outer["lines"]] == [["1", "2 in"], ["3"]] and outer["head"] == ["H"] and inner["inside"] == ["a"] and inner["lines"][0]["cells"] == ["in"]
    assert dict(page["marks"])["q"] == "a" and outline.outline(None)["grids"] == [] == outline.outline("")["cards"]
    long = "<table><tr><th>Activity code</th><th>Activity name</th></tr>" + "<tr><td>1</td><td>n</td></tr>" * 5000 + "</table>"
    df = spark.createDataFrame([("k", long), (None, None), ("e", "")], "key string, html string").withColumn("marks", F.lit(1))
    assert pages.read_activities(df).count() == 5000 and pages.read_listings(df).count() == pages.read_register(df).count() == pages.read_companies(df.limit(0)).count() == 0


def test_sql_functions(spark):
    assert "cr_root" in sql.register(spark)
    r = spark.sql("SELECT cr_root('CR-0012/3') a, is_arabic('شركة') b, indel_ratio('abc', 'abd') c, parse_day('on 1/2/2026') d, tender_state_rank('awarded') e, parse_money('1,000.5 QAR') f, cr_root(NULL) g").first()
    assert (r.a, r.b, round(r.c, 3), r.d, r.e, r.f, r.g) == ("12", True, 0.667, date(2026, 2, 1), 5, 1000.5, None)
