"""Queries for the register, tender and score operators, each with the SQL it is held against."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweir.functions import dates, text
from tallyweir.operators import asof, features, lifecycle, reports, resolve
from tallyweir.operators.history import canonical_id
from tallyweir.session import table

END, MONTHS, AT = date(2026, 6, 30), 60, date(2026, 3, 31)
FINAL = ["awarded", "cancelled"]


def _tender(spark, d) -> DataFrame:
    return features.latest_tenders(table(spark, d, "tender"))


def _companies(spark, d) -> DataFrame:
    return features.distinct_companies(table(spark, d, "tender_company"))


def _grid(spark, d) -> list[date]:
    return features.score_grid(table(spark, d, "score_observation"), END)


def _customers(spark, d) -> DataFrame:
    return table(spark, d, "customers").distinct()


def _matches(spark, d) -> DataFrame:
    """Clients by number, and as their counterparties the other companies on the tenders they took part in."""
    c = _companies(spark, d).select("tender_id", "role", "seq", "name", "cr_root")
    own = _customers(spark, d).select(F.col("customer_id").alias("client_id"), text.cr_root(F.col("cr_number")).alias("cr_root")).where("cr_root is not null").distinct().join(c, "cr_root")
    own = own.select("client_id", F.lit("self").alias("relation"), F.lit(None).cast("string").alias("party_name"), F.lit("cr").alias("method"), F.lit(0).alias("needs_review"), "tender_id", "role", "seq", "cr_root")
    other = c.withColumnRenamed("cr_root", "other")
    met = own.select("client_id", "tender_id", F.col("cr_root").alias("mine")).distinct().join(other, "tender_id").where("other is not null and other <> mine")
    cp = met.select("client_id", F.when(F.col("role") == "awarded", "supplier").otherwise("buyer").alias("relation"), F.col("name").alias("party_name"), F.lit("name_exact").alias("method"), F.lit(1).alias("needs_review"), "tender_id", "role", "seq")
    return own.drop("cr_root").unionByName(cp).distinct()


def _facts(spark, d) -> DataFrame:
    return features.match_facts(_matches(spark, d), _companies(spark, d), _tender(spark, d))


def _seen(spark, d) -> DataFrame:
    """Tenders as listed by state: gone once a later reading has another state."""
    t = table(spark, d, "tender").select("tender_id", "state", "parsed_at").distinct()
    s = t.groupBy("tender_id", "state").agg(F.min("parsed_at").alias("first"), F.max("parsed_at").alias("last"))
    top = t.groupBy("tender_id").agg(F.max("parsed_at").alias("top"))
    return s.join(top, "tender_id").select("tender_id", F.col("state").alias("kind"), "first", "last", F.when(F.col("last") < F.col("top"), F.col("top")).alias("gone_at"))


def _known_pairs(spark, d) -> DataFrame:
    company = table(spark, d, "company").select(canonical_id(F.col("id")).alias("company_id"), "cr_root").where("cr_root is not null").distinct()
    c = _customers(spark, d).select(F.col("customer_id").alias("client_id"), text.cr_root(F.col("cr_number"), True).alias("cr_root")).where("cr_root is not null").distinct()
    return c.join(company, "cr_root").select("client_id", "company_id").distinct()


def _score_pairs(spark, d) -> DataFrame:
    """Score companies as clients of themselves (the score tables and the book share no numbers)."""
    return table(spark, d, "score_observation").select(F.col("company_id").alias("client_id"), "company_id").distinct()


def _listed(spark, d) -> DataFrame:
    s = table(spark, d, "listing_state")
    return s.groupBy("company_id", "from_date").agg(F.max(F.struct("recorded_at", "to_date", "total_score", "status", "status_code", "certificate_no", "expiry_date", "manufacturer")).alias("r")).select("company_id", "from_date", "r.*")


def _industries(spark, d) -> DataFrame:
    """The score tables carry no industry; the reason stands in as one group per company (its first reason)."""
    return features.distinct_scores(table(spark, d, "score_observation")).groupBy("company_id").agg(F.min("reason").alias("industry"))


def _stored_pages(spark, d) -> DataFrame:
    docs = table(spark, d, "documents").where("text is not null")
    return docs.select(F.concat(F.lit("page/"), "doc_id").alias("url"), F.concat(F.lit("<html><script>var n="), "doc_id", F.lit(";</script><!-- "), F.length("text"), F.lit(" --><body>"), "text", F.lit("</body></html>")).alias("html"), F.lit("2026-01-02").alias("fetched_at"), F.length("text").alias("n"))


def _page_changes(spark, d) -> DataFrame:
    p = _stored_pages(spark, d)
    stored = p.where("n % 3 <> 0").select("url", F.when(F.col("n") % 3 == 1, text.html_fingerprint(F.regexp_replace("html", "var n=", "var m="))).otherwise("other").alias("content_sha256"), F.lit("2026-01-01").alias("first_seen_at"))
    return lifecycle.page_changes(stored, p.select("url", "html", "fetched_at")).select("url", "outcome", "content_sha256", "first_seen_at")


def _ladder(spark, d) -> DataFrame:
    return resolve.match(_customers(spark, d), table(spark, d, "classified_company"), ["customer_id"], ["profile_number"], ["name", "name_ar"], ["name"])


def _rarest(spark, d) -> DataFrame:
    names = table(spark, d, "tender_company").where("name_normalised <> ''").select(F.lit(False).alias("arabic"), F.col("name_normalised").alias("norm")).distinct()
    return resolve.rarest_words(names, names).select("query", "word")


def _parties(spark, d) -> DataFrame:
    book = _customers(spark, d)
    cp = _companies(spark, d).select(F.col("cr_root").alias("client_id"), "name", F.when(F.col("role") == "awarded", "Vendor").otherwise("Sales").alias("direction")).where("client_id is not null").distinct()
    return resolve.parties(book, cp).select("client_id", "relation", "party_key", "name", "client_name")


def _tracked(spark, d) -> DataFrame:
    r = table(spark, d, "listing_snapshot").withColumn("id", canonical_id(F.col("id"))).withColumn("status", F.lower(F.trim("status")))
    return lifecycle.tracked_periods(r, "id", "sweep_date", ["read_at"], ["status", "total_score"])


def _upserted(spark, d) -> DataFrame:
    t = table(spark, d, "tender").select("tender_id", "ministry", "state", "awarded_date", "awarded_amount", "parsed_at")
    return lifecycle.upsert_fold(t, "tender_id", ["parsed_at"]).select("tender_id", "ministry", "awarded_date", "awarded_amount")


def _observed_before(spark, d) -> DataFrame:
    o = table(spark, d, "score_observation")
    rows = o.select("id", "company_id", "posted_at", "score", "first_seen")
    old = rows.where("first_seen < '2025-01-01'").groupBy("id").agg(F.min(F.struct("first_seen", "company_id", "posted_at", "score")).alias("r")).select("id", "r.company_id", "r.posted_at", "r.score", "r.first_seen")
    return lifecycle.append_absent(old, rows, "id", ["first_seen", "company_id", "posted_at", "score"])


def _replaced(spark, d) -> DataFrame:
    c = _companies(spark, d).select("tender_id", "role", "seq", "name")
    return lifecycle.replace_children(c, c.where("role = 'awarded'").withColumn("name", F.upper("name")), "tender_id")


def _queue(spark, d) -> DataFrame:
    seen = _seen(spark, d)
    done = _companies(spark, d).where("stage = 'technical'").select("tender_id", F.lit("technical").alias("state")).distinct()
    dead = table(spark, d, "tender").where("ministry is null").select("tender_id").distinct()
    return lifecycle.work_queue(_tender(spark, d).select("tender_id", "state"), seen.select("tender_id").distinct(), done, dead, "tender_id", ["technical", "financial", "awarded"], "awarded").select("tender_id", "state", "priority")


def _dead(spark, d) -> DataFrame:
    f = table(spark, d, "tender_company").where("cr_number is null").select(F.col("stage").alias("kind"), F.col("tender_id").alias("ref"), F.col("name").alias("error"), F.col("seq").cast("string").alias("failed_at"))
    return lifecycle.dead_letters(f)


def _latest_award(spark, d) -> DataFrame:
    """For each bid the company's latest earlier or same-day award."""
    c, t = _companies(spark, d), _tender(spark, d).select("tender_id", dates.iso_date(F.col("closing_date")).alias("day"))
    rows = c.where("cr_root is not null").join(t, "tender_id").where("day is not null")
    points = rows.where("role = 'bidder'").select("cr_root", "day", "tender_id", "seq")
    wins = rows.where("role = 'awarded'").select("cr_root", "day", F.col("tender_id").alias("won_tender"), "value").distinct()
    return asof.latest_before(points, wins, "cr_root", "day", "day", ["won_tender", "value"], ["won_tender", "value"])


def _scalars(spark, d) -> DataFrame:
    t = table(spark, d, "tender")
    c = F.col
    return t.select(
        "tender_id", dates.parse_date(F.concat(F.lit("on "), c("awarded_date"))).alias("slashed"), dates.iso_date(c("awarded_date")).alias("iso"), text.parse_money(F.concat(F.format_number("awarded_amount", 2), F.lit(" QAR"))).alias("money"),
        text.norm_label(F.concat(F.lit("  "), c("subject"), F.lit(" : "))).alias("label"), text.companies_ref(c("tender_id"), c("state")).alias("ref"), text.direction(F.when(c("state") == "awarded", " Vendor. ").when(c("state") == "closed", "SALES").otherwise(c("sector_type"))).alias("direction"), text.state_rank(c("state")).cast("bigint").alias("rank"),
        text.kind_from_url(F.concat(F.lit("https://x/"), text.kind_path(F.when(c("family") == "bid", F.concat(F.lit("bids-"), "state")).otherwise(c("state"))), F.lit("/3"))).alias("kind"), text.clean_cell(F.when(c("awarded_amount").isNotNull(), F.concat(F.lit(" "), F.floor("awarded_amount").cast("string"), F.when(c("family") == "bid", ".00 ").otherwise(".50 ")))).alias("cleaned"),
        text.looks_rejected(F.when(c("state") == "closed", F.concat("subject", F.lit(" The requested URL was rejected."))).when(c("state") == "future", F.concat(F.lit("Your support ID is "), "tender_id")).otherwise(c("subject"))).alias("rejected"), text.stage_for_heading(F.concat(c("state"), F.lit("ly Opened :"))).alias("stage"),
    ).distinct()


QUERIES = {
    "ag1_by_state": lambda s, d: reports.by_state(_tender(s, d)),
    "ag5_win_rates": lambda s, d: reports.win_rates(_companies(s, d), _tender(s, d), 2),
    "ag12_store_counts": lambda s, d: reports.store_counts(_tender(s, d), _companies(s, d), table(s, d, "classified_company").distinct()),
    "ag12_score_counts": lambda s, d: reports.score_counts(table(s, d, "company"), table(s, d, "score_observation"), table(s, d, "listing_state")),
    "ag13_section_status": lambda s, d: reports.section_status(_seen(s, d), "kind"),
    "ag14_entity_profiles": lambda s, d: reports.entity_profiles(_companies(s, d), _tender(s, d), table(s, d, "classified_company")),
    "ag15_size_by_kind": lambda s, d: reports.size_by_kind(table(s, d, "documents"), "source", "text"),
    "jn1_company_tenders": lambda s, d: reports.company_tenders(_companies(s, d), _tender(s, d)).select("tender_id", "role", "seq", "name", "state", "ministry"),
    "jn3_open_standing": lambda s, d: table(s, d, "score_observation").select("company_id").distinct().join(_listed(s, d).where("to_date is null").groupBy("company_id").agg(F.max("from_date").alias("from_date")), "company_id", "left"),
    "jn12_score_as_at": lambda s, d: asof.latest_at(features.distinct_scores(table(s, d, "score_observation")), "company_id", "day", F.lit(AT), ["posted_at", "id"], ["score", "day"]),
    "jn12_latest_award": _latest_award,
    "jn13_status_as_at": lambda s, d: asof.period_at(_listed(s, d).withColumn("status", F.trim("status")), "company_id", F.lit(AT.isoformat()), ["status", "from_date"]),
    "jn14_parties": _parties,
    "jn16_companies_on_tender": lambda s, d: reports.companies_on_tender(_companies(s, d), _tender(s, d)),
    "so2_top_awards": lambda s, d: reports.top_awards(_companies(s, d), _tender(s, d), 25),
    "dat3_month_grid": lambda s, d: _tender(s, d).select("tender_id", F.explode(dates.month_grid(dates.iso_date(F.col("publish_date")), dates.iso_date(F.col("closing_date")))).alias("month_end")),
    "str_scalars": _scalars,
    "str6_names": lambda s, d: table(s, d, "tender_company").select("name").distinct().select("name", text.normalize_name(F.col("name")).alias("norm")),
    "str6_score_names": lambda s, d: table(s, d, "company").select("name").distinct().select("name", text.normalize_name(F.col("name")).alias("norm")),
    "str7_keys": lambda s, d: table(s, d, "tender_company").select("name").distinct().select("name", text.canonical_key(F.col("name")).alias("key"), text.consonant_skeleton(F.col("name")).alias("skeleton")),
    "str12_cr_roots": lambda s, d: table(s, d, "tender_company").select("cr_number").distinct().select("cr_number", text.cr_root(F.col("cr_number")).alias("root"), text.split_cr(F.col("cr_number"))["secondary"].alias("secondary")),
    "str15_page_changes": _page_changes,
    "jn6_resolve_number": lambda s, d: resolve.match(_customers(s, d).withColumn("none", F.lit(None).cast("string")), table(s, d, "classified_company").withColumn("none", F.lit(None).cast("string")), ["customer_id"], ["profile_number"], ["none"], ["none"], 1.0, 1.0),
    "jn11_ladder_register": _ladder,
    "ag10_match_summary": lambda s, d: resolve.match_summary(_ladder(s, d), "customer_id"),
    "wn2_rarest_words": _rarest,
    "f1_company_months": lambda s, d: features.company_months(_companies(s, d), _tender(s, d), table(s, d, "classified_company"), END, MONTHS),
    "f8_match_facts": _facts,
    "f2_client_months": lambda s, d: features.client_months(_facts(s, d), END, MONTHS),
    "f3_score_profiles": lambda s, d: features.score_profile_months(table(s, d, "score_observation"), _grid(s, d)),
    "f4_cohort_medians": lambda s, d: features.cohort_medians(features.score_profile_months(table(s, d, "score_observation"), _grid(s, d)), _industries(s, d), ["as_of"]),
    "f5_standings": lambda s, d: features.standings(_listed(s, d), _grid(s, d)),
    "f6_client_rows": lambda s, d: features.client_score_months(_score_pairs(s, d), table(s, d, "score_observation"), _listed(s, d), _industries(s, d), [AT]),
    "f7_client_score_months": lambda s, d: features.client_score_months(_score_pairs(s, d), table(s, d, "score_observation"), _listed(s, d), _industries(s, d), _grid(s, d), pick_one=True),
    "st2_upsert_fold": _upserted,
    "st3_replace_children": _replaced,
    "st5_sightings": lambda s, d: lifecycle.sightings(table(s, d, "events").select("user_id", "event_type", F.to_date("ts").alias("day")), ["user_id", "event_type"], "day"),
    "st6_tombstones": lambda s, d: lifecycle.tombstones(table(s, d, "listing_snapshot").select(canonical_id(F.col("id")).alias("id"), "sweep_date"), table(s, d, "sweep"), "id"),
    "st8_tracked_periods": _tracked,
    "st9_append_absent": _observed_before,
    "st11_watermarks": lambda s, d: lifecycle.watermark(_tender(s, d), "family", "closing_date", AT),
    "st13_work_queue": _queue,
    "st14_dead_letters": _dead,
    "st15_orphans": lambda s, d: lifecycle.orphans(_tender(s, d).select("tender_id", "state"), _seen(s, d).withColumn("gone_at", F.coalesce("gone_at", F.when(F.col("kind") == "closed", F.col("last")))), "tender_id", FINAL).select("tender_id", "state"),
    "ext_rollup_awards": lambda s, d: _tender(s, d).rollup("family", "state").agg(F.count("*").alias("n"), F.count("awarded_amount").alias("valued")),
    "ext_sessions": lambda s, d: table(s, d, "events").groupBy("user_id", F.session_window("ts", "6 hours")).agg(F.count("*").alias("n")).groupBy("user_id").agg(F.count("*").alias("sessions"), F.sum("n").alias("events")),
}

T = "t AS (SELECT * FROM tender QUALIFY row_number() OVER (PARTITION BY tender_id ORDER BY parsed_at DESC, tender_number DESC, subject DESC, ministry DESC NULLS LAST, state DESC) = 1)"
C = "c AS (SELECT DISTINCT * FROM tender_company)"
DECIDED = "dec AS (SELECT DISTINCT tender_id FROM c WHERE role = 'awarded')"
O = "o AS (SELECT DISTINCT id, company_id, posted_at, CAST(posted_date AS DATE) AS day, score, change, reason FROM score_observation)"
L = "l AS (SELECT * FROM listing_state QUALIFY row_number() OVER (PARTITION BY company_id, from_date ORDER BY recorded_at DESC, to_date DESC) = 1)"
SEEN = "seen AS (SELECT tender_id, state AS kind, max(parsed_at) AS last, CASE WHEN max(parsed_at) < any_value(top) THEN any_value(top) END AS gone_at FROM (SELECT *, max(parsed_at) OVER (PARTITION BY tender_id) top FROM tender) GROUP BY ALL)"
ISO = "TRY_CAST(try_strptime(left({c}, 10), '%Y-%m-%d') AS DATE)"
ROOT = "nullif(ltrim(regexp_extract(regexp_replace(regexp_replace(translate({c}, '٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹', '01234567890123456789'), '\\.0+\\s*$', ''), '([0-9]),([0-9])', '\\1\\2', 'g'), '[0-9]+'), '0'), '')"
MONTHS_BETWEEN = "((year({b}) - year({a})) * 12 + month({b}) - month({a}))"
GRID_SQL = "g AS (SELECT CAST(last_day(m) AS DATE) AS as_of FROM (SELECT unnest(generate_series({first}, {last}, INTERVAL 1 MONTH)) m))"
#: from the month of the earliest observation, at most five years back
SCORE_GRID = GRID_SQL.format(first="(SELECT greatest(date_trunc('month', min(CAST(posted_date AS DATE))), DATE '2021-06-01') FROM score_observation)", last="DATE '2026-06-01'")
PROFILES = f"""{O}, {{grid}},
x AS (SELECT company_id, as_of, o.*EXCLUDE (company_id), CAST(date_trunc('month', as_of) - INTERVAL 1 YEAR AS DATE) AS cut FROM o JOIN g ON day <= as_of),
prof AS (SELECT company_id, as_of, arg_max(score, struct_pack(a := day, b := posted_at, c := id)) AS score, max(day) AS score_date, arg_max(struct_pack(r := reason), struct_pack(a := day, b := posted_at, c := id)).r AS score_reason, min(day) AS first_certificate, count(*) AS observations,
  {MONTHS_BETWEEN.format(a='max(day)', b='as_of')}::INT AS months_since_last_change, arg_max(score, struct_pack(a := day, b := posted_at, c := id)) FILTER (WHERE day <= cut) AS score_12m_ago,
  round(arg_max(score, struct_pack(a := day, b := posted_at, c := id)) - arg_max(score, struct_pack(a := day, b := posted_at, c := id)) FILTER (WHERE day <= cut), 2) AS score_change_12m,
  round(sum(change) FILTER (WHERE day > cut AND coalesce(trim(reason), '') <> 'Transitional Percentage Added'), 2) AS organic_change_12m, round(sum(change) FILTER (WHERE day > cut AND trim(reason) = 'Transitional Percentage Added'), 2) AS policy_change_12m,
  {MONTHS_BETWEEN.format(a='min(day)', b='as_of')}::INT AS months_certified FROM x GROUP BY company_id, as_of)"""
STANDING = f"""{L}, st AS (SELECT company_id, as_of, trim(status) AS status, certificate_no, expiry_date, total_score, recorded_at FROM l JOIN g ON CAST(from_date AS DATE) <= as_of AND (to_date IS NULL OR CAST(to_date AS DATE) >= as_of)
  QUALIFY row_number() OVER (PARTITION BY company_id, as_of ORDER BY from_date DESC, recorded_at DESC) = 1)"""
IND = "ind AS (SELECT company_id, min(reason) AS industry FROM o GROUP BY company_id)"
MED = "med AS (SELECT industry, as_of, round(median(score), 2) AS median_score, count(*) AS companies FROM prof JOIN ind USING (company_id) WHERE industry <> '' GROUP BY ALL)"
CLIENT = """SELECT client_id, company_id, as_of AS as_of_month, industry, score, score_date, score_change_12m, organic_change_12m, policy_change_12m, months_since_last_change, months_certified, observations, status,
  CAST(CAST(expiry_date AS DATE) - as_of AS INT) AS days_to_expiry, CASE WHEN status IS NOT NULL THEN 1 ELSE 0 END AS standing_known, median_score AS industry_median, round(score - median_score, 2) AS vs_industry
FROM (SELECT DISTINCT company_id AS client_id, company_id FROM o) JOIN prof USING (company_id) LEFT JOIN st USING (company_id, as_of) LEFT JOIN ind USING (company_id) LEFT JOIN med USING (industry, as_of)"""
MATCHES = f"""{T}, {C}, cust AS (SELECT DISTINCT customer_id AS client_id, {ROOT.format(c='cr_number')} AS cr_root FROM customers),
own AS (SELECT client_id, tender_id, role, seq, c.cr_root FROM cust JOIN c USING (cr_root)),
m AS (SELECT DISTINCT * FROM (SELECT client_id, 'self' AS relation, NULL::VARCHAR AS party_name, 'cr' AS method, 0 AS needs_review, tender_id, role, seq FROM own
  UNION ALL SELECT p.client_id, CASE WHEN c.role = 'awarded' THEN 'supplier' ELSE 'buyer' END, c.name, 'name_exact', 1, c.tender_id, c.role, c.seq FROM (SELECT DISTINCT client_id, tender_id, cr_root FROM own) p JOIN c USING (tender_id) WHERE c.cr_root <> p.cr_root)),
n AS (SELECT tender_id, count(*) AS companies_on_tender, max(CASE WHEN role = 'awarded' THEN 1 ELSE 0 END) AS decided FROM c GROUP BY tender_id),
f AS (SELECT client_id, relation, party_name, method, needs_review, tender_id, role, seq, CASE WHEN role = 'awarded' THEN 1 ELSE 0 END AS won, coalesce(awarded_date, closing_date, publish_date) AS event_date,
  CASE WHEN awarded_date IS NOT NULL THEN 'awarded' WHEN closing_date IS NOT NULL THEN 'closing' WHEN publish_date IS NOT NULL THEN 'publish' END AS event_date_basis, c.value AS company_value, c.name AS company_name, ministry AS buyer, companies_on_tender, decided
  FROM m JOIN c USING (tender_id, role, seq) JOIN t USING (tender_id) JOIN n USING (tender_id))"""

ORACLES = {
    "ag1_by_state": f"WITH {T} SELECT family, state, count(*) AS n, round(sum(awarded_amount), 2) AS value FROM t WHERE family IS NOT NULL GROUP BY ALL",
    "ag5_win_rates": f"""WITH {T}, {C}, {DECIDED}, per AS (SELECT coalesce(cr_root, name_normalised) AS key, min(name) AS name, tender_id, max(CASE WHEN role = 'awarded' THEN 1 ELSE 0 END) AS won, sum(CASE WHEN role = 'awarded' THEN coalesce(value, 0) ELSE 0 END) AS value FROM c GROUP BY ALL)
SELECT key, min(per.name) AS name, count(*) AS appearances, sum(won)::BIGINT AS won, sum(CASE WHEN won = 0 AND d.tender_id IS NOT NULL THEN 1 ELSE 0 END)::BIGINT AS lost, sum(CASE WHEN d.tender_id IS NULL AND state <> 'cancelled' THEN 1 ELSE 0 END)::BIGINT AS open,
  sum(CASE WHEN d.tender_id IS NULL AND state = 'cancelled' THEN 1 ELSE 0 END)::BIGINT AS cancelled, round(sum(value), 2) AS value, min(awarded_date) AS first_award, max(awarded_date) AS last_award
FROM per JOIN t USING (tender_id) LEFT JOIN dec d USING (tender_id) GROUP BY key HAVING count(*) >= 2""",
    "ag12_store_counts": f"""WITH {T}, {C} SELECT * FROM (SELECT count(*) AS tenders, count(awarded_date) AS with_award_date, min(awarded_date) AS earliest_award, max(awarded_date) AS latest_award, round(sum(awarded_amount), 2) AS total_awarded FROM t),
(SELECT count(*) FILTER (WHERE role = 'awarded') AS award_rows, count(*) FILTER (WHERE role = 'bidder') AS bidder_rows, count(DISTINCT coalesce(cr_root, name_normalised)) AS distinct_companies, count(cr_root) AS with_cr FROM c), (SELECT count(*) AS classified FROM (SELECT DISTINCT * FROM classified_company))""",
    "ag12_score_counts": """WITH k AS (SELECT regexp_replace(lower(trim(id)), '[{}]', '', 'g') AS k, * FROM company QUALIFY row_number() OVER (PARTITION BY regexp_replace(lower(trim(id)), '[{}]', '', 'g') ORDER BY snapshot_date DESC, loaded_at DESC, gone_at DESC NULLS LAST, cr_root DESC NULLS LAST) = 1)
SELECT * FROM (SELECT count(*) FILTER (WHERE gone_at IS NULL) AS companies, count(gone_at) AS gone, count(cr_root) AS with_cr, count(history_read) AS history_read FROM k), (SELECT count(DISTINCT id) AS score_observations FROM score_observation), (SELECT count(*) AS listing_states FROM (SELECT DISTINCT company_id, from_date FROM listing_state))""",
    "ag13_section_status": f"WITH {SEEN} SELECT kind, count(*) FILTER (WHERE gone_at IS NULL) AS listed, count(gone_at) AS gone FROM seen GROUP BY kind",
    "ag14_entity_profiles": f"""WITH {T}, {C}, {DECIDED}, own AS (SELECT cr_root, tender_id, max(CASE WHEN role = 'awarded' THEN 1 ELSE 0 END) AS won, sum(CASE WHEN role = 'awarded' THEN coalesce(value, 0) END) AS value FROM c WHERE cr_root IS NOT NULL GROUP BY ALL),
j AS (SELECT own.*, state, nullif(ministry, '') AS ministry, d.tender_id IS NOT NULL AS decided FROM own JOIN t USING (tender_id) LEFT JOIN dec d USING (tender_id)),
b AS (SELECT cr_root, ministry, round(sum(value), 2) AS v FROM j WHERE ministry IS NOT NULL GROUP BY ALL HAVING max(won) = 1),
top AS (SELECT cr_root, count(*) AS awarding_bodies, max(struct_pack(v := coalesce(v, 0), m := ministry)) AS top FROM b GROUP BY cr_root),
p AS (SELECT cr_root, count(*) AS tenders, sum(won)::BIGINT AS won, count(*) FILTER (WHERE won = 0 AND decided) AS lost, count(*) FILTER (WHERE NOT decided AND state <> 'cancelled') AS open, round(coalesce(sum(value), 0), 2) AS value FROM j GROUP BY cr_root),
r AS (SELECT cr_root, min(struct_pack(p := profile_number, s := size, e := evaluation)) AS r FROM classified_company WHERE cr_root IS NOT NULL GROUP BY cr_root)
SELECT cr_root, tenders, won, lost, open, value, CASE WHEN won + lost >= 1 THEN round(won / (won + lost), 4) END AS win_rate, coalesce(awarding_bodies, 0) AS awarding_bodies, top.m AS top_body, CASE WHEN value > 0 THEN round(top.v / value, 4) END AS top_share, r.s AS size, r.e AS evaluation
FROM p LEFT JOIN top USING (cr_root) LEFT JOIN r USING (cr_root)""",
    "ag15_size_by_kind": "SELECT source, count(*) AS pages, sum(length(text))::BIGINT AS chars FROM documents GROUP BY source",
    "jn1_company_tenders": f"WITH {T}, {C} SELECT tender_id, role, seq, name, state, ministry FROM c JOIN t USING (tender_id)",
    "jn3_open_standing": f"WITH {L} SELECT o.company_id, x.from_date FROM (SELECT DISTINCT company_id FROM score_observation) o LEFT JOIN (SELECT company_id, max(from_date) AS from_date FROM l WHERE to_date IS NULL GROUP BY ALL) x USING (company_id)",
    "jn12_score_as_at": f"WITH {O} SELECT company_id, score, day FROM o WHERE day <= DATE '2026-03-31' QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY day DESC, posted_at DESC, id DESC) = 1",
    "jn12_latest_award": f"""WITH {T}, {C}, r AS (SELECT c.*, {ISO.format(c='closing_date')} AS day FROM c JOIN t USING (tender_id) WHERE cr_root IS NOT NULL AND {ISO.format(c='closing_date')} IS NOT NULL),
p AS (SELECT row_number() OVER () AS k, cr_root, day, tender_id, seq FROM r WHERE role = 'bidder'), w AS (SELECT cr_root, day, tender_id AS won_tender, value FROM r WHERE role = 'awarded')
SELECT p.cr_root, p.day, p.tender_id, p.seq, w.won_tender, w.value FROM p LEFT JOIN w ON w.cr_root = p.cr_root AND w.day <= p.day QUALIFY row_number() OVER (PARTITION BY k ORDER BY w.day DESC NULLS LAST, won_tender DESC, value DESC NULLS LAST) = 1""",
    "jn13_status_as_at": f"WITH {L} SELECT company_id, trim(status) AS status, from_date FROM l WHERE from_date <= '2026-03-31' AND (to_date IS NULL OR to_date >= '2026-03-31') QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY from_date DESC, trim(status) DESC) = 1",
    "jn14_parties": f"""WITH {C}, b AS (SELECT DISTINCT * FROM customers), f AS (SELECT customer_id AS client_id, min(name) AS client_name FROM b GROUP BY ALL)
SELECT client_id, relation, party_key, name, client_name FROM (SELECT customer_id AS client_id, 'self' AS relation, '' AS party_key, name FROM b UNION ALL SELECT DISTINCT cr_root, CASE WHEN role = 'awarded' THEN 'supplier' ELSE 'buyer' END, upper(name), name FROM c WHERE cr_root IS NOT NULL AND trim(name) <> '') LEFT JOIN f USING (client_id)""",
    "jn16_companies_on_tender": f"WITH {T}, {C} SELECT tender_id, (SELECT count(*) FROM c WHERE c.tender_id = t.tender_id) AS companies, (SELECT count(*) FROM c WHERE c.tender_id = t.tender_id AND role = 'awarded') AS awarded, CASE WHEN EXISTS (SELECT 1 FROM c WHERE c.tender_id = t.tender_id AND role = 'awarded') THEN 1 ELSE 0 END AS decided FROM t",
    "so2_top_awards": f"WITH {T}, {C} SELECT tender_id, seq, name, ministry, value FROM c JOIN t USING (tender_id) WHERE role = 'awarded' AND value IS NOT NULL ORDER BY value DESC, CAST(tender_id AS BIGINT), seq LIMIT 25",
    "dat3_month_grid": f"WITH {T} SELECT tender_id, CAST(last_day(CAST(m AS DATE)) AS DATE) AS month_end FROM (SELECT tender_id, unnest(generate_series(date_trunc('month', CAST(publish_date AS DATE)), date_trunc('month', CAST(closing_date AS DATE)), INTERVAL 1 MONTH)) AS m FROM t)",
    "str_scalars": f"""SELECT DISTINCT tender_id, CAST(try_strptime(nullif(regexp_extract(awarded_date, '\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}'), ''), '%d/%m/%Y') AS DATE) AS slashed, {ISO.format(c='awarded_date')} AS iso, round(awarded_amount, 2) AS money,
  lower(regexp_replace(trim(regexp_replace(subject || ' :', '\\s+', ' ', 'g')), ':+$', '')) AS label, tender_id || '@' || coalesce(state, '') AS ref, CASE state WHEN 'awarded' THEN 'supplier' WHEN 'closed' THEN 'buyer' ELSE 'counterparty' END AS direction, (CASE state WHEN 'future' THEN 0 WHEN 'published' THEN 1 WHEN 'closed' THEN 2 WHEN 'technical' THEN 3 WHEN 'financial' THEN 4 WHEN 'awarded' THEN 5 WHEN 'cancelled' THEN 6 ELSE -1 END)::BIGINT AS rank,
  CASE WHEN state = 'published' THEN NULL WHEN family = 'bid' THEN 'bids-' || state ELSE state END AS kind, coalesce(CAST(CAST(floor(awarded_amount) AS BIGINT) AS VARCHAR) || CASE WHEN family = 'bid' THEN '' ELSE '.50' END, '') AS cleaned, state IN ('closed', 'future') AS rejected, CASE state WHEN 'technical' THEN 'technical' WHEN 'financial' THEN 'financial' ELSE 'unknown' END AS stage FROM tender""",
    "str6_names": "SELECT DISTINCT name, name_normalised AS norm FROM tender_company",
    "str6_score_names": "SELECT DISTINCT name, name_norm AS norm FROM company",
    "str7_keys": "SELECT DISTINCT name, array_to_string(list_sort(list_distinct(string_split(name_normalised, ' '))), ' ') AS key, array_to_string(list_transform(string_split(regexp_replace(name_normalised, '[aeiou]', '', 'g'), ' '), lambda w: list_reduce(string_split(w, ''), lambda a, b: CASE WHEN right(a, 1) = b THEN a ELSE a || b END)), ' ') AS skeleton FROM tender_company WHERE name_normalised <> ''",
    "str12_cr_roots": f"SELECT DISTINCT cr_number, {ROOT.format(c='cr_number')} AS root, nullif(trim(split_part(cr_number, '|', 2)), '') AS secondary FROM tender_company",
    "str15_page_changes": """WITH p AS (SELECT 'page/' || doc_id AS url, sha256(trim(regexp_replace('<html><body>' || text || '</body></html>', '[\\s\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}\\x{0b}\\x{1c}-\\x{1f}]+', ' ', 'g'))) AS sha, length(text) AS n FROM documents WHERE text IS NOT NULL)
SELECT url, CASE n % 3 WHEN 0 THEN 'new' WHEN 1 THEN 'unchanged' ELSE 'changed' END AS outcome, sha AS content_sha256, CASE n % 3 WHEN 0 THEN '2026-01-02' ELSE '2026-01-01' END AS first_seen_at FROM p""",
    "jn6_resolve_number": f"SELECT DISTINCT customer_id, profile_number, 'cr' AS method, 1.0::DOUBLE AS score, 0 AS needs_review FROM (SELECT customer_id, {ROOT.format(c='cr_number')} AS r FROM customers) JOIN (SELECT profile_number, {ROOT.format(c='cr_number')} AS r FROM classified_company) USING (r)",
    "wn2_rarest_words": "WITH n AS (SELECT DISTINCT name_normalised AS query FROM tender_company WHERE name_normalised <> ''), w AS (SELECT DISTINCT query, unnest(string_split(query, ' ')) AS word FROM n), df AS (SELECT word, count(*) AS df FROM w GROUP BY word) SELECT query, word FROM w JOIN df USING (word) QUALIFY row_number() OVER (PARTITION BY query ORDER BY df, word) <= 2",
    "f1_company_months": f"""WITH {T}, {C}, {DECIDED}, own AS (SELECT cr_root, tender_id, max(CASE WHEN role = 'awarded' THEN 1 ELSE 0 END) AS won, round(sum(CASE WHEN role = 'awarded' THEN value END), 2) AS amount FROM c WHERE cr_root IS NOT NULL GROUP BY ALL),
e AS (SELECT own.*, coalesce({ISO.format(c='awarded_date')}, {ISO.format(c='closing_date')}) AS day, d.tender_id IS NOT NULL AS decided, nullif(ministry, '') AS ministry FROM own JOIN t USING (tender_id) LEFT JOIN dec d USING (tender_id)),
{GRID_SQL.format(first="greatest(DATE '2021-07-01', (SELECT date_trunc('month', min(day)) FROM e))", last="DATE '2026-06-01'")},
x AS (SELECT *, day > as_of - 365 AS i12, day > as_of - 1095 AS i36 FROM e JOIN g ON day <= as_of),
b AS (SELECT cr_root, as_of, sum(amount) AS v FROM x WHERE won = 1 AND i12 GROUP BY cr_root, as_of, ministry), bb AS (SELECT cr_root, as_of, max(v) AS top FROM b GROUP BY ALL),
r AS (SELECT cr_root, max(struct_pack(p := parsed_at, s := size, e := evaluation, c := certificate_end)) AS r FROM classified_company WHERE cr_root IS NOT NULL GROUP BY ALL),
a AS (SELECT cr_root, as_of, count(*) FILTER (WHERE won = 1 AND i12) AS w12, sum(amount) FILTER (WHERE won = 1 AND i12) AS v12, count(*) FILTER (WHERE won = 1 AND i36) AS w36, sum(amount) FILTER (WHERE won = 1 AND i36) AS v36, sum(amount) FILTER (WHERE won = 1) AS vl, max(amount) FILTER (WHERE won = 1 AND i12) AS largest,
  max(day) FILTER (WHERE won = 1) AS last, count(*) FILTER (WHERE i12) AS b12, count(*) FILTER (WHERE i12 AND decided) AS d12, count(DISTINCT ministry) FILTER (WHERE won = 1 AND i12) AS buyers, min(day) AS first FROM x GROUP BY cr_root, as_of)
SELECT cr_root, as_of AS as_of_month, w12 AS awards_12m_count, round(v12, 2) AS awards_12m_value, w36 AS awards_36m_count, round(v36, 2) AS awards_36m_value, round(vl, 2) AS awards_life_value, largest AS largest_award_12m, {MONTHS_BETWEEN.format(a='last', b='as_of')}::INT AS months_since_last_award, b12 AS bids_12m_count, d12 AS decided_12m_count, w12 AS wins_12m_count,
  CASE WHEN d12 >= 3 THEN round(w12 / d12, 4) END AS win_rate_12m, buyers AS distinct_buyers_12m, CASE WHEN v12 > 0 THEN round(top / v12, 4) END AS top_buyer_share_12m, {MONTHS_BETWEEN.format(a='first', b='as_of')}::INT AS months_since_first_seen,
  CASE WHEN as_of = DATE '2026-06-30' THEN r.s END AS classified_size, CASE WHEN as_of = DATE '2026-06-30' THEN r.e END AS classified_evaluation, CASE WHEN as_of = DATE '2026-06-30' THEN r.c END AS certificate_end FROM a LEFT JOIN bb USING (cr_root, as_of) LEFT JOIN r USING (cr_root)""",
    "f8_match_facts": f"WITH {MATCHES} SELECT * FROM f",
    "f2_client_months": f"""WITH {MATCHES}, e AS (SELECT client_id, relation, tender_id, {ISO.format(c='event_date')} AS day, won, decided, company_value AS value, nullif(buyer, '') AS buyer, needs_review AS review, CASE WHEN relation <> 'self' THEN upper(coalesce(party_name, '')) ELSE '' END AS party FROM f),
{GRID_SQL.format(first="date_trunc('month', DATE '2026-06-01' - 1860)", last="DATE '2026-06-01'")},
x AS (SELECT *, day > CAST(date_trunc('month', as_of) - INTERVAL 1 YEAR AS DATE) AS i12, day > CAST(date_trunc('month', as_of) - INTERVAL 3 YEAR AS DATE) AS i36 FROM e JOIN g ON day <= as_of),
pt AS (SELECT client_id, as_of, max(v) AS largest FROM (SELECT client_id, as_of, sum(value) AS v FROM x WHERE relation = 'self' AND i12 AND won = 1 GROUP BY client_id, as_of, tender_id) GROUP BY ALL),
pb AS (SELECT client_id, as_of, max(v) AS top, sum(v) AS tot FROM (SELECT client_id, as_of, sum(value) AS v FROM x WHERE relation = 'self' AND i12 AND won = 1 AND buyer IS NOT NULL GROUP BY client_id, as_of, buyer) GROUP BY ALL),
a AS (SELECT client_id, as_of, count(DISTINCT tender_id) FILTER (WHERE relation = 'self' AND i12) AS bids, count(DISTINCT tender_id) FILTER (WHERE relation = 'self' AND i12 AND decided = 1) AS dcd, count(DISTINCT tender_id) FILTER (WHERE relation = 'self' AND i12 AND won = 1) AS wins,
  sum(value) FILTER (WHERE relation = 'self' AND i12 AND won = 1) AS v12, sum(value) FILTER (WHERE relation = 'self' AND i36 AND won = 1) AS v36, max(day) FILTER (WHERE relation = 'self' AND won = 1) AS last, count(DISTINCT buyer) FILTER (WHERE relation = 'self' AND i12 AND won = 1) AS nb, min(day) AS first,
  count(DISTINCT party) FILTER (WHERE relation = 'buyer') AS bm, count(DISTINCT party) FILTER (WHERE relation = 'buyer' AND i12 AND won = 1) AS ba, sum(value) FILTER (WHERE relation = 'buyer' AND i12 AND won = 1) AS bv,
  count(DISTINCT party) FILTER (WHERE relation = 'supplier') AS sm, count(DISTINCT party) FILTER (WHERE relation = 'supplier' AND i12 AND won = 1) AS sa, sum(value) FILTER (WHERE relation = 'supplier' AND i12 AND won = 1) AS sv,
  count(*) FILTER (WHERE relation <> 'self' AND i12) AS cr, count(*) FILTER (WHERE relation <> 'self' AND i12 AND review = 1) AS rv FROM x GROUP BY client_id, as_of)
SELECT client_id, as_of AS as_of_month, bids AS self_bids_12m, dcd AS self_decided_12m, wins AS self_wins_12m, CASE WHEN dcd >= 3 THEN round(wins / dcd, 4) END AS self_win_rate_12m, nullif(v12, 0) AS self_award_value_12m, nullif(v36, 0) AS self_award_value_36m, largest AS self_largest_award_12m,
  {MONTHS_BETWEEN.format(a='last', b='as_of')}::INT AS self_months_since_last_award, nb AS self_distinct_buyers_12m, CASE WHEN tot > 0 THEN round(top / tot, 4) END AS self_top_buyer_share_12m, {MONTHS_BETWEEN.format(a='first', b='as_of')}::INT AS self_months_since_first_seen, bm AS buyers_matched, ba AS buyers_active_12m, nullif(bv, 0) AS buyer_award_value_12m,
  sm AS suppliers_matched, sa AS suppliers_active_12m, nullif(sv, 0) AS supplier_award_value_12m, CASE WHEN cr > 0 THEN round(rv / cr, 4) END AS counterparty_review_share FROM a LEFT JOIN pt USING (client_id, as_of) LEFT JOIN pb USING (client_id, as_of)""",
    "f3_score_profiles": f"WITH {PROFILES.format(grid=SCORE_GRID)} SELECT * FROM prof",
    "f4_cohort_medians": f"WITH {PROFILES.format(grid=SCORE_GRID)}, {IND}, {MED} SELECT * FROM med",
    "f5_standings": f"WITH {SCORE_GRID}, {STANDING} SELECT company_id, as_of, status, certificate_no, expiry_date, total_score AS total_score_listed, CAST(CAST(expiry_date AS DATE) - as_of AS INT) AS days_to_expiry FROM st",
    "f6_client_rows": f"WITH {PROFILES.format(grid=chr(103) + ' AS (SELECT DATE ' + repr('2026-03-31') + ' AS as_of)')}, {STANDING}, {IND}, {MED} {CLIENT}",
    "f7_client_score_months": f"WITH {PROFILES.format(grid=SCORE_GRID)}, {STANDING}, {IND}, {MED} {CLIENT}",
    "st2_upsert_fold": "SELECT tender_id, arg_max(ministry, parsed_at) FILTER (WHERE ministry IS NOT NULL) AS ministry, arg_max(awarded_date, parsed_at) FILTER (WHERE awarded_date IS NOT NULL) AS awarded_date, arg_max(awarded_amount, parsed_at) FILTER (WHERE awarded_amount IS NOT NULL) AS awarded_amount FROM tender GROUP BY tender_id",
    "st3_replace_children": f"WITH {C} SELECT tender_id, role, seq, name FROM c WHERE tender_id NOT IN (SELECT tender_id FROM c WHERE role = 'awarded') UNION ALL SELECT tender_id, role, seq, upper(name) FROM c WHERE role = 'awarded'",
    "st5_sightings": "SELECT user_id, event_type, min(CAST(ts AS DATE)) AS first_seen, max(CAST(ts AS DATE)) AS last_seen, count(*) AS readings FROM events GROUP BY ALL",
    "st6_tombstones": """WITH p AS (SELECT regexp_replace(lower(trim(id)), '[{}]', '', 'g') AS id, max(sweep_date) AS last_seen FROM listing_snapshot GROUP BY 1), f AS (SELECT sweep_date AS d FROM sweep WHERE finished),
k AS (SELECT id, last_seen, list_sort(list(d) FILTER (WHERE d > last_seen)) AS a FROM p CROSS JOIN f GROUP BY ALL) SELECT id, last_seen, CAST(least(coalesce(len(a), 0), 2) AS INT) AS misses, a[2] AS gone_at FROM k""",
    "st8_tracked_periods": """WITH r AS (SELECT regexp_replace(lower(trim(id)), '[{}]', '', 'g') AS id, sweep_date, lower(trim(status)) AS status, total_score FROM listing_snapshot QUALIFY row_number() OVER (PARTITION BY regexp_replace(lower(trim(id)), '[{}]', '', 'g'), sweep_date ORDER BY read_at DESC, lower(trim(status)) DESC, total_score DESC) = 1),
c AS (SELECT *, lag(status) OVER w AS os, lag(total_score) OVER w AS oc, row_number() OVER w AS k FROM r WINDOW w AS (PARTITION BY id ORDER BY sweep_date))
SELECT id, sweep_date AS from_date, lead(sweep_date) OVER (PARTITION BY id ORDER BY sweep_date) AS to_date, status, total_score FROM c WHERE k = 1 OR os IS DISTINCT FROM status OR oc IS DISTINCT FROM total_score""",
    "st9_append_absent": "SELECT id, company_id, posted_at, score, first_seen FROM score_observation QUALIFY row_number() OVER (PARTITION BY id ORDER BY first_seen, company_id, posted_at, score) = 1",
    "st11_watermarks": f"WITH {T} SELECT family, max(closing_date) AS watermark FROM t WHERE closing_date <= '2026-03-31' GROUP BY family",
    "st13_work_queue": f"""WITH {T}, {C} SELECT tender_id, state, CASE WHEN state = 'awarded' THEN 0 ELSE 1 END AS priority FROM t WHERE state IN ('technical', 'financial', 'awarded') AND tender_id NOT IN (SELECT tender_id FROM tender WHERE ministry IS NULL)
AND (tender_id NOT IN (SELECT tender_id FROM c WHERE stage = 'technical') OR state = 'awarded')""",
    "st14_dead_letters": "SELECT stage AS kind, tender_id AS ref, count(*) AS attempts, arg_max(name, struct_pack(a := CAST(seq AS VARCHAR), b := name)) AS error, max(CAST(seq AS VARCHAR)) AS failed_at, count(*) >= 5 AS given_up FROM tender_company WHERE cr_number IS NULL GROUP BY ALL",
    "st15_orphans": f"WITH {T}, {SEEN} SELECT tender_id, state FROM t WHERE state NOT IN ('awarded', 'cancelled') AND tender_id NOT IN (SELECT tender_id FROM seen WHERE gone_at IS NULL AND kind <> 'closed')",
    "ext_rollup_awards": f"WITH {T} SELECT family, state, count(*) AS n, count(awarded_amount) AS valued FROM t GROUP BY ROLLUP (family, state)",
    "ext_sessions": "WITH e AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL OR ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 6 HOUR THEN 1 ELSE 0 END AS s FROM events) SELECT user_id, sum(s)::BIGINT AS sessions, count(*) AS events FROM e GROUP BY user_id",
}
