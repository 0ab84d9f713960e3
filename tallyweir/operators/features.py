"""Point-in-time features by entity and month. Nothing later than its month end enters a row.

Events go to the months in which they count, are summed where they lie and only then shuffled; no entity is ever gathered
in one place. Windows differ by feature set on purpose: 365 and 1,095 days for companies, first of the month a year (three
years) earlier, exclusive, for clients and scores.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweir.functions.dates import guarded_ratio, iso_date, month_ends, months_between, year_start

POLICY_REASONS = ["Transitional Percentage Added"]  # fixed value


def spread(events: DataFrame, when: str, grid: list[date]) -> DataFrame:
    """Each event once for every month end of the (small, fixed) grid that is not before it, as ``as_of``."""
    ends = F.array(*(F.lit(d) for d in grid))
    return events.withColumn("as_of", F.explode(F.filter(ends, lambda d: d >= F.col(when))))


def grid_of(last: date, months: int, earliest: date | None) -> list[date]:
    """The last ``months`` month ends up to the month of ``last``, none before the month of ``earliest``."""
    y, m = divmod(last.year * 12 + last.month - 1 - (months - 1), 12)
    return month_ends(max(date(y, m + 1, 1), date(earliest.year, earliest.month, 1)) if earliest else date(y, m + 1, 1), last)


def score_grid(observations: DataFrame, as_of_end: date, months: int = 60) -> list[date]:
    """The month ends from the month of the earliest observation to that of ``as_of_end``, none before the same month ``months // 12`` years earlier; only the last one if nothing was observed by then."""
    low = date(as_of_end.year - months // 12, as_of_end.month, 1)
    earliest = distinct_scores(observations).agg(F.min("day")).first()[0] or as_of_end
    return month_ends(max(earliest, low), as_of_end) or month_ends(as_of_end, as_of_end)


def latest_tenders(tender: DataFrame) -> DataFrame:
    """One row per tender, its latest reading (then the greater row)."""
    cols = [c for c in tender.columns if c not in ("tender_id", "parsed_at")]
    return tender.where("tender_id is not null").groupBy("tender_id").agg(F.max(F.struct("parsed_at", *cols)).alias("t")).select("tender_id", "t.*")


def distinct_companies(rows: DataFrame) -> DataFrame:
    """Rows without exact repeats."""
    return rows.distinct()


def company_events(companies: DataFrame, tender: DataFrame) -> DataFrame:
    """cr_root, tender_id, day, won, decided, amount, ministry: one event per company and dated tender."""
    dated = tender.select("tender_id", F.coalesce(iso_date(F.col("awarded_date")), iso_date(F.col("closing_date"))).alias("day"), F.nullif("ministry", F.lit("")).alias("ministry"))
    awarded = F.col("role") == "awarded"
    decided = companies.where(awarded).select("tender_id").distinct().withColumn("decided", F.lit(True))
    own = companies.where("cr_root is not null").groupBy("cr_root", "tender_id").agg(F.max(awarded.cast("int")).cast("boolean").alias("won"), F.round(F.sum(F.when(awarded, F.col("value"))), 2).alias("amount"))
    return own.join(dated.where("day is not null"), "tender_id").join(decided, "tender_id", "left").select("cr_root", "tender_id", "day", "won", F.coalesce("decided", F.lit(False)).alias("decided"), "amount", "ministry")


def company_months(companies: DataFrame, tender: DataFrame, register: DataFrame, as_of_end: date, months: int = 60) -> DataFrame:
    """cr_root x as_of_month: awards, bids, win rate (three decided at least), buyers and their top share; register columns on the last month only.

    A company has rows from the month of its first event. Sums are rounded to cents; sums of nothing are null.
    """
    events = company_events(companies, tender)
    bounds = events.agg(F.min("day")).first()[0]
    grid = grid_of(as_of_end, months, bounds)
    if bounds is None or not grid:
        grid = [as_of_end]
        events = events.where("false")
    e = spread(events, "day", grid)
    in12, in36 = F.col("day") > F.date_sub("as_of", 365), F.col("day") > F.date_sub("as_of", 1095)
    count = lambda c: F.sum(F.when(c, 1).otherwise(0))
    won = F.col("won")
    by_buyer = e.groupBy("cr_root", "as_of", "ministry").agg(
        count(won & in12).alias("w12"), count(won & in36).alias("w36"), count(in12).alias("b12"), count(in12 & F.col("decided")).alias("d12"),
        F.sum(F.when(won & in12, F.col("amount"))).alias("v12"), F.sum(F.when(won & in36, F.col("amount"))).alias("v36"), F.sum(F.when(won, F.col("amount"))).alias("vl"),
        F.max(F.when(won & in12, F.col("amount"))).alias("largest"), F.max(F.when(won, F.col("day"))).alias("last"), F.min("day").alias("first"),
    )
    r = by_buyer.groupBy("cr_root", "as_of").agg(
        *(F.sum(c).alias(c) for c in ("w12", "w36", "b12", "d12", "v12", "v36", "vl")), F.max("largest").alias("largest"), F.max("last").alias("last"), F.min("first").alias("first"),
        count(F.col("ministry").isNotNull() & (F.col("w12") > 0)).alias("buyers"), F.max("v12").alias("top"),
    )
    known = register.where("cr_root is not null").groupBy("cr_root").agg(F.max(F.struct("parsed_at", "size", "evaluation", "certificate_end")).alias("c"))
    last = F.col("as_of") == F.lit(grid[-1])
    return r.join(known, "cr_root", "left").select(
        "cr_root", F.col("as_of").alias("as_of_month"), F.col("w12").alias("awards_12m_count"), F.round("v12", 2).alias("awards_12m_value"), F.col("w36").alias("awards_36m_count"), F.round("v36", 2).alias("awards_36m_value"),
        F.round("vl", 2).alias("awards_life_value"), F.col("largest").alias("largest_award_12m"), months_between(F.col("last"), F.col("as_of")).alias("months_since_last_award"), F.col("b12").alias("bids_12m_count"),
        F.col("d12").alias("decided_12m_count"), F.col("w12").alias("wins_12m_count"), guarded_ratio(F.col("w12"), F.col("d12"), 3).alias("win_rate_12m"), F.col("buyers").alias("distinct_buyers_12m"),
        F.when(F.col("v12") > 0, F.round(F.col("top") / F.col("v12"), 4)).alias("top_buyer_share_12m"), months_between(F.col("first"), F.col("as_of")).alias("months_since_first_seen"),
        F.when(last, F.col("c.size")).alias("classified_size"), F.when(last, F.col("c.evaluation")).alias("classified_evaluation"), F.when(last, F.col("c.certificate_end")).alias("certificate_end"),
    )


def match_facts(matches: DataFrame, companies: DataFrame, tender: DataFrame) -> DataFrame:
    """Each match with its company row and tender: won, event date and which date it is, companies on the tender, decided.

    matches: client_id, relation, party_name, method, needs_review, tender_id, role, seq.
    """
    counts = companies.groupBy("tender_id").agg(F.count("*").alias("companies_on_tender"), F.max((F.col("role") == "awarded").cast("int")).alias("decided"))
    c = companies.select("tender_id", "role", "seq", F.col("value").alias("company_value"), F.col("name").alias("company_name"))
    t = tender.select("tender_id", F.col("ministry").alias("buyer"), "awarded_date", "closing_date", "publish_date")
    event = F.coalesce("awarded_date", "closing_date", "publish_date")
    basis = F.when(F.col("awarded_date").isNotNull(), "awarded").when(F.col("closing_date").isNotNull(), "closing").when(F.col("publish_date").isNotNull(), "publish")
    out = matches.join(c, ["tender_id", "role", "seq"]).join(t, "tender_id").join(counts, "tender_id")
    return out.select("client_id", "relation", "party_name", "method", "needs_review", "tender_id", "role", "seq", (F.col("role") == "awarded").cast("int").alias("won"), event.alias("event_date"), basis.alias("event_date_basis"), "company_value", "company_name", "buyer", "companies_on_tender", "decided")


def client_months(facts: DataFrame, as_of_end: date, months: int = 60) -> DataFrame:
    """client_id x as_of_month from match_facts: own bids, wins and values, and what matched buyers and suppliers did."""
    e = facts.select("client_id", "relation", "tender_id", iso_date(F.col("event_date")).alias("day"), (F.col("won") == 1).alias("won"), (F.col("decided") == 1).alias("decided"), F.col("company_value").alias("value"), F.nullif("buyer", F.lit("")).alias("buyer"), (F.col("needs_review") == 1).alias("review"), F.when(F.col("relation") != "self", F.upper(F.coalesce("party_name", F.lit("")))).otherwise("").alias("party"))
    e = e.where("day is not null")
    # The first month of the grid is that of the first event, or 31 days a month before the last month's first day.
    low = date.fromordinal(date(as_of_end.year, as_of_end.month, 1).toordinal() - 31 * months)
    e = spread(e, "day", month_ends(low, as_of_end))
    y12, y36 = F.col("day") > year_start(F.col("as_of"), 1), F.col("day") > year_start(F.col("as_of"), 3)
    own, won = F.col("relation") == "self", F.col("won")
    flag = lambda c: F.max(F.when(c, 1).otherwise(0))
    # One row per tender, buyer and party first: all distinct counts below are sums of its flags.
    fine = e.groupBy("client_id", "as_of", "relation", "tender_id", "buyer", "party").agg(
        flag(y12).alias("in12"), flag(y12 & F.col("decided")).alias("d12"), flag(y12 & won).alias("w12"), F.sum(F.when(y12 & won, F.col("value"))).alias("v12"), F.sum(F.when(y36 & won, F.col("value"))).alias("v36"),
        F.max(F.when(won, F.col("day"))).alias("last"), F.min("day").alias("first"), F.sum(F.when(y12, 1).otherwise(0)).alias("n12"), F.sum(F.when(y12 & F.col("review"), 1).otherwise(0)).alias("r12"),
    )
    side = lambda r, c: F.when(F.col("relation") == r, c)
    by_tender = fine.where(own).groupBy("client_id", "as_of", "tender_id").agg(F.max("in12").alias("in12"), F.max("d12").alias("d12"), F.max("w12").alias("w12"), F.sum("v12").alias("v12"), F.sum("v36").alias("v36"), F.max("last").alias("last"))
    tenders = by_tender.groupBy("client_id", "as_of").agg(F.sum("in12").alias("bids"), F.sum("d12").alias("decided"), F.sum("w12").alias("wins"), F.sum("v12").alias("v12"), F.sum("v36").alias("v36"), F.max("v12").alias("largest"), F.max("last").alias("last"))
    by_buyer = fine.where(own & F.col("buyer").isNotNull()).groupBy("client_id", "as_of", "buyer").agg(F.max("w12").alias("w"), F.sum("v12").alias("v"))
    buyers = by_buyer.groupBy("client_id", "as_of").agg(F.sum("w").alias("buyers"), F.max("v").alias("top"), F.sum("v").alias("all"))
    by_party = fine.groupBy("client_id", "as_of", "relation", "party").agg(F.max("w12").alias("w"), F.sum("v12").alias("v"), F.min("first").alias("first"), F.sum("n12").alias("n"), F.sum("r12").alias("r"))
    cp = F.col("relation").isin("buyer", "supplier")
    parties = by_party.groupBy("client_id", "as_of").agg(
        F.min("first").alias("first"), F.sum(F.when(cp, F.col("r"))).alias("review"), F.sum(F.when(cp, F.col("n"))).alias("rows"),
        *(f for r in ("buyer", "supplier") for f in (F.count(side(r, F.lit(1))).alias(f"{r}_matched"), F.coalesce(F.sum(side(r, F.col("w"))), F.lit(0)).alias(f"{r}_active"), F.sum(side(r, F.col("v"))).alias(f"{r}_value"))),
    )
    zero = lambda c: F.nullif(F.coalesce(c, F.lit(0.0)), F.lit(0.0))
    nil = lambda c: F.coalesce(c, F.lit(0))
    j = parties.join(tenders, ["client_id", "as_of"], "left").join(buyers, ["client_id", "as_of"], "left")
    return j.select(
        "client_id", F.col("as_of").alias("as_of_month"), nil("bids").alias("self_bids_12m"), nil("decided").alias("self_decided_12m"), nil("wins").alias("self_wins_12m"), guarded_ratio(F.col("wins"), F.col("decided"), 3).alias("self_win_rate_12m"),
        zero("v12").alias("self_award_value_12m"), zero("v36").alias("self_award_value_36m"), F.col("largest").alias("self_largest_award_12m"), months_between(F.col("last"), F.col("as_of")).alias("self_months_since_last_award"),
        nil("buyers").alias("self_distinct_buyers_12m"), F.when(F.col("all") > 0, F.round(F.col("top") / F.col("all"), 4)).alias("self_top_buyer_share_12m"), months_between(F.col("first"), F.col("as_of")).alias("self_months_since_first_seen"),
        F.col("buyer_matched").alias("buyers_matched"), F.col("buyer_active").alias("buyers_active_12m"), zero("buyer_value").alias("buyer_award_value_12m"), F.col("supplier_matched").alias("suppliers_matched"),
        F.col("supplier_active").alias("suppliers_active_12m"), zero("supplier_value").alias("supplier_award_value_12m"), F.when(F.col("rows") > 0, F.round(F.col("review") / F.col("rows"), 4)).alias("counterparty_review_share"),
    )


def distinct_scores(observations: DataFrame) -> DataFrame:
    """company_id, day, posted_at, id, score, change, reason of each dated observation, re-reads once."""
    o = observations.groupBy("id").agg(F.max(F.struct("company_id", "posted_at", "posted_date", "score", "change", "reason")).alias("o")).select("id", "o.*")
    return o.select("company_id", iso_date(F.col("posted_date")).alias("day"), "posted_at", "id", "score", "change", "reason").where("day is not null")


def score_profiles(scores: DataFrame, as_of: Column, per: list[str]) -> DataFrame:
    """The trajectory of each group of ``per`` at ``as_of`` (a column of rows spread over months, or one date). Rows after it must be gone."""
    cutoff = year_start(as_of, 1)
    inside = F.col("day") > cutoff
    policy = F.trim(F.coalesce("reason", F.lit(""))).isin(POLICY_REASONS)
    last = lambda cond: F.max(F.when(cond, F.struct("day", "posted_at", "id", "score", "reason")))
    g = scores.groupBy(*per).agg(last(F.lit(True)).alias("l"), last(~inside).alias("p"), F.min("day").alias("first"), F.count("*").alias("n"), F.sum(F.when(inside & ~policy, F.col("change"))).alias("organic"), F.sum(F.when(inside & policy, F.col("change"))).alias("policy"))
    at = as_of if "as_of" not in per else F.col("as_of")
    return g.select(
        *per, F.col("l.score").alias("score"), F.col("l.day").alias("score_date"), F.col("l.reason").alias("score_reason"), F.col("first").alias("first_certificate"), F.col("n").alias("observations"),
        months_between(F.col("l.day"), at).alias("months_since_last_change"), F.col("p.score").alias("score_12m_ago"), F.round(F.col("l.score") - F.col("p.score"), 2).alias("score_change_12m"),
        F.round("organic", 2).alias("organic_change_12m"), F.round("policy", 2).alias("policy_change_12m"), months_between(F.col("first"), at).alias("months_certified"),
    )


def score_profile_months(observations: DataFrame, grid: list[date]) -> DataFrame:
    """company_id x as_of: score_profiles on every month end of the grid; no row before the first observation."""
    return score_profiles(spread(distinct_scores(observations), "day", grid), F.col("as_of"), ["company_id", "as_of"])


def cohort_medians(profiles: DataFrame, industries: DataFrame, per: list[str]) -> DataFrame:
    """industry, per..., median_score, companies: the median of the latest scores; rows without industry are left out."""
    known = industries.where("industry is not null and industry <> ''")
    return profiles.join(known, "company_id").groupBy("industry", *per).agg(F.round(F.median("score"), 2).alias("median_score"), F.count("*").alias("companies"))


def latest_industry(company: DataFrame) -> DataFrame:
    """company_id, industry of the latest snapshot of each company."""
    key = F.lower(F.regexp_replace(F.trim("id"), r"^\{|\}$", ""))
    return company.groupBy(key.alias("company_id")).agg(F.max_by("industry", F.struct("snapshot_date", "loaded_at")).alias("industry"))


def standings(listing: DataFrame, grid: list[date]) -> DataFrame:
    """company_id x as_of: status, certificate, score and days to expiry of the period that covers the month end."""
    s = listing.select("company_id", iso_date(F.col("from_date")).alias("from_date"), iso_date(F.col("to_date")).alias("to_date"), F.trim("status").alias("status"), "certificate_no", "expiry_date", "total_score", "recorded_at")
    ends = F.array(*(F.lit(d) for d in grid))
    covered = s.withColumn("as_of", F.explode(F.filter(ends, lambda d: (d >= F.col("from_date")) & (F.col("to_date").isNull() | (d <= F.col("to_date"))))))
    top = covered.groupBy("company_id", "as_of").agg(F.max(F.struct("from_date", "recorded_at", "status", "certificate_no", "expiry_date", "total_score")).alias("s"))
    return top.select("company_id", "as_of", "s.status", "s.certificate_no", "s.expiry_date", F.col("s.total_score").alias("total_score_listed"), F.date_diff(iso_date(F.col("s.expiry_date")), F.col("as_of")).alias("days_to_expiry"))


def client_score_months(pairs: DataFrame, observations: DataFrame, listing: DataFrame, industries: DataFrame, grid: list[date], pick_one: bool = False) -> DataFrame:
    """client_id, company_id x as_of_month: profile, standing and distance to the cohort's median. pick_one: one company per client and month (the least id)."""
    profiles = score_profile_months(observations, grid)
    medians = cohort_medians(profiles, industries, ["as_of"]).drop("companies")
    j = pairs.join(profiles, "company_id").join(standings(listing, grid), ["company_id", "as_of"], "left").join(industries, "company_id", "left").join(medians, ["industry", "as_of"], "left")
    out = j.select(
        "client_id", "company_id", F.col("as_of").alias("as_of_month"), "industry", "score", "score_date", "score_change_12m", "organic_change_12m", "policy_change_12m", "months_since_last_change", "months_certified", "observations",
        "status", "days_to_expiry", F.when(F.col("status").isNotNull(), 1).otherwise(0).alias("standing_known"), F.col("median_score").alias("industry_median"), F.round(F.col("score") - F.col("median_score"), 2).alias("vs_industry"),
    )
    if not pick_one:
        return out
    rest = [c for c in out.columns if c not in ("client_id", "as_of_month")]
    return out.groupBy("client_id", "as_of_month").agg(F.min_by(F.struct(*rest), "company_id").alias("r")).select("client_id", "as_of_month", "r.*")
