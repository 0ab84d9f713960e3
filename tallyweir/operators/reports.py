"""Relational reports over tenders, companies, register and scores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweir.operators.asof import latest_at

from tallyweir.functions.dates import guarded_ratio


def win_rates(companies: DataFrame, tender: DataFrame, least: int) -> DataFrame:
    """key, name, appearances, won, lost, open, cancelled, value, first_award, last_award of the companies seen on ``least`` tenders or more.

    A company is its number root, else its normalised name. Sums are taken per company and tender first.
    """
    awarded = F.col("role") == "awarded"
    decided = companies.where(awarded).select("tender_id").distinct().withColumn("decided", F.lit(1))
    per = companies.groupBy(F.coalesce("cr_root", "name_normalised").alias("key"), "tender_id").agg(F.min("name").alias("name"), F.max(awarded.cast("int")).alias("won"), F.sum(F.when(awarded, F.coalesce("value", F.lit(0.0))).otherwise(0.0)).alias("value"))
    j = per.join(tender.select("tender_id", "state", "awarded_date"), "tender_id").join(decided, "tender_id", "left")
    undecided = F.col("decided").isNull()
    n = lambda c: F.sum(F.when(c, 1).otherwise(0))
    out = j.groupBy("key").agg(
        F.min("name").alias("name"), F.count("*").alias("appearances"), F.sum("won").alias("won"), n((F.col("won") == 0) & ~undecided).alias("lost"), n(undecided & (F.col("state") != "cancelled")).alias("open"),
        n(undecided & (F.col("state") == "cancelled")).alias("cancelled"), F.round(F.sum("value"), 2).alias("value"), F.min("awarded_date").alias("first_award"), F.max("awarded_date").alias("last_award"),
    )
    return out.where(F.col("appearances") >= least)


def by_state(tender: DataFrame) -> DataFrame:
    return tender.where("family is not null").groupBy("family", "state").agg(F.count("*").alias("n"), F.round(F.sum("awarded_amount"), 2).alias("value"))


def store_counts(tender: DataFrame, companies: DataFrame, register: DataFrame) -> DataFrame:
    """One row of totals; each table is read once."""
    t = tender.agg(F.count("*").alias("tenders"), F.count("awarded_date").alias("with_award_date"), F.min("awarded_date").alias("earliest_award"), F.max("awarded_date").alias("latest_award"), F.round(F.sum("awarded_amount"), 2).alias("total_awarded"))
    c = companies.agg(F.count_if(F.col("role") == "awarded").alias("award_rows"), F.count_if(F.col("role") == "bidder").alias("bidder_rows"), F.count_distinct(F.coalesce("cr_root", "name_normalised")).alias("distinct_companies"), F.count("cr_root").alias("with_cr"))
    r = register.agg(F.count("*").alias("classified"))
    one = F.lit(True)  # three one-row results side by side
    return t.join(F.broadcast(c), one, "left").join(F.broadcast(r), one, "left")


def store_statistics(tender: DataFrame, companies: DataFrame, register: DataFrame, pages: DataFrame, seen: DataFrame, tender_activities: DataFrame, matches: DataFrame, features: DataFrame, failed: DataFrame, runs: DataFrame) -> DataFrame:
    """One row with all counters of the store; each table is read once.

    Beside store_counts(): pages (kind) by listing and detail; seen (tender_id, gone_at): tenders that are listed nowhere now;
    register: delisted_at, activities; matches (method) and those for review; rows of features, tender activities and failed
    pages; runs (finished_at): the latest.
    """
    n = lambda df, name: df.agg(F.count("*").alias(name))
    gone = seen.groupBy("tender_id").agg(F.count_if(F.col("gone_at").isNull()).alias("live")).agg(F.count_if(F.col("live") == 0).alias("listed_nowhere"))
    parts = [
        pages.agg(F.count_if(F.col("kind") == "listing").alias("listing_pages"), F.count_if(F.col("kind") == "detail").alias("detail_pages")), gone,
        register.agg(F.count("delisted_at").alias("delisted"), F.coalesce(F.sum(F.size("activities")), F.lit(0)).cast("bigint").alias("company_activities")), n(tender_activities, "tender_activities"),
        matches.agg(F.count("*").alias("matches"), F.count_if(F.col("method").isin("name_fuzzy", "name_translit")).alias("matches_for_review")), n(features, "feature_rows"), n(failed, "pages_awaiting_retry"), runs.agg(F.max("finished_at").alias("last_run")),
    ]
    return reduce(lambda x, y: x.join(F.broadcast(y), F.lit(True), "left"), parts, store_counts(tender, companies, register))  # one-row results side by side


def cohort_scores(scores: DataFrame, industries: DataFrame, as_of: Column) -> DataFrame:
    """industry, company_id, score: the cohort of each industry as at a date, one row per company with a score by then. scores: as features.distinct_scores gives them."""
    latest = latest_at(scores, "company_id", "day", as_of, ["posted_at", "id"], ["score"])
    return latest.join(industries.where("industry is not null"), "company_id").select("industry", "company_id", "score")


def register_of_matches(matches: DataFrame, register: DataFrame, client: str) -> DataFrame:
    """client, profile_number, name, size, evaluation: of the register rows whose number root is that of any number the client was matched by, the one of the least profile_number. matches: client, matched_cr (root)."""
    roots = matches.where("matched_cr is not null").select(client, F.col("matched_cr").alias("cr_root")).distinct()
    rows = register.where("cr_root is not null").groupBy("cr_root").agg(F.min(F.struct("profile_number", "name", "size", "evaluation")).alias("r"))
    return roots.join(rows, "cr_root").groupBy(client).agg(F.min("r").alias("r")).select(client, "r.*")


def score_counts(company: DataFrame, observations: DataFrame, listing: DataFrame) -> DataFrame:
    """One row: companies live and gone, with number and history (by their latest snapshot), observations, listing states."""
    key = F.lower(F.regexp_replace(F.trim("id"), r"^\{|\}$", ""))
    latest = company.groupBy(key.alias("id")).agg(F.max(F.struct("snapshot_date", "loaded_at", "gone_at", "cr_root", "history_read")).alias("c"))
    c = latest.agg(F.count_if(F.col("c.gone_at").isNull()).alias("companies"), F.count("c.gone_at").alias("gone"), F.count("c.cr_root").alias("with_cr"), F.count("c.history_read").alias("history_read"))
    one = F.lit(True)
    return c.join(F.broadcast(observations.agg(F.count_distinct("id").alias("score_observations"))), one, "left").join(F.broadcast(listing.agg(F.count_distinct("company_id", "from_date").alias("listing_states"))), one, "left")


def section_status(seen: DataFrame, kind: str) -> DataFrame:
    """kind, listed, gone. seen: kind, gone_at."""
    return seen.groupBy(kind).agg(F.count_if(F.col("gone_at").isNull()).alias("listed"), F.count("gone_at").alias("gone"))


def company_tenders(companies: DataFrame, tender: DataFrame) -> DataFrame:
    """Company rows with their tender."""
    t = tender.select("tender_id", "tender_number", "subject", "ministry", "state", "awarded_date", "closing_date")
    return companies.join(t, "tender_id")


def companies_on_tender(companies: DataFrame, tender: DataFrame) -> DataFrame:
    """tender_id, companies, awarded, decided of every tender (correlated counts as one aggregate)."""
    c = companies.groupBy("tender_id").agg(F.count("*").alias("companies"), F.count_if(F.col("role") == "awarded").alias("awarded"))
    n = lambda x: F.coalesce(x, F.lit(0))
    return tender.select("tender_id").join(c, "tender_id", "left").select("tender_id", n("companies").alias("companies"), n("awarded").alias("awarded"), (n("awarded") > 0).cast("int").alias("decided"))


def entity_profiles(companies: DataFrame, tender: DataFrame, register: DataFrame) -> DataFrame:
    """cr_root, tenders, won, lost, open, value, win_rate, awarding_bodies, top_body, top_share, size, evaluation of every company with a number."""
    awarded = F.col("role") == "awarded"
    decided = companies.where(awarded).select("tender_id").distinct().withColumn("decided", F.lit(1))
    t = tender.select("tender_id", "state", F.nullif("ministry", F.lit("")).alias("ministry"))
    own = companies.where("cr_root is not null").groupBy("cr_root", "tender_id").agg(F.max(awarded.cast("int")).alias("won"), F.sum(F.when(awarded, F.coalesce("value", F.lit(0.0)))).alias("value"))
    by_body = own.join(t, "tender_id").join(decided, "tender_id", "left").groupBy("cr_root", "ministry").agg(
        F.count("*").alias("n"), F.sum("won").alias("won"), F.count_if((F.col("won") == 0) & F.col("decided").isNotNull()).alias("lost"),
        F.count_if(F.col("decided").isNull() & (F.coalesce("state", F.lit("")) != "cancelled")).alias("open"), F.round(F.sum("value"), 2).alias("value"),
    )
    body = F.when(F.col("ministry").isNotNull() & (F.col("won") > 0), F.struct(F.coalesce("value", F.lit(0.0)).alias("value"), "ministry"))
    p = by_body.groupBy("cr_root").agg(F.sum("n").alias("tenders"), F.sum("won").alias("won"), F.sum("lost").alias("lost"), F.sum("open").alias("open"), F.round(F.coalesce(F.sum("value"), F.lit(0.0)), 2).alias("value"), F.count(body).alias("awarding_bodies"), F.max(body).alias("top"))
    known = register.where("cr_root is not null").groupBy("cr_root").agg(F.min(F.struct("profile_number", "size", "evaluation")).alias("r"))
    return p.join(known, "cr_root", "left").select(
        "cr_root", "tenders", "won", "lost", "open", "value", guarded_ratio(F.col("won"), F.col("won") + F.col("lost"), 1).alias("win_rate"), "awarding_bodies", F.col("top.ministry").alias("top_body"),
        F.when(F.col("value") > 0, F.round(F.col("top.value") / F.col("value"), 4)).alias("top_share"), F.col("r.size").alias("size"), F.col("r.evaluation").alias("evaluation"),
    )


def top_awards(companies: DataFrame, tender: DataFrame, n: int) -> DataFrame:
    """The n largest awarded rows, ties by tender and seq; a report's limit, taken as top-k of each partition first."""
    j = companies.where("role = 'awarded' and value is not null").join(tender.select("tender_id", "ministry"), "tender_id")
    return j.select("tender_id", "seq", "name", "ministry", "value").orderBy(F.col("value").desc_nulls_last(), F.col("tender_id").try_cast("bigint"), "seq").limit(n)


def size_by_kind(pages: DataFrame, kind: str, body: str) -> DataFrame:
    return pages.groupBy(kind).agg(F.count("*").alias("pages"), F.sum(F.length(body)).alias("chars"))


def tender_history(tender: DataFrame, companies: DataFrame, tender_id: str) -> DataFrame:
    """All readings of one tender and its company rows, as (kind, at, text)."""
    t = tender.where(F.col("tender_id") == tender_id).select(F.lit("reading").alias("kind"), F.col("parsed_at").cast("string").alias("at"), F.concat_ws(" ", "state", "awarded_date").alias("text"))
    c = companies.where(F.col("tender_id") == tender_id).select(F.concat_ws(" ", F.lit("company"), "role").alias("kind"), F.lit(None).cast("string").alias("at"), F.col("name").alias("text"))
    return t.unionByName(c)
