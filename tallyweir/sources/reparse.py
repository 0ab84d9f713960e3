"""The parsed tables built anew from stored pages, in a fixed order: listings, terms, tender pages, register."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweir.functions import text
from tallyweir.operators.lifecycle import upsert_fold
from tallyweir.sources import pages


def reparse(raw: DataFrame) -> dict[str, DataFrame]:
    """tender, company, tender_activity, classified_company of stored pages (kind, key, html, fetched_at).

    kind: listing (key: section), detail, terms (key: tender_id) or register. Of a page stored more than once the latest
    counts. A tender's fields are folded over its pages: later kinds win where they say something, so terms fill what the
    listing lacks and the tender page has the last word; the first family and the furthest state stand. Empty tables give
    empty tables.
    """
    latest = raw.groupBy("kind", "key").agg(F.max(F.struct("fetched_at", "html")).alias("p")).select("kind", "key", "p.html")
    of = lambda kind: latest.where(F.col("kind") == kind)
    steps = [pages.read_listings(of("listing")), pages.read_terms(of("terms")), pages.read_tenders(of("detail"))]
    log = steps[0].withColumn("step", F.lit(0)).unionByName(steps[1].withColumn("step", F.lit(1))).unionByName(steps[2].withColumn("step", F.lit(2)))
    tender = upsert_fold(log, "tender_id", ["step"], first_wins=("family",), forward={"state": text.state_rank(F.col("state"))}).drop("step")
    company = pages.read_companies(of("detail")).withColumn("name_normalised", text.normalize_name(F.col("name"))).withColumn("cr_root", text.cr_root(F.col("cr_number")))
    register = pages.read_register(of("register")).withColumn("name_normalised", text.normalize_name(F.col("name"))).withColumn("cr_root", text.cr_root(F.col("cr_number")))
    return {"tender": tender, "company": company, "tender_activity": pages.read_activities(of("terms")).distinct(), "classified_company": register}
