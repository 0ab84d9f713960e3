"""Exports: CSV with byte-order mark, named exports, copies without customer tables, rebuilt tables, compressed pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from tallyweir.operators.reports import size_by_kind

#: tables that never leave the house
PRIVATE = ["raw_page", "blob_dict", "customers", "match", "client_month"]


def write_csv(frames: list[DataFrame], path: str, one_file: bool = False) -> None:
    """The rows of all frames under the union of their columns, in the order they first appear; missing is empty.

    UTF-8 with a byte-order mark in each file. one_file writes through a single task and is for reports.
    """
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    first = rows.columns[0]
    marked = rows.withColumnRenamed(first, "﻿" + first)
    (marked.coalesce(1) if one_file else marked).write.mode("overwrite").csv(path, header=True, emptyValue="", nullValue="")


def export(name: str, builders: dict, path: str) -> None:
    """A named export; KeyError for an unknown name, ValueError if it has no rows."""
    rows = builders[name]()
    if rows.isEmpty():
        raise ValueError(f"{name} has no rows")
    write_csv([rows], path)


#: fixed values: the exports of the tender store and of the score store; each a table as it is, but for the awards
TENDER_EXPORTS = {"tenders": "tender", "sightings": "sighting", "companies": "classified_company", "activities": "company_activity", "tender_activities": "tender_activity", "matches": "match", "features": "feature_cr_month"}
SCORE_EXPORTS = {"companies": "company", "scores": "score_observation", "listing": "listing_state", "matches": "match", "services": "company_service", "goods": "company_good"}
ORDERED = {"sightings": ["tender_id", "first_seen"], "scores": ["company_id", "posted_at"], "listing": ["company_id", "from_date"]}


def awards(company: DataFrame, tender: DataFrame) -> DataFrame:
    """Every company row with what its tender says of the award."""
    return company.join(tender.select("tender_id", "family", "state", "awarded_date", "ministry", "awarded_amount"), "tender_id")


def exports_of(tables: dict[str, DataFrame], scores: bool = False) -> dict:
    """The builders of the store's named exports, of the tables that are there."""
    ordered = lambda name, t: t.orderBy(*ORDERED[name]) if name in ORDERED else t
    built = {name: lambda name=name, t=tables[t]: ordered(name, t) for name, t in (SCORE_EXPORTS if scores else TENDER_EXPORTS).items() if t in tables}
    if not scores and {"company", "tender"} <= {*tables}:
        built["awards"] = lambda: awards(tables["company"], tables["tender"])
    return built


def pack(tables: dict[str, DataFrame], path: str, private: list[str] = PRIVATE) -> list[str]:
    """Writes a copy of all tables but the private ones; returns the names written."""
    shared = sorted(t for t in tables if t not in private)
    for t in shared:
        tables[t].write.mode("overwrite").parquet(f"{path}/{t}")
    return shared


def rebuild(rows: DataFrame, path: str) -> None:
    """Replaces a table; running it again does not stack rows."""
    rows.write.mode("overwrite").parquet(path)


def store_pages(pages: DataFrame, path: str) -> None:
    """Pages by kind, compressed by the columnar format."""
    pages.write.mode("overwrite").partitionBy("kind").option("compression", "zstd").parquet(path)


def stored_sizes(pages: DataFrame) -> DataFrame:
    return size_by_kind(pages, "kind", "html")


def compact(path: str, out: str, spark, rows_per_file: int = 1_000_000) -> None:
    """Rewrites a table in files of at most ``rows_per_file`` rows, as many tasks as it has such files."""
    rows = spark.read.parquet(path)
    files = max(1, -(-rows.count() // rows_per_file))
    rows.coalesce(files).write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(out)


