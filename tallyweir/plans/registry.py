"""All queries of the core, by name."""

from __future__ import annotations

from tallyweir.plans import data_queries, register_queries, store_queries

FLAGSHIP = "p6_found"


def queries() -> dict:
    return {**data_queries.QUERIES, **register_queries.QUERIES, **store_queries.QUERIES}


def oracles() -> dict:
    return {**data_queries.ORACLES, **register_queries.ORACLES, **store_queries.ORACLES}
