from datetime import date

import pytest
from pyspark.sql import functions as F

from tallyweir.operators import features
from tallyweir.plans import registry
from tests.oracle import SF, compare, connect

QUERIES, SQL = registry.queries(), registry.oracles()
OBSERVATION = "id string, company_id string, posted_at string, posted_date string, score double, change double, reason string"


def test_grid_starts_with_the_earliest_observation(spark):
    seen = lambda *days: spark.createDataFrame([(str(i), "c", d, d, 1.0, None, None) for i, d in enumerate(days)], OBSERVATION)
    grid = lambda *days, months=60: features.score_grid(seen(*days), date(2026, 6, 30), months)
    assert grid("2026-04-17", "2026-05-01", "bad") == [date(2026, 4, 30), date(2026, 5, 31), date(2026, 6, 30)]
    assert len(grid("2023-01-14")) == 42
    assert (grid("2001-01-01")[0], grid("2001-01-01", months=30)[0]) == (date(2021, 6, 30), date(2024, 6, 30))  # whole years back
    assert grid() == grid("2026-07-01") == [date(2026, 6, 30)]


@pytest.mark.parametrize("name", ["f3_score_profiles", "f4_cohort_medians", "f5_standings", "f7_client_score_months"])
def test_score_queries_hold_all_months(spark, name):
    """The SQL finds the first month itself; with the month written out it gives the same, and the months before 2025 are there."""
    month = "as_of_month" if name.startswith("f7") else "as_of"
    first = connect().execute("SELECT date_trunc('month', min(CAST(posted_date AS DATE)))::DATE FROM score_observation").fetchone()[0]
    written = SQL[name].replace("(SELECT greatest(date_trunc('month', min(CAST(posted_date AS DATE))), DATE '2021-06-01') FROM score_observation)", f"DATE '{first}'")
    assert first < date(2025, 1, 1) and written != SQL[name]
    compare(spark, QUERIES[name], written)
    assert not QUERIES[name](spark, SF).where(F.col(month) < "2025-01-01").isEmpty()
