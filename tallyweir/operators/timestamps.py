"""Date attributes of raw records as one instant."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweir.functions.timestamps import Candidate, normalise

DATE_ATTRIBUTES = ["icv_posteddate", "createdon", "modifiedon", "icv_icvscoreexpirydate"]


def attribute_instants(attributes: DataFrame, names: list[str] = DATE_ATTRIBUTES, default_tz: str = "Asia/Qatar") -> DataFrame:
    """attr_id, utc_ms of each attribute row with a readable instant; the first readable of the three value fields counts.

    Names compare without case and outer blanks. One input row gives at most one output row, so repeats stay repeats of
    their own attr_id. A narrow map: a filter, three projections, no shuffle. Empty tables give no rows; extra columns are
    ignored.
    """
    rows = attributes.where(F.lower(F.trim("attr_name")).isin(names)).select("attr_id", "attr_value", "display_value", "formatted_value", "tz", "culture")
    us = F.coalesce(F.lower(F.trim("culture")) == "en-us", F.lit(False))
    at = normalise(rows, [Candidate("attr_value"), Candidate("display_value"), Candidate("formatted_value", local=True, month_first=us)], tz=F.col("tz"), default_tz=default_tz)
    return at.where(F.col("utc_ms").isNotNull()).select("attr_id", "utc_ms")
