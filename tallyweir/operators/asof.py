"""Latest value at or before a date, and the period that covers a date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_before(points: DataFrame, history: DataFrame, key: str, at: str, when: str, order: list[str], columns: list[str], slot_days: int = 16) -> DataFrame:
    """points with, of the history rows of their key that are not later, the latest one's columns (null without one).

    points: key, at (date) and more; history: key, when (date), order (ties) and columns. No pair of point and row is ever
    built: the latest row is carried along the union of both in two steps, inside slots of ``slot_days`` and over the slots of
    a key, so no window holds more of a hot key than one slot. Points keep their repeats; points without key or date get nulls.
    """
    own = [c for c in points.columns if c not in (key, at)]
    slot = F.floor(F.unix_date("__t") / slot_days)
    found = F.struct(*(F.col(c).alias(f"o{i}") for i, c in enumerate([when, *order])), F.struct(*(F.col(c) for c in columns)).alias("v"))
    left = points.select(F.col(key).alias("__k"), F.col(at).alias("__t"), F.struct(F.lit(1).alias("__p"), *own).alias("__own"), F.lit(None).alias("__row"))
    right = history.where(F.col(when).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("__k"), F.col(when).alias("__t"), F.lit(None).alias("__own"), found.alias("__row"))
    rows = left.unionByName(right).withColumn("__slot", slot)
    inside = Window.partitionBy("__k", "__slot").orderBy("__t").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy("__k").orderBy("__slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = right.groupBy("__k", slot.alias("__slot")).agg(F.max("__row").alias("__top"))
    # Every slot of the key, so that one without rows of its own carries on as well.
    slots = rows.where("__k is not null").select("__k", "__slot").distinct().join(slots, ["__k", "__slot"], "left").select("__k", "__slot", F.max("__top").over(before).alias("__carry"))
    reached = rows.withColumn("__in", F.max("__row").over(inside)).where("__own is not null").join(slots, ["__k", "__slot"], "left")
    last = F.coalesce("__in", "__carry")["v"]
    return reached.select(F.col("__k").alias(key), F.col("__t").alias(at), *(F.col(f"__own.{c}").alias(c) for c in own), *(last[c].alias(c) for c in columns))


def latest_at(history: DataFrame, key: str, when: str, at: Column, order: list[str], columns: list[str]) -> DataFrame:
    """key and columns of each key's latest row not after the one date ``at``: an aggregation with map-side combine."""
    top = F.max_by(F.struct(*columns), F.struct(when, *order))
    return history.where(F.col(when) <= at).groupBy(key).agg(top.alias("__row")).select(key, "__row.*")


def period_at(periods: DataFrame, key: str, at: Column, columns: list[str], start: str = "from_date", end: str = "to_date") -> DataFrame:
    """key and columns of the period that covers ``at``; both ends count, an open end is null; of two the newest start."""
    covers = (F.col(start) <= at) & (F.col(end).isNull() | (F.col(end) >= at))
    return periods.where(covers).groupBy(key).agg(F.max_by(F.struct(*columns), F.struct(start, *columns)).alias("__row")).select(key, "__row.*")
