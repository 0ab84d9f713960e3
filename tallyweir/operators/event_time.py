"""Attributes as they were known when an event happened, by version numbers and an equi-join.

A row of the history is known from the later of its recorded_at and its from_date. Over the narrow rows (entity, time) of
one union, an entity's versions are the rows that raise the greatest (from_date, recorded_at) so far; an event's version
number is the count of versions up to its time. Wide attributes join on (entity, number). Running maxima and counts are
taken in two steps, inside a time slot and over the slots of an entity, so no window holds more of a hot entity than one
slot, and events of one instant count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweir.operators.history import BLANK, canonical_id
from tallyweir.session import cut

SLOT_SECONDS = 86_400


def running(rows: DataFrame, key: str, time: str, slot: str, value: Column, combine, out: str) -> DataFrame:
    """Adds ``out``: combine(value) over the key's rows with a time up to and including the row's own, in two steps."""
    inside = Window.partitionBy(key, slot).orderBy(time).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(key).orderBy(slot).rowsBetween(Window.unboundedPreceding, -1)
    slots = rows.groupBy(key, slot).agg(combine(value).alias("__slot"))
    slots = slots.select(key, slot, combine(F.col("__slot")).over(before).alias("__carry"))
    return rows.withColumn("__in", combine(value).over(inside)).join(slots, [key, slot]).withColumn(out, F.struct("__carry", "__in")).drop("__carry", "__in")


def known_versions(history: DataFrame, slot_seconds: int = SLOT_SECONDS) -> DataFrame:
    """entity, known (seconds), k (struct from_date, recorded_at): the history rows that outdo all that were known before them. history: entity, from_date, recorded_at."""
    k = F.struct("from_date", "recorded_at")
    known = F.greatest(F.unix_micros("recorded_at"), F.unix_date("from_date").cast("bigint") * 86_400_000_000)
    rows = history.select("entity", known.alias("known"), k.alias("k")).where("known is not null").groupBy("entity", "known").agg(F.max("k").alias("k"))
    rows = rows.withColumn("slot", F.floor(F.col("known") / (slot_seconds * 1_000_000)))
    before = Window.partitionBy("entity", "slot").orderBy("known").rowsBetween(Window.unboundedPreceding, -1)
    slots = rows.groupBy("entity", "slot").agg(F.max("k").alias("top"))
    slots = slots.select("entity", "slot", F.max("top").over(Window.partitionBy("entity").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)).alias("carry"))
    rows = rows.withColumn("prior", F.max("k").over(before)).join(slots, ["entity", "slot"])
    beaten = (F.col("prior") >= F.col("k")) | (F.col("carry") >= F.col("k"))
    return rows.where(~F.coalesce(beaten, F.lit(False))).select("entity", "known", "k")


def version_numbers(times: DataFrame, slot_seconds: int = SLOT_SECONDS) -> DataFrame:
    """entity, at, change, k, number: the count of changes of the entity up to and including ``at``. times: entity, at (microseconds), change (0/1), k."""
    rows = times.withColumn("slot", F.floor(F.col("at") / (slot_seconds * 1_000_000)))
    n = running(rows, "entity", "at", "slot", F.col("change"), F.sum, "__n")
    return n.select("entity", "at", "change", "k", (F.coalesce("__n.__carry", F.lit(0)) + F.col("__n.__in")).alias("number"))


def as_known_at(events: DataFrame, history: DataFrame, attributes: list[str]) -> DataFrame:
    """Each event with the attributes of the history row that was known at its time: latest from_date, then latest recorded_at.

    events: event_id, entity, at (microseconds); history: entity, from_date date, recorded_at timestamp and attributes.
    Events without entity, time or known row have no row in the result; repeats of an event are kept.
    """
    history = history.where("entity is not null and from_date is not null and recorded_at is not null")
    wide = history.groupBy("entity", "from_date", "recorded_at").agg(F.max(F.struct(*attributes)).alias("a"))
    versions = cut(known_versions(history.select("entity", "from_date", "recorded_at")))
    times = events.where("entity is not null and at is not null").select("entity", "at").distinct()
    none = F.lit(None).cast("struct<from_date:date,recorded_at:timestamp>")
    numbered = cut(version_numbers(versions.select("entity", F.col("known").alias("at"), F.lit(1).alias("change"), "k").unionByName(times.select("entity", "at", F.lit(0).alias("change"), none.alias("k")))))
    by_number = numbered.where("change = 1").select("entity", "number", "k.from_date", "k.recorded_at").join(wide, ["entity", "from_date", "recorded_at"]).select("entity", "number", "from_date", "recorded_at", "a.*")
    at_number = events.join(numbered.where("change = 0 and number > 0").select("entity", "at", "number"), ["entity", "at"])
    return at_number.join(by_number, ["entity", "number"]).select("event_id", "entity", "at", "from_date", "recorded_at", *attributes)


def scores_with_state(observations: DataFrame, listing: DataFrame) -> DataFrame:
    """observation_id, from_date, status of each score observation that had a known listing row when it was posted.

    posted_date is the UTC day of posted_at; where they disagree or one is missing, the earlier governs. Repeats of an
    observation that differ only in first_seen are one.
    """
    micros = F.unix_micros(F.try_to_timestamp(F.col("posted_at")))
    day_end = (F.unix_date(F.to_date(F.try_to_timestamp(F.substring("posted_date", 1, 10)))).cast("bigint") + 1) * 86_400_000_000 - 1
    events = observations.select(F.col("id").alias("event_id"), canonical_id(F.col("company_id")).alias("entity"), F.least(micros, day_end).alias("at")).where("event_id is not null").distinct()
    day = F.to_date(F.try_to_timestamp(F.substring("from_date", 1, 10)))
    status = F.initcap(F.regexp_replace(F.regexp_replace("status", BLANK, ""), r"(?U)\s+", " "))
    states = listing.select(canonical_id(F.col("company_id")).alias("entity"), day.alias("from_date"), "recorded_at", status.alias("status"))
    known = as_known_at(events, states, ["status"])
    return known.select(F.col("event_id").alias("observation_id"), F.date_format("from_date", "yyyy-MM-dd").alias("from_date"), "status")
