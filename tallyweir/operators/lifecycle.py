"""State kept over repeated readings, as batch folds over logs: upserts, sightings, tombstones, periods, queues, dead letters.

Every fold is an aggregation with map-side combine or a join on the key; none depends on the order of its input.
"""

from __future__ import annotations

from datetime import date, datetime
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweir.functions import text
from tallyweir.operators.history import calendar
from tallyweir.session import cut, small_side

GONE_AFTER, LOOK_BACK_DAYS = 2, 14  # fixed values
MOST_ATTEMPTS, MOST_MISSING = 5, 3  # fixed values


def page_changes(stored: DataFrame, fetched: DataFrame) -> DataFrame:
    """url, outcome (new, changed, unchanged), content_sha256, first_seen_at, fetched_at of each fetched page.

    stored: url, content_sha256, first_seen_at; fetched: url, html, fetched_at. Scripts, styles, comments and blanks do not count.
    """
    new = fetched.groupBy("url").agg(F.max(F.struct("fetched_at", "html")).alias("p")).select("url", "p.fetched_at", text.html_fingerprint(F.col("p.html")).alias("sha"))
    old = stored.select("url", F.col("content_sha256").alias("old"), "first_seen_at")
    outcome = F.when(F.col("old").isNull(), "new").when(F.col("old") == F.col("sha"), "unchanged").otherwise("changed")
    return new.join(old, "url", "left").select("url", outcome.alias("outcome"), F.col("sha").alias("content_sha256"), F.coalesce("first_seen_at", "fetched_at").alias("first_seen_at"), "fetched_at")


def upsert_fold(log: DataFrame, key: str, order: list[str], first_wins: tuple[str, ...] = (), always: tuple[str, ...] = (), forward: dict[str, Column] | None = None) -> DataFrame:
    """One row per key of a log of partial rows: of each column the latest value that is not null; of ``first_wins`` the earliest; of ``always`` the latest, null or not; of ``forward`` (column: its rank) the latest of the greatest rank, as such a value never moves back."""
    ahead = forward or {}
    at = F.struct(*order)
    rest = [c for c in log.columns if c != key]
    pick = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(ahead[c], *order, c))) if c in ahead else F.min_by(c, F.when(F.col(c).isNotNull(), F.struct(*order, c))) if c in first_wins else F.max_by(c, at) if c in always else F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(*order, c)))
    return log.where(F.col(key).isNotNull()).groupBy(key).agg(*(pick(c).alias(c) for c in rest))


def merge_rows(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """old with new merged in: a value of new that is not null wins."""
    n = new.select(F.col(key), *(F.col(c).alias(f"__n_{c}") for c in new.columns if c != key))
    return old.join(n, key, "full").select(key, *(F.coalesce(f"__n_{c}", c).alias(c) for c in old.columns if c != key))


def replace_children(old: DataFrame, new: DataFrame, parent: str) -> DataFrame:
    """old without the rows of any parent that new has rows of, and new."""
    return old.join(new.select(parent).distinct(), parent, "left_anti").unionByName(new)


def append_absent(old: DataFrame, new: DataFrame, key: str, order: list[str]) -> DataFrame:
    """old and those rows of new whose key is not there yet, the first of each; old rows stay as they are."""
    rest = [c for c in new.columns if c != key]
    first = new.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*order, *(c for c in rest if c not in order))).alias("r")).select(key, "r.*")
    return old.unionByName(first.join(old.select(key), key, "left_anti").select(*old.columns))


def sightings(log: DataFrame, keys: list[str], when: str) -> DataFrame:
    """keys, first_seen, last_seen, readings."""
    return log.groupBy(*keys).agg(F.min(when).alias("first_seen"), F.max(when).alias("last_seen"), F.count("*").alias("readings"))


def tombstones(presence: DataFrame, sweeps: DataFrame, key: str) -> DataFrame:
    """key, last_seen, misses, gone_at: after all sweeps. presence: key, sweep_date.

    Finished sweeps without the entity count; after two in a row it is gone from the second; a reappearance resets.
    """
    days = small_side(cut(calendar(sweeps, presence.select("sweep_date"))))
    latest = sweeps.where("finished").agg(F.max("sweep_date")).first()[0]
    last = presence.where(F.col(key).isNotNull()).groupBy(key).agg(F.max("sweep_date").alias("sweep_date")).join(days, "sweep_date")
    misses = F.when(F.col("gone_date").isNotNull(), GONE_AFTER).when(F.col("sweep_date") < F.lit(latest), 1).otherwise(0)
    return last.select(key, F.col("sweep_date").alias("last_seen"), misses.alias("misses"), F.col("gone_date").alias("gone_at"))


def register_upsert(log: DataFrame, passes: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The register after a log of readings: of each key its latest row whole, last_pass, missed, delisted_at.

    log: key, pass_id (null where a stored page was read again), order and columns; passes: pass_id, finished_at of the
    complete passes. A reading in a pass clears misses and delisting; one without a pass leaves both as they were. Each
    complete pass that lacks the key counts, and the second one in a row delists it at its finished_at. Keys that no pass
    has seen count from the first pass on. Rows without key are left out; a pass that is not complete counts as no miss.
    """
    rest = [c for c in log.columns if c not in (key, "pass_id")]
    rows = log.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order, *(c for c in rest if c not in order))).alias("r"), F.max("pass_id").alias("last_pass"))
    ends = passes.groupBy("pass_id").agg(F.max("finished_at").alias("finished_at")).groupBy().agg(F.array_sort(F.collect_list(F.struct("pass_id", "finished_at"))).alias("p"))
    # What is missed after each pass that the log knows, and after none: a table of one row per pass.
    seen = log.select("pass_id").distinct().unionByName(log.sparkSession.createDataFrame([(None,)], log.select("pass_id").schema)).distinct()
    after = seen.crossJoin(F.broadcast(ends)).select(F.col("pass_id").alias("last_pass"), F.filter("p", lambda x: F.col("pass_id").isNull() | (x["pass_id"] > F.col("pass_id"))).alias("a"))
    after = small_side(cut(after.select("last_pass", F.least(F.size("a"), F.lit(GONE_AFTER)).alias("missed"), F.get("a", F.lit(GONE_AFTER - 1))["finished_at"].alias("delisted_at"))))
    joined = rows.join(after.withColumnRenamed("last_pass", "__p"), F.col("last_pass").eqNullSafe(F.col("__p")))
    return joined.select(key, "r.*", "last_pass", "missed", "delisted_at")


def sweep_rows(rows: DataFrame, page: str, key: str, more: str) -> DataFrame:
    """key, page: each key once, on the first page that has it, up to the page where a sweep stops.

    A sweep stops after the first page that brings nothing new or says that no more follow. rows: page, key, more, one per
    record. Rows without key bring nothing.
    """
    first = cut(rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(page).alias(page)))
    fresh = first.groupBy(page).agg(F.count("*").alias("fresh"))
    pages = rows.groupBy(page).agg(F.min(more).alias("more")).join(fresh, page, "left")
    stop = pages.where(F.col("fresh").isNull() | ~F.coalesce("more", F.lit(False))).agg(F.min(page)).first()[0]
    return first if stop is None else first.where(F.col(page) <= F.lit(stop))


def tracked_periods(readings: DataFrame, key: str, when: str, order: list[str], fields: list[str]) -> DataFrame:
    """key, from_date, to_date, fields: a period per unchanged run of ``fields``; the latest reading of a day counts; null while open.

    Windows hold one entity's distinct days.
    """
    day = readings.where(F.col(key).isNotNull() & F.col(when).isNotNull()).groupBy(key, when).agg(F.max(F.struct(*order, F.struct(*fields).alias("v"))).alias("r")).select(key, when, "r.v")
    w = Window.partitionBy(key).orderBy(when)
    changed = day.withColumn("old", F.lag("v").over(w)).where(F.col("old").isNull() | ~F.col("v").eqNullSafe(F.col("old")))
    return changed.select(key, F.col(when).alias("from_date"), F.lead(when).over(w).alias("to_date"), *(F.col(f"v.{f}").alias(f) for f in fields))


def first_and_last(rows: DataFrame, keys: list[str], seen: str) -> DataFrame:
    """keys with first_seen and last_seen (upsert of goods and services)."""
    return rows.groupBy(*keys).agg(F.min(seen).alias("first_seen"), F.max(seen).alias("last_seen"))


def watermark(rows: DataFrame, kind: str, when: str, today: date) -> DataFrame:
    """kind, watermark: the latest date of each kind that is not after today."""
    return rows.where(F.col(when).isNotNull() & (F.col(when) <= F.lit(today.isoformat()))).groupBy(kind).agg(F.max(when).alias("watermark"))


def on_time(rows: DataFrame, marks: DataFrame, kind: str, when: Column, days: int = LOOK_BACK_DAYS) -> DataFrame:
    """rows with ``late``: dated more than ``days`` before their kind's watermark, to be taken by a full pass."""
    return rows.join(small_side(marks), kind, "left").withColumn("late", F.coalesce(F.date_diff(F.to_date("watermark"), when) > days, F.lit(False))).drop("watermark")


def orphans(entities: DataFrame, seen: DataFrame, key: str, final_states: list[str]) -> DataFrame:
    """Entities in no final state that were listed once and are listed nowhere now. seen: key, gone_at. A null state is no state and is left out."""
    live = seen.where("gone_at is null").select(key)
    return entities.where(~F.col("state").isin(final_states)).join(seen.select(key), key, "left_semi").join(live, key, "left_anti")


def work_queue(entities: DataFrame, listed: DataFrame, done: DataFrame, dead: DataFrame, key: str, states: list[str], again: str) -> DataFrame:
    """key, state, priority: listed entities of ``states`` not done yet, or done before they came to state ``again``, without dead letters; priority 0 for ``again``. done: key, state; listed, dead: key."""
    last = done.groupBy(key).agg(F.max((F.coalesce("state", F.lit("")) == again).cast("int")).alias("done"))
    open_ = entities.where(F.col("state").isin(states)).join(listed.select(key), key, "left_semi").join(dead.select(key), key, "left_anti").join(last, key, "left")
    todo = F.col("done").isNull() | ((F.col("state") == again) & (F.col("done") == 0))
    return open_.where(todo).withColumn("priority", F.when(F.col("state") == again, 0).otherwise(1)).drop("done")


def dead_letters(failures: DataFrame) -> DataFrame:
    """kind, ref, attempts, error (the latest), failed_at, given_up. failures: kind, ref, error, failed_at."""
    f = failures.groupBy("kind", "ref").agg(F.count("*").alias("attempts"), F.max(F.struct("failed_at", "error")).alias("l"))
    limit = F.when(F.col("kind").startswith("missing:"), MOST_MISSING).otherwise(MOST_ATTEMPTS)
    return f.select("kind", "ref", "attempts", "l.error", "l.failed_at", (F.col("attempts") >= limit).alias("given_up"))


def scoped_replace(old: DataFrame, new: DataFrame, scope: list[str]) -> DataFrame:
    """old without the scopes that new touches, and new (dynamic partition overwrite)."""
    return replace_children(old.withColumn("__s", F.struct(*scope)), new.withColumn("__s", F.struct(*scope)), "__s").drop("__s")


def add_missing_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Schema migration: absent columns come in as nulls of their type."""
    return df.select("*", *(F.lit(None).cast(t).alias(c) for c, t in columns.items() if c not in df.columns))


def run_summary(runs: DataFrame) -> DataFrame:
    """command, runs, last_finished, pages: of a run log (command, finished_at, pages)."""
    return runs.groupBy("command").agg(F.count("*").alias("runs"), F.max("finished_at").alias("last_finished"), F.sum("pages").alias("pages"))


def days_since_last_run(runs: DataFrame, now: datetime, command: str | None = None, exclude: int | None = None) -> DataFrame:
    """One row, days: since the latest start of a run of the command (of any, without one), at least 0; 1.0 if none is known. runs: run_id, command, started_at."""
    known = runs.where(F.col("started_at").isNotNull())
    known = known if command is None else known.where(F.col("command") == command)
    known = known if exclude is None else known.where(F.col("run_id") != exclude)
    gap = (F.unix_micros(F.lit(now).cast("timestamp")) - F.unix_micros(F.max(F.try_to_timestamp(F.col("started_at").cast("string"))))) / 86_400_000_000
    return known.agg(F.greatest(F.coalesce(gap, F.lit(1.0)), F.lit(0.0)).alias("days"))


def migrate(tables: dict[str, DataFrame], have: int, steps: dict[int, dict[str, tuple[dict[str, str], dict[str, Column]]]]) -> tuple[dict[str, DataFrame], int]:
    """The tables brought from version ``have`` to the latest of steps, and that version. steps: version -> table -> (columns to add with their types, columns to compute anew); a table that is not there is left out; running it again changes nothing."""
    for version in sorted(v for v in steps if v > have):
        for name, (added, computed) in steps[version].items():
            if name in tables:
                tables = tables | {name: add_missing_columns(tables[name], added).withColumns(computed)}
        have = version
    return tables, have


def slice_pages(last_page: int, gap_days: float, period_days: float, floor: int) -> int:
    """Pages of a rolling pass that keeps a full pass within ``period_days``."""
    return min(last_page, max(floor, ceil(last_page * min(1.0, gap_days / period_days)))) if last_page else floor
