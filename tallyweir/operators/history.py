"""Periods of unchanged state from periodic snapshots, by tree-reduction coalescing.

Each reading is an interval of one snapshot. Intervals of an entity are grouped in blocks of 1, 2, 4 ... neighbouring
snapshots; a round merges two neighbouring blocks, where only the last run of the left and the first of the right can
become one. Runs that have become final inside a block are never looked at again, so a round is linear in its runs.
Rounds within a tile of ``2**tile_bits`` snapshots share one exchange on (entity, tile), so a hot entity is spread over its
tiles; each further level of tiles takes one exchange of already coalesced runs.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweir.session import cut, small_side

BLANK = "(?U)^\\s+|\\s+$"


def canonical_id(c: Column) -> Column:
    """Lower case, no braces, no outer blanks."""
    return F.lower(F.regexp_replace(F.regexp_replace(c, BLANK, ""), r"^\{|\}$", ""))


def canonical_value(c: Column) -> Column:
    """Outer blanks and case do not count; '' equals null."""
    return F.nullif(F.lower(F.regexp_replace(c, BLANK, "")), F.lit(""))


def calendar(sweeps: DataFrame, dates: DataFrame) -> DataFrame:
    """sweep_date, pos (1, 2, ...), gone_pos, gone_date (of the second finished sweep after it). One row per sweep date.

    ``dates`` (sweep_date) adds dates that only the readings know, as unfinished sweeps. The window without partition sees
    one row per sweep, never readings.
    """
    days = sweeps.select("sweep_date", F.coalesce("finished", F.lit(False)).alias("finished")).unionByName(dates.distinct().withColumn("finished", F.lit(False)))
    days = days.where(F.col("sweep_date").isNotNull()).groupBy("sweep_date").agg(F.max("finished").alias("finished"))
    order = "array_sort(collect_list(struct(sweep_date, finished)))"
    all_days = days.groupBy().agg(F.expr(order).alias("s"))
    ends = F.expr("transform(s, (x, i) -> get(filter(transform(s, (y, j) -> if(y.finished and j > i, struct(j + 1 as pos, y.sweep_date as d), null)), z -> z is not null), 1))")
    return all_days.select("s", ends.alias("e")).select(F.posexplode(F.arrays_zip("s", "e"))).select(F.col("col.s.sweep_date").alias("sweep_date"), (F.col("pos") + 1).cast("int").alias("pos"), F.col("col.e.pos").cast("int").alias("gone_pos"), F.col("col.e.d").alias("gone_date"))


def _merge(left: Column, right: Column, same: str) -> Column:
    """Two run lists as one; the runs at the seam become one if nothing changed and the entity was not gone between them."""
    a, b = F.element_at(left, -1), F.get(right, F.lit(0))
    joined = F.struct(a["first"].alias("first"), a["from_date"].alias("from_date"), b["last"].alias("last"), b["gone_pos"].alias("gone_pos"), b["gone_date"].alias("gone_date"), a[same].alias(same))
    one = a[same].eqNullSafe(b[same]) & (a["gone_pos"].isNull() | (b["first"] <= a["gone_pos"]))
    both = F.when(one, F.concat(F.slice(left, F.lit(1), F.size(left) - 1), F.array(joined), F.slice(right, F.lit(2), F.size(right)))).otherwise(F.concat(left, right))
    return F.when(left.isNull(), right).when(right.isNull(), left).otherwise(both)


def coalesce_runs(units: DataFrame, key: str, snapshots: int, tile_bits: int = 6) -> DataFrame:
    """key, runs: the maximal runs of each entity in order. units: key, pos (unique in key, from 1), from_date, gone_pos, gone_date, payload."""
    run = F.array(F.struct(F.col("pos").alias("first"), F.col("from_date"), F.col("pos").alias("last"), F.col("gone_pos"), F.col("gone_date"), F.col("payload")))
    blocks = units.select(key, F.shiftright(F.col("pos") - 1, tile_bits).alias("tile"), (F.col("pos") - 1).alias("block"), run.alias("runs"))
    rounds = max(1, ceil(log2(max(2, snapshots))))
    at_tile = 0
    for r in range(rounds):
        if r and r % tile_bits == 0:
            at_tile = r
            blocks = blocks.withColumn("tile", F.shiftright("tile", tile_bits))
        if r == at_tile:
            blocks = blocks.repartition(key, "tile")  # the one exchange of this level; the rounds below keep to it
        side = lambda odd: F.first(F.when(F.col("block").bitwiseAND(1) == odd, F.col("runs")), ignorenulls=True)
        blocks = blocks.groupBy(key, "tile", F.shiftright("block", 1).alias("block")).agg(side(0).alias("l"), side(1).alias("r"))
        blocks = blocks.select(key, "tile", "block", _merge(F.col("l"), F.col("r"), "payload").alias("runs"))
    return blocks.select(key, "runs")


def status_periods(readings: DataFrame, sweeps: DataFrame, tile_bits: int = 6) -> DataFrame:
    """id, from_date, to_date: periods of unchanged (status, certificate_no) of each listed entity.

    Values compare without outer blanks and case, '' equals null; of several readings of an entity on one sweep the latest
    read_at counts (then the greater values); a period ends with the reading that differs, or with the second finished
    sweep in a row that lacks the entity; '' while it is open. An absence from an unfinished sweep is none; readings on a
    date without a sweep count as those of an unfinished one. Rows without id or sweep_date belong to no entity and give
    nothing; empty tables give no rows; other columns are ignored.
    """
    rows = readings.select(canonical_id(F.col("id")).alias("id"), "sweep_date", F.struct("read_at", canonical_value(F.col("status")).alias("status"), canonical_value(F.col("certificate_no")).alias("certificate_no")).alias("r")).where("id <> '' and sweep_date is not null")
    rows = rows.groupBy("id", "sweep_date").agg(F.max("r").alias("r"))
    days = cut(calendar(sweeps, readings.select("sweep_date")))  # one row per sweep, read thrice
    snapshots = days.count()
    units = rows.join(small_side(days), "sweep_date").select("id", "pos", F.col("sweep_date").alias("from_date"), "gone_pos", "gone_date", F.struct("r.status", "r.certificate_no").alias("payload"))
    runs = coalesce_runs(units, "id", snapshots, tile_bits)
    # Each run meets its neighbour inside the array: what is exploded are finished periods, not copies of the array.
    gone = lambda run, after: run["gone_pos"].isNotNull() & (after.isNull() | (after["first"] > run["gone_pos"]))
    ends = lambda run, after: F.when(gone(run, after), run["gone_date"]).when(after.isNotNull(), after["from_date"]).otherwise("")
    zipped = F.transform("runs", lambda run, i: F.struct(run["from_date"].alias("from_date"), ends(run, F.get("runs", i + 1)).alias("to_date")))
    return runs.select("id", F.explode(zipped).alias("p")).select("id", "p.from_date", "p.to_date")
