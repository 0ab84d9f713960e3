"""Totals over trailing days of each entity, days without activity included.

Daily totals are aggregated first. Days are cut into tiles; a day's total goes to its own tile and, as halo, to the next
tiles it reaches into. Each (block of entities, tile) is one dense int64 matrix of entities by days, multiplied by a banded
0/1 operator per window length. A task holds ``entities_per_block * (tile_days + halo)`` numbers, however hot an entity is.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date, timedelta

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweir.functions.timestamps import Candidate, normalise

EPOCH = date(1970, 1, 1)
#: the greatest total a bigint holds
SAFE = 2**63 - 1


def whole(total: Column) -> Column:
    """A total as bigint; an error, never another number, where it does not fit."""
    fits = total.isNotNull() & (F.abs(total) <= F.lit(SAFE))
    return F.when(fits, total.cast("bigint")).otherwise(F.raise_error(F.lit("the total of a day is beyond a bigint")).cast("bigint"))



def banded(days: int, halo: int, window: int) -> np.ndarray:
    """(halo + days) x days; column j sums the ``window`` days that end with day j of the tile."""
    rows, cols = np.arange(halo + days)[:, None], np.arange(days)[None, :] + halo
    return ((rows <= cols) & (rows > cols - window)).astype(np.int64)


def rolling_totals(daily: DataFrame, entities: DataFrame, first: date, last: date, windows: tuple[int, ...] = (7, 30), tile_days: int = 32, entities_per_block: int = 512) -> DataFrame:
    """entity, day (yyyy-mm-dd), total_w and avg_w (floor of total / w) of each window, for every entity and day of [first, last].

    daily: entity, day (days since 1970), total (whole numbers, bigint or decimal), one row per entity and day; entities: entity, distinct. Windows end
    with and include the day. Days of entities that are not in ``entities`` are ignored. A daily or trailing total that a
    bigint can't hold raises an error; none is left out or wrapped.
    """
    halo = max(windows) - 1
    start, end = (first - EPOCH).days, (last - EPOCH).days
    tiles = (end - start) // tile_days + 1
    blocks = max(1, -(-entities.count() // entities_per_block))
    block = F.pmod(F.xxhash64("entity"), F.lit(blocks)).cast("int").alias("block")
    kept = daily.where(F.col("day").between(start - halo, end)).join(entities, "entity", "left_semi").withColumn("total", whole(F.col("total")))
    low = F.greatest(F.lit(0), F.floor((F.col("day") - start) / tile_days)).cast("int")
    high = F.least(F.lit(tiles - 1), F.floor((F.col("day") - start + halo) / tile_days)).cast("int")
    facts = kept.select("entity", block, F.explode(F.sequence(low, high)).alias("tile"), F.col("day").cast("int").alias("day"), "total")
    spread = max(1, min(blocks * tiles, max(int(daily.sparkSession.conf.get("spark.sql.shuffle.partitions")), daily.sparkSession.sparkContext.defaultParallelism)))
    every = entities.select("entity", block, F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("tile"), F.lit(None).cast("int").alias("day"), F.lit(0).cast("bigint").alias("total"))
    ops = {w: banded(tile_days, halo, w) for w in windows}

    def tile_of(key: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches), ignore_index=True)  # at most entities_per_block x (tile + halo) rows, on average
        at, names = pd.factorize(rows["entity"])
        base = start + int(key[1]) * tile_days
        dense = np.zeros((len(names), halo + tile_days), dtype=np.int64)
        real = rows["day"].notna().to_numpy()
        np.add.at(dense, (at[real], rows["day"].to_numpy()[real].astype(np.int64) - base + halo), rows["total"].to_numpy()[real].astype(np.int64))
        n = min(tile_days, end - base + 1)
        if len(dense) and max(dense.max(), -dense.min()) > SAFE // max(ops):
            dense = dense.astype(object)  # sums that may leave int64 are taken exactly
        out = {"entity": np.repeat(names, n), "day": np.tile([str(EPOCH + timedelta(base + i)) for i in range(n)], len(names))}
        for w, op in ops.items():
            total = (dense @ op)[:, :n].ravel()
            if dense.dtype == object and len(total) and max(total.max(), -total.min()) > SAFE:
                raise OverflowError(f"a total of {w} days is beyond a bigint")
            out |= {f"total_{w}": total, f"avg_{w}": total // w}
        yield pd.DataFrame(out)

    schema = "entity string, day string, " + ", ".join(f"total_{w} bigint, avg_{w} bigint" for w in windows)
    # The result is many times the input: the number of tasks is set by the tiles, not by the bytes that are shuffled.
    return facts.unionByName(every).repartition(spread, "block", "tile").groupBy("block", "tile").applyInPandas(tile_of, schema)


def daily_awards(tender: DataFrame, tender_company: DataFrame, register: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entity, day, total in hundredths) of the awards of each register company, and its distinct entities with at least one.

    An award is the latest row (parsed_at, then the greater row) of a tender with readable date and amount, once for each
    cr_root among its awarded rows. Amounts that are null, NaN or infinite and dates that can't be read make no award. Totals
    are decimals, so that no amount is too large to be added.
    """
    latest = tender.where("tender_id is not null").groupBy("tender_id").agg(F.max(F.struct("parsed_at", "awarded_date", "awarded_amount")).alias("t")).select("tender_id", "t.awarded_date", "t.awarded_amount")
    sound = latest.where("awarded_amount is not null and not isnan(awarded_amount) and abs(awarded_amount) < double('infinity')")
    # Beyond 1e35 an amount stands for "more than any total holds": it still overflows, and so is an error where it counts.
    cents = F.least(F.greatest(F.round(F.col("awarded_amount") * 100), F.lit(-1e37)), F.lit(1e37)).cast("decimal(38,0)")
    dated = normalise(sound, [Candidate("awarded_date")], out="ms").where("ms is not null")
    roots = register.where("cr_root is not null").select("cr_root").distinct()
    won = tender_company.where("role = 'awarded' and cr_root is not null").select("tender_id", "cr_root").join(roots, "cr_root", "left_semi").distinct()
    daily = won.join(dated, "tender_id").groupBy(F.col("cr_root").alias("entity"), F.floor(F.col("ms") / 86_400_000).alias("day")).agg(F.try_sum(cents).alias("total"))
    return daily, daily.select("entity").distinct()


def trailing_awards(tender: DataFrame, tender_company: DataFrame, register: DataFrame, first: date, last: date) -> DataFrame:
    """cr_root, day, total_7, avg_7, total_30, avg_30 of each register company with an award, for every day of [first, last]."""
    from tallyweir.session import cut

    daily, _ = daily_awards(tender, tender_company, register)
    daily = cut(daily)
    return rolling_totals(daily, daily.select("entity").distinct(), first, last).withColumnRenamed("entity", "cr_root")
