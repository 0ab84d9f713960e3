"""Attribute rows into one typed row per entity, by column-block pivoting.

The input is read once. Its rows are reduced to one cell per (entity, attribute), the latest, with map-side combine, so
that a hot entity is spread over its attributes; only then the cells are laid out by entity. The attributes are divided
into blocks; the cells stand in one table, a partition per block, all with the same buckets of the entity. Each block is
read and pivoted alone, and the blocks are joined from a spine of the entities where they lie: after the layout no row is
shuffled again, however many blocks there are. Beyond JOINED blocks they are joined in groups, so that the memory of a task
does not grow with the blocks.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweir.functions.timestamps import ascii_digits
from tallyweir.session import scratch

BLANK = "(?U)^\\s+|\\s+$"
#: fixed values: the option numbers of the certificate status
STATUS_CODES = {"valid": 100000002, "expired": 100000003, "under review": 100000005, "suspended": 100000007, "withdrawn": 100000009}
#: blocks joined in one stage at most; more are joined in groups, each laid out in the same buckets
JOINED = 8
YES, NO = ["true", "1", "yes", "نعم"], ["false", "0", "no", "لا"]


@dataclass(frozen=True)
class Attribute:
    """name: the attribute's name in lower case; out: its column; kind: text, number, option or flag; scale: for numbers."""

    name: str
    out: str
    kind: str = "text"
    scale: int = 1
    labels: dict = field(default_factory=dict)

    @property
    def default(self) -> Column:
        return F.lit("") if self.kind == "text" else F.lit(-1).cast("bigint")


ACCOUNT = [
    Attribute("name", "name"), Attribute("icv_commercialregistrationnumber", "cr_number"), Attribute("icv_mainactivity", "industry"), Attribute("icv_totalscore", "score_x100", "number", 100),
    Attribute("cert.statuscode", "status_code", "option", labels=STATUS_CODES), Attribute("icv_latestcertificate", "certificate_no"), Attribute("icv_ismanufacturer", "manufacturer", "flag"),
]


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.regexp_replace(c, BLANK, ""), F.lit(""))


def label(c: Column) -> Column:
    """The text of a value: trimmed; of a lookup its Name, of an option set its Value; null if blank."""
    t = blank_to_null(c)
    named = F.coalesce(F.get_json_object(t, "$.Name"), F.get_json_object(t, "$.Value"))
    return F.when(t.startswith("{"), blank_to_null(named)).otherwise(t)


def typed(text: Column, a: Attribute) -> Column:
    """The label as text or bigint; null if it can't be read as the attribute's kind."""
    if a.kind == "text":
        return text
    plain = F.lower(ascii_digits(text))
    if a.kind == "flag":
        return F.when(plain.isin(YES), 1).when(plain.isin(NO), 0).cast("bigint")
    if a.kind == "option":
        by_label = F.create_map(*(F.lit(x) for kv in a.labels.items() for x in kv)) if a.labels else None
        number = plain.try_cast("bigint")
        return F.coalesce(number, by_label[F.regexp_replace(plain, r"(?U)\s+", " ")].cast("bigint")) if by_label is not None else number
    number = F.regexp_replace(F.translate(plain, "٫", "."), r"[\s,٬%]", "")
    return F.round(number.try_cast("double") * a.scale).cast("bigint")


def _cells(rows: DataFrame, entity: str, read_at: str, name: str, values: list[str], attributes: list[Attribute], block_size: int) -> DataFrame:
    """e, n, block, t (the entity's latest read of n), x (the greatest value of that read). Rows of no wanted attribute stand as n = '' in block -1: they tell when the entity was last read."""
    named = F.lower(F.regexp_replace(F.col(f"`{name}`"), BLANK, ""))
    block_of = text_map({a.name: i // block_size for i, a in enumerate(attributes)})
    base = rows.where(F.col(f"`{entity}`").isNotNull()).select(F.col(f"`{entity}`").alias("e"), F.col(f"`{read_at}`").alias("t"), named.alias("n"), *(F.col(f"`{v}`").alias(f"v{i}") for i, v in enumerate(values)))
    text = F.coalesce(*(label(F.col(f"v{i}")) for i in range(len(values))))
    wanted = base.withColumn("block", F.coalesce(block_of[F.col("n")], F.lit(-1)))
    own = F.col("block") >= 0
    cells = wanted.select("e", F.when(own, F.col("n")).otherwise("").alias("n"), "block", "t", F.when(own, text).alias("x"))
    return cells.groupBy("e", "block", "n").agg(F.max(F.struct("t", "x")).alias("c")).select("e", "n", "block", "c.t", "c.x")


def text_map(d: dict[str, int]) -> Column:
    """A constant map; written as one literal, so that thousands of names are planned at once."""
    return F.from_json(F.lit(json.dumps(d, ensure_ascii=False)), "map<string,int>") if d else F.lit(None).cast("map<string,int>")


def widen(rows: DataFrame, entity: str, read_at: str, name: str, values: list[str], attributes: list[Attribute], block_size: int = 64, buckets: int | None = None) -> DataFrame:
    """One row per entity with a typed column per attribute, from the entity's latest ``read_at`` alone.

    Names compare without case and outer blanks; of ``values`` the first that is neither null nor blank counts; of a
    repeated attribute in the latest read the greatest non-blank one. Absent, blank or unreadable gives '' for text and -1
    for numbers. A null read_at is older than any other. Rows without entity are left out; an entity whose rows hold none
    of the attributes still gets its row. Empty tables give no rows; other columns are ignored. With more than one block
    the cells are written once, in ``buckets`` buckets (spark.sql.shuffle.partitions by default).
    """
    spark = rows.sparkSession
    blocks = [attributes[i : i + block_size] for i in range(0, len(attributes), block_size)]
    cells = _cells(rows, entity, read_at, name, values, attributes, block_size)
    pick = lambda a: F.max(F.when(F.col("n") == a.name, F.struct("t", "x"))).alias(a.out)
    if len(blocks) <= 1:  # the one block and the spine are one pivot
        wide = cells.repartition("e").groupBy("e").agg(F.max("t").alias("__last"), *map(pick, attributes))
    else:
        n = min(100_000, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))  # no table takes more buckets
        cells = laid_out(cells.repartition(n, "e"), n, ["block"])
        frames = [cells.where(F.col("block") == b).groupBy("e").agg(*map(pick, block)) for b, block in enumerate(blocks)]
        names = cells.groupBy("e").agg(F.max("t").alias("__last"))
        joined = lambda fs: reduce(lambda x, y: x.join(y, "e", "left"), fs, names)
        while len(frames) > JOINED:  # a task sorts every block it joins, so it joins a bounded number at once
            frames = [laid_out(joined(frames[i : i + JOINED]).drop("__last"), n) for i in range(0, len(frames), JOINED)]
        wide = joined(frames)
    cell = lambda a: F.coalesce(typed(F.when(F.col(f"`{a.out}`.t").eqNullSafe(F.col("__last")), F.col(f"`{a.out}`.x")), a), a.default).alias(a.out)
    return wide.select(F.col("e").alias(entity), *map(cell, attributes))


def laid_out(df: DataFrame, buckets: int, parts: list[str] = []) -> DataFrame:
    """df, which is partitioned by e, as a table in the shared folder with that many buckets of e."""
    path = scratch(df.sparkSession, "cells")
    at = "cells_" + path.rsplit("-", 1)[1]
    df.write.partitionBy(*parts).bucketBy(buckets, "e").sortBy("e").option("path", path).saveAsTable(at)
    return df.sparkSession.table(at)


def account_rows(attributes: DataFrame, block_size: int = 64) -> DataFrame:
    """The typed row of each account record."""
    return widen(attributes.where("entity_name = 'account'"), "record_id", "read_at", "attr_name", ["attr_value", "display_value", "formatted_value"], ACCOUNT, block_size)
