"""What changed between consecutive full snapshots, by Merkle trees over hash ranges of the keys.

The input is read once. Its canonical rows are written as a table sorted by the hash of the key, so a hash range lies
together in every file. A range's digest is the xor of its rows' 64-bit hashes under two seeds, and its count; the ranges
are as fine as the greatest snapshot asks for (about ``per_leaf`` rows each), so that few changes leave most ranges alone
at any size. A pair of snapshots is compared from the root down, children only below nodes that differ. Only the ranges
that differ are read from the table again, and only once: a row meets its neighbour in time by one window.
"""

from __future__ import annotations

from functools import reduce
from math import ceil, log2

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyweir.operators.history import canonical_id
from tallyweir.session import cut, small_side, written

#: bits of the hash a level of the tree takes; levels at most; levels gone down at once, where the tree is deep
BITS, DEEPEST, STRIDE = 4, 15, 2
FIELDS = ["name", "cr_number", "industry", "misses"]


def _blanks(c):
    return F.lower(F.regexp_replace(F.regexp_replace(c, r"(?U)\s+", " "), "^ | $", ""))


def canonical_snapshots(company: DataFrame, sweeps: DataFrame) -> DataFrame:
    """at (upper 60 bits of the id's hash), snapshot_date, id, live, name, cr_number, industry, misses, h1, h2: the row that counts of each id in each finished snapshot, live or not."""
    finished = small_side(sweeps.where("finished and sweep_date is not null").select(F.col("sweep_date").alias("snapshot_date")).distinct())
    fields = [_blanks(F.col("name")).alias("name"), F.nullif("cr_number", F.lit("")).alias("cr_number"), "industry", "misses"]
    rows = company.select("snapshot_date", canonical_id(F.col("id")).alias("id"), F.struct("loaded_at", F.col("gone_at").isNull().alias("live"), *fields).alias("r")).join(finished, "snapshot_date", "left_semi")
    latest = rows.groupBy("snapshot_date", "id").agg(F.max("r").alias("r")).select("snapshot_date", "id", "r.live", "r.name", "r.cr_number", "r.industry", "r.misses")
    packed = F.to_json(F.struct("id", *FIELDS))
    return latest.select(F.shiftrightunsigned(F.xxhash64("id"), 64 - BITS * DEEPEST).alias("at"), "*", F.xxhash64(packed).alias("h1"), F.xxhash64(F.lit(7), packed).alias("h2"))


def numbered_snapshots(dates: DataFrame) -> DataFrame:
    """pos, snapshot_date, in order, also of snapshots without a live row. dates: snapshot_date."""
    return dates.groupBy().agg(F.array_sort(F.collect_set("snapshot_date")).alias("s")).select(F.posexplode("s").alias("pos", "snapshot_date"))


def node(depth: int, of: int = DEEPEST):
    """The node of a row's ``at`` (or of a node of depth ``of``) at ``depth``."""
    return lambda c: F.shiftright(c, BITS * (of - depth))


def differing_leaves(leaves: DataFrame, last: int, depth: int) -> DataFrame:
    """pair, leaf: the hash ranges in which snapshot ``pair`` differs from the one before. leaves: pos, leaf, h1, h2, n (the digests)."""
    # A leaf of a snapshot counts for it in its own pair and against it in the next; equal digests cancel out.
    sides = leaves.select(F.explode(F.array(F.struct(F.col("pos").alias("pair"), F.col("n").alias("n")), F.struct((F.col("pos") + 1).alias("pair"), (-F.col("n")).alias("n")))).alias("p"), "leaf", "h1", "h2")
    sides = sides.select("p.pair", "leaf", "h1", "h2", "p.n").where(F.col("pair").between(1, last))
    known = None
    for level in range(0, depth + 1, STRIDE) if depth % STRIDE == 0 else [*range(0, depth, STRIDE), depth]:
        below = sides if known is None else sides.withColumn("node", node(held, depth)(F.col("leaf"))).join(known, ["pair", "node"], "left_semi")
        known = below.groupBy("pair", node(level, depth)(F.col("leaf")).alias("node")).agg(F.bit_xor("h1").alias("x1"), F.bit_xor("h2").alias("x2"), F.sum("n").alias("d")).where("x1 <> 0 or x2 <> 0 or d <> 0").select("pair", "node")
        held = level
    return known.withColumnRenamed("node", "leaf")


def snapshot_changes(company: DataFrame, sweeps: DataFrame, depth: int | None = None, per_leaf: int = 16) -> DataFrame:
    """snapshot_date, id, change (added, removed or changed) for every two consecutive snapshots of finished sweeps.

    Of several rows of an id in a snapshot the latest loaded_at counts (then the greater row); live is a null gone_at;
    changed is another name (case and extra blanks aside), cr_number ('' equals null), industry or misses. Null values are
    equal to each other. Rows without id are left out, but their snapshot is one; fewer than two snapshots give no rows.
    Other columns are ignored. The tree is ``depth`` levels deep, by default as many as leave about ``per_leaf`` rows to a leaf.
    """
    canonical = written(canonical_snapshots(company, sweeps), "snapshots", ["at"])
    counts = cut(canonical.groupBy("snapshot_date").agg(F.count("*").alias("n")))  # one row per snapshot
    numbered = cut(numbered_snapshots(counts))
    last, most = (x or 0 for x in numbered.crossJoin(counts.agg(F.max("n").alias("n"))).agg(F.max("pos"), F.max("n")).first())
    if depth is None:
        depth = min(DEEPEST, max(1, ceil(log2(max(2, most / per_leaf)) / BITS)))
    leaf = node(depth)(F.col("at"))
    live = canonical.where("live and id <> ''").join(small_side(numbered), "snapshot_date")
    digests = cut(live.groupBy("pos", leaf.alias("leaf")).agg(F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2"), F.count("*").alias("n")))
    differ = cut(differing_leaves(digests, last, depth).groupBy("leaf").agg(F.collect_set("pair").alias("pairs")))  # at most one entry per snapshot
    # The ranges that differ, as intervals of the upper levels: the reader leaves the row groups between them out.
    upper = min(depth, 2)
    nodes = sorted(r[0] for r in differ.select(node(upper, depth)(F.col("leaf"))).distinct().collect())  # at most 256
    low, high = (lambda k: k << BITS * (DEEPEST - upper)), (lambda k: (k + 1 << BITS * (DEEPEST - upper)) - 1)
    at = reduce(lambda x, y: x | y, (F.col("at").between(low(a), high(b)) for a, b in _intervals(nodes)), F.lit(False))
    rows = live.where(at).select("pos", leaf.alias("leaf"), "id", *FIELDS).join(differ, "leaf")
    rows = rows.withColumn("as_new", F.array_contains("pairs", F.col("pos"))).withColumn("as_old", F.array_contains("pairs", F.col("pos") + 1)).where("as_new or as_old")
    by_id = Window.partitionBy("leaf", "id").orderBy("pos")  # an id has one row in a snapshot
    v = F.struct("pos", F.struct(*FIELDS).alias("v"))
    met = rows.select("pos", "leaf", "id", "as_new", "as_old", F.struct(*FIELDS).alias("v"), F.lag(v).over(by_id).alias("before"), F.lead("pos").over(by_id).alias("after"))
    known = F.col("before.pos").eqNullSafe(F.col("pos") - 1)
    now = F.when(F.col("as_new") & (F.col("pos") >= 1), F.when(~known, "added").when(~F.col("v").eqNullSafe(F.col("before.v")), "changed"))
    gone = F.when(F.col("as_old") & (F.col("pos") < last) & ~F.col("after").eqNullSafe(F.col("pos") + 1), "removed")
    found = met.select("id", F.explode(F.array(F.struct(F.col("pos").alias("pos"), now.alias("change")), F.struct((F.col("pos") + 1).alias("pos"), gone.alias("change")))).alias("c")).where("c.change is not null")
    return found.select("id", "c.pos", "c.change").join(small_side(numbered), "pos").select("snapshot_date", "id", "change")


def _intervals(nodes: list[int]) -> list[tuple[int, int]]:
    """Neighbouring nodes as one interval."""
    out: list[tuple[int, int]] = []
    for k in nodes:
        if out and out[-1][1] == k - 1:
            out[-1] = (out[-1][0], k)
        else:
            out.append((k, k))
    return out
