"""All pairs of similar strings under a common key, compared block by block in numpy.

A key's strings are dealt into blocks of ``side`` at most, and each block of one side meets each of the other in a group of
its own, so a key that a tenth of all strings hold is spread over tasks; small keys share groups, whose pairs are compared all
at once. Inside a group most pairs go by one 64-bit word per string: bits tell whether a letter occurs so many times, and no
two strings differ in more bits than they have letters outside their longest common subsequence. Where a key has many pairs,
strings are put into cells by how many letters of three groups of letters they have, and cells that differ in more letters
never meet. Another word of bits tells which letters stand side by side. The others get that subsequence, bit-parallel for many pairs at once. Nothing is left out: the result is that of
all pairs.
"""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal
from math import floor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweir.functions.similarity import plain_ratio
from tallyweir.session import among, cut, written

#: Strings of a group of small keys; pairs that are looked at in one step; keys so few that their sizes are broadcast.
GROUP_ROWS, STEP, FEW_KEYS = 20_000, 1 << 17, 2_000
#: Strings longer than a machine word are compared one by one. More pairs than MANY_PAIRS under a key are sought by cells of CELLS groups of letters.
LONGEST, MANY_PAIRS, CELLS = 64, 1 << 20, 3
#: Words that are ruled out by strings: so many are looked up in a table, more are searched.
MOST_HELD = 1 << 24


def room(n: int, m: int, least: float) -> int:
    """Letters that two strings of n and m may have outside their common subsequence at ratio ``least``; -1 where no such ratio is possible."""
    return floor((n + m) * (1 - least) + 1e-9) if n and m and 2 * min(n, m) >= (n + m) * least - 1e-9 else -1


def rounded(score: float) -> float:
    """To three places, halves up, as Spark's round."""
    return float(Decimal(repr(score)).quantize(Decimal("0.001"), ROUND_HALF_UP))


def _all_rounded() -> np.ndarray:
    """By both lengths' sum and the common length: strings of at most LONGEST letters have few ratios."""
    out = np.zeros((2 * LONGEST + 1, LONGEST + 1))
    for total in range(1, 2 * LONGEST + 1):
        for common in range(min(total // 2, LONGEST) + 1):
            out[total, common] = rounded(2 * common / total)
    return out


def _one_by_one(a: list[str], b: list[str], ia, ib, least: float) -> list[tuple[int, int, float]]:
    possible = ((i, j) for i in ia for j in ib if room(len(a[i]), len(b[j]), least) >= 0)
    return [(i, j, rounded(s)) for i, j in possible if (s := 1.0 if a[i] == b[j] else plain_ratio(a[i], b[j])) >= least]


def _bits(counts: np.ndarray) -> list[tuple[int, int]]:
    """The 64 (letter, times) that tell most: those nearest to half of the strings have the letter so many times."""
    share = np.stack([(counts >= t).mean(0) for t in range(1, 9)], 1)
    most = np.argsort(-(share * (1 - share)), axis=None, kind="stable")[:64]
    return [(int(k) // 8, int(k) % 8 + 1) for k in most]


def _coded(strings: list[list[str]]) -> tuple[list[np.ndarray], list[np.ndarray], int]:
    """Letters as small numbers (0 behind the end) and how often each occurs, by string; the number of letters."""
    letters = [np.array(x).view(np.uint32).reshape(len(x), -1) for x in strings]
    there = np.zeros(max(int(x.max()) for x in letters) + 1, bool)
    for x in letters:
        there[x] = True
    there[0] = True  # what is behind the end
    size, number = int(there.sum()), (np.cumsum(there) - 1).astype(np.int32)
    codes = [number[x] for x in letters]
    counts = [np.bincount((np.arange(len(x))[:, None] * size + x).ravel(), minlength=len(x) * size).reshape(len(x), size).astype(np.uint8) for x in codes]
    for x in counts:
        x[:, 0] = 0
    return codes, counts, size


def _grams(codes: np.ndarray) -> np.ndarray:
    """64 bits by string that tell which pairs of neighbouring letters it has, each odd or even times: a letter put in or left out changes at most three."""
    out = np.zeros(len(codes), np.uint64)
    for k in range(codes.shape[1] - 1):
        x, y = codes[:, k], codes[:, k + 1]
        out ^= (y != 0).astype(np.uint64) << ((13 * x + 37 * y) & 63).astype(np.uint64)
    return out


def _cells(counts: np.ndarray) -> np.ndarray:
    """How many letters of each of CELLS groups a string has; the groups vary alike."""
    groups = np.argsort(-counts.var(0), kind="stable")
    return np.stack([counts[:, groups[k :: 2 * CELLS]].sum(1, dtype=np.int64) + counts[:, groups[2 * CELLS - 1 - k :: 2 * CELLS]].sum(1, dtype=np.int64) for k in range(CELLS)], 1)


def _listed(rows: np.ndarray, lo: np.ndarray, hi: np.ndarray, bits, lengths, rooms):
    """Pairs of a row with all from its lo to its hi that letters allow, in pieces."""
    upto = np.cumsum(hi - lo)
    first = 0
    while first < len(rows):
        last = max(first + 1, int(np.searchsorted(upto, (upto[first - 1] if first else 0) + STEP, "right")))
        n, own = (hi - lo)[first:last], rows[first:last]
        i = np.repeat(own, n)
        j = np.arange(len(i)) + np.repeat(lo[first:last] - (np.cumsum(n) - n), n)
        near = np.bitwise_count(bits[0][i] ^ bits[1][j]) <= rooms[lengths[0][i], lengths[1][j]]
        yield i[near], j[near]
        first = last


def _by_cells(rows: np.ndarray, lo: int, hi: int, bits, lengths, cells, rooms):
    """The same for many rows with one lo and hi: only cells are compared that differ in no more letters than there is room for."""
    width = 1 + max(int(c.max()) for c in cells)
    keys = [c @ np.array([width**k for k in range(CELLS)]) for c in (cells[0][rows], cells[1][lo:hi])]
    b_order = np.argsort(keys[1], kind="stable")
    b_bits = bits[1][lo:hi][b_order]
    _, b_first, b_size = np.unique(keys[1][b_order], return_index=True, return_counts=True)
    b_cell, b_len = (x[lo:hi][b_order][b_first] for x in (cells[1], lengths[1]))
    a_order = np.argsort(keys[0], kind="stable")
    _, a_first, a_size = np.unique(keys[0][a_order], return_index=True, return_counts=True)
    for at, n in zip(a_first.tolist(), a_size.tolist()):
        own = rows[a_order[at : at + n]]
        room_of = rooms[lengths[0][own[0]], b_len]
        fit = np.abs(b_cell - cells[0][own[0]]).sum(1) <= room_of
        some = np.flatnonzero(np.repeat(fit, b_size))
        if not len(some):
            continue
        most, there = np.repeat(room_of[fit], b_size[fit]), b_bits[some]
        every = max(1, STEP // len(some))
        for start in range(0, n, every):
            part = own[start : start + every]
            near = np.flatnonzero(np.bitwise_count(bits[0][part][:, None] ^ there) <= most)
            if len(near):
                i, j = np.divmod(near, len(some))
                yield part[i], lo + b_order[some[j]]


def _in_steps(pieces):
    """Pieces of pairs put together or taken apart to about STEP pairs each."""
    held, n = [], 0
    for piece in pieces:
        held.append(piece)
        n += len(piece[0])
        if n >= STEP:
            i, j = (np.concatenate(x) for x in zip(*held))
            yield from ((i[k : k + STEP], j[k : k + STEP]) for k in range(0, len(i), STEP))
            held, n = [], 0
    if n:
        yield tuple(np.concatenate(x) for x in zip(*held))


def _of_short(a: list[str], b: list[str], a_slot: np.ndarray, b_slot: np.ndarray, least: float, scores: np.ndarray):
    """Positions and scores of the pairs of one slot with ratio ``least``, in pieces; for strings of at most LONGEST letters. b is in the order of its slots."""
    (a_code, b_code), counts, size = _coded([a, b])
    lengths, grams = [x.sum(1, dtype=np.int64) for x in counts], [_grams(x) for x in (a_code, b_code)]
    both = np.concatenate(counts)
    bits = [np.zeros(len(a), np.uint64), np.zeros(len(b), np.uint64)]
    for e, (c, t) in enumerate(_bits(both)):
        for own, x in zip(bits, counts):
            own |= (x[:, c] >= t).astype(np.uint64) << np.uint64(e)
    at = np.zeros((len(a), size), np.uint64)
    for k in range(a_code.shape[1]):
        at[np.arange(len(a)), a_code[:, k]] |= np.uint64(1 << k)
    at[:, 0] = 0
    at, b_code = at.ravel(), np.ascontiguousarray(b_code.T)
    rooms = np.array([[room(n, m, least) for m in range(LONGEST + 1)] for n in range(LONGEST + 1)], np.int16)
    lo, hi = (np.searchsorted(b_slot, a_slot, side) for side in ("left", "right"))
    # By size of the slot: pairs are listed where they are few, else found by cells.
    number, many = np.bincount(a_slot)[a_slot], np.zeros(len(a), bool)
    many = number * (hi - lo) > MANY_PAIRS
    few = np.flatnonzero(~many & (hi > lo))

    def near():
        yield from _listed(few, lo[few], hi[few], bits, lengths, rooms)
        if many.any():
            cells = _cells(both)
            cells = cells[: len(a)], cells[len(a) :]
            for slot in np.unique(a_slot[many]):
                rows = np.flatnonzero(a_slot == slot)
                yield from _by_cells(rows, int(lo[rows[0]]), int(hi[rows[0]]), bits, lengths, cells, rooms)

    ends = np.array([(1 << n) - 1 for n in range(LONGEST + 1)], np.uint64)
    for i, j in _in_steps(near()):
        like = np.bitwise_count(grams[0][i] ^ grams[1][j]) <= 3 * rooms[lengths[0][i], lengths[1][j]]
        i, j = i[like], j[like]
        if not len(i):
            continue
        row, base = np.full(len(i), ~np.uint64(0)), i * size
        for k in range(int(lengths[1][j].max())):
            u = row & at[base + b_code[k][j]]
            row = (row + u) | (row - u)
        common = np.bitwise_count(~row & ends[lengths[0][i]]).astype(np.int64)
        total = lengths[0][i] + lengths[1][j]
        kept = 2 * common / total >= least
        yield i[kept], j[kept], scores[total[kept], common[kept]]


def _of_slots(a: list[str], b: list[str], a_slot: np.ndarray, b_slot: np.ndarray, least: float, scores: np.ndarray):
    """Positions and scores of the similar pairs of equal slots, as three arrays; None where there is none."""
    short = lambda s: len(s) <= LONGEST and s != "" and "\0" not in s
    a_short, b_short = (np.array([short(s) for s in x], bool) for x in (a, b))
    sa, sb = np.flatnonzero(a_short), np.flatnonzero(b_short)
    sb = sb[np.argsort(b_slot[sb], kind="stable")]
    found = []
    if len(sa) and len(sb):
        found = [(sa[i], sb[j], s) for i, j, s in _of_short([a[i] for i in sa], [b[j] for j in sb], a_slot[sa], b_slot[sb], least, scores)]
    plain = []
    for some_a, some_b in ((np.flatnonzero(~a_short), np.arange(len(b))), (sa, np.flatnonzero(~b_short))):
        if len(some_a) and len(some_b):
            there = _by_slot(b_slot[some_b].tolist())
            for slot, ia in _by_slot(a_slot[some_a].tolist()).items():
                plain += _one_by_one(a, b, some_a[ia].tolist(), some_b[there.get(slot, [])].tolist(), least)
    if plain:
        found.append(tuple(map(np.array, zip(*plain))))
    return [np.concatenate(x) for x in zip(*found)] if found else None


def _of_key(a: list[str], b: list[str], least: float, scores: np.ndarray):
    """_of_slots() of one slot."""
    return _of_slots(a, b, np.zeros(len(a), np.int64), np.zeros(len(b), np.int64), least, scores)


def _allowed(a: list[str], b: list[str], unless: list[str | None], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Of pairs: not of equal strings, and b doesn't hold the word that a rules out."""
    same: dict[str, int] = {}
    a_own, b_own = (np.array([same.setdefault(s, len(same)) for s in x]) for x in (a, b))
    kept = a_own[i] != b_own[j]
    ruled = {w: k for k, w in enumerate(dict.fromkeys(w for w in unless if w is not None))}
    if ruled:
        n = len(ruled) + 1  # the last: none is ruled out
        out = np.array([ruled.get(w, n - 1) for w in unless])[i]
        held = np.array([k * n + ruled[w] for k, s in enumerate(b) for w in s.split(" ") if w in ruled], np.int64)
        if n * len(b) <= MOST_HELD:
            holds = np.zeros(n * len(b), bool)
            holds[held] = True
            kept &= ~holds[j * n + out]
        else:
            kept &= ~np.isin(j * n + out, held)
    return kept


def _by_slot(slots: list) -> dict:
    out: dict = {}
    for k, slot in enumerate(slots):
        out.setdefault(slot, []).append(k)
    return out


def similar_pairs(left: DataFrame, right: DataFrame, on: list[str], least: float, side: int, words: bool = False, held: str | None = None) -> DataFrame:
    """arabic, a, b, score (three places) of all pairs of a left (on, a, unless) and a right row (on, b) with equal ``on`` and ratio ``least``. Rows are distinct; arabic is one of on.

    words: the strings are compared with their words sorted, equal strings are no pair, and neither are those whose b holds the word in ``unless``.
    held: a column of left with the number of right rows of its key, if that is known.
    """
    asked = left.groupBy(*on).agg(F.count("*").alias("na"), *([F.max(held).alias("nb")] if held else []))
    keys = written((asked if held else asked.join(right.groupBy(*on).agg(F.count("*").alias("nb")), on)).select(*on, "na", "nb", F.ceil(F.col("na") / side).alias("ma"), F.ceil(F.col("nb") / side).alias("mb")), "keys", compression="zstd")
    small = F.col("ma") * F.col("mb") == 1
    of_small = lambda x: F.coalesce(F.sum(F.when(small, x)), F.lit(0))
    known, pairs, rows = keys.agg(F.count("*"), of_small(F.col("na").cast("double") * F.col("nb")), of_small(F.col("na") + F.col("nb"))).first()
    groups = 1 + max(int(pairs // side**2), rows // GROUP_ROWS)
    put = keys.select(*on, "ma", "mb")
    # Of many keys only the few of more than one block are told; most rows of keys that the other side lacks are left out first.
    how = "inner" if known <= FEW_KEYS else "left"
    put = F.broadcast(cut(put if how == "inner" else put.where(~small)))
    if how == "left":
        right = among(right, on, keys.select(*on))
    slot = F.concat_ws(" ", "i", "j", *(F.col(c).cast("string") for c in on))
    unit = F.when(small, F.pmod(F.xxhash64(*on), F.lit(groups))).otherwise(F.xxhash64("slot"))
    dealt = lambda d, c, own, m, other, of: d.join(put, on, how).fillna(1, ["ma", "mb"]).withColumn(own, F.pmod(F.xxhash64(c), F.col(m))).withColumn(other, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(of) - 1))).withColumn("slot", slot).withColumn("unit", unit)
    a = dealt(left, "a", "i", "ma", "j", "mb").select("unit", "slot", "arabic", "a", "unless")
    b = dealt(right, "b", "j", "mb", "i", "ma").select("unit", "slot", "b")
    spark = left.sparkSession
    # Asked for by number: the bytes of names tell nothing of the work on them.
    parts = 4 * max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    scores = _all_rounded()
    schema = pa.schema([("arabic", pa.bool_()), ("a", pa.string()), ("b", pa.string()), ("score", pa.float64())])

    def compare(l: pa.Table, r: pa.Table) -> pa.Table:
        slots = pa.concat_arrays([x for t in (l, r) for x in t["slot"].chunks]).dictionary_encode().indices.to_numpy().astype(np.int64)
        a_slot, b_slot = slots[: len(l)], slots[len(l) :]
        met = np.isin(b_slot, a_slot, kind="table") if len(l) and len(r) else np.zeros(len(r), bool)
        r, b_slot = r.select(["b"]).filter(pa.array(met)), b_slot[met]
        a, b, unless = l["a"].to_pylist(), r["b"].to_pylist(), l["unless"].to_pylist()
        in_order = (lambda x: [" ".join(sorted(s.split(" "))) for s in x]) if words else (lambda x: x)
        a_text, b_text = in_order(a), in_order(b)
        found = _of_slots(a_text, b_text, a_slot, b_slot, least, scores) if a and b else None
        if found is None:
            return schema.empty_table()
        i, j, s = found
        if words:
            kept = _allowed(a, b, unless, i, j)
            i, j, s = i[kept], j[kept], s[kept]
        return pa.table([l["arabic"].take(pa.array(i)), pa.array(a, pa.string()).take(pa.array(i)), pa.array(b, pa.string()).take(pa.array(j)), pa.array(s, pa.float64())], schema=schema)

    return a.repartition(parts, "unit").groupBy("unit").cogroup(b.repartition(parts, "unit").groupBy("unit")).applyInArrow(compare, "arabic boolean, a string, b string, score double")
