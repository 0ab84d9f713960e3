"""Timestamps of mixed formats, precisions and zones as one UTC instant in milliseconds.

All spellings stand in one alternation with named groups. One ``regexp_replace`` writes the groups of whichever
alternative matched into a fixed list of components, so a text is scanned once; ranges are checked on integers and the
instant is assembled by day arithmetic. Everything stays inside JVM code generation; no shuffle, no Python.

Defined results: null, empty, unreadable or out-of-range texts (31/02, hour 24, month 13), instants before 1900 or after
9999 give null. Digits below the millisecond are cut off. Without a zone a text is UTC, or local in ``tz`` where the
candidate says so; a local time that occurs twice is its earlier instant, one that is skipped moves on by the gap. A bare
date is midnight UTC. An unknown zone name makes local texts unreadable.
"""

from __future__ import annotations

import zoneinfo
from dataclasses import dataclass
from functools import cache

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEP = "\u0001"
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
_CLOCK = r"(?<h{k}>\d{{1,2}}):(?<mi{k}>\d{{2}})(?::(?<s{k}>\d{{2}})(?:[.,](?<f{k}>\d{{1,12}}))?)?(?:\s*(?<ap{k}>[ap]\.?m\.?|ص|م|صباحا|مساء))?(?:\s*(?<z{k}>z|utc|gmt|[+-]\d{{2}}:?\d{{2}}|[+-]\d{{2}}))?(?:\[[^\]]*\])?"
ALTERNATIVES = [
    r"/date\((?<msA>-?\d{1,17})(?:[+-]\d{4})?\)/",
    r"(?<msB>-?\d{12,14})",
    r"(?<secC>-?\d{9,11})",
    r"(?<yD>\d{4})[-/](?<moD>\d{1,2})[-/](?<dD>\d{1,2})(?:[t\s]\s*" + _CLOCK.format(k="D") + ")?",
    r"(?<aE>\d{1,2})(?<sepE>[/.-])(?<bE>\d{1,2})\k<sepE>(?<yE>\d{4})(?:,?[t\s]\s*" + _CLOCK.format(k="E") + ")?",
    r"(?:(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*,?\s+)?(?<dF>\d{1,2})[\s-](?<monF>" + "|".join(MONTHS) + r")[a-z]*\.?[\s-](?<yF>\d{4})(?:,?\s+" + _CLOCK.format(k="F") + ")?",
]
PATTERN = r"^(?i:" + "|".join(ALTERNATIVES) + r")$|^[\s\S]*$"
#: component -> the groups that may hold it
GROUPS = {
    "ms": ["msA", "msB"], "sec": ["secC"], "y": ["yD", "yE", "yF"], "mo": ["moD"], "d": ["dD", "dF"], "a": ["aE"], "b": ["bE"], "mon": ["monF"],
    "h": ["hD", "hE", "hF"], "mi": ["miD", "miE", "miF"], "s": ["sD", "sE", "sF"], "f": ["fD", "fE", "fF"], "ap": ["apD", "apE", "apF"], "z": ["zD", "zE", "zF"],
}
REPLACEMENT = SEP.join("".join(f"${{{g}}}" for g in gs) for gs in GROUPS.values())
DIGITS = ("٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹", "0123456789" * 2)
BLANKS, MARKS = "\u00a0\u202f\u2009\u2007", "\u200e\u200f\u061c\u202a\u202b\u202c\u2066\u2067\u2068\u2069\ufeff\u0001"
FIRST_MS, LAST_MS = -2_208_988_800_000, 253_402_300_799_999  # 1900-01-01 and the end of 9999


@dataclass(frozen=True)
class Candidate:
    """A column that may hold the timestamp. month_first: a boolean Column; local: a time without zone is local in the row's tz."""

    column: str
    local: bool = False
    month_first: Column | None = None


def ascii_digits(c: Column) -> Column:
    return F.translate(c, DIGITS[0], DIGITS[1])


def components(c: Column) -> Column:
    """array<string> in the order of GROUPS; all empty if no alternative matches, null for null."""
    clean = F.trim(F.translate(F.translate(ascii_digits(c), BLANKS, " " * len(BLANKS)), MARKS, ""))
    return F.split(F.regexp_replace(clean, F.lit(PATTERN), F.lit(REPLACEMENT)), SEP, -1)


def days_from_civil(y: Column, m: Column, d: Column) -> Column:
    """Days since 1970-01-01 in the proleptic Gregorian calendar, by integer arithmetic (years start in March)."""
    yy = y - F.when(m <= 2, 1).otherwise(0)
    era = F.floor(yy / 400)
    yoe = yy - era * 400
    doy = F.floor((F.lit(153) * (m + F.when(m > 2, -3).otherwise(9)) + 2) / 5) + d - 1
    return era * 146097 + yoe * 365 + F.floor(yoe / 4) - F.floor(yoe / 100) + doy - 719468


def _ints(parts: Column, month_first: Column) -> Column:
    """The components as checked integers: struct(ms, days, day_ms, zoned, off_min), each null where absent or out of range."""
    p = {k: F.get(parts, F.lit(i)) for i, k in enumerate(GROUPS)}
    n = {k: p[k].try_cast("bigint") for k in ("ms", "sec", "y", "mo", "d", "a", "b", "h", "mi", "s")}
    swap = month_first & n["a"].isNotNull()
    mo = F.coalesce(n["mo"], F.when(swap, n["a"]).otherwise(n["b"]), F.nullif(F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(p["mon"])), F.lit(0)))
    d = F.coalesce(n["d"], F.when(swap, n["b"]).otherwise(n["a"]))
    leap = (n["y"] % 4 == 0) & ((n["y"] % 100 != 0) | (n["y"] % 400 == 0))
    length = F.when(mo == 2, F.when(leap, 29).otherwise(28)).when(mo.isin(4, 6, 9, 11), 30).otherwise(31)
    days = F.when(mo.between(1, 12) & (d >= 1) & (d <= length) & (n["y"] >= 1), days_from_civil(n["y"], mo, d))
    pm = F.lower(F.substring(p["ap"], 1, 1)).isin("p", "م")
    hour = F.when(p["ap"] == "", n["h"]).when(n["h"].between(1, 12), n["h"] % 12 + F.when(pm, 12).otherwise(0))
    second, part = F.coalesce(n["s"], F.lit(0)), F.substring(F.concat(p["f"], F.lit("000")), 1, 3).try_cast("bigint")
    day_ms = F.when((hour <= 23) & (n["mi"] <= 59) & (second <= 59), ((hour * 60 + n["mi"]) * 60 + second) * 1000 + part)
    digits = F.regexp_replace(p["z"], "[^0-9]", "")
    hh, mm = F.substring(digits, 1, 2).try_cast("bigint"), F.coalesce(F.substring(digits, 3, 2).try_cast("bigint"), F.lit(0))
    off = F.when(digits == "", 0).when((hh <= 18) & (mm <= 59), (hh * 60 + mm) * F.when(p["z"].startswith("-"), -1).otherwise(1))
    return F.struct(
        F.coalesce(n["ms"], n["sec"] * 1000).alias("ms"), days.alias("days"), F.when(p["h"] == "", F.lit(None).cast("bigint")).otherwise(day_ms).alias("day_ms"),
        (p["h"] != "").alias("timed"), (p["z"] != "").alias("zoned"), off.alias("off"),
    )


@cache
def known_zones(gateway: object) -> str:
    """The zone names that the JVM behind ``gateway`` knows (a fixed list of about 600), as a list of SQL literals."""
    names = gateway.jvm.java.time.ZoneId.getAvailableZoneIds() if gateway is not None else zoneinfo.available_timezones() - {"Factory", "ROC", "localtime"}
    return ", ".join(f"'{z}'" for z in sorted(names))


@cache
def _checked(gateway: object) -> Column:
    """_ints over the columns that normalise() names; built once for a JVM, as hundreds of calls make it up."""
    return _ints(F.col("__parts"), F.col("__month_first"))


@cache
def _at(gateway: object, local: bool) -> Column:
    return _instant(F.col("__v"), local, F.col("__zone"))


def _instant(v: Column, local: bool, zone: Column) -> Column:
    wall = v["days"] * 86_400_000 + v["day_ms"]
    offset = v["off"] * 60_000
    if local:
        utc = F.unix_micros(F.to_utc_timestamp(F.timestamp_millis(wall), zone))
        offset = F.when(v["zoned"], offset).otherwise(wall - F.floor(utc / 1000))
    else:
        offset = F.when(v["zoned"], offset).otherwise(0)
    ms = F.coalesce(v["ms"], F.when(v["timed"], wall - offset).otherwise(v["days"] * 86_400_000))
    return F.when(ms.between(FIRST_MS, LAST_MS), ms)


def normalise(df: DataFrame, candidates: list[Candidate], out: str = "utc_ms", tz: Column | None = None, default_tz: str = "UTC") -> DataFrame:
    """Adds ``out``: the first readable of the candidates as UTC milliseconds. Rows and other columns stay as they are."""
    keep, gateway = df.columns, SparkContext._gateway
    kept = lambda d, *more: d.select(*(F.col(f"`{c}`") for c in keep), *more)
    if any(c.local for c in candidates):
        # One parsed list in place of hundreds of columns; the optimiser makes a hash set of it.
        df = kept(df, (F.trim(tz) if tz is not None else F.lit("")).alias("__tz"))
        zone = F.expr(f"CASE WHEN coalesce(__tz, '') = '' THEN '{default_tz}' WHEN __tz IN ({known_zones(gateway)}) OR __tz RLIKE '^[+-](0[0-9]|1[0-7]):[0-5][0-9]$' THEN __tz END")
    else:
        zone = F.lit(default_tz)
    df, found = kept(df, zone.alias("__zone")), None
    done = [F.col("__zone")]
    for c in candidates:
        text = F.col(f"`{c.column}`").cast("string")
        text = text if found is None else F.when(found.isNull(), text)
        step = [*done] if found is None else [*done, F.col("__ms")]
        df = kept(df, *step, components(text).alias("__parts"), (c.month_first if c.month_first is not None else F.lit(False)).alias("__month_first"))
        df = kept(df, *step, _checked(gateway).alias("__v"))
        at = _at(gateway, c.local)
        df = kept(df, *done, (at if found is None else F.coalesce(F.col("__ms"), at)).alias("__ms"))
        found = F.col("__ms")
    # Without the condition that looks as if it could change, Catalyst would copy these expressions into any later filter.
    return kept(df, F.when(F.monotonically_increasing_id() >= 0, F.col("__ms")).alias(out))
