"""Matching two books of companies without a common key, by a label model.

Both books are reduced to distinct (names, number) profiles. Candidates share a number or one end of a name, up to one
slip at that end. Several matching functions vote on each candidate (1 same, -1 different, 0 no opinion). A generative
model with two classes, and in each a tree of dependences between the functions, is fitted to the counts of the vote
patterns by expectation maximisation; the tree is learned too. Its posterior is the confidence. The patterns are bounded by
the functions, so the model needs nothing of the books' size on the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweir.functions.similarity import plain_ratio as ratio
from tallyweir.functions.text import ABBREVIATIONS, ARABIC_DROP, LEGAL, LETTERS, STOPWORDS, TRANSLATED
from tallyweir.llm.words import words
from tallyweir.operators.resolve import members, numbered
from tallyweir.session import cut, small_side

# The words and letters are the core's tables; what they lack for this purpose is added here.
#: words of legal form or place in a group, which name no company: the core's, without those that say a line of business or a reach
FORMS = {*LEGAL, *ARABIC_DROP, *STOPWORDS, "w", "l", "c", "q", "s", "p", "branch", "warehouse", "enterprises", "ventures", "ذ", "م", "ش", "ق", "فرع", "مستودع"} - {"trdg", "trad", "intl", "international"}
#: lines of business, as folded Arabic words without article, in English (one word)
LINES = {k: v for k, v in TRANSLATED.items() if " " not in v} | {"صيانه": "maintenance"}
ENGLISH_LINES = {*LINES.values(), "manufacturing", "construction"}
#: a number that more differently named profiles of a book bear than this is a placeholder, and counts as missing
MOST_NAMES = 16
#: what the voters are taken to be worth before any pair is seen
TRUST = [0.99, 0.9, 0.8, 0.8, 0.7, 0.9, 0.7, 0.7]
VOTERS = ["number", "slip", "name", "close", "each_word", "business", "same_business", "second_name"]
END = 8


def sounded(word: str) -> str:
    """One spelling for both scripts: Arabic letters in Latin, gh as g, w as u, y as i, o as u, runs of a letter once."""
    s = "".join(LETTERS.get(c, c) for c in word)
    s = s.replace("gh", "g").replace("w", "u").replace("y", "i").replace("o", "u")
    return re.sub(r"(.)\1+", r"\1", s)


def parsed(name: str | None) -> tuple[list[str], list[str]]:
    """The sounded own words of a name in order and its lines of business, sorted; both empty for null and empty names."""
    own, business = [], set()
    for w in words(name):
        if "؀" <= w[0] <= "ۿ":
            bare = re.sub("^(?:ولل|وال|لل|ال)(?=..)", "", w)
            line = LINES.get(bare) or LINES.get("ا" + bare) or LINES.get(re.sub("^و", "", bare)) or (LINES.get("ا" + bare[1:]) if bare[0] == "ل" else None)
            if line:
                business.add(line)
            elif w not in FORMS and not w.isdigit():
                own.append(sounded(re.sub("^ال(?=..)", "", w)))
        else:
            w = ABBREVIATIONS.get(w, w)
            if w in ENGLISH_LINES:
                business.add(w)
            elif w not in FORMS and not w.isdigit():
                own.append(sounded(w))
    return [w for w in own if w], sorted(business)


def number_root(c: Column) -> Column:
    """The digits of a registration number that join: ASCII, without prefix, branch, separators, float tail and leading zeros; null for numbers of another registry (letters but CR before the digits)."""
    digits = F.translate(F.split(c, r"\|", 2)[0], "٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹", "0123456789" * 2)
    joined = F.regexp_replace(F.regexp_replace(digits, r"\.0+\s*$", ""), r"(?<=[0-9])[,٬،](?=[0-9]{3}(?![0-9]))", "")
    home = F.regexp_extract(joined, r"(?i)^[^\p{L}\p{N}]*(?:c\.?r\.?(?:\s*no\.?)?)?[^\p{L}\p{N}]*([0-9]+)", 1)
    return F.nullif(F.regexp_replace(home, "^0+", ""), F.lit(""))


def orders(own: list[str]) -> list[str]:
    """The words run together: as they stand, and with the last one first or the first one last."""
    return list(dict.fromkeys("".join(x) for x in (own, own[1:] + own[:1], own[-1:] + own[:-1]))) if own else []


def ends(own: list[str], end: int = END) -> set[str]:
    """Keys of a name: its two ends of ``end`` letters in each order, as they are and with one letter left out."""
    keys = set()
    for s in orders(own):
        for side, part in (("<", s[:end]), (">", s[-end:])):
            keys |= {side + part} | {side + part[:i] + part[i + 1 :] for i in range(len(part))}
    return keys


def one_slip(a: str, b: str) -> bool:
    """Whether two different numbers differ by one digit changed, left out or added, or by two neighbours exchanged."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    x, y = a[i:], b[i:]
    return x[1:] == y[1:] or x[1:] == y or x == y[1:] or (x[:2] == y[:2][::-1] and x[2:] == y[2:])


def votes(a_number: str | None, a_names: list[tuple[list[str], list[str]]], b_number: str | None, b_name: tuple[list[str], list[str]]) -> list[int]:
    """The votes of VOTERS on a pair; a has up to two names, b one."""
    own, business = b_name
    whole = orders(own)
    best = [max((ratio(x, y) for x in orders(n[0]) for y in whole), default=-1.0) for n in a_names]
    top = max(best, default=-1.0)
    first = a_names[best.index(top)] if a_names else ([], [])
    equal = a_number is not None and a_number == b_number
    slip = a_number is not None and b_number is not None and one_slip(a_number, b_number)
    held = {b for n in a_names for b in n[1]} if a_names else set()
    mine = {*business}
    named = [w for w in first[0]]
    each = [max((ratio(w, x) for x in own), default=0.0) for w in named]
    if top < 0.8 and len(named) < len(own) and each and min(each) >= 0.86:
        top = -1.0  # part of the name says nothing of the rest
    return [
        1 if equal else -1 if a_number and b_number and not slip else 0,
        1 if slip else 0,
        1 if top == 1 else 0 if top < 0 or top >= 0.8 else -1,
        1 if top >= 0.86 else -1 if 0 <= top < 0.8 else 0,
        0 if not each else 1 if min(each) >= 0.75 else -1 if max(each) < 0.75 else 0,
        0 if not held or not mine else 1 if held <= mine or mine <= held else -1,
        0 if not held or not mine else 1 if held == mine else 0,
        0 if len(best) < 2 else 1 if min(best) >= 0.86 else -1 if min(best) < 0.8 else 0,
    ]


class LabelModel:
    """Two classes; in each, a tree of the voters with a table of each vote given its parent's. Fitted to pattern counts."""

    def __init__(self, patterns: np.ndarray, counts: np.ndarray, rounds: int = 60, prior: float = 0.02):
        self.patterns, n = patterns + 1, counts.sum()
        voters = patterns.shape[1]
        # Start: a pair is the same as far as its votes say so; each voter is taken to be right more often than not.
        score = patterns @ np.array([2.0, 2.0, 1.5, 1.0, 0.5, 1.5, 0.5, 0.5])
        self.post = 1 / (1 + np.exp(-(score - 1.5) * 1.5))
        self.parents = [-1] * voters
        belief = np.array([[[t, 0.5, 1 - t], [1 - t, 0.5, t]] for t in TRUST]) * 2
        smooth = prior * n / voters
        for r in range(rounds):
            weight = np.stack([counts * (1 - self.post), counts * self.post])
            if r % 10 == 0:
                self.parents = self._tree(weight)
            log = np.log(weight.sum(1) + 1)[:, None].repeat(len(patterns), 1)
            self.share = weight[1].sum() / max(n, 1)
            for v in range(voters):
                log += self._table(weight, v, self.parents[v], belief[v] * smooth)
            new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
            if np.abs(new - self.post).max(initial=0) < 1e-9 and r > 20:
                break
            self.post = new

    def _table(self, weight: np.ndarray, v: int, parent: int, prior: np.ndarray) -> np.ndarray:
        """log P(vote | parent's vote, class) of each pattern, 2 x patterns."""
        out = np.zeros((2, len(self.patterns)))
        for y in (0, 1):
            single = np.bincount(self.patterns[:, v], weight[y], 3) + prior[y]
            single = single / single.sum()
            if parent < 0:
                out[y] = np.log(single[self.patterns[:, v]])
                continue
            pair = np.zeros((3, 3))
            np.add.at(pair, (self.patterns[:, parent], self.patterns[:, v]), weight[y])
            pair += single * (prior.sum() / 6)  # where a parent's vote is rare, the voter's own share
            pair /= pair.sum(1, keepdims=True)
            out[y] = np.log(pair[self.patterns[:, parent], self.patterns[:, v]])
        return out

    def _tree(self, weight: np.ndarray) -> list[int]:
        """Parents of the tree with the greatest mutual information between voters, given the class (Chow and Liu)."""
        voters = self.patterns.shape[1]
        gain = np.zeros((voters, voters))
        for i in range(voters):
            for j in range(i):
                for y in (0, 1):
                    pair = np.full((3, 3), 1e-9)
                    np.add.at(pair, (self.patterns[:, i], self.patterns[:, j]), weight[y])
                    p = pair / pair.sum()
                    gain[i, j] += weight[y].sum() * (p * np.log(p / np.outer(p.sum(1), p.sum(0)))).sum()
        gain = gain + gain.T
        parents, inside = [-1] * voters, {0}
        while len(inside) < voters:
            i, j = max(((i, j) for i in inside for j in range(voters) if j not in inside), key=lambda e: (gain[e], -e[1]))
            parents[j] = i
            inside.add(j)
        return parents


NAME = "struct<own:array<string>,business:array<string>>"


def _parse(rows: DataFrame, names: list[str]) -> DataFrame:
    """Adds ``parsed`` (array of name structs of the non-empty names) and ``keys`` to rows."""

    @F.pandas_udf(f"struct<parsed:array<{NAME}>,keys:array<string>>")
    def parse(*cols: pd.Series) -> pd.DataFrame:
        out = []
        for row in zip(*cols):
            found = [p for p in (parsed(x) for x in dict.fromkeys(row)) if p[0] or p[1]]
            out.append({"parsed": [{"own": o, "business": b} for o, b in found], "keys": sorted({k for o, _ in found for k in ends(o)})})
        return pd.DataFrame(out, columns=["parsed", "keys"])

    return rows.withColumn("p", parse(*(F.col(n) for n in names))).select("*", "p.parsed", "p.keys").drop("p")


def _vote(pairs: DataFrame) -> DataFrame:
    """left, right, pattern of each pair (left, right, a_number, a_parsed, b_number, b_parsed)."""

    def voted(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = lambda names: [(x["own"], x["business"]) for x in names]
        for batch in it:
            a_no, a, b_no, b = (batch.column(i).to_pylist() for i in range(2, 6))
            found = [votes(an, plain(x), bn, (plain(y) or [([], [])])[0]) for an, x, bn, y in zip(a_no, a, b_no, b)]
            codes = pa.array(["".join("-0+"[v + 1] for v in f) for f in found], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), codes], names=["left", "right", "pattern"])

    return pairs.select("left", "right", "a_number", "a_parsed", "b_number", "b_parsed").mapInArrow(voted, "left bigint, right bigint, pattern string")


def placeholders(a: DataFrame, b: DataFrame) -> DataFrame:
    """number: of each book those that more than MOST_NAMES differently named profiles bear."""
    own = lambda d: d.where("number is not null").groupBy("number", "parsed").agg(F.lit(1)).groupBy("number").agg(F.count("*").alias("names")).where(F.col("names") > MOST_NAMES).select("number")
    return own(a).unionByName(own(b)).distinct()


def trusted(profiles: DataFrame, placeholders: DataFrame) -> DataFrame:
    """profiles without the numbers that are placeholders."""
    return profiles.join(small_side(placeholders.withColumn("placed", F.lit(True))), "number", "left").withColumn("number", F.when(F.col("placed").isNull(), F.col("number"))).drop("placed")


def candidates(a: DataFrame, b: DataFrame) -> DataFrame:
    """left, right of the pairs that share a number, two keys of their names, or one where the lines of business allow it."""
    by_number = a.join(b.select("right", "number"), "number").select("left", "right")
    # A pair that shares a single key, by chance mostly, is kept where the lines of business allow it.
    keyed = lambda d, side, lines: d.select(side, F.explode("keys").alias("k"), F.array_distinct(F.flatten("parsed.business")).alias(lines))
    inside = lambda x, y: F.size(F.array_except(x, y)) == 0
    shared = keyed(a, "left", "x").join(keyed(b, "right", "y"), "k").select("left", "right", (inside("x", "y") | inside("y", "x")).alias("fits"))
    by_name = shared.groupBy("left", "right").agg(F.count("*").alias("n"), F.max("fits").alias("fits")).where("n >= 2 or fits").select("left", "right")
    return by_number.unionByName(by_name).distinct()


def profiles(book: DataFrame, names: list[str], out: str) -> tuple[DataFrame, DataFrame]:
    """(book's rows with the number of their profile, the profiles with number, names, parsed, keys). A profile is a distinct pair of names and number; nulls are values."""
    distinct = numbered(book, [*names, "number"], out)
    return members(book, distinct, [*names, "number"], out), cut(_parse(distinct, names).select(out, "number", "parsed", "keys"))


def link(customers: DataFrame, register: DataFrame, least: float = 0.5) -> DataFrame:
    """customer_id, profile_number, confidence: the pairs that are the same company with a confidence of ``least`` or more.

    customers: customer_id, name, name_ar, cr_number; register: profile_number, name, cr_number. Rows that repeat count
    once; a null id belongs to no pair; rows without number and name match nothing; a number that more than MOST_NAMES
    differently named profiles of a book bear is a placeholder and counts as missing. The register rows of a matched row's
    company (its branches) take its confidence. Confidence is the posterior of the model.
    """
    left = customers.where("customer_id is not null").select("customer_id", F.col("name").cast("string").alias("name"), F.col("name_ar").cast("string").alias("name_ar"), number_root(F.col("cr_number")).alias("number"))
    right = register.where("profile_number is not null").select("profile_number", F.col("name").cast("string").alias("name"), number_root(F.col("cr_number")).alias("number"))
    a_rows, a = profiles(left, ["name", "name_ar"], "left")
    b_rows, b = profiles(right, ["name"], "right")
    placed = cut(placeholders(a, b))
    if not placed.isEmpty():
        a, b = trusted(a, placed), trusted(b, placed)
    pairs = candidates(a, b)
    pairs = pairs.join(a.select("left", F.col("number").alias("a_number"), F.col("parsed").alias("a_parsed")), "left").join(b.select("right", F.col("number").alias("b_number"), F.col("parsed").alias("b_parsed")), "right")
    voted = cut(_vote(pairs))
    patterns = voted.groupBy("pattern").agg(F.count("*").alias("n")).orderBy("pattern").collect()  # at most 3 ** len(VOTERS)
    if not patterns:
        return left.join(right, F.lit(False)).select("customer_id", "profile_number", F.lit(0.0).alias("confidence"))
    model = LabelModel(np.array([["-0+".index(c) - 1 for c in p["pattern"]] for p in patterns]), np.array([p["n"] for p in patterns], dtype=float))
    judged = customers.sparkSession.createDataFrame([(p["pattern"], float(c)) for p, c in zip(patterns, model.post) if c >= least], "pattern string, confidence double")
    same = voted.join(F.broadcast(judged), "pattern").select("left", "right", "confidence")
    companies = register_companies(b)
    matched = same.join(companies, "right").groupBy("left", "company").agg(F.max("confidence").alias("confidence"))
    out = matched.join(a_rows.select("customer_id", "left").distinct(), "left").join(b_rows.select("profile_number", "right").distinct().join(companies, "right").select("profile_number", "company"), "company")
    return out.groupBy("customer_id", "profile_number").agg(F.round(F.max("confidence"), 4).alias("confidence"))


def register_companies(rows: DataFrame) -> DataFrame:
    """right, company: the register rows of one company. rows: right, number, parsed.

    Rows of one number root are one company; rows without number join the company that bears their sounded name and lines
    of business, if just one number does, else those without number of the same name.
    """
    name = F.get("parsed", F.lit(0))
    key = F.when(F.size(name["own"]) > 0, F.concat_ws(" ", F.array_sort(name["own"]), F.lit("|"), name["business"]))
    keyed = rows.select("right", "number", key.alias("key"))
    bearers = keyed.where("key is not null").groupBy("key").agg(F.min("number").alias("low"), F.max("number").alias("high"))
    alone = keyed.where("number is null").join(bearers, "key", "left")
    by_name = F.when(F.col("low") == F.col("high"), F.concat(F.lit("number:"), "low")).when(F.col("key").isNotNull() & F.col("low").isNull(), F.concat(F.lit("name:"), "key")).otherwise(F.concat(F.lit("row:"), F.col("right").cast("string")))
    return keyed.where("number is not null").select("right", F.concat(F.lit("number:"), "number").alias("company")).unionByName(alone.select("right", by_name.alias("company")))


def same_companies(customers: DataFrame, register: DataFrame) -> DataFrame:
    """customer_id, profile_number of the pairs that are the same company."""
    return link(customers, register).select("customer_id", "profile_number")
