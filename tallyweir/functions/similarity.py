"""Similarity of names: twice the longest common subsequence over both lengths, bit-parallel in Arrow batches."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyweir.functions import text

MIN_SKELETON = 6


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence; a word of bits per letter of a."""
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    row = full = (1 << len(a)) - 1
    for c in b:
        u = row & at.get(c, 0)
        row = ((row + u) | (row - u)) & full
    return len(a) - row.bit_count()


def plain_ratio(a: str | None, b: str | None) -> float:
    return 2 * common_length(a, b) / (len(a) + len(b)) if a and b else 0.0


@F.pandas_udf(T.DoubleType())
def indel_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """0 if either is null or empty."""
    return pd.Series([1.0 if x and x == y else plain_ratio(x, y) for x, y in zip(a, b)], dtype="float64")


def length_bound(a: Column, b: Column, least: float) -> Column:
    """What the lengths allow: no ratio of ``least`` is possible where this is false."""
    return F.least(F.length(a), F.length(b)) * 2 >= (F.length(a) + F.length(b)) * least - 1e-9


def sorted_words(normal: Column) -> Column:
    return F.array_join(F.array_sort(F.split(normal, " ")), " ")


def token_sort_similarity(a: Column, b: Column) -> Column:
    """Of two normalised names, without word order (repeated words count)."""
    return F.when((a == "") | (b == "") | a.isNull() | b.isNull(), 0.0).when(a == b, 1.0).otherwise(indel_ratio(sorted_words(a), sorted_words(b)))


def translit_similarity(a: Column, b: Column) -> Column:
    """The best ratio of the skeletons of two names of which just one is Arabic; 0 else."""
    long = lambda c: F.filter(text.skeleton_forms(c), lambda s: F.length(s) >= MIN_SKELETON)
    x, y = long(a), long(b)
    pairs = [indel_ratio(F.get(x, F.lit(i)), F.get(y, F.lit(j))) for i in (0, 1) for j in (0, 1)]
    return F.when(text.is_arabic(a) != text.is_arabic(b), F.greatest(*pairs)).otherwise(0.0)


def similarity(a: Column, b: Column) -> Column:
    """Same script: by words; else by skeletons."""
    return F.when(text.is_arabic(a) == text.is_arabic(b), token_sort_similarity(text.normalize_name(a), text.normalize_name(b))).otherwise(translit_similarity(a, b))
