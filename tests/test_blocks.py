import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyweir.functions.similarity import plain_ratio
from tallyweir.operators import blocks, resolve


def slipped(rng, s):
    for _ in range(rng.randrange(0, 4)):
        i = rng.randrange(len(s))
        s = rng.choice([s[:i] + s[i + 1 :], s[:i] + "x" + s[i:], s[:i] + "y" + s[i + 1 :]])
    return s


def test_scores_are_rounded_as_spark_does(spark):
    ratios = [(t, c) for t in range(1, 129) for c in range(t // 2 + 1)]
    got = spark.createDataFrame([(t, c, 2 * c / t) for t, c in ratios], "t int, c int, s double").withColumn("s", F.round("s", 3)).collect()
    table = blocks._all_rounded()
    assert all(table[r.t, r.c] == r.s for r in got)


@pytest.mark.parametrize("least", [0.92, 0.3])
def test_a_word_in_many_blocks_loses_no_pair_and_gives_none_twice(spark, least, monkeypatch):
    """One word of all names, second words, names longer than a machine word, names in both scripts, word order."""
    monkeypatch.setattr(resolve, "SIDE", 16)
    monkeypatch.setattr(resolve, "FEW", 16)
    rng = random.Random(5)
    name = lambda: "".join(rng.choice("abdefgu") for _ in range(rng.choice([5, 9, 14, 70])))
    held = sorted({f"{name()} {rng.choice(['trading', 'trading works', 'works trading'])}" for _ in range(70)} | {"12 345 trading", "12 346 trading", "777", "12 77"})
    asked = sorted({slipped(rng, h.split(" ")[0]) + " " + " ".join(h.split(" ")[1:]) for h in held if h[0] > "9"} | {"12 345 trading", "trading 12 345", "777 12"})
    frame = lambda names, arabic: spark.createDataFrame([(arabic, n) for n in names], "arabic boolean, norm string")
    digits = lambda names: [n for n in names if n[0] <= "9" and "trading" not in n]
    q, n = frame(asked, False).union(frame(digits(asked), True)), frame(held, False).union(frame(digits(held), True))
    rows = resolve.fuzzy_pairs(q, n, least).collect()
    got = {(r["query"], r["norm"]): r["score"] for r in rows}
    assert len(got) == len(rows)
    words = {(r["arabic"], r["query"], r["word"]) for r in resolve.rarest_words(q, n).collect()}
    in_order = lambda s: " ".join(sorted(s.split(" ")))
    pairs = {(a, b) for _, a, w in words for b in held if w in b.split(" ") and a != b}
    assert got == {(a, b): blocks.rounded(s) for a, b in pairs if (s := plain_ratio(in_order(a), in_order(b))) >= least}


def test_a_word_of_all_names_is_spread_over_groups(spark, monkeypatch):
    """It was one task's work before: names of one word lay in one partition."""
    seen = []
    rows = lambda c, n: spark.createDataFrame([(False, "w", f"{c}{i} w") for i in range(n)], f"arabic boolean, word string, {c} string")
    kept = blocks.cut
    monkeypatch.setattr(blocks, "cut", lambda df: (seen.append(x := kept(df)), x)[1])
    df = blocks.similar_pairs(rows("a", 100).withColumn("unless", F.lit(None).cast("string")), rows("b", 100), ["arabic", "word"], 0.5, 10, True)
    assert [(r.ma, r.mb) for r in seen[0].collect()] == [(10, 10)]
    assert df.select("a", "b").distinct().count() == df.count() > 0


def test_skeletons_of_many_blocks_lose_no_pair_and_are_not_keyed_by_segments(spark, monkeypatch):
    """Each skeleton got hundreds of keys before, and the rows of a frequent key were one task's work."""
    monkeypatch.setattr(resolve, "FORMS", 8)
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("bdfgklm") for _ in range(rng.randrange(6, 20))) for _ in range(60)} | {"bdfgklm" * 11})
    asked = [slipped(rng, w) for w in words]
    frame = lambda forms, arabic: spark.createDataFrame([(arabic, [f]) for f in forms], "arabic boolean, forms array<string>")
    df = resolve.translit_pairs(frame(asked, True).union(frame(words[:5], False)), frame(words, False), 0.85)
    rows = df.collect()
    got = {(r["query"], r["form"], r["arabic"]): r["score"] for r in rows}
    assert len(got) == len(rows)
    assert got == {(a, b, True): blocks.rounded(s) for a in set(asked) for b in words if len(a) >= 6 and (s := plain_ratio(a, b)) >= 0.85}
    assert "FlatMapCoGroupsInArrow" in df._jdf.queryExecution().optimizedPlan().toString()


def test_a_block_gives_all_pairs_and_only_allowed_ones():
    """Numpy alone: lengths from one letter to beyond a machine word, letters of both scripts, an empty string."""
    rng = random.Random(7)
    b = ["".join(rng.choice("bdfgklmبدف") for _ in range(rng.choice([1, 5, 9, 20, 64, 65]))) for _ in range(60)] + [""]
    a = [slipped(rng, s) if len(s) > 4 else s for s in b[:40]] + [""]
    for least in (0.92, 0.3):
        i, j, s = blocks._of_key(a, b, least, blocks._all_rounded())
        assert {(x, y): z for x, y, z in zip(i.tolist(), j.tolist(), s.tolist())} == {(x, y): blocks.rounded(r) for x in range(len(a)) for y in range(len(b)) if (r := plain_ratio(a[x], b[y])) >= least}
        assert len(i) == len(set(zip(i.tolist(), j.tolist())))
    names = ["x trading", "y trading works"]
    i, j = (x.ravel() for x in np.indices((2, 2)))
    assert blocks._allowed(["x trading", "z"], names, [None, "works"], i, j).tolist() == [False, True, True, False]


@pytest.mark.parametrize("translit", [0.9, 1.0])
def test_the_ladder_and_its_summary_are_the_same_in_blocks_of_any_size(spark, monkeypatch, translit):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("bdfgklmnrst") + rng.choice("aiu") for _ in range(6))
    arabic = str.maketrans({"b": "ب", "d": "د", "f": "ف", "g": "ج", "k": "ك", "l": "ل", "m": "م", "n": "ن", "r": "ر", "s": "س", "t": "ت", "a": "ا", "i": "ي", "u": "و"})
    names = [f"{word()} {word()} trading" for _ in range(60)]
    left = [(str(k), slipped(rng, n), n[:-8].translate(arabic) if k % 3 == 0 else None, None) for k, n in enumerate(names)]
    frames = spark.createDataFrame(left, "customer_id string, name string, name_ar string, cr_number string"), spark.createDataFrame([(str(k), n, None) for k, n in enumerate(names)], "rid string, name string, cr_number string")
    run = lambda: resolve.match(*frames, ["customer_id"], ["rid"], ["name", "name_ar"], ["name"], translit=translit)
    whole = run().collect()
    for side in ("SIDE", "FORMS"):
        monkeypatch.setattr(resolve, side, 7)
    parts = run()
    assert sorted(parts.collect()) == sorted(whole) and len(whole) > 40
    assert resolve.match_summary(parts, "customer_id").first().matches == len(whole)
