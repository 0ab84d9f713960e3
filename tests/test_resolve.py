import random

from pyspark.sql import functions as F

from tallyweir.functions.similarity import plain_ratio
from tallyweir.operators import resolve

LEFT, RIGHT = "customer_id string, name string, name_ar string, cr_number string", "rid string, name string, cr_number string"


def run(spark, left, right, **kw):
    return {(r.customer_id, r.rid): (r.method, r.score, r.needs_review) for r in resolve.match(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), ["customer_id"], ["rid"], ["name", "name_ar"], ["name"], **kw).collect()}


def test_ladder(spark):
    left = [("1", "Al Rayyan Trading WLL", None, "29,309.0"), ("2", "Trading Rayyan", None, None), ("3", "Gulf Packaging Industries", None, None), ("4", None, "شركة الريان للتجارة", None), ("5", None, None, None), ("6", "", "", "N/A"), ("1", "Al Rayyan Trading WLL", None, "29,309.0"), ("7", "Nasser Trading", None, None)]
    right = [("a", "AL RAYYAN TRADING W.L.L.", "29309/2"), ("b", "Gulf Packagng Industries Co", None), ("c", "Nisr Trading", None), ("d", None, None), ("d", None, None), ("e", "Rayyan Trading", None)]
    got = run(spark, left, right)
    assert got[("1", "a")] == ("cr", 1.0, 0) and got[("1", "e")] == ("name_exact", 1.0, 0) and got[("2", "e")] == ("name_exact", 0.99, 0)
    assert got[("3", "b")][0] == "name_fuzzy" and got[("3", "b")][1] >= 0.92 and got[("3", "b")][2] == 1
    assert got[("4", "a")][0] == "name_translit" and ("7", "c") not in got
    assert not any(k[0] in "56" or k[1] == "d" for k in got)
    assert {m for m, _, _ in run(spark, left, right, fuzzy=1.0, translit=1.0).values()} == {"cr", "name_exact"}
    assert run(spark, [left[4]], right) == {}


def test_segments_lose_no_pair(spark):
    rng = random.Random(2)
    words = ["".join(rng.choice("bdfgklm") for _ in range(rng.randrange(6, 16))) for _ in range(60)]
    def slip(w):
        for _ in range(rng.randrange(0, 3)):
            i = rng.randrange(len(w))
            w = rng.choice([w[:i] + w[i + 1 :], w[:i] + "x" + w[i:], w[:i] + "y" + w[i + 1 :]])
        return w
    asked = [slip(w) for w in words]
    q = spark.createDataFrame([(True, [w]) for w in asked], "arabic boolean, forms array<string>")
    n = spark.createDataFrame([(False, [w]) for w in words], "arabic boolean, forms array<string>")
    for least in (0.9, 0.8):
        got = {(r["query"], r["form"]) for r in resolve.translit_pairs(q, n, least).collect()}
        assert got == {(a, b) for a in set(asked) for b in set(words) if len(a) >= 6 and plain_ratio(a, b) >= least}


def test_fuzzy_is_what_the_rarest_words_allow(spark):
    names = ["alpha beta trading", "alpha betta trading", "gamma trading", "gama trading", "delta services trading"]
    q = spark.createDataFrame([(False, n) for n in names], "arabic boolean, norm string")
    words = {(r["query"], r["word"]) for r in resolve.rarest_words(q, q).collect()}
    assert ("gamma trading", "gamma") in words and ("delta services trading", "trading") not in words
    got = {(r["query"], r["norm"]): r["score"] for r in resolve.fuzzy_pairs(q, q, 0.9).collect()}
    assert got == {("alpha beta trading", "alpha betta trading"): 0.973, ("alpha betta trading", "alpha beta trading"): 0.973, ("gama trading", "gamma trading"): 0.96, ("gamma trading", "gama trading"): 0.96}


def test_parties_and_summary(spark):
    book = spark.createDataFrame([("1", "Al Rayyan Trading", None, "5")], LEFT)
    cp = spark.createDataFrame([("1", "Gulf Packaging", "vendor"), ("1", " ", "vendor"), (None, "x", "buyer"), ("2", "Doha Steel", "?")], "client_id string, name string, direction string")
    p = resolve.parties(book, cp)
    assert sorted((r.client_id, r.relation, r.party_key, r.client_name) for r in p.collect()) == [("1", "self", "", "Al Rayyan Trading"), ("1", "supplier", "GULF PACKAGING", "Al Rayyan Trading"), ("2", "counterparty", "DOHA STEEL", None)]
    companies = spark.createDataFrame([("a", "Al Rayan Trading", None), ("b", "Gulf Packaging WLL", None)], RIGHT)
    m = resolve.match_parties(p, companies, ["rid"])
    got = {(r.relation, r.rid): (r.method, r.needs_review) for r in m.collect()}
    assert got == {("self", "a"): ("name_fuzzy", 1), ("supplier", "b"): ("name_exact", 1)}
    s = resolve.match_summary(m, "client_id").first()
    assert (s.matches, s.entities, s.name_exact, s.name_fuzzy, s.needs_review) == (2, 1, 1, 1, 1)
    assert resolve.match_summary(m.where(F.lit(False)), "client_id").first().matches == 0
