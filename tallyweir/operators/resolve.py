"""Resolution of a book of names against companies by a ladder of evidence: number, exact name, similar name, transliteration.

Each side is read once and its names are normalised once; distinct normalised names are compared, so a name that fills a third
of the rows is looked up once. Each rung is an equi-join on the number or on name keys, or compares names in blocks (``blocks``): those that hold one of a
query's two rarest words, and for transliteration the skeletons of the two scripts. The best evidence per pair wins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyweir.functions import text
from tallyweir.functions.similarity import MIN_SKELETON, indel_ratio, length_bound, sorted_words
from tallyweir.operators.blocks import similar_pairs
from tallyweir.session import among, cut, written

FUZZY, TRANSLIT = 0.92, 0.90
NARRATED_FUZZY, NARRATED_TRANSLIT = 0.97, 0.96
#: Names of a block: so many, or so few where the threshold lets most pairs through; skeletons of a block.
SIDE, FEW, FORMS = 65536, 512, 16384
METHODS = ["cr", "name_exact", "name_fuzzy", "name_translit"]


def name_table(rows: DataFrame, id_col: str, names: list[str], forms: bool = True, number: str | None = None) -> DataFrame:
    """id, norm, canon, arabic, forms (if asked for) of each distinct non-empty name of a row, written. With a number, that of the row too, in one of its rows or in one without a name."""
    listed = F.array_distinct(F.array_compact(F.array(*names)))
    if number is None:
        raw = rows.select(id_col, F.explode(listed).alias("raw"))
    else:
        once = F.when(F.coalesce(F.col("at"), F.lit(0)) == 0, F.col(number)).alias(number)
        raw = rows.select(id_col, number, F.posexplode_outer(listed).alias("at", "raw")).select(id_col, once, "raw").where(F.col("raw").isNotNull() | F.col(number).isNotNull())
    named = raw.withColumn("norm", text.normalize_name(F.col("raw"))).withColumn("canon", text.key_of(F.col("norm"))).withColumn("arabic", text.is_arabic(F.col("raw")))
    # Empty ones are left out after it is written: before, each name would be normalised for the test and again for its value.
    done = written((named.withColumn("forms", text.skeleton_forms(F.col("raw"))) if forms else named).drop("raw"), "names", compression="zstd")
    return done if number else done.where("norm <> ''")


def _rarest(queries: DataFrame, names: DataFrame, words: int) -> DataFrame:
    """rarest_words() with unless (the query's rarest word, null for that word itself), twice (the query is one of both scripts) and df (the names that hold the word). names are distinct."""
    held = names.select("arabic", F.explode(F.array_distinct(F.split("norm", " "))).alias("word")).groupBy("arabic", "word").agg(F.count("*").alias("df"))
    scripts = queries.groupBy(F.col("norm").alias("query")).agg(F.min("arabic").alias("low"), F.max("arabic").alias("high"))
    twice = F.col("low") != F.col("high")
    asked = scripts.select("query", twice.alias("twice"), F.explode(F.when(twice, F.array("low", "high")).otherwise(F.array("low"))).alias("arabic")).select("arabic", "query", "twice", F.explode(F.array_distinct(F.split("query", " "))).alias("word"))
    order = Window.partitionBy("arabic", "query").orderBy("df", "word")  # a name's few words
    ranked = asked.join(held, ["arabic", "word"]).withColumn("r", F.row_number().over(order)).withColumn("unless", F.when(F.col("r") > 1, F.first("word").over(order)))
    return ranked.where(F.col("r") <= words).drop("r")


def rarest_words(queries: DataFrame, names: DataFrame, words: int = 2) -> DataFrame:
    """query, arabic, word: of each query name the words that the fewest distinct names of its script hold (ties: the word)."""
    return _rarest(queries, names.select("arabic", "norm").distinct(), words).select("arabic", "word", "query")


def fuzzy_pairs(queries: DataFrame, names: DataFrame, least: float) -> DataFrame:
    """query, norm, score of the distinct normalised names that share a rarest word and are similar enough, not equal."""
    names = written(names.select("arabic", "norm").distinct(), "norms", compression="zstd")
    held = names.select("arabic", F.col("norm").alias("b"), F.explode(F.array_distinct(F.split("norm", " "))).alias("word"))
    asked = written(_rarest(queries, names, 2).withColumnRenamed("query", "a"), "asked", compression="zstd")
    pairs = similar_pairs(asked.where("not twice").drop("twice"), held, ["arabic", "word"], least, SIDE if least >= 0.8 else FEW, True, "df").select("a", "b", "score")
    if not asked.where("twice").isEmpty():  # names of digits alone are of both scripts, and their pairs could come twice
        both = asked.where("twice").join(held, ["arabic", "word"]).where("a <> b").select("a", "b").distinct()
        texts = sorted_words(F.col("a")), sorted_words(F.col("b"))
        pairs = pairs.unionByName(both.where(length_bound(*texts, least)).withColumn("score", indel_ratio(*texts)).where(F.col("score") >= least).withColumn("score", F.round("score", 3)))
    return pairs.select(F.col("a").alias("query"), F.col("b").alias("norm"), "score")


def translit_pairs(queries: DataFrame, names: DataFrame, least: float) -> DataFrame:
    """query form, form, score of skeletons of the other script with ratio ``least`` or more; both of at least MIN_SKELETON letters."""
    forms = lambda d, as_, arabic: d.select(arabic.alias("arabic"), F.explode("forms").alias(as_)).where(F.length(as_) >= MIN_SKELETON).distinct()
    q = cut(forms(queries, "a", F.col("arabic"))).withColumn("unless", F.lit(None).cast("string"))
    pairs = similar_pairs(q, cut(forms(names, "b", ~F.col("arabic"))), ["arabic"], least, FORMS)
    return pairs.select(F.col("a").alias("query"), F.col("b").alias("form"), "arabic", "score")


def class_digest(columns: list[str]):
    """128 bits that tell rows with equal texts in columns from all others, nulls from ''; two classes agree by chance once in about 2^128."""
    said = [F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("-")) for c in columns]
    return F.unhex(F.md5(F.concat(*said)))


def numbered(rows: DataFrame, columns: list[str], out: str) -> DataFrame:
    """The distinct values of columns with a number of their own; cut, so that the numbers stay. Nulls are values like others, and no two classes meet by chance.

    They lie in as many parts as the session shuffles into: what is done with names costs far more than their bytes tell.
    """
    spark = rows.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return cut(rows.select(*columns).distinct().repartition(parts).withColumn(out, F.monotonically_increasing_id()))


def members(rows: DataFrame, classes: DataFrame, columns: list[str], out: str) -> DataFrame:
    """rows with the number of their class."""
    said = classes.select(out, *(F.col(c).alias(f"__{c}") for c in columns))
    same = reduce(lambda x, y: x & y, (F.col(c).eqNullSafe(F.col(f"__{c}")) for c in columns))
    return rows.join(said, same).drop(*(f"__{c}" for c in columns))


def _key(columns: list[str]):
    return F.col(columns[0]) if len(columns) == 1 else F.struct(*columns)


def match(left: DataFrame, right: DataFrame, left_key: list[str], right_key: list[str], left_names: list[str], right_names: list[str], fuzzy: float = FUZZY, translit: float = TRANSLIT, qfc: bool = False) -> DataFrame:
    """left_key, right_key, method, score, needs_review: of each pair with any evidence the best (method first, then score).

    left, right: their keys, names and cr_number. A threshold of 1 or more leaves its rung out. Null and empty names and
    numbers match nothing; repeated rows count once; a key whose rows differ is matched by any of them.
    """
    # Repeated rows go first, else a pair of them would be found as often as one is repeated times the other.
    sides = [(d.select(_key(key).alias(c), *names, "cr_number").distinct(), c, names) for d, key, c, names in ((left, left_key, "l", left_names), (right, right_key, "r", right_names))]
    spark = left.sparkSession
    # Skeletons cost far more than the names' bytes tell, so they are spread over as many parts as the session shuffles into.
    spread = lambda d: d.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))) if translit < 1 else d
    l_all, r_all = (name_table(spread(d.withColumn("root", text.cr_root(F.col("cr_number"), qfc))), c, names, translit < 1, "root") for d, c, names in sides)
    q, n = (d.where("norm <> ''") for d in (l_all, r_all))
    # The best evidence of a pair is the least: its rank, then its score, of three places.
    as_ = lambda d, method, score: d.select("l", "r", (F.lit(2000 * METHODS.index(method) + 1000) - F.round(score * 1000).cast("int")).alias("evidence"))
    numbers = lambda d, c: d.select(c, "root").where("root is not null").distinct()
    found = as_(numbers(l_all, "l").join(numbers(r_all, "r"), "root"), "cr", F.lit(1.0))
    # Equal forms have equal keys, so one join finds both.
    q_keys, n_keys = q.select("l", F.col("norm").alias("query"), "canon"), n.select("r", "norm", "canon")
    alike = among(q_keys, ["canon"], n_keys.select("canon")).join(among(n_keys, ["canon"], q_keys.select("canon")), "canon")
    found = found.unionByName(as_(alike, "name_exact", F.when(F.col("query") == F.col("norm"), 1.0).otherwise(0.99)))
    # Each rung is written: one after the other they take less of the driver than all in one plan.
    if fuzzy < 1:
        near = written(fuzzy_pairs(q, n, fuzzy), "near", compression="zstd")
        asked, held = among(q.select("l", F.col("norm").alias("query")), ["query"], near.select("query")), among(n.select("r", "norm"), ["norm"], near.select("norm"))
        found = found.unionByName(as_(asked.join(near, "query").join(held, "norm"), "name_fuzzy", F.col("score")))
    if translit < 1:
        near = translit_pairs(q, n, translit)
        spelled = lambda d, k, form, flip: d.select(k, F.explode("forms").alias(form), (~F.col("arabic") if flip else F.col("arabic")).alias("arabic"))
        found = found.unionByName(cut(as_(spelled(q, "l", "query", False).join(near, ["query", "arabic"]).join(spelled(n, "r", "form", True), ["form", "arabic"]), "name_translit", F.col("score"))))
    rank, score = F.floor(F.col("evidence") / 2000).cast("int"), (1000 - F.pmod(F.col("evidence"), F.lit(2000))) / 1000
    pairs = found.groupBy("l", "r").agg(F.min("evidence").alias("evidence"))
    named = [F.col(k if len(keys) == 1 else f"{k}.{name}").alias(name) for keys, k in ((left_key, "l"), (right_key, "r")) for name in keys]
    return pairs.select(*named, F.element_at(F.array(*map(F.lit, METHODS)), rank + 1).alias("method"), score.alias("score"), (rank >= 2).cast("int").alias("needs_review"))


def parties(book: DataFrame, counterparties: DataFrame) -> DataFrame:
    """One list of all names to resolve: the book's own (relation self, empty party_key) and the clients' counterparties.

    The client's name is the first (least) of the book. Counterparties without client or name are left out.
    """
    first = book.where("customer_id is not null").groupBy(F.col("customer_id").alias("client_id")).agg(F.min("name").alias("client_name"))
    own = book.select(F.col("customer_id").alias("client_id"), F.lit("self").alias("relation"), F.lit("").alias("party_key"), "name", "name_ar", "cr_number")
    others = counterparties.where("client_id is not null and trim(name) <> ''").select("client_id", text.direction(F.col("direction")).alias("relation"), F.upper("name").alias("party_key"), "name", F.lit(None).cast("string").alias("name_ar"), F.lit(None).cast("string").alias("cr_number"))
    return own.unionByName(others).where("client_id is not null").join(first, "client_id", "left")


def match_parties(all_parties: DataFrame, companies: DataFrame, keys: list[str]) -> DataFrame:
    """The ladder for parties: the book's names at the usual bars, counterparties (names from narrations) at stricter ones and always for review."""
    key = ["client_id", "relation", "party_key"]
    run = lambda rows, f, t: match(rows, companies, key, keys, ["name", "name_ar"], ["name"], f, t)
    own = run(all_parties.where("relation = 'self'"), FUZZY, TRANSLIT)
    others = run(all_parties.where("relation <> 'self'"), NARRATED_FUZZY, NARRATED_TRANSLIT)
    return own.unionByName(others.withColumn("needs_review", F.lit(1)))


def match_summary(matches: DataFrame, left_key: str) -> DataFrame:
    """One row: matches, matched entities, matches by method, and for review by method."""
    by = [F.count_if(F.col("method") == m).alias(m) for m in METHODS]
    return matches.agg(F.count("*").alias("matches"), F.count_distinct(left_key).alias("entities"), *by, F.count_if(F.col("method").isin(METHODS[2:])).alias("needs_review"))
