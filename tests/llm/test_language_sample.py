from pyspark.sql import functions as F

from tallyweir.llm.language import Fit, sample_of


def test_copies_of_a_text_take_one_place(spark):
    """A text that holds most rows and whose hash comes first leaves the other places to other texts."""
    texts = spark.createDataFrame([(f"text {chr(97 + i)}",) for i in range(20)], "text string").orderBy(F.xxhash64("text"))
    order = [r.text for r in texts.collect()]
    rows = [(t, "fr") for t in order] + [(order[0], "fr")] * 50 + [(order[0], "FR-ca"), (order[1], "es"), (order[1], "es")]
    docs = spark.createDataFrame(rows, "text string, lang string")
    assert sample_of(docs, Fit(per_label=5)) == [(order[1], "es"), *((t, "fr") for t in sorted(order[:5]))]
    assert len(sample_of(docs, Fit(per_label=250))) == 21


def test_sample_is_bounded_in_rows_and_characters(spark):
    """Few hashes of a large label are ranked, and they are the first ones; very long texts are not fitted on."""
    many = [(f"text {i}", "fr") for i in range(400)] + [("lang " * 50, "es"), ("x" * 500, "es")]
    docs = spark.createDataFrame(many, "text string, lang string")
    first = [r.text for r in docs.where("lang = 'fr'").orderBy(F.xxhash64("text")).limit(5).collect()]
    got = sample_of(docs, Fit(per_label=5, most_chars=300))
    assert got == [("lang " * 50, "es"), *((t, "fr") for t in sorted(first))]


def test_a_label_of_copies_is_ranked_in_full(spark):
    """The bound that the row count sets leaves a label of many copies short; then all its hashes are ranked."""
    docs = spark.createDataFrame([("copy", "tr")] * 5000 + [(f"text {i}", "tr") for i in range(30)], "text string, lang string")
    assert len(sample_of(docs, Fit(per_label=10))) == 10 and sample_of(docs.limit(0), Fit()) == []
