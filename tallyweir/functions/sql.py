"""The library's functions for SQL text: temporary functions of a session, all but the similarities plain expressions."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tallyweir.functions import dates, similarity, text

#: name: (type, the expression over one text). Expressions with lambdas have no SQL text; names are normalised by columns.
EXPRESSIONS = {
    "is_arabic": ("boolean", text.is_arabic), "strip_accents": ("string", text.strip_accents), "cr_root": ("string", text.cr_root), "parse_money": ("double", text.parse_money), "norm_label": ("string", text.norm_label),
    "html_fingerprint": ("string", text.html_fingerprint), "party_direction": ("string", text.direction), "tender_state_rank": ("int", text.state_rank), "parse_day": ("date", dates.parse_date), "iso_day": ("date", dates.iso_date),
}


def register(spark: SparkSession) -> list[str]:
    """Registers the functions as temporary SQL functions; returns their names. They are expanded into their expressions, so they stay inside code generation."""
    jvm = spark.sparkContext._jvm
    for name, (kind, build) in EXPRESSIONS.items():
        tree = spark.createDataFrame([], "x string").select(build(F.col("x")).alias("y"))
        body = jvm.scala.jdk.javaapi.CollectionConverters.asJava(tree._jdf.queryExecution().analyzed().expressions())[0]
        sql = body.child().sql()
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(x STRING) RETURNS {kind} RETURN {sql}")
    spark.udf.register("indel_ratio", similarity.indel_ratio)
    return [*EXPRESSIONS, "indel_ratio"]
