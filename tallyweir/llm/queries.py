"""Queries p7 to p10 and the SQL they are held against."""

from __future__ import annotations

from tallyweir.llm import language, leakage, linkage, tokenizer
from tallyweir.session import table

QUERIES = {
    "p7_found": lambda spark, d: linkage.same_companies(table(spark, d, "customers"), table(spark, d, "classified_company")),
    "p7_confidence": lambda spark, d: linkage.link(table(spark, d, "customers"), table(spark, d, "classified_company")),
    "p10_found": lambda spark, d: language.cases(language.label_lines(table(spark, d, "documents"))),
    "p10_lines": lambda spark, d: language.label_lines(table(spark, d, "documents")),
    "p9_found": lambda spark, d: leakage.leaks(table(spark, d, "documents"), table(spark, d, "eval_item")),
    "p9_spans": lambda spark, d: leakage.leaked_spans(table(spark, d, "documents"), table(spark, d, "eval_item")),
    "p8_ids": lambda spark, d: tokenizer.encode(table(spark, d, "documents")),
    "p8_round_trip": lambda spark, d: tokenizer.decode(tokenizer.encode(table(spark, d, "documents"))),
}

ORACLES = {
    "p8_round_trip": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
}
