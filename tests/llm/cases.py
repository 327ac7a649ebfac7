"""Rows that every operator has to live with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LONG = "alpha beta " * 20_000
ODD_TEXTS = [
    (1, "One two three four five six seven."),
    (1, "One two three four five six seven."),
    (2, ""),
    (3, None),
    (None, "no id here, none at all"),
    (None, None),
    (4, LONG),
    (5, "x" * 50_000),
    (6, " \t\n\r\n  "),
    (7, "ünï 😀 日本語\u0000 ▁ end\n"),
    (8, "One two three four five six seven."),
    (9, "line one\nline two\nline three\n"),
    (10, "line one\nline two\nline three\n"),
]
# Names that operators use within.
CLASHING = ("h", "row", "line", "fp", "uid", "begin", "words", "hits", "score", "base", "all", "kept", "key", "label", "at", "y", "n")


def odd_documents(spark: SparkSession, clash: bool = True) -> DataFrame:
    docs = spark.createDataFrame(ODD_TEXTS, "doc_id long, text string")
    return docs.selectExpr("*", *(f"'c' as {c}" for c in CLASHING)) if clash else docs


def no_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
