"""Small tables with awkward rows, shared by the tests of the text operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
EXTRA = "kept string, score string, place int, ids string, rule string"


def words(n: int, seed: int = 0) -> str:
    """Distinct made-up words."""
    return " ".join(f"w{seed}x{i}" for i in range(n))


def documents(spark: SparkSession, rows: list[tuple], extra: bool = False) -> DataFrame:
    """Rows of (doc_id, text); with ``extra``, columns whose names operators use themselves."""
    full = [(i, text, "en", "src", None if text is None else len(text)) for i, text in rows]
    schema = SCHEMA
    if extra:
        full = [(*row, "x", "y", 7, "z", "r") for row in full]
        schema = f"{SCHEMA}, {EXTRA}"
    return spark.createDataFrame(full, schema)


def awkward(spark: SparkSession) -> DataFrame:
    """Null and empty texts, a null id, repeated rows, ties, one very long text and word."""
    rows = [
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (None, words(40, 9)),
        (4, words(60, 1)),
        (4, words(60, 1)),
        (5, words(60, 1)),
        (6, words(30_000, 2)),
        (7, "x" * 20_000),
        (8, "é" * 5_000 + " ü\x00\u2028 \u3000" + words(25, 3)),
        (None, None),
    ]
    return documents(spark, rows, extra=True)


def empty(spark: SparkSession) -> DataFrame:
    return documents(spark, [], extra=True)
