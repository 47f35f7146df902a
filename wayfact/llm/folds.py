"""The fixed split of labelled rows, shared by the operators that learn from labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wayfact.llm.common import prepare


def held_out(doc_id: Column) -> Column:
    """Rows that no label may be learned from: crc32 of the id's text, modulo 5, is 0."""
    remainder = F.crc32(doc_id.cast("string").cast("binary")) % 5
    return F.coalesce(remainder == 0, F.lit(False))


def training_labels(labels: DataFrame, label: str) -> DataFrame:
    """doc_id and label (0 or 1) outside the held-out fold, one row an id; nulls are left out."""
    prepare(labels.sparkSession)
    rows = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("label"))
    rows = rows.where("doc_id is not null and label in (0, 1)").where(~held_out(F.col("doc_id")))
    return rows.groupBy("doc_id").agg(F.max("label").alias("label"))
