"""Expressions over dirty text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values.
NUMBER_PATTERN = r"[-+]?(?:\d+(?:\.\d*)?|\.\d+)"
TRACE_MARK = "T"
WORD_BREAK_PATTERN = "[^a-z']+"


def numeric_text(text: Column) -> Column:
    """The first number inside a text, null for blank text or none."""
    found = F.regexp_extract(F.trim(text), NUMBER_PATTERN, 0)
    return F.nullif(found, F.lit("")).try_cast("double")


def is_trace(text: Column) -> Column:
    """Whether an amount is reported as a trace; null for a missing report."""
    return F.upper(F.trim(text)) == TRACE_MARK


def trace_amount(text: Column) -> Column:
    """The reported amount, a trace counting as zero."""
    return F.when(is_trace(text), F.lit(0.0)).otherwise(numeric_text(text))


def words(line: Column) -> Column:
    """Lower-case words of a line as an array; edges of the line may give empty ones."""
    return F.split(F.lower(line), WORD_BREAK_PATTERN)
