"""Exact quantiles of a column of any size."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from wayfact.session import materialize

ACCURACY = 10_000  # percentile_approx is off by n / ACCURACY ranks at most
SMALL = 100_000  # values that one exact aggregation may hold


@dataclass
class _Search:
    """The value of 1-based ``rank`` among the values strictly between two bounds."""

    rank: int
    low: float | None = None
    high: float | None = None
    found: float | None = None


def exact_quantiles(
    df: DataFrame, column: str, probabilities: Sequence[float], small: int = SMALL, accuracy: int = ACCURACY
) -> list[float | None]:
    """The values at the given ranks (``percentile_disc``), without sorting the column.

    The column alone is stored and read. A round takes a bracket around each rank from
    ``percentile_approx``, whose error is bounded for any distribution, and counts what
    lies below, on and between its ends. A rank on an end is found; otherwise the values
    strictly between are at most a small share of those before. Once they are few, one
    exact aggregation picks the value: three reads for up to ``small`` times ``accuracy``
    / 8 rows, two more for each such factor beyond. One row a round reaches the driver.
    NaN and nulls are left out; infinities are values like others.
    """
    values = df.select(F.col(column).cast("double").alias("v"))
    values = materialize(values.where(F.col("v").isNotNull() & ~F.isnan("v")), "values")
    count = values.count()
    if not count:
        return [None] * len(probabilities)
    searches = [_Search(max(1, math.ceil(p * count))) for p in probabilities]
    sizes = [count] * len(searches)
    while any(s.found is None for s in searches):
        open_ = [i for i, s in enumerate(searches) if s.found is None]
        few = [i for i in open_ if sizes[i] <= small]
        many = [i for i in open_ if sizes[i] > small]
        if few:
            _pick(values, [searches[i] for i in few], [sizes[i] for i in few])
        if many:
            narrowed = _narrow(values, [searches[i] for i in many], [sizes[i] for i in many], accuracy)
            for i, size in zip(many, narrowed):
                sizes[i] = size
    return [s.found for s in searches]


def _inside(search: _Search) -> str:
    tests = [
        f"v {sign} double('{bound!r}')"
        for sign, bound in ((">", search.low), ("<", search.high))
        if bound is not None
    ]
    return " and ".join(tests) or "true"


def _pick(values: DataFrame, searches: list[_Search], sizes: list[int]) -> None:
    """Finds ranks among few values."""
    picks = [
        F.expr(
            f"percentile_disc({(s.rank - 0.5) / size!r}D) within group (order by v) filter (where {_inside(s)})"
        ).alias(f"s{i}")
        for i, (s, size) in enumerate(zip(searches, sizes))
    ]
    for search, value in zip(searches, values.agg(*picks).first()):
        search.found = value


def _narrow(values: DataFrame, searches: list[_Search], sizes: list[int], accuracy: int) -> list[int]:
    """Moves the bounds towards each rank; the numbers of values left between them."""
    brackets = []
    for i, (s, size) in enumerate(zip(searches, sizes)):
        share, margin = s.rank / size, 2 / accuracy
        ends = [max(0.0, share - margin), min(1.0, share + margin)]
        brackets.append(
            F.expr(f"percentile_approx(v, array({ends[0]!r}D, {ends[1]!r}D), {accuracy}) filter (where {_inside(s)})")
            .alias(f"s{i}")
        )
    counts = []
    ends = [tuple(pair) for pair in values.agg(*brackets).first()]
    for i, (s, (low, high)) in enumerate(zip(searches, ends)):
        a, b = (f"double('{x!r}')" for x in (low, high))
        for name, test in (
            ("below", f"v < {a}"),
            ("low", f"v = {a}"),
            ("inner", f"v > {a} and v < {b}"),
            ("high", f"v = {b} and {b} > {a}"),
        ):
            counts.append(F.expr(f"count_if({_inside(s)} and {test})").alias(f"{name}{i}"))
    row = values.agg(*counts).first()
    left = []
    for i, (s, (low, high), size) in enumerate(zip(searches, ends, sizes)):
        rank = s.rank
        for part, bounds, value in (
            ("below", (s.low, low), None),
            ("low", None, low),
            ("inner", (low, high), None),
            ("high", None, high),
            ("above", (high, s.high), None),
        ):
            held = size - sum(row[f"{n}{i}"] for n in ("below", "low", "inner", "high")) if part == "above" else row[f"{part}{i}"]
            if rank <= held:
                s.rank, s.found = rank, value
                if bounds:
                    s.low, s.high = bounds
                left.append(held)
                break
            rank -= held
    return left
