"""Sums, averages and ratios that do not depend on the order of the rows.

Adding doubles gives a different last digit for every partitioning, and a
rounded average then flips. Each value is therefore rounded to six decimals, kept as
a ``bigint`` of whole units, and summed in two halves: the high part and the low 16
bits. Both halves stay in ``bigint`` inside generated code (decimal sums were about
eight times slower when measured) and meet in a decimal only once per group. The low
half overflows after 1.4e14 rows, the high half after 6e23 divided by the largest
unit: 6e12 rows of values of 1e5.

Values beyond ``LIMIT`` raise an error. NaN and infinities are not counted in units;
``unusual`` adds them up by themselves, and an average or sum takes its value from
there if it has any, as ``avg`` and ``sum`` would.

Arguments are SQL expressions, results are columns.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

PLACES = 6
LOW_BITS = 16
LOW_MASK = (1 << LOW_BITS) - 1
LIMIT_UNITS = 9e18


def units(value: str, places: int = PLACES) -> str:
    """``value`` as whole units of 10**-places, half rounded up.

    Null for NaN and infinities; an error for finite values too large for a bigint.
    """
    number = f"cast(({value}) as double)"
    return (
        f"(case when abs({number}) <= {LIMIT_UNITS / 10**places!r}D "
        f"then floor({number} * {10**places}D + 0.5D) "
        f"when abs({number}) < double('Infinity') "
        f"then cast(raise_error('a value is too large to be summed exactly') as bigint) end)"
    )


def unusual(value: str) -> str:
    """Sum of the NaN and infinite values, null without any (aggregate)."""
    number = f"cast(({value}) as double)"
    return f"sum(case when isnan({number}) or abs({number}) = double('Infinity') then {number} end)"


def high_part(whole: str) -> str:
    return f"shiftright({whole}, {LOW_BITS})"


def low_part(whole: str) -> str:
    return f"({whole} & {LOW_MASK}L)"


def joined_parts(high: str, low: str) -> str:
    """The exact total from the two summed halves."""
    return f"(cast({high} as decimal(20,0)) * {1 << LOW_BITS} + cast({low} as decimal(20,0)))"


def total(whole: str) -> str:
    """Exact sum of whole units (aggregate)."""
    return joined_parts(f"sum({high_part(whole)})", f"sum({low_part(whole)})")


def ratio(numerator: str, denominator: str, places: int) -> Column:
    """``numerator/denominator`` of whole numbers, rounded half away from zero.

    Null when the denominator is zero or null. The denominator is never negative.
    """
    num = f"cast({numerator} as decimal(28,0))"
    den = f"cast({denominator} as decimal(28,0))"
    whole = f"(abs({num}) * {2 * 10**places} + {den}) div (nullif({den}, 0) * 2)"
    sign = f"case when {num} < 0 then -1 else 1 end"
    return F.expr(f"cast({sign} * ({whole}) as double) / {10**places}D")


def percent(part: str, whole: str, places: int = 2) -> Column:
    """``100 * part / whole`` rounded to ``places`` digits."""
    return ratio(f"(cast({part} as decimal(20,0)) * 100)", whole, places)


def mean_of_parts(high: str, low: str, count: str, places: int, odd: str = "null") -> Column:
    """The average from the two summed halves, the count and the sum of unusual values."""
    scale = f"(cast({count} as decimal(20,0)) * {10**PLACES})"
    return F.coalesce(F.expr(f"cast({odd} as double)"), ratio(joined_parts(high, low), scale, places))


def mean(value: str, places: int = 2) -> Column:
    """Average of the non-null values, rounded to ``places`` digits (aggregate)."""
    whole = units(value)
    return mean_of_parts(
        f"sum({high_part(whole)})",
        f"sum({low_part(whole)})",
        f"count({value})",
        places,
        unusual(value),
    )


def sum_of(value: str, places: int = 2) -> Column:
    """Sum of the non-null values, rounded to ``places`` digits (aggregate)."""
    finite = ratio(total(units(value)), str(10**PLACES), places)
    return F.coalesce(F.expr(unusual(value)), finite)


def difference(left: str, right: str, places: int = 2) -> Column:
    """``left - right`` of two values already rounded to ``places`` digits."""
    gap = f"{units(left, places)} - {units(right, places)}"
    return F.expr(f"cast({gap} as double) / {10**places}D")


def weighted_mean(value: str, weight: str, places: int = 2) -> Column:
    """``sum(value*weight)/sum(weight)`` of values rounded to ``places`` (aggregate)."""
    whole = units(value, places)
    # decimal before the product: a rolled-up weight can be any bigint
    products = f"sum(cast({whole} as decimal(18,0)) * cast({weight} as decimal(19,0)))"
    return ratio(
        products, f"(cast(sum({weight}) as decimal(20,0)) * {10**places})", places
    )


def mean_of_rounded(value: str, places: int = 2) -> Column:
    """Unweighted average of values already rounded to ``places`` (aggregate)."""
    count = f"(cast(count({value}) as decimal(20,0)) * {10**places})"
    return ratio(f"sum({units(value, places)})", count, places)
