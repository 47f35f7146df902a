"""Condition classes, payment labels and tip rates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

# Fixed values.
DRY, RAIN, HEAVY_RAIN, SNOW = "Dry", "Rain", "Heavy Rain", "Snow"
SNOW_TEXT = "snow|sn"
REPORT_ORDER = (DRY, RAIN, SNOW, HEAVY_RAIN)
SEASON_ORDER = ("Winter", "Spring", "Summer", "Fall")
PAYMENT_LABELS = {
    1: "credit_card",
    2: "cash",
    3: "no_charge",
    4: "dispute",
    5: "unknown",
    6: "voided",
}
CARD = 1


@dataclass(frozen=True)
class HourlyThresholds:
    snow_temperature: float = 1.0
    heavy_precipitation: float = 2.5


def hourly_condition(
    text: Column,
    temperature: Column,
    precipitation: Column,
    trace: Column,
    limits: HourlyThresholds = HourlyThresholds(),
) -> Column:
    """Class of one hour; a null measure never satisfies a branch."""
    wet = precipitation > 0
    return (
        F.when(F.lower(F.coalesce(text, F.lit(""))).rlike(SNOW_TEXT), SNOW)
        .when((temperature <= limits.snow_temperature) & wet, SNOW)
        .when(precipitation >= limits.heavy_precipitation, HEAVY_RAIN)
        .when(wet | trace, RAIN)
        .otherwise(DRY)
    )


def daily_condition(snow: Column, precipitation: Column, heavy: float = 0.5) -> Column:
    """Class of one day from its own totals."""
    return (
        F.when(snow > 0, SNOW)
        .when(precipitation >= heavy, HEAVY_RAIN)
        .when(precipitation > 0, RAIN)
        .otherwise(DRY)
    )


def worst_condition(snow: Column, heavy_rain: Column, rain: Column) -> Column:
    """Class of a day from flags saying which hourly classes occurred."""
    return (
        F.when(snow, SNOW).when(heavy_rain, HEAVY_RAIN).when(rain, RAIN).otherwise(DRY)
    )


def temperature_bin(temperature: Column) -> Column:
    return (
        F.when(temperature < 32, "Freezing")
        .when(temperature < 45, "Cold")
        .when(temperature < 60, "Mild")
        .otherwise("Warm")
    )


def payment_label(code: Column) -> Column:
    label = F.lit("other")
    for number, name in PAYMENT_LABELS.items():
        label = F.when(code == number, name).otherwise(label)
    return label


def card_tip_percentage(
    payment: Column, tip: Column, fare: Column, bounds: tuple[float, float] = (0.0, 200.0)
) -> Column:
    """Tip as a percentage of a card fare; null where undefined or implausible."""
    rate = tip / fare * F.lit(100.0)
    # the outer guard also keeps a zero fare away from the division
    return F.when(
        (payment == CARD) & (fare > 0), F.when(rate.between(*bounds), rate)
    )


def rank_in(value: Column, order: tuple[str, ...]) -> Column:
    """Sort position of a label; labels outside ``order`` come last."""
    position = F.lit(len(order) + 1)
    for index, name in enumerate(order, start=1):
        position = F.when(value == name, index).otherwise(position)
    return position
