"""Weather classes and the multipliers they and the zone density carry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Order-volume multiplier of a zone's density tier.
DENSITY_WEIGHT = {"high": 1.8, "medium": 1.0, "low": 0.5}

# Multiplier by condition, then the extra factor under a flash
# flood and under a heatwave.
DEMAND = ({"clear": 1.0, "rain": 1.15, "storm": 1.25, "snow": 1.20}, 1.15, 1.12)
ISSUE_RATE = ({"clear": 1.0, "rain": 1.2, "storm": 1.5, "snow": 1.6}, 1.4, 1.05)
TRAVEL_MEAN = ({"clear": 1.0, "rain": 1.15, "storm": 1.35, "snow": 1.5}, 1.25, 1.08)
TRAVEL_SD = ({"clear": 1.0, "rain": 1.3, "storm": 1.6, "snow": 1.8}, 1.4, 1.1)

# What a missing weather row stands for when a delivery is scored.
NO_WEATHER = {
    "condition": "clear",
    "is_flash_flood": False,
    "is_heatwave": False,
    "precipitation_mm": 0.0,
    "temp_high_c": 20.0,
}


def pick(value: Column, table: dict[str, float]) -> Column:
    pairs = [F.lit(x) for pair in table.items() for x in pair]
    return F.element_at(F.create_map(*pairs), value)


def density_weight(tier: Column) -> Column:
    return pick(tier, DENSITY_WEIGHT)


def condition(precipitation_mm: Column, temp_low_c: Column) -> Column:
    return (
        F.when((temp_low_c < 0) & (precipitation_mm > 0), "snow")
        .when(precipitation_mm > 25, "storm")
        .when(precipitation_mm > 0, "rain")
        .otherwise("clear")
    )


def flash_flood(precipitation_mm: Column) -> Column:
    return precipitation_mm > 45


def heatwave(day: Column, latitude: Column, temp_high_c: Column) -> Column:
    """June to September, and well above the seasonal peak of that latitude."""
    base = F.lit(28.0) - latitude * 0.55
    swing = F.lit(8.0) + latitude * 0.35
    return F.month(day).between(6, 9) & (temp_high_c > base + swing * 1.15)


def multiplier(rule: tuple, condition: Column, flood: Column, heat: Column) -> Column:
    by_condition, in_flood, in_heat = rule
    return (
        pick(condition, by_condition)
        * F.when(flood, in_flood).otherwise(1.0)
        * F.when(heat, in_heat).otherwise(1.0)
    )
