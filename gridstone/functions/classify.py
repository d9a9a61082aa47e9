"""Threshold ladders. Conditions are tried from the top; the first that holds decides."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridstone import constants as K


def ladder(steps: list[tuple[Column, str]], default: str) -> Column:
    (first, label), *rest = steps
    case = F.when(first, label)
    for condition, label in rest:
        case = case.when(condition, label)
    return case.otherwise(default)


def quality_tier(score: Column) -> Column:
    return ladder([(score > 0.5, "high"), (score > 0, "medium")], "basic")


def hotspot_level(density: Column) -> Column:
    return ladder([(density >= 20, "high"), (density >= 10, "medium")], "low")


def hotspot_score(level: Column) -> Column:
    return F.when(level == "high", 1.0).when(level == "medium", 0.5).otherwise(0.0)


def comfort_level(temperature: Column, humidity: Column, wind: Column) -> Column:
    pleasant = temperature.between(15, 25) & humidity.between(30, 60) & (wind < 5)
    return ladder(
        [
            (pleasant, "comfortable"),
            ((temperature < 5) | (temperature > 30), "extreme"),
            ((humidity > 80) | (wind > 10), "uncomfortable"),
        ],
        "moderate",
    )


def season(month: Column) -> Column:
    return ladder(
        [(month.isin(12, 1, 2), "Winter"), (month.isin(3, 4, 5), "Spring"), (month.isin(6, 7, 8), "Summer")],
        "Autumn",
    )


def correlation_level(score: Column) -> Column:
    return ladder([(score >= 0.7, "high"), (score >= 0.4, "medium"), (score >= 0.1, "low")], "none")


def zone_risk(is_hotspot: Column, crimes: Column, assets: Column) -> Column:
    return ladder(
        [
            (is_hotspot & (assets > 10), "high_risk"),
            ((crimes > 5) & (assets > 5), "medium_risk"),
            ((crimes > 0) | (assets > 0), "low_risk"),
        ],
        "no_data",
    )


def area_risk(score: Column) -> Column:
    return ladder([(score >= 70, "high_risk"), (score >= 40, "medium_risk"), (score >= 10, "low_risk")], "minimal_risk")


def recommended_action(quality: Column, hotspot: Column) -> Column:
    poor, hot = quality < 0.5, hotspot >= 1.0
    return ladder([(poor & hot, K.ACTION_URGENT), (poor, K.ACTION_QUALITY), (hot, K.ACTION_SECURITY)], K.ACTION_ROUTINE)
