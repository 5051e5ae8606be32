"""Business rules as column expressions over the tables of fixed values below."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.config import DEFAULTS, Settings
from roadlens.functions.bands import (
    ceilings,
    ceilings_open,
    first_match,
    floors,
    floors_open,
    in_hours,
    lookup,
)

# ---------------------------------------------------------------- fixed values
# Junction counts.
VEHICLE_LEVELS = ((20, "Low Traffic"), (50, "Medium Traffic"))
VEHICLE_LEVEL_ABOVE = "High Traffic"
FLAT_FARES = ((50, 60), (20, 30))
PEAK_FARES = ((50, 60), (20, 40))
OFF_PEAK_FARES = ((50, 40), (20, 20))
BASE_FARE = 10
PEAK_HOURS = ((8, 11), (17, 20))
RUSH_HOURS = ((8, 10), (17, 20))

# Weather categories: first pattern found in the lower-case description wins.
WEATHER_SUMMARY = (
    ("clear", "Clear"),
    ("cloud", "Cloudy"),
    ("rain|drizzle", "Rainy"),
    ("fog|mist|haze|smoke", "Low Visibility"),
    ("thunder|storm", "Storm"),
)
WEATHER_REPORT = (
    ("clear", "Clear"),
    ("cloud", "Cloudy"),
    ("rain|drizzle", "Rainy"),
    ("thunder", "Storm"),
    ("snow|sleet", "Snow"),
    ("fog|mist|haze|smoke", "Low Visibility"),
)
WEATHER_TRAINING = (
    ("thunder|storm|squall|tornado", "Storm"),
    ("snow|sleet|blizzard|flurr", "Snow"),
    ("fog|mist|smoke|haze|dust|sand", "Low Visibility"),
    ("rain|drizzle|shower", "Rainy"),
    ("cloud|overcast", "Cloudy"),
    ("clear|sun", "Clear"),
)
WEATHER_LABELS = (
    ("thunder|storm", "Storm"),
    ("snow|sleet", "Snow"),
    ("fog|mist|haze|smoke", "Low Visibility"),
    ("rain|drizzle", "Rainy"),
    ("cloud", "Cloudy"),
    ("clear", "Clear"),
)
SEVERITY_TO_4 = {
    "Clear": 0,
    "Cloudy": 1,
    "Rainy": 2,
    "Low Visibility": 3,
    "Storm": 4,
    "Snow": 4,
}
SEVERITY_TO_5 = {
    "Clear": 0,
    "Cloudy": 1,
    "Rainy": 2,
    "Low Visibility": 3,
    "Snow": 4,
    "Storm": 5,
}
SEVERITY_OTHERWISE = 1

# Sub-scores: (bound, points).
STRICT_VISIBILITY = ((2, 2), (5, 1))
STRICT_POLLUTION = ((150, 2), (100, 1))
STRICT_VOLUME = ((6000, 2), (3000, 1))
INCLUSIVE_VISIBILITY = ((1, 2), (3, 1))
INCLUSIVE_POLLUTION = ((150, 2), (75, 1))
INCLUSIVE_VOLUME = ((6000, 2), (3000, 1))
SEVERITY_POINTS = ((4, 2), (2, 1))

# Risk levels from the total score.
ADDITIVE_LEVELS = ((6, "Severe"), (4, "High"), (2, "Moderate"))
BANDED_LEVELS = ((6, "Severe"), (4, "High"), (2, "Moderate"))
LOWEST_LEVEL = "Low"
RISK_REASONS = {
    "Severe": "High traffic + poor weather/visibility",
    "High": "Heavy traffic or bad weather",
    "Moderate": "Normal traffic with minor issues",
}
RISK_REASON_OTHERWISE = "Smooth conditions"

# Sensor speeds.
FREE_FLOW_QUANTILE = 0.95
SEVERE_FROM, MODERATE_FROM = 0.75, 0.30
FORECAST_LEVELS = ((75, "severe"), (55, "high"), (30, "moderate"))
CALM_LEVEL = "low"
MULTIPLIER_SLOPE = 2.5
ALERT_LEVELS = ("high", "severe")
ALERT_MULTIPLIER = 2.0

# Prices.
DEMAND_PER_DENSITY, DEMAND_PER_HOUR = 0.7, 0.8
FARE_FACTOR_PEAK, FARE_FACTOR_OFF_PEAK, FARE_FACTOR_SLOPE = 1.20, 0.90, 0.35
CONGESTION_CHARGES = {"severe": 12.0, "high": 8.0, "moderate": 4.0}
CONGESTION_CHARGE_BASE = 1.5
PARKING_BASE, PARKING_SLOPE, PARKING_PEAK = 2.0, 5.0, 1.5
# ------------------------------------------------------------ end fixed values


# Junction counts


def vehicle_level(vehicles: Column) -> Column:
    return ceilings(vehicles, VEHICLE_LEVELS, VEHICLE_LEVEL_ABOVE)


def flat_fare(vehicles: Column) -> Column:
    """Fare by volume alone; also used on predicted volumes."""
    return floors_open(vehicles, FLAT_FARES, BASE_FARE)


def peak_fare(vehicles: Column, is_peak: Column) -> Column:
    """Fare by volume, dearer in peak hours."""
    off_peak = floors_open(vehicles, OFF_PEAK_FARES, BASE_FARE)
    return F.when(is_peak, floors_open(vehicles, PEAK_FARES, BASE_FARE)).otherwise(off_peak)


def is_peak_hour(hour: Column) -> Column:
    return F.coalesce(in_hours(hour, PEAK_HOURS), F.lit(False))


def time_band(is_peak: Column) -> Column:
    return F.when(is_peak, "Peak Hour").otherwise("Off-Peak")


def is_rush_hour(hour: Column) -> Column:
    return F.coalesce(in_hours(hour, RUSH_HOURS), F.lit(False))


# Weather and road risk


def weather_category(description: Column, patterns, otherwise: str) -> Column:
    text = F.lower(F.trim(F.coalesce(description, F.lit("unknown"))))
    return first_match(((text.rlike(found), name) for found, name in patterns), otherwise)


def weather_severity(category: Column, scale: dict[str, int]) -> Column:
    return lookup(category, scale, SEVERITY_OTHERWISE)


@dataclass(frozen=True)
class RiskScheme:
    """One of the four published ways to turn road conditions into a risk level."""

    patterns: tuple[tuple[str, str], ...]
    no_pattern: str
    severity: tuple[tuple[str, int], ...]
    inclusive: bool  # thresholds include their bound
    banded: bool  # severity enters the total as 0, 1 or 2 points

    def category(self) -> Column:
        return weather_category(F.col("weather_description"), self.patterns, self.no_pattern)

    def sub_scores(self) -> dict[str, Column]:
        low, high = (ceilings, floors) if self.inclusive else (ceilings_open, floors_open)
        visibility = INCLUSIVE_VISIBILITY if self.inclusive else STRICT_VISIBILITY
        pollution = INCLUSIVE_POLLUTION if self.inclusive else STRICT_POLLUTION
        volume = INCLUSIVE_VOLUME if self.inclusive else STRICT_VOLUME
        return {
            "visibility_risk": low(F.col("visibility_in_miles"), visibility, 0),
            "pollution_risk": high(F.col("air_pollution_index"), pollution, 0),
            "traffic_risk": high(F.col("traffic_volume"), volume, 0),
        }

    def total(self) -> Column:
        severity = F.col("weather_severity")
        weather = floors(severity, SEVERITY_POINTS, 0) if self.banded else severity
        return (
            weather + F.col("visibility_risk") + F.col("pollution_risk") + F.col("traffic_risk")
        )

    def level(self) -> Column:
        levels = BANDED_LEVELS if self.banded else ADDITIVE_LEVELS
        return floors(F.col("total_risk_score"), levels, LOWEST_LEVEL)


def _scheme(patterns, no_pattern, severity, inclusive=False, banded=False) -> RiskScheme:
    return RiskScheme(patterns, no_pattern, tuple(severity.items()), inclusive, banded)


RISK_SCHEMES = {
    "summary": _scheme(WEATHER_SUMMARY, "Other", SEVERITY_TO_4),
    "report": _scheme(WEATHER_REPORT, "Other", SEVERITY_TO_4),
    "training": _scheme(WEATHER_TRAINING, "Cloudy", SEVERITY_TO_5, inclusive=True, banded=True),
    "labels": _scheme(WEATHER_LABELS, "Other", SEVERITY_TO_4),
}


def score_risk(roads: DataFrame, scheme: str | RiskScheme) -> DataFrame:
    """Adds category, severity, three sub-scores, total score and risk level. No shuffle."""
    rule = RISK_SCHEMES[scheme] if isinstance(scheme, str) else scheme
    severity = weather_severity(F.col("weather_category"), dict(rule.severity))
    return (
        roads.withColumn("weather_category", rule.category())
        .withColumns({"weather_severity": severity, **rule.sub_scores()})
        .withColumn("total_risk_score", rule.total())
        .withColumn("risk_level", rule.level())
    )


def risk_reason(level: Column) -> Column:
    return lookup(level, RISK_REASONS, RISK_REASON_OTHERWISE)


# Sensor speeds


def density_proxy(speed: Column, free_flow: Column) -> Column:
    """Share of the free-flow speed that is lost, never below 0."""
    lost = F.greatest(F.lit(0.0), 1 - F.try_divide(speed, free_flow))
    return F.when(free_flow > 0, lost).otherwise(0.0)


def congestion_level(proxy: Column, settings: Settings = DEFAULTS) -> Column:
    steps = (
        (SEVERE_FROM, "severe"),
        (settings.congestion_threshold, "high"),
        (MODERATE_FROM, "moderate"),
    )
    return floors(proxy, steps, CALM_LEVEL)


def travel_time_multiplier(proxy: Column) -> Column:
    return F.round(1 + proxy * MULTIPLIER_SLOPE, 3)


def is_peak_period(hour: Column, settings: Settings = DEFAULTS) -> Column:
    return in_hours(hour, (settings.morning_peak, settings.evening_peak))


def is_alert(level: Column, multiplier: Column) -> Column:
    return level.isin(*ALERT_LEVELS) | (multiplier >= ALERT_MULTIPLIER)


# Prices


def demand_index(density_score: Column, hour: Column) -> Column:
    return F.round(density_score * DEMAND_PER_DENSITY + hour * DEMAND_PER_HOUR, 2)


def fare_multiplier(proxy: Column, is_peak: Column) -> Column:
    base = F.when(is_peak, FARE_FACTOR_PEAK).otherwise(FARE_FACTOR_OFF_PEAK)
    return F.round(base + proxy * FARE_FACTOR_SLOPE, 2)


def congestion_charge(level: Column) -> Column:
    return lookup(level, CONGESTION_CHARGES, CONGESTION_CHARGE_BASE)


def parking_fee(proxy: Column, is_peak: Column) -> Column:
    peak = F.when(is_peak, PARKING_PEAK).otherwise(0.0)
    return F.round(PARKING_BASE + proxy * PARKING_SLOPE + peak, 2)
