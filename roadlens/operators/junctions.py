"""Junction counts: fares and levels per row, and the summary tables over them.

Every summary is one grouped aggregate that combines before its shuffle; the extremes are
taken from the few grouped rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.functions import rules



def label_flat(counts: DataFrame) -> DataFrame:
    """Hour, level and the fare that depends on volume alone."""
    vehicles = F.col("Vehicles")
    return counts.withColumns(
        {
            "hour_of_day": F.hour("DateTime"),
            "traffic_level": rules.vehicle_level(vehicles),
            "dynamic_fare": rules.flat_fare(vehicles),
        }
    )


def label_peak(counts: DataFrame) -> DataFrame:
    """Hour, level, peak flag, time band and the fare that is dearer in peak hours."""
    vehicles, hour = F.col("Vehicles"), F.hour("DateTime")
    peak = rules.is_peak_hour(hour)
    return counts.withColumns(
        {
            "hour_of_day": hour,
            "traffic_level": rules.vehicle_level(vehicles),
            "is_peak_hour": peak.cast("int"),
            "time_band": rules.time_band(peak),
            "dynamic_fare": rules.peak_fare(vehicles, peak),
        }
    )


def _totals(fare_average: bool = False):
    columns = [
        F.count(F.lit(1)).alias("records"),
        F.sum("Vehicles").alias("total_vehicles"),
        F.avg("Vehicles").alias("average_vehicles"),
        F.sum("dynamic_fare").alias("total_fare"),
    ]
    if fare_average:
        columns.append(F.avg("dynamic_fare").alias("average_fare"))
    return columns


def cube(labeled: DataFrame) -> DataFrame:
    """Partial sums per junction, hour and level: the one scan behind all report tables."""
    keys = ["Junction", "hour_of_day", "traffic_level"]
    if "time_band" in labeled.columns:
        keys.append("time_band")
    return labeled.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("Vehicles").alias("counted"),
        F.sum("Vehicles").alias("vehicles"),
        F.sum("dynamic_fare").alias("fares"),
        F.min("DateTime").alias("first_time"),
        F.max("DateTime").alias("last_time"),
    )


def from_cube(partial: DataFrame, *keys: str, fare_average: bool = False) -> DataFrame:
    """The same tables as by(), dataset_range() and overall(), from the partial sums."""
    columns = [
        F.sum("rows").alias("records"),
        F.sum("vehicles").alias("total_vehicles"),
        F.try_divide(F.sum("vehicles"), F.sum("counted")).alias("average_vehicles"),
        F.sum("fares").alias("total_fare"),
    ]
    if fare_average:
        columns.append((F.sum("fares") / F.sum("rows")).alias("average_fare"))
    return partial.groupBy(*keys).agg(*columns) if keys else partial.agg(*columns)


def overall(labeled: DataFrame) -> DataFrame:
    return labeled.agg(*_totals())


def dataset_range(labeled: DataFrame) -> DataFrame:
    """First and last time, the span between them in seconds, and the totals."""
    first, last = F.min("DateTime"), F.max("DateTime")
    return labeled.agg(first.alias("start_time"), last.alias("end_time"), *_totals()).withColumn(
        "covered_seconds", F.timestamp_diff("SECOND", F.col("start_time"), F.col("end_time"))
    )


def by(labeled: DataFrame, *keys: str, fare_average: bool = False) -> DataFrame:
    """Totals per hour, junction, junction and hour, band, or band and level."""
    return labeled.groupBy(*keys).agg(*_totals(fare_average))


def hourly(labeled: DataFrame, hours: int | None = None) -> DataFrame:
    """Hour table in hour order; ``hours`` keeps the first so many rows only.

    Rows without a readable time are a group of their own, which comes first.
    """
    table = by(labeled, "hour_of_day").orderBy("hour_of_day")
    return table if hours is None else table.limit(hours)


def extremes(grouped: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One row: the key with the lowest and the one with the highest value.

    Among equal values the smallest key is the lowest and the largest key the highest.
    """
    rank = F.struct(value, *keys)
    key = F.struct(*keys, value)
    picked = grouped.agg(F.min_by(key, rank).alias("low"), F.max_by(key, rank).alias("high"))
    return picked.select(
        *[F.col(f"low.{name}").alias(f"lowest_{name}") for name in [*keys, value]],
        *[F.col(f"high.{name}").alias(f"highest_{name}") for name in [*keys, value]],
    )


def ranked(
    grouped: DataFrame, keys: Sequence[str], value: str, limit: int, highest: bool
) -> DataFrame:
    """The ``limit`` groups with highest or lowest value; equal values in key order."""
    order = F.col(value).desc() if highest else F.col(value).asc()
    return grouped.orderBy(order, *keys).limit(limit)


def commonest_level(labeled: DataFrame) -> DataFrame:
    counted = labeled.groupBy("traffic_level").agg(F.count(F.lit(1)).alias("records"))
    return ranked(counted, ["traffic_level"], "records", 1, highest=True)


def hourly_fit(scored: DataFrame, actual: str = "Vehicles") -> DataFrame:
    """Mean actual and mean predicted volume per hour of day."""
    return (
        scored.groupBy(F.hour("DateTime").alias("hour_of_day"))
        .agg(
            F.avg(actual).alias("average_actual"),
            F.avg("prediction").alias("average_predicted"),
        )
        .orderBy("hour_of_day")
    )
