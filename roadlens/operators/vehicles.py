"""Vehicle mix: preparation, totals by class, shares, situation, weekday and daily trend."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.functions import scalars
from roadlens.operators import reshape
from roadlens.schemas import VEHICLE_CLASSES

REQUIRED = sorted(set(scalars.CANONICAL_HEADERS.values()))
_CLASS_TOTALS = {
    "CarCount": "total_cars",
    "BikeCount": "total_bikes",
    "BusCount": "total_buses",
    "TruckCount": "total_trucks",
}


def prepare(raw: DataFrame) -> DataFrame:
    """Clean headers, typed counts, usable rows only, hour of the clock text and two shares."""
    table = reshape.require_columns(reshape.canonical_columns(raw), REQUIRED)
    numbers = [*VEHICLE_CLASSES, "Total"]
    typed = reshape.as_numbers(table, numbers)
    usable = reshape.keep_known(typed, ["Time", "DayOfWeek", "TrafficSituation"])
    filled = reshape.fill_constants(usable, numbers=numbers)
    hours = filled.withColumn("Time_hour", scalars.clock_hour(F.col("Time").cast("string")))
    return with_shares(reshape.keep_known(hours, ["Time_hour"]))


def with_shares(mix: DataFrame) -> DataFrame:
    total, heavy = F.col("Total"), F.col("BusCount") + F.col("TruckCount")
    return mix.withColumns(
        {
            "Car_ratio": scalars.safe_share(F.col("CarCount"), total),
            "Heavy_ratio": scalars.safe_share(heavy, total),
        }
    )


def totals(mix: DataFrame) -> DataFrame:
    sums = [F.sum(name).alias(alias) for name, alias in _CLASS_TOTALS.items()]
    return mix.agg(
        *sums, F.sum("Total").alias("grand_total"), F.count(F.lit(1)).alias("records")
    )


def composition(mix: DataFrame) -> DataFrame:
    """One row per vehicle class: its total and its percentage of all classes together."""
    row = totals(mix).select(*_CLASS_TOTALS.values())
    everything = sum((F.col(name) for name in _CLASS_TOTALS.values()), F.lit(0))
    tall = row.withColumn("everything", everything).unpivot(
        "everything", list(_CLASS_TOTALS.values()), "vehicle_class", "vehicles"
    )
    share = scalars.safe_share(F.col("vehicles") * 100.0, F.col("everything"))
    return tall.select("vehicle_class", "vehicles", share.alias("share_percent"))


def by_situation(mix: DataFrame) -> DataFrame:
    return mix.groupBy("TrafficSituation").agg(
        F.count(F.lit(1)).alias("records"), F.avg("Total").alias("average_total_vehicles")
    )


def by_weekday(mix: DataFrame) -> DataFrame:
    """Mean total per weekday, busiest first."""
    grouped = mix.groupBy("DayOfWeek").agg(F.avg("Total").alias("average_total_vehicles"))
    return grouped.orderBy(F.col("average_total_vehicles").desc(), "DayOfWeek")


def daily_trend(mix: DataFrame) -> DataFrame:
    """Mean total per clock time."""
    return mix.groupBy("Time").agg(F.avg("Total").alias("average_total_vehicles"))
