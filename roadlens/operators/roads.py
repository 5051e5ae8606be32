"""Road conditions: risk tables and risk transitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import functions as F

from roadlens.functions import rules
from roadlens.operators.ordered import ordered_columns


def with_hour(roads: DataFrame) -> DataFrame:
    return roads.withColumn("hour", F.hour("date_time"))


def intelligence(roads: DataFrame) -> DataFrame:
    """Hour, rush-hour flag, risk level and the sentence that explains it."""
    rush = rules.is_rush_hour(F.col("hour")).cast("int")
    flagged = with_hour(roads).withColumn("rush_hour", rush)
    scored = rules.score_risk(flagged, "report")
    return scored.withColumn("risk_reason", rules.risk_reason(F.col("risk_level")))


def hourly_risk(scored: DataFrame) -> DataFrame:
    return scored.groupBy("hour").agg(F.avg("total_risk_score").alias("avg_risk_score"))


_MEASURES = ("traffic_volume", "visibility_in_miles", "weather_severity", "total_risk_score")


def cube(scored: DataFrame) -> DataFrame:
    """Partial sums per hour and level: the one scan behind all risk tables."""
    sums = [F.sum(name).alias(f"{name}_sum") for name in _MEASURES]
    counts = [F.count(name).alias(f"{name}_n") for name in _MEASURES]
    return scored.groupBy("hour", "risk_level").agg(F.count(F.lit(1)).alias("rows"), *sums, *counts)


def from_cube(partial: DataFrame, *keys: str) -> DataFrame:
    """Records and the mean of every measure per hour, per level, or per both."""
    means = [
        F.try_divide(F.sum(f"{name}_sum"), F.sum(f"{name}_n")).alias(f"avg_{name}")
        for name in _MEASURES
    ]
    return partial.groupBy(*keys).agg(F.sum("rows").alias("records"), *means)


def transitions(scored: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Rows whose risk level differs from the row before in time over the whole table.

    ``order`` is the time followed by tie columns; without it all columns follow the time, so
    equal times are ordered the same on every run. The whole table is one sequence, so it
    is cut into equal runs along ``order``; no task sees more than one run.
    """
    kept = ["date_time", "risk_level", "traffic_volume", "visibility_in_miles"]
    line = order or ["date_time", *[c for c in scored.columns if c != "date_time"]]
    narrow = scored.select(*dict.fromkeys([*line, *kept]))

    def before(window: WindowSpec):
        return {"previous_risk_level": F.lag("risk_level").over(window)}

    compared = ordered_columns(narrow, [], line, 1, [before])
    return compared.where(F.col("risk_level") != F.col("previous_risk_level"))


def first_transitions(changes: DataFrame, order: list[str], limit: int = 10) -> DataFrame:
    return changes.orderBy(*order).limit(limit)
