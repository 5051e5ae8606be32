"""Report jobs over junction counts, road conditions and vehicle mix.

Each job scans its input once into a small table of partial sums (one row per group), and
derives all report tables from that.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.config import DEFAULTS, Settings
from roadlens.functions import rules
from roadlens.operators import junctions, roads, vehicles
from roadlens.operators.lineage import staged
from roadlens.sources import sinks

_VOLUME = "average_vehicles"


def junction_summary(counts: DataFrame, hours: int = 12) -> dict[str, DataFrame]:
    """Flat fares: totals, quietest and busiest hour, and the first hours of the day."""
    partial = staged(junctions.cube(junctions.label_flat(counts)))
    hourly = junctions.from_cube(partial, "hour_of_day")
    return {
        "overall": junctions.from_cube(partial),
        "hours_to_travel": junctions.extremes(hourly, ["hour_of_day"], _VOLUME),
        "hourly": hourly.orderBy("hour_of_day").limit(hours),
    }


def junction_report(counts: DataFrame, preview: int = 20) -> dict[str, DataFrame]:
    """Peak fares: range, hours, junctions, both together, bands, levels and their extremes."""
    labeled = junctions.label_peak(counts)
    partial = staged(junctions.cube(labeled))
    hourly = junctions.from_cube(partial, "hour_of_day")
    per_junction = junctions.from_cube(partial, "Junction", fare_average=True)
    both = ["Junction", "hour_of_day"]
    routes = junctions.from_cube(partial, *both)
    bands = junctions.from_cube(partial, "time_band")
    levels = junctions.from_cube(partial, "traffic_level").select("traffic_level", "records")
    covered = partial.agg(
        F.min("first_time").alias("start_time"), F.max("last_time").alias("end_time")
    )
    return {
        "preview": labeled.orderBy("DateTime", "Junction").limit(preview),
        "dataset_range": covered.withColumn(
            "covered_seconds", F.timestamp_diff("SECOND", F.col("start_time"), F.col("end_time"))
        ),
        "overall": junctions.from_cube(partial),
        "hourly": hourly.orderBy("hour_of_day"),
        "junctions": per_junction.orderBy("Junction"),
        "hour_extremes": junctions.extremes(hourly, ["hour_of_day"], _VOLUME),
        "junction_extremes": junctions.extremes(per_junction, ["Junction"], _VOLUME),
        "route_extremes": junctions.extremes(routes, both, _VOLUME),
        "quietest_routes": junctions.ranked(routes, both, _VOLUME, 10, highest=False),
        "busiest_routes": junctions.ranked(routes, both, _VOLUME, 10, highest=True),
        "most_congested_band": junctions.ranked(bands, ["time_band"], _VOLUME, 1, highest=True),
        "commonest_level": junctions.ranked(
            levels, ["traffic_level"], "records", 1, highest=True
        ),
        "bands_and_levels": junctions.from_cube(partial, "time_band", "traffic_level").orderBy(
            "time_band", "traffic_level"
        ),
    }


def _risk_tables(scored: DataFrame, ties: Sequence[str] | None, limit: int, settings: Settings):
    partial = staged(roads.cube(scored))
    hourly = roads.from_cube(partial, "hour").select("hour", "avg_total_risk_score")
    # Without ``ties`` all columns order rows of one time, so no partitioning changes the result.
    line = ["date_time", *([c for c in scored.columns if c != "date_time"] if ties is None else ties)]
    changes = roads.transitions(scored, line)
    return partial, {
        "hour_extremes": junctions.extremes(hourly, ["hour"], "avg_total_risk_score"),
        "hourly": hourly.orderBy("hour"),
        "transitions": changes,
        "first_transitions": roads.first_transitions(changes, line, limit),
    }


def risk_summary(
    conditions: DataFrame, ties: Sequence[str] | None = None, settings: Settings = DEFAULTS
) -> dict[str, DataFrame]:
    """Riskiest and safest hour, level table, first risk transitions."""
    scored = rules.score_risk(roads.with_hour(conditions), "summary")
    partial, tables = _risk_tables(scored, ties, 10, settings)
    return {**tables, "levels": roads.from_cube(partial, "risk_level").orderBy("risk_level")}


def risk_intelligence(
    conditions: DataFrame, ties: Sequence[str] | None = None, settings: Settings = DEFAULTS
) -> dict[str, DataFrame]:
    """Scored rows with reasons, hour and level table, transitions."""
    scored = roads.intelligence(conditions)
    partial, tables = _risk_tables(scored, ties, 10, settings)
    both = roads.from_cube(partial, "hour", "risk_level").orderBy("hour", "risk_level")
    return {**tables, "rows": scored, "hours_and_levels": both, "first_rows": both.limit(10)}


def vehicle_report(mix: DataFrame) -> dict[str, DataFrame]:
    """Totals, shares, situations, weekdays and the trend over the day."""
    return {
        "totals": vehicles.totals(mix),
        "composition": vehicles.composition(mix),
        "situations": vehicles.by_situation(mix).orderBy("TrafficSituation"),
        "weekdays": vehicles.by_weekday(mix),
        "daily_trend": vehicles.daily_trend(mix),
    }


def write_tables(tables: Mapping[str, DataFrame], output: str) -> None:
    for name, table in tables.items():
        sinks.write_table(table, f"{output}/{name}")
