"""Feature tables and reproducible splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from roadlens.functions import rules, scalars
from roadlens.functions.bands import lookup
from roadlens.operators import reshape
from roadlens.operators.ordered import ordered_columns
from roadlens.operators.quantiles import quantiles
from roadlens.schemas import ROAD_NUMBERS, ROAD_TEXTS

# Inputs of the models, in order.
VOLUME_INPUTS = (
    "hour",
    "day_of_week",
    "day_of_month",
    "month",
    "is_weekend",
    "hour_sin",
    "hour_cos",
    "lag_1",
    "lag_2",
    "lag_24",
    "rolling_mean_3",
)
SITUATION_INPUTS = (
    "CarCount",
    "BikeCount",
    "BusCount",
    "TruckCount",
    "Total",
    "Car_ratio",
    "Heavy_ratio",
    "Time_hour",
)
SMALL_VOLUME_INPUTS = ("hour", "junction")
SMALL_SITUATION_NUMBERS = (
    "car_count",
    "bike_count",
    "bus_count",
    "truck_count",
    "traffic_volume",
    "hour",
)
SMALL_SITUATION_TEXTS = ("day_of_week",)
SMALL_RISK_NUMBERS = ("hour", *ROAD_NUMBERS)
SMALL_RISK_TEXTS = ROAD_TEXTS
RISK_SCORES = ("weather_severity", "visibility_risk", "pollution_risk", "traffic_risk")
RISK_TOTAL = "total_risk_score"
RISK_TEXTS = (*ROAD_TEXTS, "weather_category", "rush_hour")
LAGS = (1, 2, 24)
ROLLING_ROWS = 3
# End of fixed values.

RISK_NUMBERS = (*ROAD_NUMBERS, "hour", *RISK_SCORES, RISK_TOTAL)
# Without the score the label is derived from.
RISK_NUMBERS_NO_LEAK = (*ROAD_NUMBERS, "hour")


def demand_features(counts: DataFrame, ties: Sequence[str] | None = None) -> DataFrame:
    """Calendar features, three lags and the mean of the three rows before, per junction.

    Rows without a full set of features are dropped, so the first 24 of each junction are.
    Equal times are ordered by ``ties``, by default by all other columns.
    A junction may hold any share of the rows: all are windowed in equal runs.
    """
    known = counts.where(F.col("Junction").isNotNull() & F.col("DateTime").isNotNull())

    rest = [c for c in counts.columns if c not in ("Junction", "DateTime")]
    line = rest if ties is None else ties

    def history(window: WindowSpec):
        columns = {f"lag_{k}": F.lag("Vehicles", k).over(window) for k in LAGS}
        before = window.rowsBetween(-ROLLING_ROWS, -1)
        return {**columns, "rolling_mean_3": F.avg("Vehicles").over(before)}

    rolled = ordered_columns(
        known, ["Junction"], ["DateTime", *line], max(LAGS), [history]
    )
    return rolled.withColumns(scalars.calendar_features(F.col("DateTime"))).dropna()


def risk_features(roads: DataFrame) -> DataFrame:
    """Risk scores and level from the raw values, then gaps filled.

    The level is fixed before the medians go in, so imputed values never change it.
    """
    typed = reshape.as_text(reshape.as_numbers(roads, ROAD_NUMBERS), ROAD_TEXTS)
    hour = F.hour("date_time")
    rush = F.when(rules.is_rush_hour(hour), "Yes").otherwise("No")
    scored = rules.score_risk(typed.withColumns({"hour": hour, "rush_hour": rush}), "training")
    filled = reshape.fill_medians(scored, [*ROAD_NUMBERS, "hour"])
    named = reshape.fill_constants(filled, texts=RISK_TEXTS)
    return reshape.keep_known(named, ["date_time"])


def small_volume_features(counts: DataFrame) -> DataFrame:
    return counts.withColumnRenamed("Junction", "junction").withColumn("hour", F.hour("DateTime"))


def small_situation_features(mix: DataFrame) -> DataFrame:
    """Vehicle mix in the names of a prediction request."""
    return mix.select(
        F.col("CarCount").cast("double").alias("car_count"),
        F.col("BikeCount").cast("double").alias("bike_count"),
        F.col("BusCount").cast("double").alias("bus_count"),
        F.col("TruckCount").cast("double").alias("truck_count"),
        F.col("Total").cast("double").alias("traffic_volume"),
        scalars.strict_clock_hour(F.col("Time")).alias("hour"),
        F.col("DayOfWeek").alias("day_of_week"),
        F.col("TrafficSituation").cast("string").alias("traffic_situation"),
        *[c for c in mix.columns if c not in ("DayOfWeek", "TrafficSituation", "Time", "hour")],
    )


def small_risk_features(roads: DataFrame) -> DataFrame:
    """Request-shaped road conditions with the level of the ``labels`` scheme."""
    return rules.score_risk(roads.withColumn("hour", F.hour("date_time")), "labels")


# Splits. Cut points are read once (one number, or one row per class): every use of the two
# sides then sees the same cut, and no row can fall on both sides or on none.


def time_split(df: DataFrame, share: float = 0.8):
    """Rows up to the given percentile of ``timestamp_seconds``, and the rows after it.

    Without any time both sides are empty.
    """
    (point,) = quantiles(df, ["timestamp_seconds"], [share]).first()["timestamp_seconds"]
    seconds, cut = F.col("timestamp_seconds"), F.lit(None if point is None else int(point))
    return df.where(seconds <= cut), df.where(seconds > cut)


def random_split(df: DataFrame, key: str, share: float = 0.8, seed: int = 42):
    """Each row falls on one side by a seeded hash of its key, however often it is recomputed."""
    place = uniform_place(key, seed)
    return df.where(place < share), df.where(place >= share)


def uniform_place(key: str, seed: int) -> Column:
    return scalars.uniform_hash(F.col(key), seed) / F.lit(float(2**52))


def _class_cuts(
    df: DataFrame, key: str, label: str, shares: Sequence[float], seed: int
) -> list[Column]:
    """Per share, the row's class's quantile of the hash, as a constant map over the classes.

    Rows without a label have no class and so no cut. One row per class is read.
    """
    labelled = df.where(F.col(label).isNotNull())
    hashed = labelled.select(label, scalars.uniform_hash(F.col(key), seed).alias("h"))
    rows = quantiles(hashed, ["h"], shares, by=[label]).collect()
    if not rows:
        return [F.lit(None).cast("long")] * len(shares)
    return [
        lookup(F.col(label), {row[label]: int(row["h"][place]) for row in rows})
        for place in range(len(shares))
    ]


def stratified_split(
    df: DataFrame,
    key: str,
    label: str,
    share: float = 0.8,
    seed: int = 42,
):
    """Like random_split, but each class is cut at its own percentile of the hash.

    Rows without a label are on neither side.
    """
    (cut,) = _class_cuts(df, key, label, [share], seed)
    hashed = scalars.uniform_hash(F.col(key), seed)
    return df.where(hashed <= cut), df.where(hashed > cut)


def with_folds(
    df: DataFrame,
    key: str,
    label: str,
    folds: int = 3,
    seed: int = 42,
) -> DataFrame:
    """Adds ``fold``: equal shares of every class, by percentiles of the seeded hash.

    Rows without a label have no fold.
    """
    hashed = scalars.uniform_hash(F.col(key), seed)
    shares = [(i + 1) / folds for i in range(folds - 1)]
    above = [
        (hashed > cut).cast("int") for cut in _class_cuts(df, key, label, shares, seed)
    ]
    return df.withColumn("fold", sum(above, F.lit(0)))
