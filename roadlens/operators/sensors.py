"""Sensor speeds: metrics, alerts, forecast, anomalies and prices.

``sensor_facts`` does all the grouping and windowing once; the five result tables are
projections and filters of it, so no result needs a shuffle of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from roadlens import schemas
from roadlens.config import DEFAULTS, Settings
from roadlens.functions import rules
from roadlens.functions.bands import first_match, floors
from roadlens.operators.ordered import ordered_columns


def sensor_profile(
    readings: DataFrame, settings: Settings = DEFAULTS, sensors: DataFrame | None = None
) -> DataFrame:
    """One row per sensor: free-flow speed, mean, deviation, rows, and the latest reading.

    Grouped aggregates (combined before the shuffle), not a window over the sensor, in two levels: per
    sensor and group of tasks, then per sensor, so a sensor with readings in every task is not merged in
    one place. With a sensor list only listed sensors stay; ``copies`` says how often the list names them,
    and the figures are those of readings repeated that often. Speeds that are NaN do not count for the
    free flow.
    """
    speed, size = F.col("speed").cast("double"), settings.free_flow_sketch
    group = F.pmod(F.spark_partition_id(), F.lit(settings.task_groups))
    known = F.count(F.when(~F.isnan(speed), speed))
    first = readings.withColumn("_group", group).groupBy("sensor_id", "_group").agg(
        F.count(F.lit(1)).alias("n"),
        F.kll_sketch_agg_double(speed, size).alias("sketch"),
        known.alias("ranked"),
        F.struct(F.count(speed).alias("n"), F.avg(speed).alias("mean"), F.stddev(speed).alias("std")).alias("part"),
        F.sum(speed).alias("total"),
        F.max(F.struct("timestamp", "speed")).alias("latest"),
    )
    merged = first.groupBy("sensor_id").agg(
        F.sum("n").alias("n"),
        F.sum("ranked").alias("ranked"),
        F.kll_merge_agg_double("sketch", size).alias("sketch"),
        F.sort_array(F.collect_list(F.when(F.col("part.n") > 0, F.col("part")))).alias("parts"),
        F.max("latest").alias("latest"),
        F.sum("total").alias("total"),
    )
    free_flow = F.kll_sketch_get_quantile_double("sketch", F.lit(rules.FREE_FLOW_QUANTILE))
    profile = merged.withColumn("whole", _moments(F.col("parts"))).select(
        "sensor_id",
        "n",
        F.when(F.col("ranked") > 0, free_flow).alias("free_flow_speed"),
        F.try_divide("total", "whole.n").alias("sensor_mean_speed"),
        F.coalesce(F.col("whole.n"), F.lit(0)).alias("known"),
        F.coalesce(F.col("whole.std"), F.lit(0.0)).alias("sensor_std_speed"),
        "latest",
    )
    if sensors is None:
        return profile.withColumn("copies", F.lit(1).cast("long"))
    # One row per sensor on both sides, so neither a hot sensor nor a long list can skew this.
    listed = sensors.groupBy("sensor_id").agg(F.count(F.lit(1)).alias("copies"))
    known, copies = F.col("known"), F.col("copies")
    repeated = F.sqrt(F.try_divide(copies * (known - 1), copies * known - 1))
    return profile.join(listed, "sensor_id").withColumns(
        {
            "n": F.col("n") * copies,
            "sensor_std_speed": F.coalesce(F.col("sensor_std_speed") * repeated, F.lit(0.0)),
        }
    )


def _moments(parts: Column) -> Column:
    """Number and sample deviation of all rows from those and the means of their parts."""

    def squares(part: Column) -> Column:
        return F.coalesce(part["std"] * part["std"] * (part["n"] - 1), F.lit(0.0))

    def add(state: Column, part: Column) -> Column:
        n, apart = state["n"] + part["n"], part["mean"] - state["mean"]
        return F.struct(
            n.alias("n"),
            (state["mean"] + apart * part["n"] / n).alias("mean"),
            (state["squares"] + squares(part) + apart * apart * state["n"] * part["n"] / n).alias("squares"),
        )

    one = parts[0]
    start = F.struct(one["n"].alias("n"), one["mean"].alias("mean"), squares(one).alias("squares"))

    def end(state: Column) -> Column:
        std = F.sqrt(F.try_divide(state["squares"], state["n"] - 1))
        return F.struct(state["n"].alias("n"), state["mean"].alias("mean"), std.alias("std"))

    rest = F.aggregate(F.slice(parts, 2, F.greatest(F.lit(1), F.size(parts))), start, add, end)
    return F.when(F.size(parts) == 1, one).when(F.size(parts) > 1, rest)


def sensor_facts(
    readings: DataFrame,
    settings: Settings = DEFAULTS,
    sensors: DataFrame | None = None,
    profile: DataFrame | None = None,
) -> DataFrame:
    """Readings with everything the five result tables are made of.

    With ``sensors`` only readings of listed sensors stay, once per mention in the list. That
    join rides on the one that brings each sensor's profile to its rows. ``profile`` is the
    stored result of sensor_profile(), if there is one.
    """
    speed = F.col("speed")
    back = settings.rolling_window

    def repeats(window: WindowSpec):
        return {"copies": F.explode(F.sequence(F.lit(1), F.col("copies")))}

    def changes(window: WindowSpec):
        return {"speed_delta": F.coalesce(speed - F.lag(speed).over(window), F.lit(0.0))}

    def trailing(window: WindowSpec):
        frame = window.rowsBetween(-back, 0)
        return {
            "avg_speed_1h": F.avg(speed).over(frame),
            "speed_std_1h": F.coalesce(F.stddev(speed).over(frame), F.lit(0.0)),
            "speed_trend": F.avg("speed_delta").over(frame),
        }

    once = sensors is None and profile is None
    if profile is None:
        profile = sensor_profile(readings, settings, sensors)
    rolled = ordered_columns(
        readings,
        keys=["sensor_id"],
        order=["timestamp"],
        depth=back + 1,
        steps=[changes, trailing] if once else [repeats, changes, trailing],
        per_key=profile.drop("n", "known", "latest"),
    ).drop("copies")
    proxy, hour = F.col("density_proxy"), F.col("hour_of_day")
    return rolled.withColumns(
        {
            "density_proxy": rules.density_proxy(speed, F.col("free_flow_speed")),
            "hour_of_day": F.hour("timestamp"),
        }
    ).withColumns(
        {
            "density_score": F.round(proxy * 100, 2),
            "congestion_level": rules.congestion_level(proxy, settings),
            "travel_time_multiplier": rules.travel_time_multiplier(proxy),
            "is_peak_period": rules.is_peak_period(hour, settings),
        }
    )


def traffic_metrics(facts: DataFrame) -> DataFrame:
    return facts.select(*schemas.column_names(schemas.METRICS))


def congestion_alerts(facts: DataFrame) -> DataFrame:
    """Rows that are high or severe, or at least double the travel time."""
    level, multiplier = F.col("congestion_level"), F.col("travel_time_multiplier")
    return facts.where(rules.is_alert(level, multiplier)).select(
        *schemas.column_names(schemas.ALERTS)
    )


def speed_forecast(facts: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Rolling speed plus trend times horizon, and the congestion that speed would mean."""
    ahead = F.col("avg_speed_1h") + F.col("speed_trend") * settings.forecast_horizon
    lost = (1 - F.try_divide(F.col("forecast_speed"), F.col("free_flow_speed"))) * 100
    score = F.col("forecast_density_score")
    return (
        facts.withColumn("forecast_speed", F.round(F.greatest(F.lit(0.0), ahead), 2))
        .withColumn("forecast_density_score", F.round(F.greatest(F.lit(0.0), lost), 2))
        .withColumn(
            "forecast_congestion_level", floors(score, rules.FORECAST_LEVELS, rules.CALM_LEVEL)
        )
        .select(*schemas.column_names(schemas.FORECAST))
    )


def speed_anomalies(facts: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Readings far from their sensor's mean, as slowdown or plain outlier."""
    spread = F.col("sensor_std_speed")
    zscore = (F.col("speed") - F.col("sensor_mean_speed")) / F.when(spread > 0, spread)
    far = F.abs(F.col("speed_zscore")) >= settings.anomaly_zscore
    below = F.col("speed") < F.col("avg_speed_1h")
    kind = first_match([(far & below, "sudden_slowdown"), (far, "sensor_outlier")], None)
    return (
        facts.withColumn(
            "speed_zscore", F.when(spread > 0, zscore).otherwise(0.0)
        )
        .withColumn("anomaly_type", kind)
        .where(F.col("anomaly_type").isNotNull())
        .select(*schemas.column_names(schemas.ANOMALIES))
    )


def dynamic_prices(facts: DataFrame) -> DataFrame:
    proxy, peak = F.col("density_proxy"), F.col("is_peak_period")
    return facts.withColumns(
        {
            "demand_index": rules.demand_index(F.col("density_score"), F.col("hour_of_day")),
            "public_transport_fare_multiplier": rules.fare_multiplier(proxy, peak),
            "congestion_charge_usd": rules.congestion_charge(F.col("congestion_level")),
            "parking_fee_usd": rules.parking_fee(proxy, peak),
        }
    ).select(*schemas.column_names(schemas.PRICING))


# Reports over the result tables


def run_counts(facts: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Rows of each of the five result tables, in one pass over the facts."""
    level, multiplier = F.col("congestion_level"), F.col("travel_time_multiplier")
    deviation = F.abs(F.col("speed") - F.col("sensor_mean_speed"))
    spread = F.col("sensor_std_speed")
    far = (spread > 0) & (deviation / F.when(spread > 0, spread) >= settings.anomaly_zscore)
    rows = F.count(F.lit(1))
    return facts.agg(
        rows.alias("records_processed"),
        F.count_if(rules.is_alert(level, multiplier)).alias("congestion_alerts"),
        rows.alias("forecast_records"),
        F.count_if(far).alias("anomalies_detected"),
        rows.alias("pricing_records"),
    )


def latest_snapshot(metrics: DataFrame) -> DataFrame:
    """Rows at the newest timestamp of the table; the maximum stays inside the plan."""
    newest = metrics.select(F.max("timestamp")).scalar()
    return metrics.where(F.col("timestamp") == newest)


def latest_per_sensor(metrics: DataFrame) -> DataFrame:
    """Newest row of each sensor, by an aggregate that combines before the shuffle."""
    others = [name for name in metrics.columns if name not in ("timestamp", "sensor_id")]
    newest = F.max(F.struct("timestamp", *others)).alias("row")
    return metrics.groupBy("sensor_id").agg(newest).select("sensor_id", "row.*")


def top_sensors(alerts: DataFrame, limit: int = 10) -> DataFrame:
    """Sensors with most alerts; equal counts in sensor order."""
    return alert_counts(alerts).orderBy(F.col("events").desc(), "sensor_id").limit(limit)


def alert_counts(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("sensor_id").agg(F.count(F.lit(1)).alias("events"))


def most_congested_now(metrics: DataFrame, limit: int = 30) -> DataFrame:
    latest = latest_per_sensor(metrics)
    return latest.orderBy(F.col("density_score").desc(), "sensor_id").limit(limit)


def sensor_history(forecast: DataFrame, sensor_id: str | Column) -> DataFrame:
    """Observed and forecast speed of one sensor over time."""
    return (
        forecast.where(F.col("sensor_id") == sensor_id)
        .select("timestamp", "speed", "forecast_speed")
        .orderBy("timestamp")
    )


def sensor_choices(forecast: DataFrame) -> DataFrame:
    return forecast.select("sensor_id").distinct().orderBy("sensor_id")


def parking_fee_distribution(prices: DataFrame) -> DataFrame:
    """Box-plot numbers of the parking fee per congestion level.

    Fees have two decimals, so counting equal fees first leaves a few hundred rows per
    level and the exact quartiles come from those counts.
    """
    fee = F.col("parking_fee_usd")
    counted = prices.groupBy("congestion_level", "parking_fee_usd").agg(
        F.count(F.lit(1)).alias("n")
    )
    return counted.groupBy("congestion_level").agg(
        F.sum("n").alias("records"),
        F.min(fee).alias("min_fee"),
        F.percentile(fee, 0.25, F.col("n")).alias("q1_fee"),
        F.percentile(fee, 0.5, F.col("n")).alias("median_fee"),
        F.percentile(fee, 0.75, F.col("n")).alias("q3_fee"),
        F.max(fee).alias("max_fee"),
    )


def top_charges(prices: DataFrame, limit: int = 20) -> DataFrame:
    keys = [F.col("congestion_charge_usd").desc(), "timestamp", "sensor_id"]
    return prices.orderBy(*keys).limit(limit)


def latest_anomalies(anomalies: DataFrame, limit: int = 50) -> DataFrame:
    return anomalies.orderBy(F.col("timestamp").desc(), "sensor_id").limit(limit)
