"""Alerts on arriving readings against a fixed free-flow table.

Stateless: each reading is judged alone, so no watermark is needed. The free-flow table is
the grouped part of the batch job and is refreshed by rerunning that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadlens import schemas
from roadlens.config import DEFAULTS, Settings
from roadlens.functions import rules
from roadlens.operators.sensors import congestion_alerts


def reading_files(spark: SparkSession, folder: str, files_per_batch: int = 1_000) -> DataFrame:
    return (
        spark.readStream.schema(schemas.READINGS)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def live_alerts(
    readings: DataFrame, free_flow: DataFrame, settings: Settings = DEFAULTS
) -> DataFrame:
    """Readings that are alerts; works on a stream and on a batch alike."""
    known = readings.join(free_flow.select("sensor_id", "free_flow_speed"), "sensor_id")
    proxy, hour = F.col("density_proxy"), F.hour("timestamp")
    judged = known.withColumn(
        "density_proxy", rules.density_proxy(F.col("speed"), F.col("free_flow_speed"))
    ).withColumns(
        {
            "density_score": F.round(proxy * 100, 2),
            "congestion_level": rules.congestion_level(proxy, settings),
            "travel_time_multiplier": rules.travel_time_multiplier(proxy),
            "is_peak_period": rules.is_peak_period(hour, settings),
        }
    )
    return congestion_alerts(judged)


def write_alerts(alerts: DataFrame, output: str, checkpoint: str) -> StreamingQuery:
    """Append alerts as Parquet until the files present are done; restartable from ``checkpoint``."""
    return (
        alerts.writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
