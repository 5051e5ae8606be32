"""CSV, text and Parquet inputs as typed DataFrames.

CSV columns are taken by header name as text and cast, so unreadable cells become null and
no extra pass over the file guesses types.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens import schemas
from roadlens.config import DatasetLayout
from roadlens.functions import scalars
from roadlens.operators import reshape, vehicles


def _missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def header_csv(spark: SparkSession, path: str, required: Iterable[str] = ()) -> DataFrame:
    """All columns as text. The file must exist and hold the required columns."""
    try:
        table = spark.read.option("header", True).csv(path)
    except AnalysisException as error:
        if _missing(error):
            raise FileNotFoundError(f"No dataset at {path}") from error
        raise
    return reshape.require_columns(table, required)


def text_lines(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.text(path).select(F.col("value").alias(name))


def sensor_readings(spark: SparkSession, layout: DatasetLayout) -> DataFrame:
    return reshape.wide_to_long(header_csv(spark, layout.readings))


def sensor_list(spark: SparkSession, layout: DatasetLayout) -> DataFrame:
    return text_lines(spark, layout.sensors, "sensor_id")


def road_edges(spark: SparkSession, layout: DatasetLayout) -> DataFrame:
    required = schemas.column_names(schemas.EDGE_FILE)
    return reshape.road_edges(header_csv(spark, layout.distances, required))


def junction_counts(spark: SparkSession, path: str) -> DataFrame:
    """``DateTime, Junction, Vehicles``; other columns stay as text."""
    table = header_csv(spark, path, schemas.column_names(schemas.JUNCTION_COUNTS))
    return table.withColumns(
        {
            "DateTime": scalars.parse_time(F.col("DateTime")),
            "Junction": F.col("Junction").try_cast("int"),
            "Vehicles": F.col("Vehicles").try_cast("int"),
        }
    )


def road_conditions(spark: SparkSession, path: str) -> DataFrame:
    required = ["date_time", *schemas.ROAD_NUMBERS, *schemas.ROAD_TEXTS]
    table = reshape.as_numbers(header_csv(spark, path, required), schemas.ROAD_NUMBERS)
    return table.withColumn("date_time", scalars.parse_time(F.col("date_time")))


def vehicle_mix(spark: SparkSession, path: str) -> DataFrame:
    """Canonical headers, typed counts."""
    table = reshape.canonical_columns(header_csv(spark, path))
    table = reshape.require_columns(table, vehicles.REQUIRED)
    return reshape.as_numbers(table, [*schemas.VEHICLE_CLASSES, "Total"])


def result_table(
    spark: SparkSession,
    folder: str,
    name: str,
    days: tuple[str, str] | None = None,
    sensor_id: str | Column | None = None,
) -> DataFrame:
    """One table of the sensor job; empty, with the right columns, if it was never written.

    ``days`` (first, last) reads the folders of these days only, ``sensor_id`` only row groups that may
    hold the sensor.
    """
    schema = schemas.RESULT_TABLES[name]
    try:
        table = spark.read.schema(f"{schema}, {schemas.DAY} date").parquet(f"{folder.rstrip('/')}/{name}")
    except AnalysisException as error:
        if _missing(error):
            return spark.createDataFrame([], schema)
        raise
    if days is not None:
        table = table.where(F.col(schemas.DAY).between(*[F.lit(day).cast("date") for day in days]))
    if sensor_id is not None:
        table = table.where(F.col("sensor_id") == sensor_id)
    return table.drop(schemas.DAY)


def run_summary(spark: SparkSession, folder: str) -> DataFrame | None:
    try:
        return spark.read.json(f"{folder.rstrip('/')}/summary.json")
    except AnalysisException as error:
        if _missing(error):
            return None
        raise
