"""Parquet, CSV and JSON outputs, and model files."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens import schemas


# Spark writes times in text files to the millisecond unless told otherwise.
_WHOLE_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").parquet(path, partitionBy=list(partition_by) or None)


def write_days(df: DataFrame, path: str, only_these: bool = False) -> None:
    """A table with a ``timestamp``, a folder for each day.

    ``only_these`` replaces the days that ``df`` has rows of and leaves the others as they are. Rows keep
    their order, so a reader can pass over row groups of other sensors in a table sorted by sensor.
    """
    mode = "dynamic" if only_these else "static"
    by_day = df.withColumn(schemas.DAY, F.to_date("timestamp"))
    by_day.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(schemas.DAY).parquet(path)


def rows_written(spark: SparkSession, path: str, schema: str) -> int:
    """Row count from the Parquet footers; exact even if tasks of the write ran twice."""
    return spark.read.schema(schema).parquet(path).count()


def write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """``compression`` is one that Spark's reader knows by the name of the file, such as gzip."""
    df.write.mode("overwrite").options(header=True, compression=compression, **_WHOLE_TIMES).csv(path)


def write_document(df: DataFrame, path: str) -> None:
    """A DataFrame of nested rows as JSON."""
    df.write.mode("overwrite").options(**_WHOLE_TIMES).json(path)


def nested(df: DataFrame, name: str) -> DataFrame:
    """One row with all rows of a small report table as an array of structs, sorted."""
    rows = F.sort_array(F.collect_list(F.struct(*df.columns)))
    return df.agg(rows.alias(name))


def document(spark: SparkSession, constants: Mapping[str, object], parts: Mapping[str, DataFrame]):
    """One row: constant fields, then each small report table as an array of structs."""
    fields = {
        k: F.lit(v).cast("long") if isinstance(v, int) else F.lit(v) for k, v in constants.items()
    }
    row = spark.range(0, 1, 1, 1).select(*[v.alias(k) for k, v in fields.items()])
    return row.withColumns({name: nested(df, name).scalar() for name, df in parts.items()})


def save_model(model: PipelineModel, path: str, facts: Mapping[str, object]) -> None:
    """Model first, then its facts; the facts mark a complete model."""
    spark = SparkSession.active()
    model.write().overwrite().save(f"{path}/model")
    row = spark.createDataFrame([tuple(facts.values())], list(facts))
    write_document(row, f"{path}/facts")


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(f"{path}/model")


def model_facts(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.json(f"{path}/facts")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def model_or_train(
    spark: SparkSession,
    path: str,
    train: Callable[[], tuple[PipelineModel, Mapping[str, object]]],
) -> PipelineModel:
    """The saved model; trains and saves it only if there is none."""
    if model_facts(spark, path) is None:
        model, facts = train()
        save_model(model, path, facts)
    return load_model(path)
