"""Cutting lineage in a folder that survives the loss of an executor."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def checkpoint_folder(spark: SparkSession) -> None:
    """Use the folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("Set spark.checkpoint.dir to a folder all executors share.")
        folder = tempfile.mkdtemp(prefix="road-checkpoints-")
    context.setCheckpointDir(folder)


def cut(df: DataFrame) -> DataFrame:
    """The same rows, written to the shared checkpoint folder and read back from there."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared checkpoint folder that nothing else uses."""
    checkpoint_folder(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4()}"


def staged(df: DataFrame) -> DataFrame:
    """The same rows through a Parquet table in the shared folder.

    For wide results that several narrow queries read: each reads its own columns only, and
    the table's size is known when their joins are planned.
    """
    path = new_folder(df.sparkSession, "staged")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system, whichever that is."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def observed(stage: Callable[[DataFrame], DataFrame], df: DataFrame, **figures: Column) -> tuple[DataFrame, dict]:
    """The staged rows and aggregates of them, taken while they are written.

    Meant for smallest and largest values, which a task that runs twice cannot change. Without rows a
    figure is missing.
    """
    note = Observation()
    out = stage(df.observe(note, *[column.alias(name) for name, column in figures.items()]))
    return out, note.get


@contextmanager
def staging(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A ``staged`` whose tables are removed at the end; nothing lazy may outlive the block."""
    paths: list[str] = []

    def stage(df: DataFrame) -> DataFrame:
        paths.append(new_folder(spark, "staged"))
        df.write.parquet(paths[-1])
        return spark.read.parquet(paths[-1])

    try:
        yield stage
    finally:
        for path in paths:
            remove(spark, path)
