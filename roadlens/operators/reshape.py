"""Reshaping and cleaning: unpivot, typed projections, null handling, imputation."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.functions import scalars
from roadlens.operators.quantiles import quantiles


def wide_to_long(wide: DataFrame) -> DataFrame:
    """First column is the time, every other one a sensor; empty cells stay, no time drops."""
    time, *names = wide.columns
    cells = {name: F.col(f"`{name}`").try_cast("double") for name in names}
    typed = wide.select(
        scalars.parse_time(F.col(f"`{time}`")).alias("timestamp"),
        *[cell.alias(name) for name, cell in cells.items()],
    ).where(F.col("timestamp").isNotNull())
    quoted = [F.col(f"`{name}`") for name in names]
    return typed.unpivot("timestamp", quoted, "sensor_id", "speed")


def road_edges(table: DataFrame) -> DataFrame:
    """``from, to, cost`` as a typed, directed edge table."""
    return table.select(
        F.col("from").cast("string").alias("source_sensor"),
        F.col("to").cast("string").alias("target_sensor"),
        F.col("cost").try_cast("double").alias("distance_meters"),
    )


def canonical_columns(df: DataFrame) -> DataFrame:
    """All headers through scalars.canonical_header in one projection."""
    return df.toDF(*[scalars.canonical_header(name) for name in df.columns])


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """The same DataFrame, or ValueError naming the missing columns; runs no job."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"Missing required columns: {', '.join(missing)}")
    return df


def as_numbers(df: DataFrame, columns: Iterable[str], kind: str = "double") -> DataFrame:
    """Cast the columns; unreadable text becomes null."""
    return df.withColumns({name: F.col(name).try_cast(kind) for name in columns})


def as_text(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("string") for name in columns})


def keep_known(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null in the given columns, or in any column."""
    return df.dropna(subset=list(columns)) if columns else df.dropna()


def fill_constants(
    df: DataFrame, numbers: Sequence[str] = (), texts: Sequence[str] = ()
) -> DataFrame:
    """Missing numbers become 0, missing texts ``Unknown``."""
    values: dict[str, object] = {name: 0 for name in numbers}
    values.update({name: "Unknown" for name in texts})
    return df.fillna(values) if values else df


def medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: the median of every column, all in one pass; no value gives 0.0."""
    row = quantiles(df, columns, [0.5])
    return row.select(*[F.coalesce(F.col(c)[0], F.lit(0.0)).alias(c) for c in columns])


def fill_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing numbers become the column's median over the whole table, kept in its type."""
    row = medians(df, columns)
    kinds = dict(df.dtypes)
    one = row.select(F.struct(*columns).alias("medians")).scalar()
    return df.withColumns(
        {c: F.coalesce(F.col(c), one.getField(c).cast(kinds[c])) for c in columns}
    )


# Rows a task must have to be worth its own sums, which every task sends for every node.
_TASK_ROWS = 5000


def spread(rows: DataFrame) -> DataFrame:
    """The same rows in equal parts, as many as there are cores or as there were before.

    A forest walks every row through every tree once a level, so a table that is a small file (or one row
    group of a large one) would keep one core busy. Small tables stay as they are.
    """
    n = rows.count() // _TASK_ROWS
    if n < 2:
        return rows
    parts = max(rows.sparkSession.sparkContext.defaultParallelism, rows.rdd.getNumPartitions())
    return rows.repartition(min(n, parts))
