"""Ordered windows and joins that stay balanced when one key holds a large share of the rows.

Rows are range-partitioned on (key, order) into equal runs, whatever the keys hold, and each run
also receives the few rows before it that its frames reach back to. Every row so gets exactly the
frame a window over its whole key would give. This costs two full shuffles: one by range, one that
brings the runs and their borrowed rows together.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from roadlens.operators.lineage import cut

Step = Callable[[WindowSpec], dict[str, Column]]


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ordered_columns(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    depth: int,
    steps: Sequence[Step],
    per_key: DataFrame | None = None,
) -> DataFrame:
    """Add window columns whose frames reach at most ``depth`` rows back.

    Each step maps a window (partitioned and ordered) to new columns; a later step may
    use columns of an earlier one, and ``depth`` then is the sum of their reaches.
    ``per_key`` is an optional table with one row per key; its columns are joined to every
    row on the way, and AQE splits that join where a key is hot. Without ``keys`` the whole
    table is one ordered sequence.
    """
    if per_key is not None:
        df = df.join(per_key, list(keys))
    runs = range_runs(df, [*keys, *order], descending=True)
    # The last rows of a run also go to the next `depth` runs. No run between two others
    # is empty, so `depth` rows back never lies more than `depth` runs back.
    homes = F.when(
        F.col("_place") < depth, F.sequence(F.col("_run"), F.col("_run") + depth)
    ).otherwise(F.array("_run"))
    done = runs.withColumn("_home", F.explode(homes))
    window = Window.partitionBy("_home", *keys).orderBy(*order)
    for step in steps:
        done = done.withColumns(step(window))
    return done.where(F.col("_home") == F.col("_run")).drop("_run", "_place", "_home")


def range_runs(df: DataFrame, line: Sequence[str], descending: bool = False) -> DataFrame:
    """Cut the table into equal runs along ``line``; adds ``_run`` and the place in the run.

    At most one run per shuffle partition; AQE may join neighbouring small runs.
    """
    direction = F.desc if descending else F.asc
    return (
        df.repartitionByRange(*line)
        .sortWithinPartitions(*[direction(name) for name in line])
        .withColumns(
            {
                "_run": F.spark_partition_id(),
                # The lower 33 bits of the generated id count the rows of a partition.
                "_place": F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1)),
            }
        )
    )


def running_totals(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Adds ``<value>_to_here``: the sum over all rows of the key up to this one.

    Sums inside equal runs, plus what the runs before add up to. The second part is a table
    with at most one row per run and key.
    """
    runs = cut(range_runs(df, [*keys, *order]))  # fixes which row is in which run
    inside = Window.partitionBy("_run", *keys).orderBy(*order)
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy(*keys).orderBy("_run")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    so_far = runs.withColumns({f"{v}_to_here": F.sum(v).over(inside) for v in values})
    per_run = runs.groupBy("_run", *keys).agg(*[F.sum(v).alias(f"_{v}") for v in values])
    before = per_run.select(
        "_run",
        *keys,
        *[F.coalesce(F.sum(f"_{v}").over(earlier), F.lit(0)).alias(f"_before_{v}") for v in values],
    )
    joined = so_far.join(before, ["_run", *keys])
    sums = {f"{v}_to_here": F.col(f"{v}_to_here") + F.col(f"_before_{v}") for v in values}
    return joined.withColumns(sums).drop("_run", "_place", *[f"_before_{v}" for v in values])


def row_positions(df: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """Adds the 0-based place of every row in the given order over the whole table."""
    runs = cut(range_runs(df, order))
    sizes = runs.groupBy("_run").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    # One row per run: never more rows than the session has shuffle partitions.
    starts = sizes.select(
        "_run", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start")
    )
    placed = runs.join(F.broadcast(starts), "_run")
    return placed.withColumn(name, F.col("_start") + F.col("_place")).drop(
        "_run", "_place", "_start"
    )
