"""Model quality from a table of predictions, computed by grouped counts and running totals."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.functions.scalars import uniform_hash
from roadlens.operators.lineage import staging
from roadlens.operators.ordered import row_positions, running_totals

REPORT = ("precision", "recall", "f1_score")


def distinct_labels(df: DataFrame, label: str) -> DataFrame:
    """One row: how many classes there are, and the sorted list of them."""
    classes = F.sort_array(F.collect_set(label))
    return df.agg(classes.alias("classes")).withColumn("n_classes", F.size("classes"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Per class: its rows and total rows / (number of classes * rows of the class).

    Rows without a label belong to no class and count nowhere.
    """
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    everything = counts.agg((F.sum("n") / F.count(F.lit(1))).alias("mean")).scalar()
    return counts.withColumn("weight", everything / F.col("n"))


def per_class(table: DataFrame, label: str, value: str) -> Column:
    """Value of the row's class, from a table with one row per class.

    The table becomes one constant map inside the plan, so a class with most of the rows
    causes no shuffle. Meant for class tables only.
    """
    pairs = F.collect_list(F.struct(F.col(label), F.col(value)))
    constant = table.agg(F.map_from_entries(pairs)).scalar()
    return F.try_element_at(constant, F.col(label))


def with_class_weight(df: DataFrame, label: str, name: str = "class_weight") -> DataFrame:
    return df.withColumn(name, per_class(class_weights(df, label), label, "weight"))


# Classification


def confusion(
    predictions: DataFrame, labels: Sequence[str], actual="actual", predicted="predicted"
) -> DataFrame:
    """Every pair of classes with the number of rows, 0 where there is none."""
    spark = predictions.sparkSession
    names = F.array(*[F.lit(name) for name in labels])
    grid = (
        spark.range(0, 1, 1, 1)
        .select(F.explode(names).alias("actual"))
        .withColumn("predicted", F.explode(names))
    )
    counted = predictions.groupBy(
        F.col(actual).alias("actual"), F.col(predicted).alias("predicted")
    ).agg(F.count(F.lit(1)).alias("n"))
    return grid.join(counted, ["actual", "predicted"], "left").fillna(0, ["n"])


def confusion_matrix(matrix: DataFrame, labels: Sequence[str]) -> DataFrame:
    """The long confusion table with one column per predicted class."""
    wide = matrix.groupBy("actual").pivot("predicted", list(labels)).agg(F.sum("n"))
    return wide.orderBy("actual")


def class_report(matrix: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support per class; a zero denominator gives 0."""
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    none = F.lit(0).cast("long")

    def part(label: str, support: Column, claimed: Column, hits: Column) -> Column:
        return F.struct(
            F.col(label).alias("label"),
            support.cast("long").alias("support"),
            claimed.cast("long").alias("claimed"),
            hits.cast("long").alias("hits"),
        )

    both = F.array(part("actual", F.col("n"), none, hit), part("predicted", none, F.col("n"), none))
    sums = (
        matrix.select(*by, F.explode(both).alias("part"))
        .groupBy(*by, F.col("part.label").alias("label"))
        .agg(*[F.sum(f"part.{name}").alias(name) for name in ("support", "claimed", "hits")])
    )
    ratio = {
        "precision": F.try_divide(F.col("hits"), F.col("claimed")),
        "recall": F.try_divide(F.col("hits"), F.col("support")),
        "f1_score": F.try_divide(2 * F.col("hits"), F.col("claimed") + F.col("support")),
    }
    filled = {name: F.coalesce(value, F.lit(0.0)) for name, value in ratio.items()}
    return sums.withColumns(filled).select(*by, "label", *REPORT, "support", "hits")


def _weighted(name: str) -> Column:
    return F.sum(F.col(name) * F.col("support")) / F.sum("support")


def full_report(matrix: DataFrame) -> DataFrame:
    """Rows per class, then their plain and their support-weighted average."""
    classes = class_report(matrix).drop("hits")
    support = F.sum("support").alias("support")
    macro = classes.agg(*[F.avg(name).alias(name) for name in REPORT], support)
    weighted = classes.agg(*[_weighted(name).alias(name) for name in REPORT], support)
    return (
        classes.unionByName(macro.withColumn("label", F.lit("macro avg")))
        .unionByName(weighted.withColumn("label", F.lit("weighted avg")))
    )


def classification_metrics(matrix: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1, in total or per group."""
    classes = class_report(matrix, by)
    accuracy = (F.sum("hits") / F.sum("support")).alias("accuracy")
    columns = [accuracy, *[_weighted(name).alias(name) for name in REPORT]]
    return classes.groupBy(*by).agg(*columns) if by else classes.agg(*columns)


def roc_points(
    predictions: DataFrame, labels: Sequence[str], actual="actual", scores="scores"
) -> DataFrame:
    """False and true positive rate of every class at every distinct score, one class vs rest.

    ``scores`` is an array in the order of ``labels``. Equal scores are counted first; the
    cumulative counts come from running_totals, so no class is gathered in one task. Classes
    that are all positive or all negative have no curve. Every curve starts at (0, 0), above
    any score, with a null threshold.
    """
    each = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("label"),
                    F.col(scores)[place].alias("score"),
                    (F.col(actual) == name).cast("long").alias("hit"),
                )
                for place, name in enumerate(labels)
            ]
        )
    )
    counted = (
        predictions.select(each.alias("one"))
        .groupBy("one.label", (-F.col("one.score")).alias("descending"))
        .agg(
            F.sum("one.hit").alias("positives"),
            F.sum(1 - F.col("one.hit")).alias("negatives"),
        )
    )
    running = running_totals(counted, ["label"], ["descending"], ["positives", "negatives"])
    # One row per class.
    totals = F.broadcast(
        counted.groupBy("label")
        .agg(F.sum("positives").alias("p"), F.sum("negatives").alias("n"))
        .where((F.col("p") > 0) & (F.col("n") > 0))
    )
    start = totals.select(
        "label",
        F.lit(None).cast("double").alias("descending"),
        *[F.lit(0).cast("long").alias(c) for c in ("positives", "negatives", "positives_to_here", "negatives_to_here")],
        "p",
        "n",
    )
    return running.join(totals, "label").unionByName(start).select(
        "label",
        (-F.col("descending")).alias("threshold"),
        (F.col("negatives_to_here") / F.col("n")).alias("false_positive_rate"),
        (F.col("positives_to_here") / F.col("p")).alias("true_positive_rate"),
        "positives",
        "negatives",
        "positives_to_here",
        "p",
        "n",
    )


def class_auc(points: DataFrame) -> DataFrame:
    """Area under each class's curve, by the trapezoid over its points."""
    above = F.col("positives_to_here") - F.col("positives") / 2
    area = F.sum(F.col("negatives") * above) / (F.first("p") * F.first("n"))
    return points.groupBy("label").agg(area.alias("auc"), F.first("p").alias("support"))


def weighted_auc(points: DataFrame) -> DataFrame:
    return class_auc(points).agg(_weighted("auc").alias("roc_auc_ovr_weighted"))


# Regression


def regression_metrics(
    predictions: DataFrame, actual: str = "Vehicles", predicted: str = "prediction"
) -> DataFrame:
    """rmse, mae and r2 in one pass."""
    error = F.col(actual) - F.col(predicted)
    squares = F.avg(error * error)
    return predictions.agg(
        F.sqrt(squares).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.try_divide(squares, F.var_pop(actual))).alias("r2"),
    )


def residual_histogram(
    predictions: DataFrame, bins: int = 30, actual="Vehicles", predicted="prediction"
) -> DataFrame:
    """Equal-width bins of actual - predicted from the smallest to the largest; the last is closed."""
    residuals = predictions.select((F.col(actual) - F.col(predicted)).alias("residual"))
    ends = residuals.agg(F.min("residual").alias("low"), F.max("residual").alias("high"))
    one = ends.select(F.struct("low", "high")).scalar()
    low, high = one.getField("low"), one.getField("high")
    width = (high - low) / bins
    place = F.coalesce(F.try_divide(F.col("residual") - low, width), F.lit(0.0))
    bin_number = F.least(F.floor(place), F.lit(bins - 1)).cast("int")
    placed = residuals.withColumn("bin", bin_number)
    counted = placed.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    edges = predictions.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return edges.join(counted, "bin", "left").select(
        "bin",
        (low + F.col("bin") * width).alias("bin_start"),
        (low + (F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


# Importance and comparison


def permutation_importance(
    rows: DataFrame,
    key: str,
    features: Sequence[str],
    predict: Callable[[DataFrame], DataFrame],
    actual: str = "actual",
    repeats: int = 5,
    seed: int = 42,
) -> DataFrame:
    """Mean loss of weighted F1 when one feature's values are dealt to other rows at random.

    ``predict`` adds a ``predicted`` column in the terms of ``actual``. The rows are numbered once, in a
    seeded order; every repeat deals them by another keyed permutation of the numbers, so nothing is
    sorted again and one join serves all repeats. All features are scored in one pass: every row appears
    once per repeat and feature, with that feature replaced, and in the first repeat once as is.
    """
    spark = rows.sparkSession
    with staging(spark) as stage:
        numbered = rows.select(key, actual, *features).withColumn("_h", uniform_hash(F.col(key), seed))
        base = stage(row_positions(numbered, ["_h", key]).drop("_h", key))
        n = base.count()
        own = base.withColumn("repeat", F.explode(F.sequence(F.lit(1), F.lit(repeats))))
        own = own.withColumn("_other", permuted(F.col("position"), n, seed, F.col("repeat")))
        dealt = base.select(F.col("position").alias("_other"), *[F.col(f).alias(f"_other_{f}") for f in features])
        paired = own.join(dealt, "_other")

        def version(changed: str) -> Column:
            values = [F.col(f"_other_{f}" if f == changed else f).alias(f) for f in features]
            return F.struct(F.lit(changed).alias("feature"), *values)

        replaced = [version(f) for f in features]
        versions = F.when(F.col("repeat") == 1, F.array(version(""), *replaced)).otherwise(F.array(*replaced))
        every = paired.select(actual, "repeat", F.explode(versions).alias("v"))
        scored = predict(every.select(actual, "repeat", "v.*"))
        matrix = stage(
            scored.groupBy("repeat", "feature", F.col(actual).alias("actual"), "predicted").agg(F.count(F.lit(1)).alias("n"))
        )
        f1 = classification_metrics(matrix, ["repeat", "feature"])
        losses = f1.groupBy("feature").agg(F.avg("f1_score").alias("f1")).collect()
    whole = next((row["f1"] for row in losses if row["feature"] == ""), None)
    found = [(row["feature"], whole - row["f1"]) for row in losses if row["feature"]]
    return spark.createDataFrame(found, "feature string, importance double")


def permuted(place: Column, n: int, seed: int, key: Column, rounds: int = 6) -> Column:
    """Where a keyed permutation of 0 .. n - 1 takes a place.

    The places are laid out as a grid of about sqrt(n) rows and columns. Every round moves a row number by
    a hash of the column number and the other way about, which can be undone, so no two places meet. The
    few that land behind n go round again.
    """
    wide = max(1, math.isqrt(max(0, n - 1)) + 1)
    high = max(1, -(-n // wide))

    def once(at: Column) -> Column:
        pair = F.struct(F.floor(at / wide).alias("row"), F.pmod(at, F.lit(wide)).alias("column"))

        def step(state: Column, turn: Column) -> Column:
            row = F.pmod(state["row"] + F.pmod(F.xxhash64(F.lit(seed), key, turn, state["column"]), F.lit(high)), F.lit(high))
            column = F.pmod(state["column"] + F.pmod(F.xxhash64(F.lit(~seed), key, turn, row), F.lit(wide)), F.lit(wide))
            return F.struct(row.alias("row"), column.alias("column"))

        turns = F.sequence(F.lit(1), F.lit(rounds))
        return F.aggregate(turns, pair, step, lambda state: state["row"] * wide + state["column"])

    # A walk stays behind n with a chance below 1 / sqrt(n) each time.
    walks = F.sequence(F.lit(1), F.lit(64))
    end = F.aggregate(walks, once(place), lambda at, _: F.when(at < n, at).otherwise(once(at)))
    return F.when(end < n, end).otherwise(F.raise_error(F.lit("A permutation's walk did not end.")).cast("long"))


def top_importances(importances: DataFrame, limit: int = 20) -> DataFrame:
    return importances.orderBy(F.col("importance").desc(), "feature").limit(limit)


def leaderboard(results: DataFrame, *measures: str) -> DataFrame:
    """Models, best first, by the given measures in turn."""
    return results.orderBy(*[F.col(m).desc() for m in measures], "model")
