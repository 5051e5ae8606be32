"""The run-wise windows give what a window over the whole key gives."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from roadlens.config import Settings
from roadlens.functions import rules
from roadlens.operators import ordered, roads, sensors


@pytest.fixture(autouse=True)
def keep_small_runs(spark):
    """Without this AQE joins the few test rows into one run."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


def test_several_runs(skewed):
    runs = ordered.range_runs(skewed, ["k", "t", "id"])
    assert runs.select("_run").distinct().count() > 4


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds a third of the rows, some keys a single one; times bunch up."""
    rng = random.Random(7)
    rows = []
    for i in range(900):
        key = "hot" if i % 3 == 0 else f"k{rng.randrange(60)}"
        second = rng.randrange(40) if rng.random() < 0.5 else rng.randrange(100_000)
        rows.append((i, key, datetime(2024, 1, 1) + timedelta(seconds=second), rng.random() * 60))
    return spark.createDataFrame(rows, "id int, k string, t timestamp_ntz, v double").cache()


def steps(depth):
    def first(window):
        return {"step": F.col("v") - F.lag("v").over(window)}

    def second(window):
        frame = window.rowsBetween(-(depth - 1), 0)
        return {"mean": F.avg("v").over(frame), "trend": F.avg("step").over(frame),
                "rows": F.count(F.lit(1)).over(frame), "far": F.lag("v", depth).over(window)}

    return [first, second]


def plain(df, keys, order, depth):
    window = Window.partitionBy(*keys).orderBy(*order)
    for step in steps(depth):
        df = df.withColumns(step(window))
    return df


def collected(df):
    return sorted(tuple(r) for r in df.select("id", "mean", "trend", "rows", "far").collect())


@pytest.mark.parametrize("depth", [1, 4, 24])
def test_hot_and_cold_keys_match_plain_windows(spark, skewed, depth):
    got = ordered.ordered_columns(skewed, ["k"], ["t", "id"], depth, steps(depth))
    assert collected(got) == collected(plain(skewed, ["k"], ["t", "id"], depth))


@pytest.mark.parametrize("depth", [1, 13])
def test_whole_table_as_one_sequence(spark, skewed, depth):
    got = ordered.ordered_columns(skewed, [], ["t", "id"], depth, steps(depth))
    want = plain(skewed.withColumn("one", F.lit(1)), ["one"], ["t", "id"], depth)
    assert collected(got) == collected(want)
    assert "SinglePartition" not in got._jdf.queryExecution().toString()


def test_fewer_rows_than_runs(spark):
    few = spark.createDataFrame(
        [(i, "a", datetime(2024, 1, 1, i), float(i)) for i in range(5)],
        "id int, k string, t timestamp_ntz, v double",
    )
    got = ordered.ordered_columns(few, ["k"], ["t", "id"], 4, steps(4))
    assert collected(got) == collected(plain(few, ["k"], ["t", "id"], 4))


def test_running_totals_and_positions(spark, skewed):
    got = ordered.running_totals(skewed.withColumn("n", F.col("id") % 5), ["k"], ["t", "id"], ["n"])
    window = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = skewed.withColumn("n_to_here", F.sum(F.col("id") % 5).over(window))
    pick = ["id", "n_to_here"]
    assert sorted(map(tuple, got.select(*pick).collect())) == sorted(
        map(tuple, want.select(*pick).collect())
    )
    placed = ordered.row_positions(skewed, ["t", "id"]).select("position", "t", "id").collect()
    placed = sorted(map(tuple, placed))
    assert [p for p, _, _ in placed] == list(range(900))
    assert [r[1:] for r in placed] == sorted(r[1:] for r in placed)


def test_transitions_across_midnight_and_gaps(spark):
    rows = [
        (1, datetime(2024, 1, 1, 23), "clear", 0.0),
        (2, datetime(2024, 1, 2, 0), "thunder", 7000.0),
        (3, datetime(2024, 1, 2, 1), "thunder", 7000.0),
        (4, datetime(2024, 1, 5, 1), "clear", 0.0),
    ]
    table = spark.createDataFrame(
        [(i, t, d, 10.0, 0.0, v) for i, t, d, v in rows],
        "event_id int, date_time timestamp_ntz, weather_description string,"
        " visibility_in_miles double, air_pollution_index double, traffic_volume double",
    )
    changes = roads.transitions(rules.score_risk(table, "report"), ["date_time", "event_id"])
    assert [(r["event_id"], r["previous_risk_level"], r["risk_level"])
            for r in changes.orderBy("date_time").collect()] == [
        (2, "Low", "Severe"), (4, "Severe", "Low")
    ]
