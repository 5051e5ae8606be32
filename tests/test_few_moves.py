"""Roads and rows that need not move stay where they are: few pairs, few rows in front, whole tasks."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from roadlens import schemas
from roadlens.ml import boosting, models, training
from roadlens.operators import paths, routing
from roadlens.operators.lineage import staging

LATEST = "timestamp timestamp_ntz, sensor_id string, travel_time_multiplier double, congestion_level string"


def test_roads_dearer_than_known_ways_are_left_out(spark):
    chain = [(f"n{i}", f"n{i + 1}", 2.0) for i in range(4)]
    dear = [("n1", "n3", 5.0), ("x", "y", 9.0), ("n0", "y", 50.0), ("y", "n4", 50.0)]
    edges = spark.createDataFrame([*chain, *dear, ("x", "n2", None)], schemas.EDGES)
    latest = spark.createDataFrame([], LATEST)

    def left(pairs):
        with staging(spark) as stage:
            wanted = spark.createDataFrame(pairs, "source string, target string")
            return {(r[0], r[1]) for r in routing.useful_roads(wanted, edges, latest, stage).collect()}

    # The way costs 8, of which 4 are for the roads at its ends.
    ends = {("n0", "y"), ("y", "n4")}
    assert left([("n0", "n4"), ("n4", "q")]) == {e[:2] for e in chain} | ends
    assert left([("n0", "n4"), ("y", "x")]) == {e[:2] for e in chain} | ends  # no road leads to x
    assert len(left([("n0", "n4"), ("n4", "y")])) == len(chain) + len(ends)  # none leaves n4
    assert len(left([("n0", "n4"), ("x", "n1")])) == len(chain + dear)  # no way is known
    assert left([("n4", "n0"), ("n1", "n1")]) == set()


def test_few_rows_go_to_the_roads(spark):
    roads = spark.range(2_000_000).selectExpr("id AS node", "id + 1 AS next", "1.0D AS weight", "0.0D AS from_0", "0.0D AS to_0")
    with staging(spark) as stage:
        active = stage(spark.createDataFrame([(1, 1, 0.0, 0)], "source long, node long, cost double, zeros int"))
        limits = stage(spark.createDataFrame([(1, 9.0, 9.0, 9.0)], "source long, reach double, most_from_0 double, most_to_0 double"))
        step = paths._step(active, stage(roads), limits, True)
        assert "SortMergeJoin" not in step._jdf.queryExecution().executedPlan().toString()
        assert [(r["node"], r["cost"]) for r in step.collect()] == [(2, 1.0)]


def test_a_task_sends_one_row_per_tree_and_node():
    rng = np.random.default_rng(4)
    fit = boosting.Fit([boosting.Member(0.1)], 3, 2, [], np.zeros((1, 3)))

    def batch(n):
        columns = {"bins": [rng.integers(0, 4, 2, np.uint8).tobytes() for _ in range(n)], "scores": [np.zeros(3).tobytes()] * n}
        numbers = {"label": rng.integers(0, 3, n), "weight": rng.random(n) + 0.5, "fold": np.full(n, -2), "part": np.full(n, 7)}
        return pa.RecordBatch.from_pydict(columns | numbers)

    batches = [batch(50), batch(0), batch(30)]
    run = boosting._level_sums(fit, boosting.Trees.empty(3, 2), 0, 2)
    table = pa.Table.from_batches(list(run(iter(batches))))
    assert table["tree"].to_pylist() == [0, 1, 2] and set(table["part"].to_pylist()) == {7}
    weight = np.concatenate([b.column("weight").to_numpy() for b in batches])
    label = np.concatenate([b.column("label").to_numpy() for b in batches])
    bins = np.frombuffer(b"".join(x for b in batches for x in b.column("bins").to_pylist()), np.uint8).reshape(-1, 2)
    for tree in range(3):
        places, sums = table["place"][tree].as_py(), np.reshape(table["sums"][tree].as_py(), (4, -1))
        for j, place in enumerate(places):
            here = bins[:, place >> 8] == place & 255
            rest = (label[here] == tree) - 1 / 3
            want = [weight[here].sum(), (weight[here] * rest).sum(), (weight[here] * abs(rest) * (1 - abs(rest))).sum(), here.sum()]
            assert np.allclose(sums[:, j], want)


def test_volume_is_forecast_by_several_tasks(spark, monkeypatch):
    seen = []

    class Model:
        def transform(self, rows):
            seen.append(rows.rdd.getNumPartitions())
            return rows.withColumn("prediction", F.lit(1.0))

    monkeypatch.setattr(models, "volume_forecaster", lambda *a: type("Forest", (), {"fit": lambda self, rows: Model()})())
    counts = spark.range(0, 60_000, 1, 1).select(
        F.col("id").alias("ID"),
        F.timestamp_seconds(F.col("id") * 600).cast("timestamp_ntz").alias("DateTime"),
        (F.col("id") % 3).cast("int").alias("Junction"),
        (F.col("id") * 7 % 50).cast("int").alias("Vehicles"),
    )
    demand = training.features.demand_features
    monkeypatch.setattr(training.features, "demand_features", lambda rows, ties: demand(rows, ties).coalesce(1))
    assert training.train_volume(counts, ["ID"]).predictions.count() > 10_000 and seen[0] > 1


def test_no_road_is_of_use(spark):
    pairs = spark.createDataFrame([("b", "a"), ("q", "q")], "source string, target string")
    edges = spark.createDataFrame([("a", "b", 10.0), ("a", "a", -1.0)], schemas.EDGES)
    got = {r["source"]: r for r in routing.least_cost_routes(pairs, edges, spark.createDataFrame([], LATEST)).collect()}
    assert got["b"]["error"] == routing.NO_PATH and got["q"]["path"] == ["q"]
