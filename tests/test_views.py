"""Views that are not run as their SQL give the rows of it."""

from pyspark.sql import functions as F

from checks.views import VIEWS, view
from roadlens.operators import reshape
from roadlens.sources import readers, sinks


def _tables(spark, folder):
    lines = [(k, s, float(p), float(q)) for k, s, p, q in (
        (1, 7, 50, 2), (1, 7, 40, 9), (2, 7, 45, 1), (2, 8, 10, 1), (3, 9, 5, 1), (9, 9, 1, 1),
    )]
    lines += [(1, 7, None, 1.0), (2, None, 3.0, 1.0), (None, 8, 2.0, 1.0), (3, 9, 4.0, None), (4, 9, None, None), (1, 7, 40.0, 9.0)]
    orders = [(1, 1), (2, 1), (3, 2), (4, 3), (4, 3), (5, 1), (2, None)]
    spark.createDataFrame(lines, "l_orderkey long, l_suppkey long, l_extendedprice double, l_quantity double").write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(f"{folder}/orders.parquet")


def test_distances_are_those_of_the_sql(spark, tmp_path):
    _tables(spark, tmp_path)
    frames = {name: spark.read.parquet(f"{tmp_path}/{name}.parquet") for name in ("lineitem", "orders")}
    asked = VIEWS["distances"].replace("FROM lineitem JOIN orders", "FROM {lineitem} JOIN {orders}")
    expected, got = spark.sql(asked, **frames), view(spark, str(tmp_path), "distances")
    assert got.dtypes == expected.dtypes
    order = lambda rows: sorted(map(tuple, rows), key=str)
    assert order(got.collect()) == order(expected.collect())


def test_distances_read_the_dealings_once(spark, tmp_path):
    _tables(spark, tmp_path)
    plan = view(spark, str(tmp_path), "distances").where(F.col("distance_meters") > 0)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 2 and plan.count("Aggregate") == 1


def test_packed_text_is_smaller_and_reads_back(spark, tmp_path):
    rows = spark.range(0, 5_000, 1, 2).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("from"), F.lit("s1").alias("to"), (F.col("id") * 1.5).alias("cost"))
    sizes = {}
    for kind in ("none", "gzip"):
        sinks.write_csv(rows, f"{tmp_path}/{kind}", kind)
        sizes[kind] = sum(p.stat().st_size for p in (tmp_path / kind).glob("part-*"))
    got = reshape.road_edges(readers.header_csv(spark, f"{tmp_path}/gzip"))
    assert sizes["gzip"] < sizes["none"] / 2
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.collect()))
