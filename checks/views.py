"""Traffic-shaped views over the test tables; the same SQL text serves Spark and DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)

VIEWS = {
    "readings": """
SELECT ts AS timestamp, CAST(user_id AS STRING) AS sensor_id, value AS speed FROM events""",
    "sensors": """
SELECT CAST(c_custkey AS STRING) AS sensor_id FROM customer
WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""",
    "readings_wide": """
SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS timestamp,
  avg(CASE WHEN event_type = 'click' THEN value END) AS click,
  avg(CASE WHEN event_type = 'error' THEN value END) AS error,
  avg(CASE WHEN event_type = 'purchase' THEN value END) AS purchase,
  avg(CASE WHEN event_type = 'signup' THEN value END) AS signup,
  avg(CASE WHEN event_type = 'view' THEN value END) AS view
FROM events GROUP BY date_trunc('hour', ts)""",
    # Customers and suppliers are the sensors, their dealings the roads; both grow with the tables.
    "distances": """
SELECT concat('c', CAST(o_custkey AS STRING)) AS source_sensor,
  concat('s', CAST(l_suppkey AS STRING)) AS target_sensor, min(l_extendedprice) AS distance_meters
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
GROUP BY o_custkey, l_suppkey
UNION ALL
SELECT concat('s', CAST(l_suppkey AS STRING)), concat('c', CAST(o_custkey AS STRING)),
  min(l_extendedprice + 1000 * l_quantity)
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
GROUP BY o_custkey, l_suppkey""",
    # The first customer of every region asks for routes to the suppliers of its orders' first lines, and
    # supplier 0 for the way to these customers: a bounded set of pairs. No road leads to a region.
    "route_pairs": """
SELECT DISTINCT concat('c', CAST(o_custkey AS STRING)) AS source,
  concat('s', CAST(l_suppkey AS STRING)) AS target
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE l_linenumber = 1 AND o_custkey IN (
  SELECT min(c_custkey) FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_regionkey)
UNION
SELECT 's0', concat('c', CAST(min(c_custkey) AS STRING))
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_regionkey
UNION
SELECT 's0', r_name FROM region
UNION
SELECT concat('s', CAST(s_suppkey AS STRING)), concat('s', CAST(s_suppkey AS STRING)) FROM supplier""",
    "route_readings": """
SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS timestamp,
  concat('c', CAST(user_id AS STRING)) AS sensor_id, max(value) AS speed
FROM events GROUP BY date_trunc('day', ts), user_id
UNION ALL
SELECT CAST(date_trunc('day', ts) AS TIMESTAMP), concat('s', CAST(user_id % 100 AS STRING)), min(value)
FROM events GROUP BY date_trunc('day', ts), user_id % 100""",
    "route_wide": """
SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS timestamp,
  max(CASE WHEN user_id % 5 = 0 THEN value END) AS s0, max(CASE WHEN user_id % 5 = 1 THEN value END) AS s1,
  max(CASE WHEN user_id % 5 = 2 THEN value END) AS s2, max(CASE WHEN user_id % 5 = 3 THEN value END) AS s3,
  max(CASE WHEN user_id % 5 = 4 THEN value END) AS s4
FROM events GROUP BY date_trunc('day', ts)""",
    "junction_counts": """
SELECT event_id AS ID, ts AS DateTime, CAST(user_id % 4 + 1 AS INT) AS Junction,
  CAST(floor(value) AS INT) AS Vehicles
FROM events""",
    "road_conditions": """
SELECT event_id, ts AS date_time,
  CASE WHEN event_id % 23 = 0 THEN NULL ELSE CAST(floor(value * 60) AS DOUBLE) END AS traffic_volume,
  CASE WHEN event_id % 19 = 0 THEN NULL
    ELSE CAST((event_id * 37) % 300 AS DOUBLE) END AS air_pollution_index,
  CAST(event_id % 101 AS DOUBLE) AS humidity,
  CASE WHEN event_id % 17 = 0 THEN NULL ELSE CAST(event_id % 7 AS DOUBLE) END AS visibility_in_miles,
  CAST(270 + event_id % 40 AS DOUBLE) AS temperature,
  CAST(event_id % 5 AS DOUBLE) AS rain_p_h, CAST(event_id % 2 AS DOUBLE) AS snow_p_h,
  event_type AS weather_type,
  CASE event_id % 12 WHEN 0 THEN 'sky is clear' WHEN 1 THEN 'broken clouds' WHEN 2 THEN 'light rain'
    WHEN 3 THEN 'thunderstorm with light rain' WHEN 4 THEN 'fog' WHEN 5 THEN 'light snow'
    WHEN 6 THEN ' Mist ' WHEN 7 THEN 'shower drizzle' WHEN 8 THEN 'smoke' WHEN 9 THEN 'SQUALLS'
    WHEN 10 THEN 'sleet and rain' END AS weather_description
FROM events""",
    "vehicle_mix": """
SELECT slot, CarCount, BikeCount, BusCount, TruckCount, Total,
  CASE WHEN Total >= 20 THEN 'heavy' WHEN Total >= 15 THEN 'high' WHEN Total >= 11 THEN 'normal'
    ELSE 'low' END AS TrafficSituation
FROM (SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS slot,
  CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS INT) AS CarCount,
  CAST(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS INT) AS BikeCount,
  CAST(sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS INT) AS BusCount,
  CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS INT) AS TruckCount,
  CAST(sum(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) AS INT) AS Total
  FROM events GROUP BY date_trunc('hour', ts)) x""",
}
_TIMES = {
    "readings_wide": "timestamp",
    "route_readings": "timestamp",
    "route_wide": "timestamp",
    "vehicle_mix": "slot",
}


def _distances(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """The rows of ``distances``: both directions of a road from one join and one grouping, not two."""
    dealt = lineitem.join(orders, lineitem["l_orderkey"] == orders["o_orderkey"])
    there = F.min("l_extendedprice").alias("there")
    back = F.min(F.col("l_extendedprice") + 1000 * F.col("l_quantity")).alias("back")
    both = dealt.groupBy("o_custkey", "l_suppkey").agg(there, back)
    customer = F.concat(F.lit("c"), F.col("o_custkey").cast("string"))
    supplier = F.concat(F.lit("s"), F.col("l_suppkey").cast("string"))

    def road(start: Column, end: Column, length: str) -> Column:
        return F.struct(start.alias("source_sensor"), end.alias("target_sensor"), F.col(length).alias("distance_meters"))

    ways = F.array(road(customer, supplier, "there"), road(supplier, customer, "back"))
    return both.select(F.inline(ways))


def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The view as a lazy DataFrame over ``folder``; no temp view is registered."""
    if name == "distances":
        return _distances(*(spark.read.parquet(f"{folder}/{table}.parquet") for table in ("lineitem", "orders")))
    sql = VIEWS[name]
    used = [t for t in TABLES if re.search(rf"\b{t}\b", sql)]
    frames = {t: spark.read.parquet(f"{folder}/{t}.parquet") for t in used}
    text = sql
    for table in used:
        text = re.sub(rf"\b(FROM|JOIN) {table}\b", rf"\1 {{{table}}}", text)
    frame = spark.sql(text, **frames)
    if name in _TIMES:  # date_trunc answers with a zoned timestamp
        frame = frame.withColumn(_TIMES[name], frame[_TIMES[name]].cast("timestamp_ntz"))
    return frame


def with_views(*names: str, **steps: str) -> str:
    """``WITH`` clause holding the named views, then the given steps, in order."""
    parts = [f"{name} AS ({VIEWS[name].strip()})" for name in names]
    parts += [f"{name} AS ({sql.strip()})" for name, sql in steps.items()]
    return "WITH " + ",\n".join(parts) + "\n"


def half_up(expression: str, places: int) -> str:
    """Spark rounds the decimal digits of a double half up; DuckDB's round() multiplies first."""
    digits = f"CAST(CAST({expression} AS VARCHAR) AS DECIMAL(38, 18))"
    return f"CAST(round({digits}, {places}) AS DOUBLE)"
