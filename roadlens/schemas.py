"""Fixed schemas of the inputs and of the result tables."""

from __future__ import annotations

READINGS = "timestamp timestamp_ntz, sensor_id string, speed double"
SENSORS = "sensor_id string"
EDGES = "source_sensor string, target_sensor string, distance_meters double"
EDGE_FILE = "`from` string, `to` string, cost double"

JUNCTION_COUNTS = "DateTime timestamp_ntz, Junction int, Vehicles int"

ROAD_NUMBERS = (
    "traffic_volume",
    "air_pollution_index",
    "humidity",
    "visibility_in_miles",
    "temperature",
    "rain_p_h",
    "snow_p_h",
)
ROAD_TEXTS = ("weather_type", "weather_description")

VEHICLE_CLASSES = ("CarCount", "BikeCount", "BusCount", "TruckCount")

METRICS = (
    READINGS
    + ", free_flow_speed double, avg_speed_1h double, speed_std_1h double, density_proxy double,"
    " density_score double, congestion_level string, travel_time_multiplier double,"
    " hour_of_day int, is_peak_period boolean"
)
ALERTS = (
    READINGS
    + ", free_flow_speed double, density_score double, congestion_level string,"
    " travel_time_multiplier double, is_peak_period boolean"
)
FORECAST = (
    READINGS
    + ", forecast_speed double, forecast_density_score double, forecast_congestion_level string"
)
ANOMALIES = (
    READINGS
    + ", avg_speed_1h double, speed_zscore double, anomaly_type string, congestion_level string"
)
PRICING = (
    "timestamp timestamp_ntz, sensor_id string, congestion_level string, density_score double,"
    " demand_index double, public_transport_fare_multiplier double,"
    " congestion_charge_usd double, parking_fee_usd double"
)

DAY = "day"  # the folder column of the result tables
# Result folder of the sensor job -> schema of the table in it.
RESULT_TABLES = {
    "traffic_metrics.parquet": METRICS,
    "congestion_alerts.parquet": ALERTS,
    "traffic_forecast.parquet": FORECAST,
    "anomalies.parquet": ANOMALIES,
    "pricing_recommendations.parquet": PRICING,
}


def column_names(ddl: str) -> list[str]:
    """Column names of one of the schemas above, in order."""
    return [part.split()[0].strip("`") for part in ddl.split(",")]
