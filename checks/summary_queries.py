"""Junction counts, road conditions, vehicle mix and request validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.sensor_queries import rounded
from checks.views import view, with_views
from roadlens.functions import rules, scalars
from roadlens.operators import junctions, requests, reshape, roads, vehicles
from roadlens.schemas import ROAD_NUMBERS

# Junction counts


def _flat(spark, folder):
    return junctions.label_flat(view(spark, folder, "junction_counts"))


def _peak(spark, folder):
    return junctions.label_peak(view(spark, folder, "junction_counts"))


def junction_flat_fares(spark, folder):
    return _flat(spark, folder)


def junction_peak_fares(spark, folder):
    return _peak(spark, folder)


def junction_overall(spark, folder):
    return junctions.overall(_flat(spark, folder))


def junction_dataset_range(spark, folder):
    return junctions.dataset_range(_peak(spark, folder))


def junction_hourly(spark, folder):
    return junctions.hourly(_peak(spark, folder))


def junction_first_hours(spark, folder):
    return junctions.hourly(_flat(spark, folder), hours=12)


def junction_totals(spark, folder):
    return junctions.by(_peak(spark, folder), "Junction", fare_average=True)


def junction_hour_totals(spark, folder):
    return junctions.by(_peak(spark, folder), "Junction", "hour_of_day")


def time_band_totals(spark, folder):
    return junctions.by(_peak(spark, folder), "time_band")


def time_band_level_totals(spark, folder):
    return junctions.by(_peak(spark, folder), "time_band", "traffic_level")


def hour_extremes(spark, folder):
    grouped = junctions.by(_flat(spark, folder), "hour_of_day")
    return junctions.extremes(grouped, ["hour_of_day"], "average_vehicles")


def junction_extremes(spark, folder):
    grouped = junctions.by(_peak(spark, folder), "Junction")
    return junctions.extremes(grouped, ["Junction"], "average_vehicles")


def junction_hour_extremes(spark, folder):
    return junctions.extremes(
        junction_hour_totals(spark, folder), ["Junction", "hour_of_day"], "average_vehicles"
    )


def most_congested_band(spark, folder):
    grouped = time_band_totals(spark, folder)
    return junctions.ranked(grouped, ["time_band"], "average_vehicles", 1, highest=True)


def commonest_level(spark, folder):
    return junctions.commonest_level(_peak(spark, folder))


def quietest_junction_hours(spark, folder):
    grouped = junction_hour_totals(spark, folder)
    keys = ["Junction", "hour_of_day"]
    return junctions.ranked(grouped, keys, "average_vehicles", 10, highest=False)


def busiest_junction_hours(spark, folder):
    grouped = junction_hour_totals(spark, folder)
    keys = ["Junction", "hour_of_day"]
    return junctions.ranked(grouped, keys, "average_vehicles", 10, highest=True)


# Road conditions


def _scored(spark, folder, scheme="summary"):
    return rules.score_risk(roads.with_hour(view(spark, folder, "road_conditions")), scheme)


_SCORES = (
    "event_id",
    "weather_category",
    "weather_severity",
    "visibility_risk",
    "pollution_risk",
    "traffic_risk",
    "total_risk_score",
    "risk_level",
)


def _risk_rows(scheme):
    return lambda spark, folder: _scored(spark, folder, scheme).select(*_SCORES)


def risk_intelligence(spark, folder):
    return roads.intelligence(view(spark, folder, "road_conditions")).select(
        "event_id", "hour", "rush_hour", "risk_level", "risk_reason"
    )


def hourly_risk(spark, folder):
    return roads.hourly_risk(_scored(spark, folder))


def risk_hour_extremes(spark, folder):
    return junctions.extremes(hourly_risk(spark, folder), ["hour"], "avg_risk_score")


def _level_table(scored):
    table = roads.from_cube(roads.cube(scored), "risk_level")
    return table.select(
        "risk_level", "records", "avg_traffic_volume", F.col("avg_visibility_in_miles").alias("avg_visibility")
    )


def hour_level_table(scored):
    names = {
        "avg_traffic_volume": "avg_traffic",
        "avg_visibility_in_miles": "avg_visibility",
        "avg_weather_severity": "avg_weather",
        "avg_total_risk_score": "avg_risk",
    }
    table = roads.from_cube(roads.cube(scored), "hour", "risk_level")
    return table.drop("records").withColumnsRenamed(names)


def risk_level_summary(spark, folder):
    return rounded(
        _level_table(_scored(spark, folder)), 8, "avg_traffic_volume", "avg_visibility"
    )


def hour_level_risk(spark, folder):
    table = hour_level_table(_scored(spark, folder, "report"))
    return rounded(table, 8, "avg_traffic", "avg_visibility", "avg_weather", "avg_risk")


_ROAD_LINE = ["date_time", "event_id"]


def risk_transitions(spark, folder):
    return roads.transitions(_scored(spark, folder), _ROAD_LINE)


def first_risk_transitions(spark, folder):
    return roads.first_transitions(risk_transitions(spark, folder), _ROAD_LINE)


def median_imputation(spark, folder):
    conditions = roads.with_hour(view(spark, folder, "road_conditions"))
    filled = reshape.fill_medians(conditions, [*ROAD_NUMBERS, "hour"])
    texts = ["weather_type", "weather_description"]
    return reshape.keep_known(reshape.fill_constants(filled, texts=texts), ["date_time"])


# Vehicle mix


def _mix(spark, folder):
    return view(spark, folder, "vehicle_mix").withColumns(
        {
            "Time": F.date_format("slot", "h:mm:ss a"),
            "Date": F.date_format("slot", "d"),
            "DayOfWeek": F.date_format("slot", "EEEE"),
        }
    )


def prepared_vehicles(spark, folder):
    raw = _mix(spark, folder)
    raw = raw.withColumnsRenamed(
        {"DayOfWeek": "Day of the week", "TrafficSituation": "Traffic Situation"}
    )
    return vehicles.prepare(raw)


def vehicle_totals(spark, folder):
    return vehicles.totals(_mix(spark, folder))


def vehicle_composition(spark, folder):
    return rounded(vehicles.composition(_mix(spark, folder)), 8, "share_percent")


def situation_summary(spark, folder):
    return vehicles.by_situation(_mix(spark, folder))


def weekday_summary(spark, folder):
    return vehicles.by_weekday(_mix(spark, folder))


def daily_trend(spark, folder):
    return vehicles.daily_trend(_mix(spark, folder))


def clock_hours(spark, folder):
    text = F.date_format("ts", "h:mm:ss a")
    events = spark.read.parquet(f"{folder}/events.parquet")
    return events.select(
        "event_id",
        scalars.clock_hour(text).alias("clock_hour"),
        scalars.strict_clock_hour(text).alias("strict_hour"),
        scalars.clock_hour(F.col("event_type")).alias("no_hour"),
    )


def validated_requests(spark, folder):
    raw = view(spark, folder, "road_conditions")
    day = F.dayofmonth("date_time")
    raw = raw.select(
        "event_id",
        F.when(F.col("event_id") % 7 == 0, "x").otherwise(day.cast("string")).alias("hour"),
        F.when(F.col("event_id") % 5 > 0, (F.col("event_id") % 4).cast("string")).alias("junction"),
        F.lit(" 35 ").alias("car_count"),
        F.lit("8").alias("bike_count"),
        F.lit("3").alias("bus_count"),
        F.lit("4").alias("truck_count"),
        F.col("traffic_volume").cast("string").alias("traffic_volume"),
        F.col("air_pollution_index").cast("string").alias("air_pollution_index"),
        (F.col("humidity") - 20).cast("string").alias("humidity"),
        F.col("visibility_in_miles").cast("string").alias("visibility_in_miles"),
        F.lit("-3.5").alias("temperature"),
        F.col("rain_p_h").cast("string").alias("rain_p_h"),
        F.col("snow_p_h").cast("string").alias("snow_p_h"),
        "weather_type",
        "weather_description",
        F.lit("Tuesday").alias("day_of_week"),
    )
    checked = requests.validate(raw)
    return checked.select(
        "event_id", "hour", "junction", "car_count", "traffic_volume", "humidity",
        "weather_description", F.concat_ws("|", "errors").alias("messages"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        junction_flat_fares,
        junction_peak_fares,
        junction_overall,
        junction_dataset_range,
        junction_hourly,
        junction_first_hours,
        junction_totals,
        junction_hour_totals,
        time_band_totals,
        time_band_level_totals,
        hour_extremes,
        junction_extremes,
        junction_hour_extremes,
        most_congested_band,
        commonest_level,
        quietest_junction_hours,
        busiest_junction_hours,
        risk_intelligence,
        hourly_risk,
        risk_hour_extremes,
        risk_level_summary,
        hour_level_risk,
        risk_transitions,
        first_risk_transitions,
        median_imputation,
        prepared_vehicles,
        vehicle_totals,
        vehicle_composition,
        situation_summary,
        weekday_summary,
        daily_trend,
        clock_hours,
        validated_requests,
    )
}
QUERIES |= {f"risk_rows_{name}": _risk_rows(name) for name in rules.RISK_SCHEMES}

# SQL

_FLAT = """
SELECT *, CAST(hour(DateTime) AS INT) AS hour_of_day,
  CASE WHEN Vehicles <= 20 THEN 'Low Traffic' WHEN Vehicles <= 50 THEN 'Medium Traffic'
    ELSE 'High Traffic' END AS traffic_level,
  CASE WHEN Vehicles > 50 THEN 60 WHEN Vehicles > 20 THEN 30 ELSE 10 END AS dynamic_fare
FROM junction_counts
"""
_PEAK = """
SELECT *, CASE WHEN is_peak_hour = 1 THEN 'Peak Hour' ELSE 'Off-Peak' END AS time_band,
  CASE WHEN Vehicles > 50 THEN 40 + 20 * is_peak_hour WHEN Vehicles > 20 THEN 20 + 20 * is_peak_hour
    ELSE 10 END AS dynamic_fare
FROM (SELECT *, CAST(hour(DateTime) AS INT) AS hour_of_day,
    CASE WHEN Vehicles <= 20 THEN 'Low Traffic' WHEN Vehicles <= 50 THEN 'Medium Traffic'
      ELSE 'High Traffic' END AS traffic_level,
    CASE WHEN hour(DateTime) BETWEEN 8 AND 11 OR hour(DateTime) BETWEEN 17 AND 20 THEN 1 ELSE 0 END
      AS is_peak_hour
  FROM junction_counts)
"""
_TOTALS = """count(*) AS records, CAST(sum(Vehicles) AS BIGINT) AS total_vehicles,
  avg(Vehicles) AS average_vehicles, CAST(sum(dynamic_fare) AS BIGINT) AS total_fare"""
_FLAT_WITH = with_views("junction_counts", labeled=_FLAT)
_PEAK_WITH = with_views("junction_counts", labeled=_PEAK)


def _extremes(keys: list[str], value: str) -> str:
    line, back = ", ".join([value, *keys]), ", ".join(f"{c} DESC" for c in [value, *keys])
    low = ", ".join(f"{c} AS lowest_{c}" for c in [*keys, value])
    high = ", ".join(f"{c} AS highest_{c}" for c in [*keys, value])
    return f"""SELECT * FROM (SELECT {low} FROM grouped ORDER BY {line} LIMIT 1),
  (SELECT {high} FROM grouped ORDER BY {back} LIMIT 1)"""


def _ranked(keys: str, direction: str, limit: int) -> str:
    return f"""SELECT {keys}, {_TOTALS} FROM labeled GROUP BY {keys}
ORDER BY average_vehicles {direction}, {keys} LIMIT {limit}"""


def _risk(patterns: str, severity: str, inclusive: bool, banded: bool) -> str:
    """Scored rows; ``patterns`` is the list of CASE branches over the lower-case text d."""
    if inclusive:
        v, p, t = ("<= 1", "<= 3"), (">= 150", ">= 75"), (">= 6000", ">= 3000")
    else:
        v, p, t = ("< 2", "< 5"), ("> 150", "> 100"), ("> 6000", "> 3000")
    points = (
        "CASE WHEN weather_severity >= 4 THEN 2 WHEN weather_severity >= 2 THEN 1 ELSE 0 END"
        if banded
        else "weather_severity"
    )

    def score(column: str, bounds: tuple[str, str]) -> str:
        return f"CASE WHEN {column} {bounds[0]} THEN 2 WHEN {column} {bounds[1]} THEN 1 ELSE 0 END"

    return f"""
SELECT *, CASE WHEN total_risk_score >= 6 THEN 'Severe' WHEN total_risk_score >= 4 THEN 'High'
    WHEN total_risk_score >= 2 THEN 'Moderate' ELSE 'Low' END AS risk_level
FROM (SELECT *, CAST({points} + visibility_risk + pollution_risk + traffic_risk AS INT)
    AS total_risk_score
  FROM (SELECT *, CASE weather_category {severity} ELSE 1 END AS weather_severity,
      {score("visibility_in_miles", v)} AS visibility_risk,
      {score("air_pollution_index", p)} AS pollution_risk,
      {score("traffic_volume", t)} AS traffic_risk
    FROM (SELECT *, CAST(hour(date_time) AS INT) AS hour, CASE {patterns} END AS weather_category
      FROM (SELECT *, lower(coalesce(weather_description, 'unknown')) AS d FROM road_conditions))))
"""


def _cases(*pairs: tuple[str, str], otherwise: str) -> str:
    body = " ".join(f"WHEN regexp_matches(d, '{p}') THEN '{name}'" for p, name in pairs)
    return f"{body} ELSE '{otherwise}'"


_TO_4 = ("WHEN 'Clear' THEN 0 WHEN 'Cloudy' THEN 1 WHEN 'Rainy' THEN 2 "
         "WHEN 'Low Visibility' THEN 3 WHEN 'Storm' THEN 4 WHEN 'Snow' THEN 4")
_TO_5 = ("WHEN 'Clear' THEN 0 WHEN 'Cloudy' THEN 1 WHEN 'Rainy' THEN 2 "
         "WHEN 'Low Visibility' THEN 3 WHEN 'Snow' THEN 4 WHEN 'Storm' THEN 5")
RISK_SQL = {
    "summary": _risk(
        _cases(("clear", "Clear"), ("cloud", "Cloudy"), ("rain|drizzle", "Rainy"),
               ("fog|mist|haze|smoke", "Low Visibility"), ("thunder|storm", "Storm"),
               otherwise="Other"),
        _TO_4, False, False),
    "report": _risk(
        _cases(("clear", "Clear"), ("cloud", "Cloudy"), ("rain|drizzle", "Rainy"),
               ("thunder", "Storm"), ("snow|sleet", "Snow"),
               ("fog|mist|haze|smoke", "Low Visibility"), otherwise="Other"),
        _TO_4, False, False),
    "training": _risk(
        _cases(("thunder|storm|squall|tornado", "Storm"), ("snow|sleet|blizzard|flurr", "Snow"),
               ("fog|mist|smoke|haze|dust|sand", "Low Visibility"),
               ("rain|drizzle|shower", "Rainy"), ("cloud|overcast", "Cloudy"),
               ("clear|sun", "Clear"), otherwise="Cloudy"),
        _TO_5, True, True),
    "labels": _risk(
        _cases(("thunder|storm", "Storm"), ("snow|sleet", "Snow"),
               ("fog|mist|haze|smoke", "Low Visibility"), ("rain|drizzle", "Rainy"),
               ("cloud", "Cloudy"), ("clear", "Clear"), otherwise="Other"),
        _TO_4, False, False),
}


def risk_with(scheme: str, **steps: str) -> str:
    return with_views("road_conditions", scored=RISK_SQL[scheme], **steps)


_TRANSITIONS = """
SELECT event_id, date_time, previous_risk_level, risk_level, traffic_volume, visibility_in_miles
FROM (SELECT *, lag(risk_level) OVER (ORDER BY date_time, event_id) AS previous_risk_level FROM scored)
WHERE risk_level <> previous_risk_level
"""
_MIX_WITH = with_views(
    "vehicle_mix",
    mix="""
SELECT *, strftime(slot, '%-I:%M:%S %p') AS Time, strftime(slot, '%-d') AS Date,
  dayname(slot) AS DayOfWeek FROM vehicle_mix""",
)
_CLASS_SUMS = """CAST(sum(CarCount) AS BIGINT) AS total_cars, CAST(sum(BikeCount) AS BIGINT) AS total_bikes,
  CAST(sum(BusCount) AS BIGINT) AS total_buses, CAST(sum(TruckCount) AS BIGINT) AS total_trucks"""
_MEDIAN_COLUMNS = [*ROAD_NUMBERS, "hour"]

ORACLES = {
    "junction_flat_fares": _FLAT_WITH + "SELECT * FROM labeled",
    "junction_peak_fares": _PEAK_WITH + "SELECT * FROM labeled",
    "junction_overall": _FLAT_WITH + f"SELECT {_TOTALS} FROM labeled",
    "junction_dataset_range": _PEAK_WITH + f"""
SELECT min(DateTime) AS start_time, max(DateTime) AS end_time, {_TOTALS},
  datesub('second', min(DateTime), max(DateTime)) AS covered_seconds FROM labeled""",
    "junction_hourly": _PEAK_WITH + f"""
SELECT hour_of_day, {_TOTALS} FROM labeled GROUP BY hour_of_day""",
    "junction_first_hours": _FLAT_WITH + f"""
SELECT hour_of_day, {_TOTALS} FROM labeled GROUP BY hour_of_day ORDER BY hour_of_day LIMIT 12""",
    "junction_totals": _PEAK_WITH + f"""
SELECT Junction, {_TOTALS}, avg(dynamic_fare) AS average_fare FROM labeled GROUP BY Junction""",
    "junction_hour_totals": _PEAK_WITH + f"""
SELECT Junction, hour_of_day, {_TOTALS} FROM labeled GROUP BY Junction, hour_of_day""",
    "time_band_totals": _PEAK_WITH + f"""
SELECT time_band, {_TOTALS} FROM labeled GROUP BY time_band""",
    "time_band_level_totals": _PEAK_WITH + f"""
SELECT time_band, traffic_level, {_TOTALS} FROM labeled GROUP BY time_band, traffic_level""",
    "hour_extremes": with_views("junction_counts", labeled=_FLAT, grouped="""
SELECT hour_of_day, avg(Vehicles) AS average_vehicles FROM labeled GROUP BY hour_of_day""")
    + _extremes(["hour_of_day"], "average_vehicles"),
    "junction_extremes": with_views("junction_counts", labeled=_PEAK, grouped="""
SELECT Junction, avg(Vehicles) AS average_vehicles FROM labeled GROUP BY Junction""")
    + _extremes(["Junction"], "average_vehicles"),
    "junction_hour_extremes": with_views("junction_counts", labeled=_PEAK, grouped="""
SELECT Junction, hour_of_day, avg(Vehicles) AS average_vehicles FROM labeled
GROUP BY Junction, hour_of_day""") + _extremes(["Junction", "hour_of_day"], "average_vehicles"),
    "most_congested_band": _PEAK_WITH + _ranked("time_band", "DESC", 1),
    "commonest_level": _PEAK_WITH + """
SELECT traffic_level, count(*) AS records FROM labeled GROUP BY traffic_level
ORDER BY records DESC, traffic_level LIMIT 1""",
    "quietest_junction_hours": _PEAK_WITH + _ranked("Junction, hour_of_day", "ASC", 10),
    "busiest_junction_hours": _PEAK_WITH + _ranked("Junction, hour_of_day", "DESC", 10),
    "risk_intelligence": risk_with("report") + """
SELECT event_id, hour, CASE WHEN hour BETWEEN 8 AND 10 OR hour BETWEEN 17 AND 20 THEN 1 ELSE 0 END
  AS rush_hour, risk_level,
  CASE risk_level WHEN 'Severe' THEN 'High traffic + poor weather/visibility'
    WHEN 'High' THEN 'Heavy traffic or bad weather'
    WHEN 'Moderate' THEN 'Normal traffic with minor issues' ELSE 'Smooth conditions' END AS risk_reason
FROM scored""",
    "hourly_risk": risk_with("summary") + """
SELECT hour, avg(total_risk_score) AS avg_risk_score FROM scored GROUP BY hour""",
    "risk_hour_extremes": risk_with("summary", grouped="""
SELECT hour, avg(total_risk_score) AS avg_risk_score FROM scored GROUP BY hour""")
    + _extremes(["hour"], "avg_risk_score"),
    "risk_level_summary": risk_with("summary") + """
SELECT risk_level, count(*) AS records, round(avg(traffic_volume), 8) AS avg_traffic_volume,
  round(avg(visibility_in_miles), 8) AS avg_visibility FROM scored GROUP BY risk_level""",
    "hour_level_risk": risk_with("report") + """
SELECT hour, risk_level, round(avg(traffic_volume), 8) AS avg_traffic,
  round(avg(visibility_in_miles), 8) AS avg_visibility,
  round(avg(weather_severity), 8) AS avg_weather, round(avg(total_risk_score), 8) AS avg_risk
FROM scored GROUP BY hour, risk_level""",
    "risk_transitions": risk_with("summary") + _TRANSITIONS,
    "first_risk_transitions": risk_with("summary") + _TRANSITIONS
    + "ORDER BY date_time, event_id LIMIT 10",
    "median_imputation": with_views("road_conditions", timed="""
SELECT *, CAST(hour(date_time) AS INT) AS hour FROM road_conditions""") + """
SELECT event_id, date_time, """
    + ", ".join(
        f"coalesce({c}, (SELECT quantile_disc({c}, 0.5) FROM timed), 0) AS {c}"
        for c in _MEDIAN_COLUMNS
    )
    + """, coalesce(weather_type, 'Unknown') AS weather_type,
  coalesce(weather_description, 'Unknown') AS weather_description
FROM timed WHERE date_time IS NOT NULL""",
    "prepared_vehicles": _MIX_WITH + """
SELECT slot, CAST(CarCount AS DOUBLE) AS CarCount, CAST(BikeCount AS DOUBLE) AS BikeCount,
  CAST(BusCount AS DOUBLE) AS BusCount, CAST(TruckCount AS DOUBLE) AS TruckCount,
  CAST(Total AS DOUBLE) AS Total, TrafficSituation, Time, Date, DayOfWeek,
  CAST(hour(slot) AS INT) AS Time_hour,
  CASE WHEN Total > 0 THEN CarCount / Total::DOUBLE ELSE 0.0 END AS Car_ratio,
  CASE WHEN Total > 0 THEN (BusCount + TruckCount) / Total::DOUBLE ELSE 0.0 END AS Heavy_ratio
FROM mix""",
    "vehicle_totals": _MIX_WITH + f"""
SELECT {_CLASS_SUMS}, CAST(sum(Total) AS BIGINT) AS grand_total, count(*) AS records FROM mix""",
    "vehicle_composition": with_views("vehicle_mix", sums=f"SELECT {_CLASS_SUMS} FROM vehicle_mix")
    + """
SELECT vehicle_class, vehicles, round(vehicles * 100.0::DOUBLE / sum(vehicles) OVER (), 8)
  AS share_percent
FROM (UNPIVOT sums ON total_cars, total_bikes, total_buses, total_trucks
  INTO NAME vehicle_class VALUE vehicles)""",
    "situation_summary": _MIX_WITH + """
SELECT TrafficSituation, count(*) AS records, avg(Total) AS average_total_vehicles
FROM mix GROUP BY TrafficSituation""",
    "weekday_summary": _MIX_WITH + """
SELECT DayOfWeek, avg(Total) AS average_total_vehicles FROM mix GROUP BY DayOfWeek""",
    "daily_trend": _MIX_WITH + """
SELECT Time, avg(Total) AS average_total_vehicles FROM mix GROUP BY Time""",
    "clock_hours": """
SELECT event_id, CAST(hour(ts) AS INT) AS clock_hour, CAST(hour(ts) AS INT) AS strict_hour,
  CAST(NULL AS INT) AS no_hour FROM events""",
    "validated_requests": with_views("road_conditions") + """
SELECT event_id,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(day(date_time) AS INT) END AS hour,
  CASE WHEN event_id % 5 > 0 THEN CAST(event_id % 4 AS INT) END AS junction,
  35.0::DOUBLE AS car_count, traffic_volume, humidity - 20 AS humidity,
  trim(weather_description) AS weather_description,
  concat_ws('|', CASE WHEN event_id % 7 = 0 THEN 'hour must be a valid number.' END,
    CASE WHEN event_id % 5 = 0 THEN 'junction is required.' END,
    CASE WHEN traffic_volume IS NULL THEN 'traffic_volume is required.' END,
    CASE WHEN air_pollution_index IS NULL THEN 'air_pollution_index is required.' END,
    CASE WHEN visibility_in_miles IS NULL THEN 'visibility_in_miles is required.' END,
    CASE WHEN weather_description IS NULL THEN 'weather_description is required.' END,
    CASE WHEN event_id % 7 <> 0 AND day(date_time) > 23 THEN 'hour must be between 0 and 23.' END,
    CASE WHEN humidity < 20 THEN 'humidity cannot be negative.' END) AS messages
FROM road_conditions""",
}
ORACLES |= {
    f"risk_rows_{name}": risk_with(name) + f"SELECT {', '.join(_SCORES)} FROM scored"
    for name in RISK_SQL
}
