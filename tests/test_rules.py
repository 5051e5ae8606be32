"""Rule tables on and around their bounds."""

import random
import re

import pytest
from pyspark.sql import functions as F

from roadlens.functions import rules, scalars
from roadlens.functions.bands import lookup


def values(spark, ddl, rows, column):
    """The column's value for each row, in order."""
    numbered = [(i, *row) for i, row in enumerate(rows)]
    table = spark.createDataFrame(numbered, f"_i int, {ddl}")
    return [r["v"] for r in table.select("_i", column.alias("v")).orderBy("_i").collect()]


def test_vehicle_level_and_flat_fare(spark):
    rows = [(20,), (21,), (50,), (51,), (None,)]
    v = F.col("v0")
    assert values(spark, "v0 int", rows, rules.vehicle_level(v)) == [
        "Low Traffic", "Medium Traffic", "Medium Traffic", "High Traffic", "High Traffic"
    ]
    assert values(spark, "v0 int", rows, rules.flat_fare(v)) == [10, 30, 30, 60, 10]


def test_peak_fare(spark):
    rows = [(8, 51), (8, 21), (12, 51), (12, 21), (8, 20), (None, 51)]
    fare = rules.peak_fare(F.col("v"), rules.is_peak_hour(F.col("h")))
    assert values(spark, "h int, v int", rows, fare) == [60, 40, 40, 20, 10, 40]


def test_peak_definitions_differ(spark):
    hours = [(h,) for h in range(24)]
    h = F.col("h")

    def chosen(column):
        return [i for i, yes in enumerate(values(spark, "h int", hours, column)) if yes]

    assert chosen(rules.is_peak_hour(h)) == [8, 9, 10, 11, 17, 18, 19, 20]
    assert chosen(rules.is_rush_hour(h)) == [8, 9, 10, 17, 18, 19, 20]
    assert chosen(rules.is_peak_period(h)) == [7, 8, 9, 10, 16, 17, 18, 19]


@pytest.mark.parametrize(
    ("scheme", "categories"),
    [
        ("summary", ["Rainy", "Other", "Other", "Clear", "Low Visibility", "Other"]),
        ("report", ["Rainy", "Other", "Snow", "Clear", "Low Visibility", "Other"]),
        ("training", ["Storm", "Cloudy", "Snow", "Clear", "Low Visibility", "Storm"]),
        ("labels", ["Storm", "Other", "Snow", "Clear", "Low Visibility", "Other"]),
    ],
)
def test_weather_categories(spark, scheme, categories):
    rows = [
        ("thunderstorm with light rain",), (None,), ("light snow",), ("Sky is CLEAR ",),
        (" Mist ",), ("SQUALLS",),
    ]
    table = spark.createDataFrame(
        [(i, *r, 5.0, 50.0, 100.0) for i, r in enumerate(rows)],
        "i int, weather_description string, visibility_in_miles double,"
        " air_pollution_index double, traffic_volume double",
    )
    scored = rules.score_risk(table, scheme).orderBy("i").collect()
    assert [r["weather_category"] for r in scored] == categories


def scores(spark, scheme, column, numbers):
    names = ("visibility_in_miles", "air_pollution_index", "traffic_volume")
    rows = [(i, "clear", *[n if name == column else None for name in names])
            for i, n in enumerate(numbers)]
    ddl = "i int, weather_description string, " + ", ".join(f"{n} double" for n in names)
    target = dict(zip(names, ("visibility_risk", "pollution_risk", "traffic_risk")))[column]
    scored = rules.score_risk(spark.createDataFrame(rows, ddl), scheme).orderBy("i").collect()
    return [r[target] for r in scored]


def test_sub_scores(spark):
    v, p, t = "visibility_in_miles", "air_pollution_index", "traffic_volume"
    assert scores(spark, "summary", v, [1.0, 2.0, 3.0, 5.0, None]) == [2, 1, 1, 0, 0]
    assert scores(spark, "training", v, [1.0, 2.0, 3.0, 5.0, None]) == [2, 1, 1, 0, 0]
    assert scores(spark, "summary", p, [75.0, 100.0, 101.0, 150.0, 151.0]) == [0, 0, 1, 1, 2]
    assert scores(spark, "training", p, [75.0, 100.0, 101.0, 150.0, 151.0]) == [1, 1, 1, 2, 2]
    assert scores(spark, "summary", t, [3000.0, 3001.0, 6000.0, 6001.0]) == [0, 1, 1, 2]
    assert scores(spark, "training", t, [3000.0, 3001.0, 6000.0, 6001.0]) == [1, 1, 2, 2]


def test_density_without_free_flow_or_speed(spark):
    rows = [(10.0, 0.0), (None, 10.0), (12.0, 10.0), (10.0, None)]
    proxy = rules.density_proxy(F.col("s"), F.col("f"))
    assert values(spark, "s double, f double", rows, proxy) == [0.0] * 4
    level = rules.congestion_level(proxy)
    assert values(spark, "s double, f double", rows, level) == ["low"] * 4
    factor = rules.travel_time_multiplier(proxy)
    assert values(spark, "s double, f double", rows, factor) == [1.0] * 4


def test_congestion_bounds_and_alerts(spark):
    p = F.col("p")
    rows = [(0.75,), (0.55,), (0.30,), (0.2999,)]
    assert values(spark, "p double", rows, rules.congestion_level(p)) == [
        "severe", "high", "moderate", "low"
    ]
    alert = rules.is_alert(rules.congestion_level(p), rules.travel_time_multiplier(p))
    assert values(spark, "p double", [(0.40,), (0.39,), (0.55,)], alert) == [True, False, True]


def test_clock_texts(spark):
    rows = [("12:01:00 AM",), ("12:30:00 PM",), ("7:15:00 PM",), ("junk",), (None,), (" 13:05",)]
    assert values(spark, "t string", rows, scalars.clock_hour(F.col("t"))) == [
        0, 12, 19, None, None, 13
    ]
    strict = scalars.strict_clock_hour(F.col("t"))
    assert values(spark, "t string", rows, strict) == [0, 12, 19, None, None, None]


def test_safe_share_and_lookup(spark):
    rows = [(1.0, 4.0), (1.0, 0.0), (1.0, None), (None, 4.0)]
    share = scalars.safe_share(F.col("a"), F.col("b"))
    assert values(spark, "a double, b double", rows, share) == [0.25, 0.0, 0.0, 0.0]
    names = lookup(F.col("k"), {0.0: "a", 1.0: "b"})
    assert values(spark, "k double", [(0.0,), (1.0,), (2.0,), (None,)], names) == [
        "a", "b", None, None
    ]


def test_headers():
    assert scalars.canonical_header("Day of the week") == "DayOfWeek"
    assert scalars.canonical_header("Traffic Situation") == "TrafficSituation"
    assert scalars.canonical_header(" rain / hour (mm) ") == "rain_hour_mm"
    assert scalars.canonical_header("__a--b__") == "a_b"


def test_plain_text_and_epoch(spark):
    rows = [(None,), ("  Light RAIN ",)]
    assert values(spark, "t string", rows, scalars.plain_text(F.col("t"))) == [
        "unknown", "light rain"
    ]
    seconds = scalars.epoch_seconds(scalars.parse_time(F.col("t")))
    rows = [("1970-01-02 00:00:01",), ("not a time",), ("1969-12-31 23:59:59",)]
    assert values(spark, "t string", rows, seconds) == [86401, None, -1]


def test_clock_hours_by_word_borders(spark):
    """Generated marks beside AM and PM, against a plain statement of the rule."""
    rng = random.Random(6)
    marks = ["", " ", "!", "?", "*", "'", '"', ".", "_", "x", "é", "1", "\t", "\x0b", "-", "[", "|"]
    texts = ["2:30 PM!", "2:30 'PM'", "12:05 AM*", "AM PM 12:00", "12:00 PM AM", "12:00 AM PM", "", "PM", "123 pm", "7pm", "7 pm"]
    for _ in range(400):
        half = "".join(rng.choice(marks) + rng.choice(["AM", "pm", "Pm", "am", "xm"]) + rng.choice(marks) for _ in range(rng.randrange(3)))
        texts.append(rng.choice(["", " ", "\t", "\x0c"]) + str(rng.choice([0, 1, 2, 11, 12, 13, 23, 99, 123])) + rng.choice([":15", ":00:00", "", " "]) + half)

    def rule(text):
        number = re.match(r"[ \t\n\x0b\f\r]*([0-9]{1,2})", text)
        if number is None:
            return None
        hour = int(number[1])
        word = re.search(r"(?<!\w)(am|pm)(?!\w)", text, re.I)
        if word and word[1].lower() == "am" and hour == 12:
            return 0
        return hour + 12 if word and word[1].lower() == "pm" and hour < 12 else hour

    table = spark.createDataFrame([(t,) for t in texts], "t string")
    got = table.select("t", scalars.clock_hour(F.col("t")).alias("h")).collect()
    assert [(r["t"], r["h"]) for r in got if r["h"] != rule(r["t"])] == []
