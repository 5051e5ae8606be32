"""Request validation and its messages."""

from samples import REQUEST

from roadlens.operators import requests


def checked(spark, *changes):
    rows = []
    for number, change in enumerate(changes):
        row = {k: str(v) for k, v in REQUEST.items()} | change
        rows.append((number, *[row.get(f) for f in requests.FIELDS]))
    ddl = "id int, " + ", ".join(f"{f} string" for f in requests.FIELDS)
    return requests.validate(spark.createDataFrame(rows, ddl)).orderBy("id").collect()


def test_example_is_valid(spark):
    (row,) = checked(spark, {})
    assert row["errors"] == []
    assert {f: row[f] for f in requests.FIELDS} == REQUEST


def test_one_message_each(spark):
    rows = checked(
        spark,
        {"hour": "24"},
        {"humidity": "-1"},
        {"weather_type": "  "},
        {"junction": "x"},
        {"junction": "2.5"},
        {"car_count": None},
        {"temperature": "-40"},
        {"rain_p_h": "1d"},
        {"snow_p_h": " 1e-2\t"},
    )
    assert [r["errors"] for r in rows] == [
        ["hour must be between 0 and 23."],
        ["humidity cannot be negative."],
        ["weather_type is required."],
        ["junction must be a valid number."],
        ["junction must be a valid number."],
        ["car_count is required."],
        [],
        ["rain_p_h must be a valid number."],
        [],
    ]
    assert rows[8]["snow_p_h"] == 0.01


def test_several_messages_and_absent_columns(spark):
    table = spark.createDataFrame([("7", "-2")], "hour string, bus_count string")
    errors = requests.validate(table).first()["errors"]
    assert len(errors) == len(requests.FIELDS) - 2 + 1
    assert errors[-1] == "bus_count cannot be negative."
