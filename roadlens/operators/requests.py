"""Validation of prediction requests as one projection over a table of raw texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Request fields, their kinds and the messages.
WHOLE_FIELDS = ("hour", "junction")
DECIMAL_FIELDS = (
    "car_count",
    "bike_count",
    "bus_count",
    "truck_count",
    "traffic_volume",
    "air_pollution_index",
    "humidity",
    "visibility_in_miles",
    "temperature",
    "rain_p_h",
    "snow_p_h",
)
TEXT_FIELDS = ("weather_type", "weather_description", "day_of_week")
MAY_BE_NEGATIVE = ("temperature",)
REQUIRED_MESSAGE = "{} is required."
NUMBER_MESSAGE = "{} must be a valid number."
HOUR_MESSAGE = "hour must be between 0 and 23."
NEGATIVE_MESSAGE = "{} cannot be negative."
WHOLE_NUMBER = r"^[+-]?\d+$"
DECIMAL_NUMBER = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity|nan))$"
# End of fixed values.

FIELDS = (*WHOLE_FIELDS, *DECIMAL_FIELDS, *TEXT_FIELDS)


def validate(raw: DataFrame) -> DataFrame:
    """Typed request fields, null where unusable, and the list of messages in field order.

    Other columns of ``raw`` pass through. A whole field takes no decimals. A missing column
    counts as an empty field.
    """
    absent = {name: F.lit("") for name in FIELDS if name not in raw.columns}
    rest = [name for name in raw.columns if name not in FIELDS]
    complete = raw.withColumns(absent) if absent else raw
    space = F.lit(" \t\r\n")
    given = {f: F.trim(F.coalesce(F.col(f).cast("string"), F.lit("")), space) for f in FIELDS}

    def number(f: str, pattern: str, kind: str):
        return F.when(F.col(f).rlike(pattern), F.col(f)).try_cast(kind)

    # One projection per stage, so that no text is trimmed, matched or cast twice.
    trimmed = complete.withColumns(given)
    typed = trimmed.select(
        *rest,
        *[number(f, WHOLE_NUMBER, "int").alias(f) for f in WHOLE_FIELDS],
        *[number(f, DECIMAL_NUMBER, "double").alias(f) for f in DECIMAL_FIELDS],
        *[F.nullif(F.col(f), F.lit("")).alias(f) for f in TEXT_FIELDS],
        *[(F.col(f) == "").alias(f"_blank_{f}") for f in FIELDS],
    )
    messages = [
        F.when(F.col(f"_blank_{f}"), REQUIRED_MESSAGE.format(f)).when(
            F.col(f).isNull(), NUMBER_MESSAGE.format(f)
        )
        for f in (*WHOLE_FIELDS, *DECIMAL_FIELDS)
    ]
    messages += [F.when(F.col(f).isNull(), REQUIRED_MESSAGE.format(f)) for f in TEXT_FIELDS]
    messages.append(F.when(~F.col("hour").between(0, 23), HOUR_MESSAGE))
    messages += [
        F.when(F.col(f) < 0, NEGATIVE_MESSAGE.format(f))
        for f in DECIMAL_FIELDS
        if f not in MAY_BE_NEGATIVE
    ]
    return typed.select(
        *rest, *FIELDS, F.array_compact(F.array(*messages)).alias("errors")
    )
