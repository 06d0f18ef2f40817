"""Cleaning of weather observations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.functions.calendar import convert, to_moment
from meterlake.functions.labels import temperature_band
from meterlake.operators.fill import fill_gaps
from meterlake.operators.readings import RESCUED

# Measured columns, those without a sign, and those whose gaps are filled.
MEASURES = [
    "air_temperature",
    "cloud_coverage",
    "dew_temperature",
    "precip_depth_1_hr",
    "sea_level_pressure",
    "wind_direction",
    "wind_speed",
]
NON_NEGATIVE = ["wind_speed", "precip_depth_1_hr", "sea_level_pressure", "cloud_coverage"]
GAP_FILLED = ["cloud_coverage", "precip_depth_1_hr", "sea_level_pressure"]


def standardise_weather(df: DataFrame, strict: bool = True) -> DataFrame:
    """Typed observations; a calm hour has no wind direction, and signs are dropped.

    The calm test sees the speed before its sign is dropped.
    """
    typed = df.drop(RESCUED).withColumns(
        {
            "timestamp": to_moment(F.col("timestamp"), strict),
            "site_id": convert(F.col("site_id"), "int", strict),
            **{m: convert(F.col(m), "double", strict) for m in MEASURES},
        }
    )
    calm = (F.col("wind_speed") == 0) & (F.col("wind_direction") == 0)
    return typed.withColumns(
        {
            "weather_date": F.to_date("timestamp"),
            "weather_hour": F.hour("timestamp"),
            "wind_direction": F.when(calm, F.lit(None)).otherwise(F.col("wind_direction")),
            **{m: F.abs(m) for m in NON_NEGATIVE},
        }
    )


def clean_weather(
    df: DataFrame,
    strict: bool = True,
    gap_columns: list[str] | None = None,
) -> DataFrame:
    """Standardised weather with gaps filled per site and a temperature band."""
    gaps = GAP_FILLED if gap_columns is None else gap_columns
    whole = fill_gaps(standardise_weather(df, strict), "site_id", "timestamp", gaps)
    return whole.withColumn("temp_category", temperature_band(F.col("air_temperature")))
