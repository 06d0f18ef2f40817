"""Readings joined with the building they belong to and the weather at its site."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.functions.numeric import ratio

# Reference year for ages, and the columns taken from each side.
BASE_YEAR = 2016
BUILDING_COLUMNS = [
    "building_id",
    "site_id",
    "primary_use",
    "square_feet",
    "year_built",
    "floor_count",
    "effective_from",
]
WEATHER_COLUMNS = [
    "air_temperature",
    "wind_speed",
    "temp_category",
    "sea_level_pressure",
    "dew_temperature",
]


def current_versions(versions: DataFrame) -> DataFrame:
    return versions.filter("is_current")


def building_age(year_built: str, base_year: int):
    return (F.lit(base_year) - F.col(year_built)).cast("int")


def with_building(readings: DataFrame, buildings: DataFrame) -> DataFrame:
    """Left join to the current building versions.

    No broadcast hint: the building table grows with the fleet, so Spark compares its
    measured size with the threshold, and beyond it splits hot buildings at run time.
    """
    current = current_versions(buildings).select(*BUILDING_COLUMNS)
    joined = readings.join(current, "building_id", "left")
    return joined.withColumn("is_building_unknown", F.col("site_id").isNull())


def with_weather(readings: DataFrame, weather: DataFrame) -> DataFrame:
    """Left join on site, date and hour. Several observations in an hour give several rows."""
    at = weather.select(
        F.col("site_id").alias("_site"), "weather_date", "weather_hour", *WEATHER_COLUMNS
    )
    same_hour = (
        (readings["site_id"] == at["_site"])
        & (readings["reading_date"] == at["weather_date"])
        & (readings["reading_hour"] == at["weather_hour"])
    )
    return readings.join(at, same_hour, "left").drop("_site", "weather_date", "weather_hour")


def enrich_readings(
    readings: DataFrame, buildings: DataFrame, weather: DataFrame, base_year: int = BASE_YEAR
) -> DataFrame:
    """Readings with building and weather columns and the measures derived from them.

    A missing floor count becomes 0 first, so here a recorded 0 also counts as unknown.
    """
    joined = with_weather(with_building(readings, buildings), weather)
    floors = F.coalesce(F.col("floor_count"), F.lit(0))
    return joined.withColumns(
        {
            "energy_per_sqft": ratio(F.col("meter_reading"), F.col("square_feet"), 6),
            "building_age": building_age("year_built", base_year),
            "floor_count": floors,
            "is_year_unknown": F.col("year_built").isNull(),
            "is_floor_unknown": floors == 0,
        }
    )
