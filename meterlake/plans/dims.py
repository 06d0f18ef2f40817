"""The seven dimensions of the star schema."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.functions.calendar import calendar_attributes
from meterlake.functions.keys import surrogate_key
from meterlake.functions.labels import METER_TYPES, day_period, is_business_hour, site_name
from meterlake.operators.enrich import BASE_YEAR, building_age
from meterlake.operators.ranking import rank_values
from meterlake.sources.generators import date_spine, hour_spine, literal_rows

# Default span of the date dimension.
FIRST_DAY, LAST_DAY = dt.date(2010, 1, 1), dt.date(2025, 12, 31)


def dim_date(spark: SparkSession, start: dt.date = FIRST_DAY, end: dt.date = LAST_DAY) -> DataFrame:
    key, *rest = calendar_attributes(F.col("date"))
    return date_spine(spark, start, end).select(key, "date", *rest)


def dim_meter_type(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, METER_TYPES, "meter_type_key int, meter_label string, unit string")


def dim_time_of_day(spark: SparkSession) -> DataFrame:
    hour = F.col("hour")
    return hour_spine(spark).select(
        hour.alias("time_of_day_key"),
        "hour",
        day_period(hour).alias("period_label"),
        is_business_hour(hour).alias("is_business_hour"),
    )


def dim_site(enriched: DataFrame) -> DataFrame:
    sites = enriched.select("site_id").filter(F.col("site_id").isNotNull()).distinct()
    return sites.select(
        F.col("site_id").alias("site_key"), "site_id", site_name(F.col("site_id")).alias("site_name")
    )


def dim_building_use(buildings: DataFrame) -> DataFrame:
    """Uses in alphabetical order. Keys shift when an earlier use appears."""
    return rank_values(buildings, "primary_use", "use_key")


def dim_building(buildings: DataFrame, base_year: int = BASE_YEAR) -> DataFrame:
    """All building versions. Only a missing floor count is unknown here, not a 0."""
    return buildings.select(
        surrogate_key("building_id", "effective_from").alias("building_key"),
        "building_id",
        "site_id",
        "primary_use",
        "square_feet",
        "year_built",
        F.coalesce("floor_count", F.lit(0)).alias("floor_count"),
        building_age("year_built", base_year).alias("building_age"),
        F.col("year_built").isNull().alias("is_year_unknown"),
        F.col("floor_count").isNull().alias("is_floor_unknown"),
        "effective_from",
        "effective_to",
        "is_current",
    )


# Columns of the weather dimension besides its key.
WEATHER_CONDITION_COLUMNS = [
    "site_id",
    "weather_date",
    "weather_hour",
    "air_temperature",
    "dew_temperature",
    "wind_speed",
    "wind_direction",
    "cloud_coverage",
    "sea_level_pressure",
    "precip_depth_1_hr",
    "temp_category",
]


def dim_weather_condition(weather: DataFrame) -> DataFrame:
    key = surrogate_key("site_id", "weather_date", "weather_hour")
    return weather.select(*WEATHER_CONDITION_COLUMNS, key.alias("weather_key"))
