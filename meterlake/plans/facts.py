"""The hourly and the daily fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.functions.keys import surrogate_key
from meterlake.functions.labels import METER_TYPES
from meterlake.functions.numeric import count_where, exact_mean, exact_sum, ratio
from meterlake.operators.enrich import current_versions

# Columns of the hourly fact.
FACT_COLUMNS = [
    "reading_key",
    "date_key",
    "building_key",
    "site_key",
    "meter_type_key",
    "time_of_day_key",
    "meter_reading",
    "energy_per_sqft",
    "is_zero_reading",
    "is_spike",
    "is_building_unknown",
    "air_temperature",
    "wind_speed",
    "temp_category",
    "source_file_name",
    "batch_id",
    "reading_date",
]
# Name of the daily total of each meter type.
METER_TOTALS = {
    0: "total_electricity_kwh",
    1: "total_chilled_water",
    2: "total_steam",
    3: "total_hot_water",
}
HOURS_PER_DAY = 24


def fact_meter_readings(
    enriched: DataFrame,
    dates: DataFrame,
    buildings: DataFrame,
    sites: DataFrame,
    meter_types: DataFrame,
    hours: DataFrame,
    run_id: str,
) -> DataFrame:
    """One row per building, meter and hour, with the keys of its dimensions (null if absent).

    The calendar, the meter types and the hours have a fixed size and are broadcast by hint.
    Buildings and sites grow with the fleet: Spark broadcasts them only while their size is
    under the session's threshold.
    """
    day = dates.select("date_key", F.col("date").alias("reading_date"))
    label = meter_types.select("meter_type_key", "meter_label")
    hour = hours.select("time_of_day_key", F.col("hour").alias("reading_hour"))
    return (
        enriched.join(F.broadcast(day), "reading_date", "left")
        .join(F.broadcast(label), "meter_label", "left")
        .join(F.broadcast(hour), "reading_hour", "left")
        .join(sites.select("site_key", "site_id"), "site_id", "left")
        .join(current_versions(buildings).select("building_key", "building_id"), "building_id", "left")
        .withColumns(
            {
                "reading_key": surrogate_key("building_id", "meter", "timestamp"),
                "batch_id": F.lit(run_id),
            }
        )
        .select(*FACT_COLUMNS)
    )


def _distinct_hours(hour_key: str):
    """Distinct hours as a bit mask: partial masks combine map-side, so one shuffle is enough."""
    bit = F.call_function("shiftleft", F.lit(1), F.col(hour_key).cast("int"))
    return F.coalesce(F.bit_count(F.bit_or(bit)), F.lit(0)).cast("bigint")


def fact_daily_summary(fact: DataFrame, buildings: DataFrame) -> DataFrame:
    """One row per building and day.

    The total is the sum of the four known types, so it leaves out unknown meter codes and is
    null when one type has only null readings. Zero readings and spikes count meter rows; the
    mean temperature is weighted by them.
    """
    reading = F.col("meter_reading")
    totals = [
        exact_sum(F.when(F.col("meter_type_key") == code, reading).otherwise(0.0)).alias(METER_TOTALS[code])
        for code, _, _ in METER_TYPES
    ]
    daily = fact.groupBy("date_key", "building_key", "site_key", "reading_date").agg(
        *totals,
        exact_mean(F.col("air_temperature")).alias("avg_temperature"),
        _distinct_hours("time_of_day_key").alias("hours_with_data"),
        count_where("is_zero_reading").alias("zero_reading_hours"),
        count_where("is_spike").alias("spike_count"),
    )
    total = sum((F.col(name) for name in METER_TOTALS.values()), start=F.lit(0.0))
    area = current_versions(buildings).select("building_key", "square_feet")
    return (
        daily.withColumn("total_energy", total)
        .join(area, "building_key", "left")
        .select(
            surrogate_key("building_key", "date_key").alias("building_date_key"),
            "date_key",
            "building_key",
            "site_key",
            *METER_TOTALS.values(),
            "total_energy",
            "avg_temperature",
            "hours_with_data",
            "zero_reading_hours",
            "spike_count",
            F.round(F.col("hours_with_data") / HOURS_PER_DAY * 100, 2).alias("data_completeness_pct"),
            ratio(F.col("total_energy"), F.col("square_feet"), 6).alias("energy_per_sqft_day"),
            "reading_date",
        )
    )
