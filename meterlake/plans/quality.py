"""The 42 checks over the bronze, silver and gold tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.operators.checks import (
    SURPLUS,
    at_least_share,
    distinct_check,
    expected,
    key_surplus,
    metric_checks,
    month_mask,
    months_in,
    no_duplicates,
    not_empty,
    total,
    union_all,
    violations,
)
from meterlake.operators.enrich import current_versions

# Table names in the log. The check names below are fixed as well.
METER, WEATHER, BUILDING = "bronze_meter_readings", "bronze_weather_readings", "bronze_building_metadata"
READINGS, CLEAN_WEATHER, ENRICHED = "silver_readings", "silver_weather", "silver_enriched"
FACT, DAILY = "fact_meter_readings", "fact_daily_building_summary"


def null_in(column: str):
    return violations(f"{column} IS NULL")


def bronze_checks(readings: DataFrame, weather: DataFrame, buildings: DataFrame) -> DataFrame:
    current = F.count_if(F.col("is_current"))
    return union_all(
        [
            metric_checks(
                readings,
                METER,
                {
                    "meter_row_count_gt_0": not_empty(),
                    "meter_building_id_notnull": null_in("building_id"),
                    "meter_reading_notnull": null_in("meter_reading"),
                    "meter_types_valid": violations("meter NOT IN (0, 1, 2, 3)"),
                },
            ),
            metric_checks(
                weather,
                WEATHER,
                {
                    "weather_row_count_gt_0": not_empty(),
                    "weather_site_id_notnull": null_in("site_id"),
                    "weather_timestamp_notnull": null_in("timestamp"),
                },
            ),
            metric_checks(
                buildings,
                BUILDING,
                {
                    "building_row_count_gt_0": (
                        F.when(current > 0, 0).otherwise(1),
                        F.concat(F.lit("current rows="), current.cast("string")),
                    ),
                    "building_id_notnull": null_in("building_id"),
                },
            ),
            no_duplicates(
                current_versions(buildings), ["building_id"], BUILDING, "building_scd2_no_dup_current"
            ),
        ]
    )


def silver_checks(
    readings: DataFrame, weather: DataFrame, enriched: DataFrame, bronze_readings: DataFrame
) -> DataFrame:
    return union_all(
        [
            at_least_share(readings, bronze_readings, 0.95, READINGS, "silver_vs_bronze_95pct"),
            metric_checks(
                readings,
                READINGS,
                {
                    "meter_label_not_null": null_in("meter_label"),
                    "reading_date_not_null": null_in("reading_date"),
                    "no_negative_readings": violations("meter_reading < 0"),
                },
            ),
            distinct_check(readings, "meter", READINGS, "all_4_meter_types", 4),
            metric_checks(
                weather,
                CLEAN_WEATHER,
                {
                    "weather_no_null_airtemp": null_in("air_temperature"),
                    "all_temp_categories": null_in("temp_category"),
                    "wind_direction_fix": violations("wind_speed = 0 AND wind_direction = 0"),
                },
            ),
            metric_checks(
                enriched,
                ENRICHED,
                {
                    "energy_per_sqft_positive": violations("energy_per_sqft < 0"),
                    "enriched_row_count": not_empty(),
                },
            ),
        ]
    )


# Row rules of the daily fact: the counters that its dates are kept with.
DAILY_RULES = {
    "null_building_key": "building_key IS NULL",
    "wrong_total": "round(total_energy, 2) <> round("
    "total_electricity_kwh + total_chilled_water + total_steam + total_hot_water, 2)",
    "odd_completeness": "data_completeness_pct NOT BETWEEN 0 AND 100",
    "odd_hours": "hours_with_data NOT BETWEEN 0 AND 24",
}
FACT_KEYS = ["building_key", "site_key", "date_key", "meter_type_key"]
UNIQUE = {FACT: "reading_key", DAILY: "building_date_key"}


def fact_summary(fact: DataFrame) -> DataFrame:
    """One row for each date and combination of the fact's keys: what row rules, orphan checks
    and months need. A date's rows depend on that date only, so they can be kept and replaced."""
    return fact.groupBy("reading_date", *FACT_KEYS).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("meter_reading").isNull()).alias("null_readings"),
        F.count_if(F.col("meter_reading") < 0).alias("negative_readings"),
        F.count_if((F.col("air_temperature") < -40) | (F.col("air_temperature") > 50)).alias("odd_temperatures"),
    )


def gold_checks(
    fact: DataFrame,
    daily: DataFrame,
    dates: DataFrame,
    buildings: DataFrame,
    sites: DataFrame,
    meter_types: DataFrame,
    hours: DataFrame,
    expected_sites: int = 16,
    expected_months: int = 12,
) -> DataFrame:
    """The gold checks from the facts themselves, each read once for its rules and once for its key."""
    rules = daily.agg(*[F.count_if(F.expr(rule)).alias(name) for name, rule in DAILY_RULES.items()])
    return gold_checks_of(
        fact_summary(fact),
        key_surplus(fact, UNIQUE[FACT]),
        rules,
        key_surplus(daily, UNIQUE[DAILY]),
        *(dates, buildings, sites, meter_types, hours, expected_sites, expected_months),
    )


def gold_checks_of(
    short: DataFrame,
    fact_surplus: DataFrame,
    daily_rules: DataFrame,
    daily_surplus: DataFrame,
    dates: DataFrame,
    buildings: DataFrame,
    sites: DataFrame,
    meter_types: DataFrame,
    hours: DataFrame,
    expected_sites: int = 16,
    expected_months: int = 12,
) -> DataFrame:
    """The gold checks from what is kept of the facts: the fact's summary, the counters of the daily
    fact's rules, and the surplus of the keys of both."""
    rows = F.count(F.lit(1))
    dims = dict(zip(FACT_KEYS, (buildings, sites, dates, meter_types), strict=True))
    found = short
    for key, dim in dims.items():
        found = found.join(dim.select(key).distinct().withColumn(f"has_{key}", F.lit(True)), key, "left")

    def rows_where(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    counted = ["null_readings", "negative_readings", "odd_temperatures"]
    # One row a site first: the months of each site and of all come from the same pass.
    by_site = found.groupBy("site_key").agg(
        rows_where(F.col("building_key").isNull()).alias("null_building"),
        rows_where(F.col("date_key").isNull()).alias("null_date"),
        *[F.sum(c).alias(c) for c in counted],
        *[rows_where(F.col(f"has_{key}").isNull()).alias(f"orphan_{key}") for key in dims],
        month_mask("reading_date").alias("months"),
    )
    too_few = F.count_if(F.bit_count("months") < expected_months)
    return union_all(
        [
            metric_checks(
                by_site,
                FACT,
                {
                    "fact_building_key_not_null": total("null_building"),
                    "fact_date_key_not_null": total("null_date"),
                    "fact_meter_reading_not_null": total("null_readings"),
                    "fact_meter_reading_gte_0": total("negative_readings"),
                    "air_temp_range": total("odd_temperatures"),
                    "data_spans_12_months": expected(months_in(F.col("months")), expected_months, "months"),
                    **{f"fact_{key}_resolves": total(f"orphan_{key}", f"orphan {key}s=") for key in dims},
                    "all_sites_have_12_months": (too_few, F.concat(F.lit("rows violating: "), too_few.cast("string"))),
                },
            ),
            metric_checks(fact_surplus, FACT, {"fact_reading_key_unique": total(SURPLUS, "surplus rows=")}),
            metric_checks(
                daily_rules,
                DAILY,
                {
                    "daily_building_key_not_null": total("null_building_key"),
                    "daily_total_energy_correct": total("wrong_total"),
                    "completeness_pct_range": total("odd_completeness"),
                    "hours_with_data_range": total("odd_hours"),
                },
            ),
            metric_checks(daily_surplus, DAILY, {"daily_building_date_key_unique": total(SURPLUS, "surplus rows=")}),
            metric_checks(buildings, "dim_building", {"dim_building_use_not_null": null_in("primary_use")}),
            no_duplicates(
                current_versions(buildings), ["building_id"], "dim_building", "dim_building_no_dup_current"
            ),
            metric_checks(sites, "dim_site", {"all_16_sites_present": expected(rows, expected_sites, "sites")}),
            metric_checks(
                meter_types, "dim_meter_type", {"all_4_meter_types_in_dim": expected(rows, 4, "meter types")}
            ),
            metric_checks(hours, "dim_time_of_day", {"dim_time_24_rows": expected(rows, 24, "hours")}),
        ]
    )
