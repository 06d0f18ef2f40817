"""The SQL each registered query is compared with, put together from common table expressions.

Every expression depends only on those listed before it. Dates and times are compared as text.
"""

from __future__ import annotations

from meterlake.sources.fixtures import BUILDINGS, CHANGES, READINGS, WEATHER

FIRST_LOAD, SECOND_LOAD = "2024-01-01", "2024-06-01"
RUN_ID = "run-1"

_DEC = "DECIMAL(28,2)"

VERSIONS = f"""
SELECT *, DATE '{FIRST_LOAD}' AS effective_from, DATE '9999-12-31' AS effective_to, TRUE AS is_current
FROM buildings"""


def scd2_sql(old: str, new: str, as_of: str, null_safe: bool = False) -> str:
    differs = "t.primary_use IS DISTINCT FROM s.primary_use" if null_safe else "t.primary_use <> s.primary_use"
    hit = f"(t.is_current AND s.building_id IS NOT NULL AND coalesce({differs}, FALSE))"
    return f"""
SELECT t.building_id, t.site_id, t.primary_use, t.square_feet, t.year_built, t.floor_count,
       t.effective_from,
       CASE WHEN {hit} THEN DATE '{as_of}' ELSE t.effective_to END AS effective_to,
       t.is_current AND NOT {hit} AS is_current
FROM {old} t LEFT JOIN {new} s ON t.building_id = s.building_id
UNION ALL
SELECT s.building_id, s.site_id, s.primary_use, s.square_feet, s.year_built, s.floor_count,
       DATE '{as_of}', DATE '9999-12-31', TRUE
FROM {new} s LEFT JOIN (SELECT * FROM {old} WHERE is_current) t ON t.building_id = s.building_id
WHERE t.building_id IS NULL OR coalesce({differs}, FALSE)"""


SILVER_READINGS = """
SELECT *, round(meter_reading, 2) = 0 AS is_zero_reading,
       CAST(timestamp AS DATE) AS reading_date,
       CAST(hour(timestamp) AS INT) AS reading_hour,
       CAST(dayofweek(timestamp) + 1 AS INT) AS reading_day_of_week,
       dayofweek(timestamp) IN (0, 6) AS is_weekend,
       CAST(month(timestamp) AS INT) AS reading_month,
       CASE meter WHEN 0 THEN 'Electricity' WHEN 1 THEN 'Chilled Water' WHEN 2 THEN 'Steam'
            WHEN 3 THEN 'Hot Water' END AS meter_label,
       CAST(floor(epoch(timestamp)) AS BIGINT) AS second
FROM readings"""

SPIKES = f"""
SELECT *, meter_reading > 0 AND rolling_avg_7d > 0 AND meter_reading > 5 * rolling_avg_7d AS is_spike
FROM (SELECT *, CAST(sum(CAST(meter_reading AS {_DEC})) OVER frame AS DOUBLE)
                / count(meter_reading) OVER frame AS rolling_avg_7d
      FROM silver_readings
      WINDOW frame AS (PARTITION BY building_id, meter ORDER BY second
                       RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW)) AS rolled"""

STANDARD_WEATHER = """
SELECT site_id, timestamp, air_temperature, dew_temperature,
       CASE WHEN wind_speed = 0 AND wind_direction = 0 THEN NULL ELSE wind_direction END AS wind_direction,
       abs(wind_speed) AS wind_speed, abs(cloud_coverage) AS cloud_coverage,
       abs(precip_depth_1_hr) AS precip_depth_1_hr, abs(sea_level_pressure) AS sea_level_pressure,
       CAST(timestamp AS DATE) AS weather_date, CAST(hour(timestamp) AS INT) AS weather_hour
FROM weather"""

FFILL_WEATHER = """
SELECT * REPLACE (last_value(cloud_coverage IGNORE NULLS) OVER past AS cloud_coverage,
                  last_value(precip_depth_1_hr IGNORE NULLS) OVER past AS precip_depth_1_hr,
                  last_value(sea_level_pressure IGNORE NULLS) OVER past AS sea_level_pressure)
FROM standard_weather
WINDOW past AS (PARTITION BY site_id ORDER BY timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""

MEDIANS = """
SELECT site_id, quantile_disc(cloud_coverage, 0.5) AS med_cloud_coverage,
       quantile_disc(precip_depth_1_hr, 0.5) AS med_precip_depth_1_hr,
       quantile_disc(sea_level_pressure, 0.5) AS med_sea_level_pressure
FROM ffill_weather GROUP BY site_id"""

CLEAN_WEATHER = """
SELECT w.site_id, timestamp, air_temperature, dew_temperature, wind_direction, wind_speed,
       coalesce(cloud_coverage, med_cloud_coverage) AS cloud_coverage,
       coalesce(precip_depth_1_hr, med_precip_depth_1_hr) AS precip_depth_1_hr,
       coalesce(sea_level_pressure, med_sea_level_pressure) AS sea_level_pressure,
       weather_date, weather_hour,
       CASE WHEN air_temperature < 0 THEN 'Freezing' WHEN air_temperature < 10 THEN 'Cold'
            WHEN air_temperature < 20 THEN 'Mild' WHEN air_temperature < 30 THEN 'Warm'
            ELSE 'Hot' END AS temp_category
FROM ffill_weather w LEFT JOIN medians m ON w.site_id = m.site_id"""

ENRICHED = """
SELECT r.*, b.site_id, b.primary_use, b.square_feet, b.year_built,
       coalesce(b.floor_count, 0) AS floor_count, b.effective_from,
       b.site_id IS NULL AS is_building_unknown,
       w.air_temperature, w.wind_speed, w.temp_category, w.sea_level_pressure, w.dew_temperature,
       CASE WHEN b.square_feet > 0 THEN round(r.meter_reading / b.square_feet, 6) END AS energy_per_sqft,
       2016 - b.year_built AS building_age,
       b.year_built IS NULL AS is_year_unknown,
       coalesce(b.floor_count, 0) = 0 AS is_floor_unknown
FROM spikes r
LEFT JOIN (SELECT * FROM versions WHERE is_current) b ON r.building_id = b.building_id
LEFT JOIN clean_weather w
       ON b.site_id = w.site_id AND r.reading_date = w.weather_date AND r.reading_hour = w.weather_hour"""

DIM_DATE = """
SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_key, d AS date, CAST(year(d) AS INT) AS year,
       CAST(month(d) AS INT) AS month, CAST(day(d) AS INT) AS day, CAST(quarter(d) AS INT) AS quarter,
       CAST(dayofweek(d) + 1 AS INT) AS day_of_week, dayname(d) AS day_name, monthname(d) AS month_name,
       dayofweek(d) IN (0, 6) AS is_weekend, CAST(weekofyear(d) AS INT) AS week_of_year
FROM (SELECT CAST(unnest(generate_series(DATE '2010-01-01', DATE '2025-12-31', INTERVAL 1 DAY)) AS DATE) AS d)
     AS days"""

DIM_METER = """
SELECT * FROM (VALUES (0, 'Electricity', 'kWh'), (1, 'Chilled Water', 'kBTU'), (2, 'Steam', 'kBTU'),
                      (3, 'Hot Water', 'kBTU')) AS t(meter_type_key, meter_label, unit)"""

DIM_TIME = """
SELECT CAST(h AS INT) AS time_of_day_key, CAST(h AS INT) AS hour,
       CASE WHEN h < 6 THEN 'Night' WHEN h < 12 THEN 'Morning' WHEN h < 18 THEN 'Afternoon'
            ELSE 'Evening' END AS period_label,
       h BETWEEN 9 AND 17 AS is_business_hour
FROM (SELECT unnest(range(24)) AS h) AS hours"""

DIM_SITE = """
SELECT DISTINCT site_id AS site_key, site_id, 'Site_' || lpad(CAST(site_id AS VARCHAR), 2, '0') AS site_name
FROM enriched WHERE site_id IS NOT NULL"""

DIM_BUILDING = """
SELECT sha256(concat_ws('||', CAST(building_id AS VARCHAR), CAST(effective_from AS VARCHAR))) AS building_key,
       building_id, site_id, primary_use, square_feet, year_built,
       coalesce(floor_count, 0) AS floor_count, 2016 - year_built AS building_age,
       year_built IS NULL AS is_year_unknown, floor_count IS NULL AS is_floor_unknown,
       effective_from, effective_to, is_current
FROM versions"""

FACT = f"""
SELECT sha256(concat_ws('||', CAST(e.building_id AS VARCHAR), CAST(e.meter AS VARCHAR),
                        CAST(e.timestamp AS VARCHAR))) AS reading_key,
       d.date_key, b.building_key, s.site_key, m.meter_type_key, t.time_of_day_key,
       e.meter_reading, e.energy_per_sqft, e.is_zero_reading, e.is_spike, e.is_building_unknown,
       e.air_temperature, e.wind_speed, e.temp_category, 'events' AS source_file_name,
       '{RUN_ID}' AS batch_id, e.reading_date
FROM enriched e
LEFT JOIN dim_date d ON e.reading_date = d.date
LEFT JOIN (SELECT * FROM dim_building WHERE is_current) b ON e.building_id = b.building_id
LEFT JOIN dim_site s ON e.site_id = s.site_id
LEFT JOIN dim_meter m ON e.meter_label = m.meter_label
LEFT JOIN dim_time t ON e.reading_hour = t.hour"""

DAILY = f"""
SELECT sha256(concat_ws('||', a.building_key, CAST(a.date_key AS VARCHAR))) AS building_date_key,
       a.* EXCLUDE (reading_date), a.reading_date,
       round(hours_with_data / 24.0e0 * 100, 2) AS data_completeness_pct,
       CASE WHEN b.square_feet > 0 THEN round(total_energy / b.square_feet, 6) END AS energy_per_sqft_day
FROM (SELECT *, total_electricity_kwh + total_chilled_water + total_steam + total_hot_water AS total_energy
      FROM (SELECT date_key, building_key, site_key, reading_date,
                   CAST(sum(CASE WHEN meter_type_key = 0 THEN CAST(meter_reading AS {_DEC}) ELSE 0 END)
                        AS DOUBLE) AS total_electricity_kwh,
                   CAST(sum(CASE WHEN meter_type_key = 1 THEN CAST(meter_reading AS {_DEC}) ELSE 0 END)
                        AS DOUBLE) AS total_chilled_water,
                   CAST(sum(CASE WHEN meter_type_key = 2 THEN CAST(meter_reading AS {_DEC}) ELSE 0 END)
                        AS DOUBLE) AS total_steam,
                   CAST(sum(CASE WHEN meter_type_key = 3 THEN CAST(meter_reading AS {_DEC}) ELSE 0 END)
                        AS DOUBLE) AS total_hot_water,
                   CAST(sum(CAST(air_temperature AS DECIMAL(28,10))) AS DOUBLE)
                       / count(air_temperature) AS avg_temperature,
                   count(DISTINCT time_of_day_key) AS hours_with_data,
                   count(*) FILTER (is_zero_reading) AS zero_reading_hours,
                   count(*) FILTER (is_spike) AS spike_count
            FROM fact GROUP BY date_key, building_key, site_key, reading_date) AS sums) AS a
LEFT JOIN (SELECT * FROM dim_building WHERE is_current) b ON a.building_key = b.building_key"""

_EXPRESSIONS = {
    "readings": READINGS,
    "buildings": BUILDINGS,
    "weather": WEATHER,
    "changes": CHANGES,
    "versions": VERSIONS,
    "silver_readings": SILVER_READINGS,
    "spikes": SPIKES,
    "standard_weather": STANDARD_WEATHER,
    "ffill_weather": FFILL_WEATHER,
    "medians": MEDIANS,
    "clean_weather": CLEAN_WEATHER,
    "enriched": ENRICHED,
    "dim_date": DIM_DATE,
    "dim_meter": DIM_METER,
    "dim_time": DIM_TIME,
    "dim_site": DIM_SITE,
    "dim_building": DIM_BUILDING,
    "fact": FACT,
    "daily": DAILY,
}


def sql(final: str, **replaced: str) -> str:
    """The final SELECT behind all common table expressions (unused ones cost nothing)."""
    parts = {**_EXPRESSIONS, **{name: text for name, text in replaced.items() if name in _EXPRESSIONS}}
    extra = {name: text for name, text in replaced.items() if name not in _EXPRESSIONS}
    body = ",\n".join(f"{name} AS ({text})" for name, text in {**parts, **extra}.items())
    return f"WITH {body}\n{final}"


FACT_OUT = "SELECT * REPLACE (CAST(reading_date AS VARCHAR) AS reading_date) FROM fact"
DAILY_OUT = "SELECT * REPLACE (CAST(reading_date AS VARCHAR) AS reading_date) FROM daily"


def bad_rows(table: str, checks: dict[str, str]) -> str:
    """One SELECT per check; each value is an expression over the table for its bad rows."""
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS check_name, CAST(({value}) AS BIGINT) AS bad_rows FROM {table}"
        for name, value in checks.items()
    )


def where(predicate: str) -> str:
    return f"count(*) FILTER ({predicate})"


def orphan_rows(key: str, dim: str) -> str:
    return where(f"NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{key} = fact.{key})")


EMPTY = "CASE WHEN count(*) > 0 THEN 0 ELSE 1 END"

BRONZE_BAD = [
    bad_rows("readings", {
        "meter_row_count_gt_0": EMPTY,
        "meter_building_id_notnull": where("building_id IS NULL"),
        "meter_reading_notnull": where("meter_reading IS NULL"),
        "meter_types_valid": where("meter NOT IN (0, 1, 2, 3)"),
    }),
    bad_rows("weather", {
        "weather_row_count_gt_0": EMPTY,
        "weather_site_id_notnull": where("site_id IS NULL"),
        "weather_timestamp_notnull": where("timestamp IS NULL"),
    }),
    bad_rows("versions", {
        "building_row_count_gt_0": "CASE WHEN count(*) FILTER (is_current) > 0 THEN 0 ELSE 1 END",
        "building_id_notnull": where("building_id IS NULL"),
    }),
    bad_rows("(SELECT building_id FROM versions WHERE is_current GROUP BY 1 HAVING count(*) > 1) AS t",
             {"building_scd2_no_dup_current": "count(*)"}),
]
SILVER_BAD = [
    bad_rows("spikes", {
        "silver_vs_bronze_95pct":
            "greatest(ceil(0.95 * (SELECT count(*) FROM readings)) - count(*), 0)",
        "meter_label_not_null": where("meter_label IS NULL"),
        "all_4_meter_types": "abs(count(DISTINCT meter) + max(CAST(meter IS NULL AS INT)) - 4)",
        "reading_date_not_null": where("reading_date IS NULL"),
        "no_negative_readings": where("meter_reading < 0"),
    }),
    bad_rows("clean_weather", {
        "weather_no_null_airtemp": where("air_temperature IS NULL"),
        "all_temp_categories": where("temp_category IS NULL"),
        "wind_direction_fix": where("wind_speed = 0 AND wind_direction = 0"),
    }),
    bad_rows("enriched", {
        "energy_per_sqft_positive": where("energy_per_sqft < 0"),
        "enriched_row_count": EMPTY,
    }),
]
_MONTHS = "SELECT DISTINCT site_key, month(reading_date) AS m FROM fact"
GOLD_BAD = [
    bad_rows("fact", {
        "fact_building_key_not_null": where("building_key IS NULL"),
        "fact_date_key_not_null": where("date_key IS NULL"),
        "fact_meter_reading_not_null": where("meter_reading IS NULL"),
        "fact_reading_key_unique": "count(*) - count(DISTINCT reading_key)",
        "fact_meter_reading_gte_0": where("meter_reading < 0"),
        "fact_building_key_resolves": orphan_rows("building_key", "dim_building"),
        "fact_site_key_resolves": orphan_rows("site_key", "dim_site"),
        "fact_date_key_resolves": orphan_rows("date_key", "dim_date"),
        "fact_meter_type_key_resolves": orphan_rows("meter_type_key", "dim_meter"),
        "air_temp_range": where("air_temperature < -40 OR air_temperature > 50"),
        "data_spans_12_months": "abs(count(DISTINCT month(reading_date)) - 12)",
    }),
    bad_rows(f"(SELECT site_key FROM ({_MONTHS}) AS t GROUP BY 1 HAVING count(*) < 12) AS t",
             {"all_sites_have_12_months": "count(*)"}),
    bad_rows("daily", {
        "daily_building_key_not_null": where("building_key IS NULL"),
        "daily_building_date_key_unique": "count(*) - count(DISTINCT building_date_key)",
        "daily_total_energy_correct": where(
            "round(total_energy, 2) <> round(total_electricity_kwh + total_chilled_water"
            " + total_steam + total_hot_water, 2)"),
        "completeness_pct_range": where("data_completeness_pct NOT BETWEEN 0 AND 100"),
        "hours_with_data_range": where("hours_with_data NOT BETWEEN 0 AND 24"),
    }),
    bad_rows("dim_building", {
        "dim_building_use_not_null": where("primary_use IS NULL"),
    }),
    bad_rows("(SELECT building_id FROM dim_building WHERE is_current GROUP BY 1 HAVING count(*) > 1) AS t",
             {"dim_building_no_dup_current": "count(*)"}),
    bad_rows("dim_site", {"all_16_sites_present": "abs(count(*) - 16)"}),
    bad_rows("dim_meter", {"all_4_meter_types_in_dim": "abs(count(*) - 4)"}),
    bad_rows("dim_time", {"dim_time_24_rows": "abs(count(*) - 24)"}),
]


def checks_sql(parts: list[str], **replaced: str) -> str:
    checks = "\nUNION ALL\n".join(parts)
    return sql(f"SELECT check_name, bad_rows, bad_rows = 0 AS passed FROM (\n{checks}\n) AS checks", **replaced)
