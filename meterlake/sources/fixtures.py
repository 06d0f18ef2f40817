"""Meter, weather and building inputs derived from the given tables.

The same SQL text runs on Spark and on DuckDB and reads its whole input table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

READINGS = """
SELECT event_id,
       CAST(floor(user_id / 10) AS INT) AS building_id,
       CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'purchase' THEN 2
            WHEN 'error' THEN 3 ELSE 4 END AS meter,
       CAST(ts AS TIMESTAMP) AS timestamp,
       CASE WHEN event_id % 97 = 0 THEN 0.0e0 WHEN event_id % 101 = 0 THEN NULL
            WHEN event_id % 211 = 0 THEN -value ELSE value END AS meter_reading
FROM events
"""

# Every ninth building number stays unused, so some readings belong to no known building.
BUILDINGS = """
SELECT CAST(c_custkey + floor(c_custkey / 8) AS INT) AS building_id,
       CAST(c_nationkey % 16 AS INT) AS site_id,
       c_mktsegment AS primary_use,
       CASE WHEN c_custkey % 11 = 3 THEN 0 WHEN c_custkey % 13 = 5 THEN NULL
            ELSE CAST(1000 + c_custkey * 37 AS INT) END AS square_feet,
       CASE WHEN c_custkey % 7 = 2 THEN NULL
            ELSE CAST(1900 + c_custkey % 117 AS INT) END AS year_built,
       CASE WHEN c_custkey % 5 = 1 THEN NULL
            ELSE CAST(c_custkey % 4 AS INT) END AS floor_count
FROM customer
"""

WEATHER = """
SELECT CAST(user_id % 16 AS INT) AS site_id,
       date_trunc('hour', CAST(ts AS TIMESTAMP)) AS timestamp,
       CASE WHEN min(event_id) % 29 = 0 THEN NULL ELSE min(value) - 10 END AS air_temperature,
       CASE WHEN min(event_id) % 3 = 0 THEN NULL
            ELSE CAST(min(event_id) % 9 AS DOUBLE) END AS cloud_coverage,
       min(value) - 15 AS dew_temperature,
       CASE WHEN min(event_id) % 2 = 0 THEN NULL
            ELSE CAST(min(event_id) % 5 - 1 AS DOUBLE) END AS precip_depth_1_hr,
       CASE WHEN min(event_id) % 4 = 0 OR user_id % 16 = 7 THEN NULL
            ELSE CAST(1000 + min(event_id) % 30 AS DOUBLE) END AS sea_level_pressure,
       CAST(min(event_id) % 4 * 90 AS DOUBLE) AS wind_direction,
       CAST(min(event_id) % 5 - 1 AS DOUBLE) AS wind_speed
FROM events
GROUP BY user_id % 16, date_trunc('hour', CAST(ts AS TIMESTAMP))
"""

# A second batch for all buildings, shifted by five numbers: most uses change, some become
# null, some stay the same, a few buildings are new and the first five are not mentioned.
CHANGES = f"""
SELECT building_id + 5 AS building_id, site_id,
       CASE WHEN building_id % 9 = 7 THEN NULL ELSE primary_use END AS primary_use,
       square_feet, year_built, floor_count
FROM ({BUILDINGS}) AS buildings
"""

_TABLES = {"readings": (READINGS, "events"), "weather": (WEATHER, "events"),
           "buildings": (BUILDINGS, "customer"), "changes": (CHANGES, "customer")}


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of readings, weather, buildings, changes over the tables in ``sf_dir``."""
    text, table = _TABLES[name]
    source = spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")
    return spark.sql(text.replace(f"FROM {table}", f"FROM {{{table}}}"), **{table: source})
