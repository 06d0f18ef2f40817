"""Every registered query with the SQL it is compared with."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.functions.calendar import is_weekend
from meterlake.operators import checks, merge, reports
from meterlake.operators.audit import add_audit_columns
from meterlake.operators.dedupe import latest_by
from meterlake.operators.enrich import with_building
from meterlake.operators.fill import forward_fill, group_medians
from meterlake.operators.readings import READING_GRAIN
from meterlake.operators.rolling import rolling_mean
from meterlake.operators.weather import GAP_FILLED, standardise_weather
from meterlake.plans import dims, lakehouse, quality
from meterlake.plans.lakehouse import BUILDING, METER, WEATHER
from meterlake.queries import oracle
from meterlake.queries.inputs import FIRST, INGESTED_AT, SECOND, Layers, portable
from meterlake.queries.landing import SCHEMAS, land_as, new_lake, write_landing
from meterlake.queries.oracle import RUN_ID, sql
from meterlake.session import materialize, scratch_dir
from meterlake.sinks.snapshots import create_snapshot_if_missing, read_snapshot, refresh
from meterlake.sinks.tables import append, create_if_missing, overwrite_partitions, read_table
from meterlake.sources.schemas import infer_or_load_schema
from meterlake.sources.streams import csv_stream
from meterlake.streaming import bronze
from meterlake.streaming.runners import stream_append
from meterlake.streaming.silver import silver_readings, stored_table
from meterlake.streaming.weather import silver_weather

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, expected: str | None = None):
    """Register a function of :class:`Layers` under a name, with its SQL."""

    def register(build: Callable[[Layers], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: portable(build(Layers(spark, sf_dir)))
        if expected is not None:
            ORACLE[name] = expected
        return build

    return register


def _text(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in columns)


# --- silver: readings ---------------------------------------------------------------------

_READING = "event_id, building_id, meter, meter_reading"
_DERIVED = (
    "reading_hour, reading_day_of_week, is_weekend, reading_month, meter_label, is_zero_reading, "
    + _text("timestamp", "reading_date")
)


@query("silver_readings", sql(f"SELECT {_READING}, {_DERIVED} FROM silver_readings"))
def _(q: Layers):
    return q.readings()


@query("rolling_avg_7d", sql("SELECT event_id, rolling_avg_7d FROM spikes"))
def _(q: Layers):
    return q.spikes().select("event_id", "rolling_avg_7d")


@query(
    "rolling_avg_1d",
    sql(
        f"""SELECT event_id, CAST(sum(CAST(meter_reading AS {oracle._DEC})) OVER frame AS DOUBLE)
                             / count(meter_reading) OVER frame AS rolling_avg_1d
            FROM silver_readings
            WINDOW frame AS (PARTITION BY building_id ORDER BY second
                             RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW)"""
    ),
)
def _(q: Layers):
    rolled = rolling_mean(
        q.readings(), ["building_id"], "timestamp", "meter_reading", "rolling_avg_1d", 86_400
    )
    return rolled.select("event_id", "rolling_avg_1d")


@query("spikes", sql(f"SELECT {_READING}, is_spike, rolling_avg_7d, {_DERIVED} FROM spikes"))
def _(q: Layers):
    return q.spikes()


@query(
    "latest_reading",
    sql(
        f"""SELECT building_id, meter, {_text('reading_date')}, reading_hour, event_id, meter_reading
            FROM silver_readings
            QUALIFY row_number() OVER (PARTITION BY building_id, meter, reading_date, reading_hour
                                       ORDER BY event_id DESC) = 1"""
    ),
)
def _(q: Layers):
    rows = q.readings().select(
        "building_id", "meter", "reading_date", "reading_hour", "event_id", "meter_reading"
    )
    return latest_by(rows, ["building_id", "meter", "reading_date", "reading_hour"], ["event_id"])


# --- silver: weather ----------------------------------------------------------------------

_WEATHER = (
    "site_id, air_temperature, dew_temperature, wind_direction, wind_speed, cloud_coverage, "
    "precip_depth_1_hr, sea_level_pressure, weather_hour, " + _text("timestamp", "weather_date")
)


@query("weather_standard", sql(f"SELECT {_WEATHER} FROM standard_weather"))
def _(q: Layers):
    return standardise_weather(q.raw("weather"))


@query("weather_ffill", sql(f"SELECT {_WEATHER} FROM ffill_weather"))
def _(q: Layers):
    return forward_fill(standardise_weather(q.raw("weather")), "site_id", "timestamp", GAP_FILLED)


@query("weather_site_median", sql("SELECT * FROM medians"))
def _(q: Layers):
    filled = forward_fill(standardise_weather(q.raw("weather")), "site_id", "timestamp", GAP_FILLED)
    return group_medians(filled, "site_id", GAP_FILLED)


@query("weather_clean", sql(f"SELECT {_WEATHER}, temp_category FROM clean_weather"))
def _(q: Layers):
    return q.weather()


@query(
    "temp_category_counts",
    sql("SELECT temp_category, count(*) AS rows FROM clean_weather GROUP BY temp_category"),
)
def _(q: Layers):
    return reports.category_counts(q.weather(), "temp_category")


# --- silver: enriched ---------------------------------------------------------------------

_ENRICHED = (
    f"{_READING}, {_DERIVED}, rolling_avg_7d, is_spike, site_id, primary_use, square_feet, year_built, "
    "floor_count, is_building_unknown, air_temperature, wind_speed, temp_category, "
    "sea_level_pressure, dew_temperature, energy_per_sqft, building_age, is_year_unknown, "
    f"is_floor_unknown, {_text('effective_from')}"
)


@query("enriched", sql(f"SELECT {_ENRICHED} FROM enriched"))
def _(q: Layers):
    return q.enriched().drop(
        "ingestion_timestamp", "ingestion_date", "source_file_name", "batch_id"
    )


@query(
    "enriched_unknown_buildings",
    sql(
        """SELECT r.building_id, count(*) AS rows
           FROM silver_readings r LEFT JOIN versions b ON r.building_id = b.building_id
           WHERE b.site_id IS NULL GROUP BY r.building_id"""
    ),
)
def _(q: Layers):
    joined = with_building(q.readings(), q.versions())
    return joined.filter("is_building_unknown").groupBy("building_id").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "energy_per_sqft",
    sql(
        """SELECT primary_use, count(*) AS rows, count(energy_per_sqft) AS known,
                  round(sum(CAST(energy_per_sqft AS DECIMAL(28,6))), 6)::DOUBLE AS energy_per_sqft
           FROM enriched GROUP BY primary_use"""
    ),
)
def _(q: Layers):
    return q.enriched().groupBy("primary_use").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("energy_per_sqft").alias("known"),
        F.sum(F.col("energy_per_sqft").cast("decimal(28,6)")).cast("double").alias("energy_per_sqft"),
    )


# --- gold: dimensions ---------------------------------------------------------------------


@query(
    "dim_date",
    sql(
        f"""SELECT d.* REPLACE (CAST(d.date AS VARCHAR) AS date), coalesce(r.readings, 0) AS readings
            FROM dim_date d
            LEFT JOIN (SELECT reading_date, count(*) AS readings FROM silver_readings GROUP BY 1) r
                   ON d.date = r.reading_date"""
    ),
)
def _(q: Layers):
    per_day = q.readings().groupBy("reading_date").agg(F.count(F.lit(1)).alias("readings"))
    days = dims.dim_date(q.spark)
    joined = days.join(per_day, days["date"] == per_day["reading_date"], "left").drop("reading_date")
    return joined.withColumn("readings", F.coalesce("readings", F.lit(0)))


@query(
    "dim_meter_type",
    sql(
        """SELECT d.*, count(r.event_id) AS readings FROM dim_meter d
           LEFT JOIN silver_readings r ON d.meter_label = r.meter_label GROUP BY ALL"""
    ),
)
def _(q: Layers):
    used = q.readings().groupBy("meter_label").agg(F.count(F.lit(1)).alias("readings"))
    joined = dims.dim_meter_type(q.spark).join(used, "meter_label", "left")
    return joined.withColumn("readings", F.coalesce("readings", F.lit(0)))


@query(
    "dim_time_of_day",
    sql(
        """SELECT d.*, count(r.event_id) AS readings FROM dim_time d
           LEFT JOIN silver_readings r ON d.hour = r.reading_hour GROUP BY ALL"""
    ),
)
def _(q: Layers):
    used = q.readings().groupBy(F.col("reading_hour").alias("hour")).agg(F.count(F.lit(1)).alias("readings"))
    joined = dims.dim_time_of_day(q.spark).join(used, "hour", "left")
    return joined.withColumn("readings", F.coalesce("readings", F.lit(0)))


@query("dim_site", sql("SELECT * FROM dim_site"))
def _(q: Layers):
    return dims.dim_site(with_building(q.readings(), q.versions()))


@query(
    "dim_building_use",
    sql(
        """SELECT CAST(row_number() OVER (ORDER BY primary_use) AS INT) AS use_key, primary_use
           FROM (SELECT DISTINCT primary_use FROM history WHERE primary_use IS NOT NULL) AS uses""",
        history=oracle.scd2_sql("versions", "changes", oracle.SECOND_LOAD),
    ),
)
def _(q: Layers):
    return dims.dim_building_use(q.history())


_BUILDING_OUT = """SELECT * REPLACE (CAST(effective_from AS VARCHAR) AS effective_from,
                                     CAST(effective_to AS VARCHAR) AS effective_to) FROM dim_building"""


def _history_sql(final: str, null_safe: bool = False) -> str:
    """SQL over the building versions after both loads."""
    history = oracle.scd2_sql(f"({oracle.VERSIONS})", "changes", oracle.SECOND_LOAD, null_safe)
    return sql(final, versions=history)


@query("dim_building", _history_sql(_BUILDING_OUT))
def _(q: Layers):
    return dims.dim_building(q.history())


@query(
    "dim_weather_condition",
    sql(
        f"""SELECT {_WEATHER.replace(', CAST(timestamp AS VARCHAR) AS timestamp', '')}, temp_category,
                   sha256(concat_ws('||', CAST(site_id AS VARCHAR), CAST(weather_date AS VARCHAR),
                                    CAST(weather_hour AS VARCHAR))) AS weather_key
            FROM clean_weather"""
    ),
)
def _(q: Layers):
    return dims.dim_weather_condition(q.weather())


# --- gold: facts --------------------------------------------------------------------------


@query("fact_meter_readings", sql(oracle.FACT_OUT))
def _(q: Layers):
    return q.fact()


@query("fact_daily_building_summary", sql(oracle.DAILY_OUT))
def _(q: Layers):
    return q.daily()


def _orphan_query(name: str, key: str, dim: int, dim_sql: str) -> None:
    expected = sql(
        f"""SELECT {key}, count(*) AS rows FROM fact
            WHERE NOT EXISTS (SELECT 1 FROM {dim_sql} d WHERE d.{key} = fact.{key}) GROUP BY {key}"""
    )

    @query(name, expected)
    def _(q: Layers):
        enriched = materialize(q.enriched(), "enriched")
        return checks.orphans(q.fact(enriched), q.fact_dims(enriched)[dim], key)


_orphan_query("orphan_buildings", "building_key", 1, "dim_building")
_orphan_query("orphan_sites", "site_key", 2, "dim_site")
_orphan_query("orphan_dates", "date_key", 0, "dim_date")
_orphan_query("orphan_meters", "meter_type_key", 3, "dim_meter")


# --- checks -------------------------------------------------------------------------------


@query(
    "dup_current",
    sql(
        """SELECT building_id, count(*) AS copies
           FROM (SELECT building_id FROM buildings UNION ALL
                 SELECT building_id FROM buildings WHERE building_id % 10 = 0) AS t
           GROUP BY building_id HAVING count(*) > 1"""
    ),
)
def _(q: Layers):
    current = q.versions().filter("is_current")
    twice = current.unionByName(current.filter("building_id % 10 = 0"))
    return checks.duplicates(twice, ["building_id"])


@query(
    "site_months",
    sql(
        """SELECT site_id, count(DISTINCT month(timestamp)) + max(CAST(timestamp IS NULL AS INT)) AS months
           FROM weather GROUP BY site_id"""
    ),
)
def _(q: Layers):
    return checks.months_per_group(q.raw("weather"), "site_id", "timestamp").withColumn(
        "months", F.col("months").cast("bigint")
    )


@query(
    "reading_key_uniqueness",
    sql(
        """SELECT 'fact_reading_key_unique' AS check_name, 'fact_meter_readings' AS "table",
                  count(*) - count(DISTINCT reading_key) AS bad_rows,
                  'surplus rows=' || (count(*) - count(DISTINCT reading_key)) AS note FROM fact"""
    ),
)
def _(q: Layers):
    return checks.unique_key(q.fact(), "reading_key", quality.FACT, "fact_reading_key_unique")


@query("distinct_meters", sql('SELECT count(*) AS "values" FROM (SELECT DISTINCT meter FROM readings) AS t'))
def _(q: Layers):
    return reports.distinct_values(q.raw("readings"), "meter")


def _verdicts(results: DataFrame) -> DataFrame:
    return results.select("check_name", "bad_rows", (F.col("bad_rows") == 0).alias("passed"))


@query("quality_bronze", oracle.checks_sql(oracle.BRONZE_BAD))
def _(q: Layers):
    return _verdicts(quality.bronze_checks(q.raw("readings"), q.raw("weather"), q.versions()))


@query("quality_silver", oracle.checks_sql(oracle.SILVER_BAD))
def _(q: Layers):
    enriched = materialize(q.enriched(), "enriched")
    weather = materialize(q.weather(), "weather")
    return _verdicts(quality.silver_checks(q.spikes(), weather, enriched, q.raw("readings")))


@query("quality_gold", oracle.checks_sql(oracle.GOLD_BAD))
def _(q: Layers):
    enriched = materialize(q.enriched(), "enriched")
    fact = materialize(q.fact(enriched), "fact", "reading_date")
    daily = materialize(q.daily(fact), "daily")
    return _verdicts(quality.gold_checks(fact, daily, *q.fact_dims(enriched)))


@query(
    "check_log",
    oracle.checks_sql(oracle.BRONZE_BAD).replace(
        "SELECT check_name, bad_rows, bad_rows = 0 AS passed",
        f"SELECT check_name, bad_rows = 0 AS passed, '{INGESTED_AT.isoformat()}' AS checked_at",
    ),
)
def _(q: Layers):
    path = f"{scratch_dir(q.spark)}/bronze_log"
    results = quality.bronze_checks(q.raw("readings"), q.raw("weather"), q.versions())
    checks.write_check_log(checks.as_log(results, INGESTED_AT), path)
    return q.spark.read.parquet(path).select("check_name", "passed", "checked_at")


# --- reports ------------------------------------------------------------------------------


@query(
    "run_report",
    sql(
        """SELECT 'total' AS metric, count(*) AS rows FROM spikes
           UNION ALL SELECT 'zero_readings', count(*) FILTER (is_zero_reading) FROM spikes
           UNION ALL SELECT 'spikes', count(*) FILTER (is_spike) FROM spikes"""
    ),
)
def _(q: Layers):
    return reports.run_report(q.spikes(), zero_readings="is_zero_reading", spikes="is_spike")


@query(
    "table_counts",
    sql(
        "\nUNION ALL\n".join(
            f"SELECT '{name}' AS table_name, count(*) AS rows FROM {table}"
            for name, table in {
                "dim_date": "dim_date",
                "dim_meter_type": "dim_meter",
                "dim_time_of_day": "dim_time",
                "dim_site": "dim_site",
                "dim_building_use": "(SELECT DISTINCT primary_use FROM versions"
                " WHERE primary_use IS NOT NULL) AS uses",
                "dim_building": "dim_building",
                "dim_weather_condition": "clean_weather",
            }.items()
        )
    ),
)
def _(q: Layers):
    versions = q.versions()
    return reports.table_counts(
        {
            "dim_date": dims.dim_date(q.spark),
            "dim_meter_type": dims.dim_meter_type(q.spark),
            "dim_time_of_day": dims.dim_time_of_day(q.spark),
            "dim_site": dims.dim_site(with_building(q.readings(), versions)),
            "dim_building_use": dims.dim_building_use(versions),
            "dim_building": dims.dim_building(versions),
            "dim_weather_condition": dims.dim_weather_condition(q.weather()),
        }
    )


@query(
    "top_previews",
    sql(f"SELECT {_READING}, reading_hour FROM silver_readings"
        " ORDER BY meter_reading DESC NULLS LAST, event_id LIMIT 25"),
)
def _(q: Layers):
    preview = reports.top_preview(q.readings(), [F.desc("meter_reading"), "event_id"], 25)
    return preview.select("event_id", "building_id", "meter", "meter_reading", "reading_hour")


@query("preview", sql("SELECT temp_category, count(*) AS rows FROM clean_weather GROUP BY temp_category"))
def _(q: Layers):
    """A preview of a table of five rows: all of it, in its order."""
    return reports.preview(reports.category_counts(q.weather(), "temp_category"), 5)


@query(
    "mean_completeness",
    sql("SELECT round(avg(data_completeness_pct), 6) AS avg_data_completeness_pct FROM daily"),
)
def _(q: Layers):
    mean = reports.global_mean(q.daily(), "data_completeness_pct", "avg_data_completeness_pct")
    return mean.withColumn("avg_data_completeness_pct", F.round("avg_data_completeness_pct", 6))


# --- table writes and merges --------------------------------------------------------------

_BUILDING = "building_id, site_id, primary_use, square_feet, year_built, floor_count"
_VERSION_OUT = (
    f"SELECT {_BUILDING}, {_text('effective_from', 'effective_to')}, is_current FROM versions"
)


@query("scd2_apply", _history_sql(_VERSION_OUT))
def _(q: Layers):
    return q.history()


@query("scd2_apply_null_safe", _history_sql(_VERSION_OUT, null_safe=True))
def _(q: Layers):
    return q.history(null_safe=True)


@query(
    "merge_update",
    sql(
        """SELECT t.building_id, t.site_id,
                  CASE WHEN s.square_feet > t.square_feet THEN s.primary_use ELSE t.primary_use END
                      AS primary_use,
                  CASE WHEN s.square_feet > t.square_feet THEN s.square_feet ELSE t.square_feet END
                      AS square_feet,
                  t.year_built, t.floor_count
           FROM buildings t LEFT JOIN changes s ON t.building_id = s.building_id"""
    ),
)
def _(q: Layers):
    return merge.merge_update(
        q.raw("buildings"),
        q.raw("changes"),
        ["building_id"],
        {"primary_use": "src.primary_use", "square_feet": "src.square_feet"},
        when="src.square_feet > tgt.square_feet",
    )


@query(
    "merge_insert",
    sql(
        f"""SELECT {_BUILDING} FROM buildings UNION ALL
            SELECT {_BUILDING} FROM changes c
            WHERE NOT EXISTS (SELECT 1 FROM buildings b WHERE b.building_id = c.building_id)"""
    ),
)
def _(q: Layers):
    return merge.merge_insert(q.raw("buildings"), q.raw("changes"), ["building_id"])


_CORRECTIONS = (
    "SELECT event_id, building_id, meter,"
    " CASE WHEN event_id % 2 = 0 THEN timestamp ELSE timestamp + INTERVAL 1 HOUR END AS timestamp,"
    " meter_reading + 1 AS meter_reading FROM readings"
)


@query(
    "upsert",
    sql(
        f"""SELECT event_id, building_id, meter, {_text('timestamp')}, meter_reading
            FROM (SELECT * FROM corrections UNION ALL
                  SELECT * FROM readings r
                  WHERE NOT EXISTS (SELECT 1 FROM corrections c WHERE c.building_id = r.building_id
                                    AND c.meter = r.meter AND c.timestamp = r.timestamp)) AS t""",
        corrections=_CORRECTIONS,
    ),
)
def _(q: Layers):
    readings = q.raw("readings")
    later = F.col("timestamp") + F.expr("INTERVAL 1 HOUR")
    moved = F.when(F.col("event_id") % 2 == 0, F.col("timestamp")).otherwise(later)
    corrections = readings.withColumns(
        {"timestamp": moved, "meter_reading": F.col("meter_reading") + 1}
    )
    return merge.upsert(readings, corrections, READING_GRAIN)


_USE_SITES = (
    "SELECT primary_use, site_id, count(*) AS buildings FROM {} GROUP BY primary_use, site_id"
)


def _uses(buildings: DataFrame) -> DataFrame:
    return buildings.groupBy("primary_use", "site_id").agg(F.count(F.lit(1)).alias("buildings"))


@query("refresh", sql(_USE_SITES.format("changes")))
def _(q: Layers):
    path = f"{scratch_dir(q.spark)}/refreshed"
    refresh(_uses(q.raw("buildings")), path)
    refresh(_uses(q.raw("changes")), path)
    return read_snapshot(q.spark, path)


@query("create_if_missing", sql(_USE_SITES.format("buildings")))
def _(q: Layers):
    path = f"{scratch_dir(q.spark)}/created"
    create_if_missing(_uses(q.raw("buildings")), path)
    create_if_missing(_uses(q.raw("changes")), path)
    return q.spark.read.parquet(path)


@query("create_snapshot_if_missing", sql(_USE_SITES.format("buildings")))
def _(q: Layers):
    path = f"{scratch_dir(q.spark)}/created"
    create_snapshot_if_missing(_uses(q.raw("buildings")), path)
    create_snapshot_if_missing(_uses(q.raw("changes")), path)
    return read_snapshot(q.spark, path)


@query(
    "append_partitioned",
    sql(
        f"""SELECT {_READING}, {_text('reading_date')}, NULL AS meter_label FROM silver_readings
            UNION ALL SELECT {_READING}, {_text('reading_date')}, meter_label FROM silver_readings"""
    ),
)
def _(q: Layers):
    path = f"{scratch_dir(q.spark)}/appended"
    columns = ["event_id", "building_id", "meter", "meter_reading", "reading_date"]
    append(q.readings().select(*columns), path, "reading_date")
    append(q.readings().select(*columns, "meter_label"), path, "reading_date")
    return read_table(q.spark, path)


@query(
    "overwrite_partitions",
    sql(
        f"SELECT {_READING}, {_text('reading_date')}, rolling_avg_7d IS NOT NULL AS rolled FROM spikes"
    ),
)
def _(q: Layers):
    path = f"{scratch_dir(q.spark)}/replaced"
    columns = ["event_id", "building_id", "meter", "meter_reading", "reading_date"]
    overwrite_partitions(q.readings().select(*columns, F.lit(None).cast("boolean").alias("rolled")),
                         path, "reading_date")
    rolled = q.spikes().select(*columns, F.col("rolling_avg_7d").isNotNull().alias("rolled"))
    overwrite_partitions(rolled, path, "reading_date")
    return read_table(q.spark, path, rolled.schema)


@query(
    "audit_columns",
    sql(
        f"""SELECT {_READING}, {_text('timestamp')}, 'events' AS source_file_name, '{RUN_ID}' AS batch_id,
                   '2024-02-01' AS ingestion_date, '2024-02-01 06:00:00' AS ingestion_timestamp
            FROM readings"""
    ),
)
def _(q: Layers):
    return q.bronze_readings()


# --- ingestion ----------------------------------------------------------------------------


def _feed(lake: lakehouse.LakeConfig, spark: SparkSession, feed: str, **settings) -> DataFrame:
    bronze.ingest_csv(
        spark,
        lake.landing(feed),
        lake.table(f"bronze_{feed}"),
        lake.store(feed),
        lake.checkpoint(f"bronze_{feed}"),
        lake.run_id,
        ingested_at=lake.ingested_at,
        **settings,
    )
    return lakehouse.bronze_table(spark, lake, feed)


@query("csv_ingest", sql(f"SELECT {_READING}, {_text('timestamp')} FROM readings"))
def _(q: Layers):
    lake = new_lake(q.spark)
    write_landing(q.raw("readings"), lake.landing(METER), parts=4)
    rows = _feed(lake, q.spark, METER, max_files=2)
    return rows.select("event_id", "building_id", "meter", "meter_reading", "timestamp")


@query("csv_stream_append", sql(f"SELECT {_READING}, {_text('timestamp')} FROM readings"))
def _(q: Layers):
    lake = new_lake(q.spark)
    write_landing(q.raw("readings"), lake.landing(METER), parts=4)
    stream = csv_stream(q.spark, lake.landing(METER), SCHEMAS[METER], max_files=3)
    audited = add_audit_columns(stream, RUN_ID, "source_file_name", INGESTED_AT)
    stream_append(audited, lake.table("raw"), lake.checkpoint("raw"))
    rows = q.spark.read.parquet(lake.table("raw"))
    return rows.select("event_id", "building_id", "meter", "meter_reading", "timestamp")


@query(
    "csv_schema_inference",
    sql(
        """SELECT * FROM (VALUES ('building_id', 'integer'), ('floor_count', 'integer'),
                                 ('primary_use', 'string'), ('site_id', 'integer'),
                                 ('square_feet', 'integer'), ('year_built', 'integer'))
                         AS t(column_name, type_name)
           CROSS JOIN (SELECT count(*) AS rows FROM buildings) AS n"""
    ),
)
def _(q: Layers):
    lake = new_lake(q.spark)
    write_landing(q.raw("buildings"), lake.landing(BUILDING))
    schema = infer_or_load_schema(q.spark, lake.landing(BUILDING), lake.store(BUILDING))
    again = infer_or_load_schema(q.spark, lake.landing(BUILDING), lake.store(BUILDING))
    rows = q.spark.read.csv(lake.landing(BUILDING), header=True, schema=again)
    types = F.array(*[F.struct(F.lit(f.name).alias("column_name"),
                               F.lit(f.dataType.typeName()).alias("type_name")) for f in schema.fields])
    return rows.agg(F.count(F.lit(1)).alias("rows")).select(F.inline(types), "rows")


# Three runs: a column more in the middle and another order, the plain columns, another new column.
@query(
    "csv_schema_evolution",
    sql(
        f"""SELECT {_READING}, {_text('timestamp')}, CASE WHEN meter < 2 THEN meter_reading * 2 END AS doubled,
                   CASE WHEN meter > 2 THEN -meter_reading END AS negated FROM readings"""
    ),
)
def _(q: Layers):
    lake = new_lake(q.spark)
    readings, landing = q.raw("readings"), lake.landing(METER)
    wide = readings.filter("meter < 2").select(
        "meter_reading",
        "building_id",
        (F.col("meter_reading") * 2).alias("doubled"),
        "timestamp",
        "meter",
        "event_id",
    )
    steps = {
        "wide": wide,
        "plain": readings.filter("meter = 2"),
        "other": readings.filter("meter > 2").withColumn("negated", -F.col("meter_reading")),
    }
    for name, rows in steps.items():
        write_landing(rows, f"{landing}/{name}", parts=2)
        _feed(lake, q.spark, METER)
    rows = bronze.read_bronze(q.spark, lake.table(f"bronze_{METER}"), lake.store(METER))
    return rows.select("event_id", "building_id", "meter", "meter_reading", "timestamp", "doubled", "negated")


@query(
    "csv_all_files",
    sql(
        f"""SELECT path, {_READING}, {_text('timestamp')} FROM readings
            CROSS JOIN (VALUES ('table'), ('stream')) AS t(path)"""
    ),
)
def _(q: Layers):
    """Files of any suffix, packed or not, one of them old, by both ways of ingestion."""
    lake = new_lake(q.spark)
    landing, readings = lake.landing(METER), q.raw("readings")
    suffixes = {0: ".csv", 1: "", 2: ".CSV", 3: ".csv.gz", 4: ".txt"}
    for meter, suffix in suffixes.items():
        land_as(readings.filter(F.col("meter") == meter), landing, f"m{meter}", suffix, days_old=40 if meter == 1 else 0)
    columns = ["event_id", "building_id", "meter", "meter_reading", "timestamp"]
    table = _feed(lake, q.spark, METER, schema=SCHEMAS[METER]).select(F.lit("table").alias("path"), *columns)
    stream_append(csv_stream(q.spark, landing, SCHEMAS[METER]), lake.table("raw"), lake.checkpoint("raw"))
    streamed = q.spark.read.parquet(lake.table("raw")).select(F.lit("stream").alias("path"), *columns)
    return table.unionByName(streamed)


@query(
    "csv_rescue",
    sql(
        """SELECT event_id, building_id, CASE WHEN event_id % 50 = 0 THEN NULL ELSE meter END AS meter,
                  CASE WHEN event_id % 75 <> 0 THEN meter_reading END AS meter_reading, NULLIF(concat_ws('; ',
                  CASE WHEN event_id % 50 = 0 THEN 'meter=n/a' END,
                  CASE WHEN event_id % 75 = 0 THEN 'meter_reading=off ' || building_id END), '') AS rescued
           FROM readings"""
    ),
)
def _(q: Layers):
    """Fields that don't fit, one or two a line: each by its name, the others of the line as values."""
    lake = new_lake(q.spark)
    broken = q.raw("readings").withColumns(
        {
            "meter": F.when(F.col("event_id") % 50 == 0, "n/a").otherwise(F.col("meter").cast("string")),
            "meter_reading": F.when(F.col("event_id") % 75 == 0, F.concat(F.lit("off "), F.col("building_id"))).otherwise(
                F.col("meter_reading").cast("string")
            ),
        }
    )
    write_landing(broken, lake.landing(METER), parts=2)
    rows = _feed(lake, q.spark, METER, schema=SCHEMAS[METER])
    fields = F.map_entries(F.from_json("_rescued_data", "map<string,string>"))
    listed = F.transform(F.array_sort(fields), lambda f: F.concat_ws("=", f["key"], f["value"]))
    return rows.select(
        "event_id", "building_id", "meter", "meter_reading", F.array_join(listed, "; ").alias("rescued")
    )


# Three runs: whole numbers, numbers past an int and with a fraction, and words.
@query(
    "csv_type_widening",
    sql(
        """SELECT event_id, meter, CASE WHEN meter = 1 THEN event_id + 4000000000 ELSE event_id END AS counter,
                  CASE WHEN meter = 1 THEN event_id + 0.5 ELSE CAST(event_id AS DOUBLE) END AS amount,
                  CASE WHEN meter >= 2 THEN 'w' || event_id ELSE CAST(event_id AS VARCHAR) END AS note,
                  'bigint, double, string' AS types
           FROM readings"""
    ),
)
def _(q: Layers):
    """Columns whose types grow while older files stay as they are."""
    lake = new_lake(q.spark)
    rows, number = q.raw("readings").select("event_id", "meter"), F.col("event_id")
    steps = {
        "a": ("meter = 0", number, number, number),
        "b": ("meter = 1", number + 4_000_000_000, number + F.lit(0.5), number),
        "c": ("meter >= 2", number, number, F.concat(F.lit("w"), number)),
    }
    for name, (part, counter, amount, note) in steps.items():
        values = {"counter": counter, "amount": amount, "note": note}
        write_landing(rows.filter(part).withColumns(values), f"{lake.landing(METER)}/{name}", parts=1)
        got = _feed(lake, q.spark, METER, on_misfit="widen_to_text")
    types = ", ".join(got.schema[c].dataType.simpleString() for c in ("counter", "amount", "note"))
    return got.select("event_id", "meter", "counter", "amount", "note", F.lit(types).alias("types"))


# --- streams ------------------------------------------------------------------------------


def _land_readings_and_run(q: Layers, rows: DataFrame, lake: lakehouse.LakeConfig, parts: int | None = None) -> None:
    write_landing(rows, lake.landing(METER), parts)
    lakehouse.run_lakehouse(q.spark, lake)


def _base_lake(q: Layers, **settings) -> lakehouse.LakeConfig:
    lake = new_lake(q.spark, **settings)
    write_landing(q.raw("weather"), lake.landing(WEATHER))
    write_landing(q.raw("buildings"), lake.landing(BUILDING))
    return lake


@query("stream_readings", sql(f"SELECT {_READING}, is_spike, rolling_avg_7d, {_DERIVED} FROM spikes"))
def _(q: Layers):
    """Readings arrive in two runs of several batches each, in no order."""
    lake = new_lake(q.spark)
    for part in (F.col("meter") < 2, F.col("meter") >= 2):
        write_landing(q.raw("readings").filter(part), lake.landing(METER), parts=2)
        _feed(lake, q.spark, METER, max_files=1, schema=SCHEMAS[METER])
        silver_readings(
            q.spark,
            lake.table(f"bronze_{METER}"),
            lake.store(METER),
            lake.table("silver_readings"),
            lake.checkpoint("silver_readings"),
        )
    rows = stored_table(q.spark, lake.table("silver_readings"))
    return rows.select(
        *["event_id", "building_id", "meter", "meter_reading", "is_spike", "rolling_avg_7d"],
        *["reading_hour", "reading_day_of_week", "is_weekend", "reading_month", "meter_label"],
        *["is_zero_reading", "timestamp", "reading_date"],
    )


@query(
    "stream_corrections",
    sql(
        """SELECT event_id, round(meter_reading + CASE WHEN event_id % 5 = 0 THEN 2 WHEN event_id % 3 = 0 THEN 1
                                                       ELSE 0 END, 2) AS meter_reading FROM readings"""
    ),
)
def _(q: Layers):
    """Corrections in files whose names sort before those they correct: some land with them and
    are newer, the others come in a later batch of the same ingestion time."""
    lake = new_lake(q.spark)
    readings, landing = q.raw("readings"), lake.landing(METER)

    def corrected(every: int, by: int) -> DataFrame:
        return readings.filter(F.col("event_id") % every == 0).withColumn("meter_reading", F.col("meter_reading") + by)

    land_as(readings, landing, "z", ".csv", days_old=3)
    land_as(corrected(3, 1), landing, "a", ".csv", days_old=2)
    _feed(lake, q.spark, METER, schema=SCHEMAS[METER])
    land_as(corrected(5, 2), landing, "0", ".csv", days_old=9)
    _feed(lake, q.spark, METER, schema=SCHEMAS[METER])
    silver_readings(
        q.spark,
        lake.table(f"bronze_{METER}"),
        lake.store(METER),
        lake.table("silver_readings"),
        lake.checkpoint("silver_readings"),
    )
    return stored_table(q.spark, lake.table("silver_readings")).select("event_id", "meter_reading")


@query("stream_weather", sql(f"SELECT {_WEATHER}, temp_category FROM clean_weather"))
def _(q: Layers):
    lake = new_lake(q.spark)
    for part in (is_weekend(F.col("timestamp")), ~is_weekend(F.col("timestamp"))):
        write_landing(q.raw("weather").filter(part), lake.landing(WEATHER), parts=1)
        _feed(lake, q.spark, WEATHER, schema=SCHEMAS[WEATHER])
        silver_weather(
            q.spark,
            lake.table(f"bronze_{WEATHER}"),
            lake.store(WEATHER),
            lake.table("silver_weather"),
            lake.checkpoint("silver_weather"),
        )
    rows = stored_table(q.spark, lake.table("silver_weather"))
    return rows.drop(
        *["ingestion_timestamp", "ingestion_date", "source_file_name", "batch_id"],
        *["ingest_batch", "source_modified_at"],
    )


@query("stream_scd2", _history_sql(_VERSION_OUT))
def _(q: Layers):
    lake = new_lake(q.spark)
    for name, as_of in (("buildings", FIRST), ("changes", SECOND)):
        write_landing(q.raw(name), lake.landing(BUILDING))
        bronze.ingest_versions(
            q.spark,
            lake.landing(BUILDING),
            lake.table("versions"),
            lake.store(BUILDING),
            lake.checkpoint("versions"),
            lake.run_id,
            as_of,
            schema=SCHEMAS[BUILDING],
            ingested_at=lake.ingested_at,
        )
    rows = read_snapshot(q.spark, lake.table("versions"))
    return rows.select(
        *SCHEMAS[BUILDING].names, "effective_from", "effective_to", "is_current"
    )


_DAILY_NAMES = (
    "date_key, building_key, site_key, total_electricity_kwh, total_chilled_water, total_steam, "
    "total_hot_water, total_energy, avg_temperature, hours_with_data, zero_reading_hours, spike_count, "
    "data_completeness_pct, energy_per_sqft_day, building_date_key"
)


@query("stream_daily", sql(f"SELECT {_DAILY_NAMES}, {_text('reading_date')} FROM daily"))
def _(q: Layers):
    """All layers, with the readings in two runs: every building-day is met twice."""
    lake = _base_lake(q)
    for part in (F.col("meter") < 2, F.col("meter") >= 2):
        write_landing(q.raw("readings").filter(part), lake.landing(METER))
        for step in (lakehouse.run_bronze, lakehouse.run_silver, lakehouse.run_dimensions, lakehouse.run_facts):
            step(q.spark, lake)
    return stored_table(q.spark, lake.table("fact_daily_building_summary"))


@query(
    "lake_report",
    sql(
        "\nUNION ALL\n".join(
            f"SELECT '{table}' AS table_name, '{metric}' AS metric, count(*) FILTER ({rule}) AS rows FROM {source}"
            for table, source, rules in (
                ("bronze_meter_readings", "readings", {"total": "TRUE", "rescued": "FALSE"}),
                ("bronze_weather_readings", "weather", {"total": "TRUE", "rescued": "FALSE"}),
                ("bronze_building_metadata", "versions", {"total": "TRUE", "current": "is_current"}),
                ("silver_readings", "spikes",
                 {"total": "TRUE", "zero_readings": "is_zero_reading", "spikes": "is_spike"}),
                ("silver_weather", "clean_weather",
                 {"total": "TRUE", "null_air_temperature": "air_temperature IS NULL"}),
                ("silver_enriched_readings", "enriched",
                 {"total": "TRUE", "unknown_buildings": "is_building_unknown",
                  "null_energy_per_sqft": "energy_per_sqft IS NULL", "spikes": "is_spike"}),
                ("fact_meter_readings", "fact",
                 {"total": "TRUE", "null_building_key": "building_key IS NULL",
                  "null_date_key": "date_key IS NULL", "zero_readings": "is_zero_reading",
                  "spikes": "is_spike"}),
                ("fact_daily_building_summary", "daily",
                 {"total": "TRUE", "null_building_date_key": "building_date_key IS NULL"}),
                ("dim_date", "dim_date", {"total": "TRUE"}),
                ("dim_meter_type", "dim_meter", {"total": "TRUE"}),
                ("dim_time_of_day", "dim_time", {"total": "TRUE"}),
                ("dim_site", "dim_site", {"total": "TRUE"}),
                ("dim_building_use", "(SELECT DISTINCT primary_use FROM versions) AS uses", {"total": "TRUE"}),
                ("dim_building", "dim_building", {"total": "TRUE"}),
                ("dim_weather_condition", "clean_weather", {"total": "TRUE"}),
            )
            for metric, rule in rules.items()
        )
        + """
UNION ALL SELECT 'bronze_meter_readings', 'ingestion_dates', 1
UNION ALL SELECT 'bronze_weather_readings', 'ingestion_dates', 1
UNION ALL SELECT 'fact_daily_building_summary', 'mean_completeness_pct',
                 CAST(round(avg(data_completeness_pct)) AS BIGINT) FROM daily"""
    ),
)
def _(q: Layers):
    lake = _base_lake(q)
    _land_readings_and_run(q, q.raw("readings"), lake, parts=2)
    return lakehouse.lake_report(q.spark, lake)


@query(
    "batch_journal",
    sql(
        """SELECT * FROM (
             SELECT 'bronze_meter_readings' AS stream, CAST(CASE WHEN meter < 2 THEN 0 ELSE 1 END AS BIGINT) AS batch_id,
                    count(*) AS rows FROM readings GROUP BY 1, 2
             UNION ALL SELECT 'bronze_weather_readings', 0, count(*) FROM weather
             UNION ALL SELECT 'bronze_building_metadata', 0, count(*) FROM versions
             UNION ALL SELECT 'silver_weather', 0, count(*) FROM clean_weather) AS t"""
    ),
)
def _(q: Layers):
    """What each batch wrote, after readings came in two runs; the journals of three hops."""
    lake = _base_lake(q)
    for part in (F.col("meter") < 2, F.col("meter") >= 2):
        write_landing(q.raw("readings").filter(part), lake.landing(METER))
        lakehouse.run_bronze(q.spark, lake)
    silver_weather(
        q.spark,
        lake.table(f"bronze_{WEATHER}"),
        lake.store(WEATHER),
        lake.table("silver_weather"),
        lake.checkpoint("silver_weather"),
    )
    return lakehouse.batch_journal(q.spark, lake).select("stream", "batch_id", "rows")


# After the second load, dates rebuilt in that run carry the new building versions.
@query(
    "lakehouse_end_to_end",
    _history_sql(
        """SELECT f.date_key, f.site_key, b.primary_use, f.meter_type_key, count(*) AS rows,
                  count(DISTINCT f.building_key) AS buildings,
                  count(*) FILTER (f.is_spike) AS spikes,
                  CAST(sum(CAST(f.meter_reading AS DECIMAL(28,2))) AS DOUBLE) AS meter_reading
           FROM fact f LEFT JOIN dim_building b ON f.building_key = b.building_key
           GROUP BY 1, 2, 3, 4"""
    ),
)
def _(q: Layers):
    first = _base_lake(q)
    _land_readings_and_run(q, q.raw("readings").filter(F.col("meter") >= 2), first, parts=2)
    second = replace(first, as_of=SECOND, run_id="run-2", ingested_at=INGESTED_AT + dt.timedelta(days=1))
    write_landing(q.raw("changes"), second.landing(BUILDING))
    _land_readings_and_run(q, q.raw("readings").filter(F.col("meter") < 2), second)
    fact = stored_table(q.spark, second.table("fact_meter_readings"))
    buildings = read_snapshot(q.spark, second.table("dim_building")).select("building_key", "primary_use")
    return (
        fact.join(buildings, "building_key", "left")
        .groupBy("date_key", "site_key", "primary_use", "meter_type_key")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.countDistinct("building_key").alias("buildings"),
            F.count_if("is_spike").alias("spikes"),
            F.sum(F.col("meter_reading").cast("decimal(28,2)")).cast("double").alias("meter_reading"),
        )
    )
