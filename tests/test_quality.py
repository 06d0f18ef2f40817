"""All 42 checks pass on a clean input and fail on a broken one."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from meterlake.operators.checks import LOG_COLUMNS, as_log, require_passed, write_check_log
from meterlake.operators.scd2 import open_versions
from meterlake.plans import dims
from meterlake.plans.quality import bronze_checks, gold_checks, silver_checks

DAY = dt.date(2024, 1, 1)


def clean(spark):
    raw = spark.createDataFrame(
        [(1, m, dt.datetime(2024, month, 1), 1.0) for m in range(4) for month in (1, 2)],
        "building_id int, meter int, timestamp timestamp, meter_reading double",
    )
    weather = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 1), 5.0, 1.0, 90.0, "Cold")],
        "site_id int, timestamp timestamp, air_temperature double, wind_speed double, wind_direction double,"
        " temp_category string",
    )
    buildings = open_versions(
        spark.createDataFrame([(1, 1, "Office", 10, 2000, 2)],
                              "building_id int, site_id int, primary_use string, square_feet int, year_built int,"
                              " floor_count int"), DAY)
    readings = raw.withColumns({"reading_date": F.to_date("timestamp"), "meter_label": F.lit("x")})
    enriched = readings.withColumns({"energy_per_sqft": F.lit(0.1), "site_id": F.lit(1)})
    building = dims.dim_building(buildings)
    key = building.first().building_key
    fact = readings.withColumns({
        "reading_key": F.concat("meter", F.lit("-"), "timestamp"), "building_key": F.lit(key), "site_key": F.lit(1),
        "date_key": F.date_format("timestamp", "yyyyMMdd").cast("int"), "meter_type_key": F.col("meter"),
        "air_temperature": F.lit(5.0)})
    daily = spark.createDataFrame(
        [("k", key, 4.0, 1.0, 1.0, 1.0, 1.0, 4.17, 1)],
        "building_date_key string, building_key string, total_energy double, total_electricity_kwh double,"
        " total_chilled_water double, total_steam double, total_hot_water double, data_completeness_pct double,"
        " hours_with_data int")
    return raw, weather, buildings, readings, enriched, fact, daily, building


def broken(spark):
    raw, weather, buildings, readings, enriched, fact, daily, building = clean(spark)
    null = F.lit(None)
    bad_raw = raw.limit(1).withColumns({"building_id": null.cast("int"), "meter_reading": null.cast("double"), "meter": F.lit(9)})
    bad_weather = weather.withColumns({"site_id": null.cast("int"), "timestamp": null.cast("timestamp")})
    bad_buildings = buildings.unionByName(buildings).unionByName(
        buildings.withColumn("building_id", null.cast("int")))
    bad_readings = readings.limit(1).withColumns({"meter_label": null.cast("string"), "reading_date": null.cast("date"),
                                                  "meter_reading": F.lit(-1.0)})
    bad_silver_weather = weather.withColumns({"air_temperature": null.cast("double"), "temp_category": null.cast("string"),
                                              "wind_speed": F.lit(0.0), "wind_direction": F.lit(0.0)})
    bad_enriched = enriched.withColumn("energy_per_sqft", F.lit(-1.0))
    bad_fact = fact.unionByName(
        fact.limit(1).withColumns({c: null.cast(t) for c, t in {"building_key": "string", "date_key": "int",
            "meter_reading": "double", "site_key": "int", "meter_type_key": "int"}.items()}
        ).withColumns({"reading_key": F.lit("same"), "air_temperature": F.lit(99.0)})
    ).unionByName(fact.limit(1).withColumns({"reading_key": F.lit("same"), "meter_reading": F.lit(-1.0)}))
    bad_daily = daily.withColumns({"building_key": null.cast("string"), "total_energy": F.lit(9.0),
                                   "data_completeness_pct": F.lit(101.0), "hours_with_data": F.lit(25)})
    bad_daily = bad_daily.unionByName(bad_daily)
    bad_building = building.withColumn("primary_use", null.cast("string"))
    bad_building = bad_building.unionByName(bad_building)
    return raw, bad_raw, bad_weather, bad_buildings, bad_readings, bad_silver_weather, bad_enriched, bad_fact, bad_daily, bad_building


def verdicts(df):
    return {r.check_name: r.bad_rows == 0 for r in df.collect()}


def parts(spark, building, sites=1):
    site = spark.createDataFrame([(1, 1, "Site_01")] * sites, "site_key int, site_id int, site_name string")
    return dims.dim_date(spark), building, site, dims.dim_meter_type(spark), dims.dim_time_of_day(spark)


def test_all_checks_pass_on_clean_tables(spark):
    raw, weather, buildings, readings, enriched, fact, daily, building = clean(spark)
    results = [bronze_checks(raw, weather, buildings), silver_checks(readings, weather, enriched, raw),
               gold_checks(fact, daily, *parts(spark, building), expected_sites=1, expected_months=2)]
    counts = [len(verdicts(r)) for r in results]
    assert counts == [10, 10, 22]
    assert all(all(verdicts(r).values()) for r in results)


def test_all_checks_fail_on_broken_tables(spark):
    raw, bad_raw, weather, buildings, readings, silver_weather, enriched, fact, daily, building = broken(spark)
    failing = verdicts(bronze_checks(bad_raw, weather, buildings))
    failing |= verdicts(silver_checks(readings, silver_weather, enriched, raw))
    empty = dims.dim_meter_type(spark).filter("false"), dims.dim_time_of_day(spark).filter("false")
    date, dim, site, _, _ = parts(spark, building, sites=2)
    failing |= verdicts(gold_checks(fact, daily, date, dim, site, *empty))
    not_empty = {"meter_row_count_gt_0", "weather_row_count_gt_0", "building_row_count_gt_0", "enriched_row_count"}
    assert {name for name, ok in failing.items() if ok} == not_empty
    nothing = [df.filter("false") for df in (bad_raw, weather, buildings, readings, silver_weather, enriched)]
    none = verdicts(bronze_checks(*nothing[:3])) | verdicts(silver_checks(*nothing[3:], raw))
    assert not any(none[name] for name in not_empty)


def test_gold_checks_read_the_fact_twice_and_leave_nothing_behind(spark, tmp_path):
    *_, fact, daily, building = clean(spark)
    fact.write.parquet(str(tmp_path / "fact"))
    stored = spark.read.parquet(str(tmp_path / "fact"))
    results = gold_checks(stored, daily, *parts(spark, building), expected_sites=1, expected_months=2)
    plan = results._jdf.queryExecution().executedPlan().toString()
    assert sum("FileScan" in line and str(tmp_path) in line for line in plan.splitlines()) == 2


def test_null_group_counts_as_a_value(spark):
    from meterlake.operators.checks import distinct_check

    df = spark.createDataFrame([(0,), (1,), (2,), (None,)], "meter int")
    assert verdicts(distinct_check(df, "meter", "t", "four", 4)) == {"four": True}


def test_log_and_fail_fast(spark, tmp_path):
    raw, weather, buildings, *_ = clean(spark)
    path = str(tmp_path / "log")
    for moment in ("2024-01-01T00:00:00", "2024-01-02T00:00:00"):
        write_check_log(as_log(bronze_checks(raw, weather, buildings), moment), path)
    log = spark.read.parquet(path)
    assert log.columns == LOG_COLUMNS and log.count() == 20
    require_passed(log)
    with pytest.raises(RuntimeError, match="meter_reading_notnull"):
        bad = raw.withColumn("meter_reading", F.lit(None).cast("double"))
        require_passed(as_log(bronze_checks(bad, weather, buildings), "now"))
