import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from meterlake.functions.keys import surrogate_key
from meterlake.functions.numeric import exact_mean, exact_sum
from meterlake.operators.checks import orphans
from meterlake.operators.enrich import enrich_readings
from meterlake.operators.ranking import rank_values
from meterlake.operators.readings import detect_spikes, transform_readings
from meterlake.operators.scd2 import open_versions
from meterlake.operators.weather import clean_weather
from meterlake.plans import dims
from meterlake.plans.facts import fact_daily_summary, fact_meter_readings
from test_weather import weather

DAY = dt.date(2024, 1, 1)
BUILDINGS = "building_id int, site_id int, primary_use string, square_feet int, year_built int, floor_count int"


def versions(spark, rows):
    return open_versions(spark.createDataFrame(rows, BUILDINGS), DAY)


def enriched(spark, readings, buildings):
    schema = "building_id int, meter int, timestamp timestamp, meter_reading double"
    rows = [(b, m, dt.datetime(2024, 1, 1, h), v) for b, m, h, v in readings]
    silver = detect_spikes(transform_readings(spark.createDataFrame(rows, schema)))
    silver = silver.withColumn("source_file_name", F.lit("file"))
    return enrich_readings(silver, versions(spark, buildings), clean_weather(weather(spark, [(1, 0, {})])))


def star(spark, readings, buildings):
    rows = enriched(spark, readings, buildings)
    building = dims.dim_building(versions(spark, buildings))
    parts = [dims.dim_date(spark), building, dims.dim_site(rows), dims.dim_meter_type(spark), dims.dim_time_of_day(spark)]
    fact = fact_meter_readings(rows, *parts, run_id="run")
    return fact, fact_daily_summary(fact, building), parts


HOUSE = (1, 1, "Office", 10, 2000, 2)


@pytest.mark.parametrize("sqft, want", [(None, None), (0, None), (10, 0.5)])
def test_energy_per_area_is_guarded(spark, sqft, want):
    row = enriched(spark, [(1, 0, 0, 5.0)], [(1, 1, "Office", sqft, 2000, 2)]).first()
    assert row.energy_per_sqft == want


@pytest.mark.parametrize("floors, silver, gold", [(None, True, True), (0, True, False), (2, False, False)])
def test_unknown_floors_differ_by_layer(spark, floors, silver, gold):
    building = (1, 1, "Office", 10, None, floors)
    assert enriched(spark, [(1, 0, 0, 5.0)], [building]).first().is_floor_unknown is silver
    row = dims.dim_building(versions(spark, [building])).first()
    assert row.is_floor_unknown is gold and row.floor_count == (floors or 0)
    assert row.is_year_unknown is True and row.building_age is None


def test_unknown_building_keeps_its_reading(spark):
    fact, daily, _ = star(spark, [(9, 0, 0, 5.0)], [HOUSE])
    row = fact.first()
    assert row.is_building_unknown is True and row.building_key is None and row.site_key is None
    only_date = hashlib.sha256(b"20240101").hexdigest()
    assert daily.first().building_date_key == only_date


def test_weather_is_joined_by_hour(spark):
    rows = enriched(spark, [(1, 0, 0, 5.0), (1, 0, 1, 5.0)], [HOUSE]).orderBy("timestamp").collect()
    assert [r.air_temperature for r in rows] == [5.0, None]


def test_unknown_meter_code(spark):
    fact, daily, _ = star(spark, [(1, 4, 0, 5.0), (1, 0, 1, 2.0)], [HOUSE])
    assert {r.meter_type_key for r in fact.collect()} == {None, 0}
    row = daily.first()
    assert (row.total_energy, row.total_electricity_kwh, row.hours_with_data) == (2.0, 2.0, 2)
    assert row.data_completeness_pct == 8.33 and row.energy_per_sqft_day == 0.2


def test_only_null_readings_of_one_type(spark):
    _, daily, _ = star(spark, [(1, 0, 0, None)], [HOUSE])
    row = daily.first()
    assert row.total_electricity_kwh is None and row.total_steam == 0.0 and row.total_energy is None


def test_null_key_is_an_orphan(spark):
    fact, _, parts = star(spark, [(9, 0, 0, 5.0), (9, 0, 1, 5.0), (1, 0, 0, 1.0)], [HOUSE])
    assert [tuple(r) for r in orphans(fact, parts[1], "building_key").collect()] == [(None, 2)]


def test_key_skips_null_parts(spark):
    row = spark.range(1).select(surrogate_key(F.lit(None).cast("int"), F.lit(7)).alias("k")).first()
    assert row.k == hashlib.sha256(b"7").hexdigest()


def test_static_dimensions(spark):
    days = dims.dim_date(spark)
    assert days.count() == 5844
    row = days.filter("date_key = 20240101").first()
    assert (row.day_name, row.month_name, row.day_of_week, row.quarter, row.week_of_year) == ("Monday", "January", 2, 1, 1)
    hours = dims.dim_time_of_day(spark).orderBy("hour").collect()
    assert [h.period_label for h in hours] == ["Night"] * 6 + ["Morning"] * 6 + ["Afternoon"] * 6 + ["Evening"] * 6
    assert [h.hour for h in hours if h.is_business_hour] == list(range(9, 18))
    assert {r.unit for r in dims.dim_meter_type(spark).collect()} == {"kWh", "kBTU"}


def test_rank_values_orders_like_sorting(spark):
    words = ["b", "", "ab", "a", "abc", "B", "é", "zz", "a", None, "ab "]
    got = rank_values(spark.createDataFrame([(w,) for w in words], "w string"), "w", "n").collect()
    ordered = sorted({w for w in words if w is not None}, key=lambda w: w.encode())
    assert {r.w: r.n for r in got} == {w: i + 1 for i, w in enumerate(ordered)}


def test_exact_sum_does_not_depend_on_order(spark):
    rows = [(0, 0.1), (0, 0.2), (0, 0.3), (1, None), (2, float("inf")), (2, 1.0), (3, float("nan"))]
    for part in (1, 4):
        df = spark.createDataFrame(rows, "k int, v double").repartition(part)
        got = {r.k: r.s for r in df.groupBy("k").agg(exact_sum(F.col("v")).alias("s")).collect()}
        means = {r.k: r.m for r in df.groupBy("k").agg(exact_mean(F.col("v")).alias("m")).collect()}
        assert means[0] == 0.6 / 3 and means[1] is None and means[2] == float("inf") and means[3] != means[3]
        assert got[0] == 0.6 and got[1] is None and got[2] == float("inf") and got[3] != got[3]
