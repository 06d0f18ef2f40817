import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from meterlake.operators.fill import forward_fill
from meterlake.operators.weather import clean_weather, standardise_weather

SCHEMA = (
    "site_id int, timestamp timestamp, air_temperature double, cloud_coverage double, dew_temperature double, "
    "precip_depth_1_hr double, sea_level_pressure double, wind_direction double, wind_speed double"
)
START = dt.datetime(2024, 1, 1)


def weather(spark, rows):
    """Rows of (site, hour, overrides)."""
    base = {"air_temperature": 5.0, "cloud_coverage": 1.0, "dew_temperature": 1.0, "precip_depth_1_hr": 0.0,
            "sea_level_pressure": 1000.0, "wind_direction": 90.0, "wind_speed": 2.0}
    data = [{"site_id": s, "timestamp": START + dt.timedelta(hours=h), **base, **more} for s, h, more in rows]
    return spark.createDataFrame(data, SCHEMA)


@pytest.mark.parametrize(
    "speed, direction, want",
    [(0.0, 0.0, (0.0, None)), (-1.0, 0.0, (1.0, 0.0)), (0.0, 90.0, (0.0, 90.0)), (None, 0.0, (None, 0.0))],
)
def test_calm_wind_and_sign(spark, speed, direction, want):
    row = standardise_weather(weather(spark, [(1, 0, {"wind_speed": speed, "wind_direction": direction})])).first()
    assert (row.wind_speed, row.wind_direction) == want


@pytest.mark.parametrize(
    "celsius, band",
    [(-0.1, "Freezing"), (0.0, "Cold"), (9.9, "Cold"), (10.0, "Mild"), (20.0, "Warm"), (30.0, "Hot"), (None, "Hot")],
)
def test_temperature_bands(spark, celsius, band):
    assert clean_weather(weather(spark, [(1, 0, {"air_temperature": celsius})])).first().temp_category == band


def test_forward_fill_comes_before_median(spark):
    values = [None, -1.0, None, 3.0]
    rows = [(1, hour, {"precip_depth_1_hr": v}) for hour, v in enumerate(values)]
    got = clean_weather(weather(spark, rows)).orderBy("timestamp").collect()
    assert [r.precip_depth_1_hr for r in got] == [1.0, 1.0, 1.0, 3.0]


def test_column_without_any_value_stays_null(spark):
    rows = [(7, h, {"sea_level_pressure": None}) for h in range(3)]
    assert {r.sea_level_pressure for r in clean_weather(weather(spark, rows)).collect()} == {None}


def test_row_without_site_gets_no_median(spark):
    rows = [(None, 0, {"cloud_coverage": None}), (None, 1, {"cloud_coverage": 4.0}), (None, 2, {"cloud_coverage": None})]
    got = clean_weather(weather(spark, rows)).orderBy("timestamp").collect()
    assert [r.cloud_coverage for r in got] == [None, 4.0, 4.0]


def test_forward_fill_matches_plain_window(spark):
    """One site holds most rows; gaps span days; times without ties, one of them null."""
    pick = random.Random(3)
    hours = pick.sample(range(24 * 60), 900)
    rows = [(1 if pick.random() < 0.7 else pick.choice([2, 3, None]), h,
             {"cloud_coverage": pick.choice([None, None, None, float(h)])}) for h in hours]
    df = weather(spark, rows)
    no_time = weather(spark, [(1, 0, {"cloud_coverage": -5.0})]).withColumn("timestamp", F.lit(None).cast("timestamp"))
    df = df.unionByName(no_time)
    past = Window.partitionBy("site_id").orderBy("timestamp").rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("plain", F.last("cloud_coverage", ignorenulls=True).over(past))
    got = forward_fill(df, "site_id", "timestamp", ["cloud_coverage"]).collect()
    assert len(got) == 901 and all(r.cloud_coverage == r.plain for r in got)


def test_forward_fill_with_copies_of_one_time(spark):
    rows = [(1, 0, {"cloud_coverage": 2.0})] + [(1, 1, {"cloud_coverage": v}) for v in (None, 3.0, 5.0, None)]
    rows += [(1, 30, {"cloud_coverage": None})]
    got = forward_fill(weather(spark, rows), "site_id", "timestamp", ["cloud_coverage"])
    assert sorted((r.timestamp.hour, r.cloud_coverage) for r in got.collect()) == [
        (0, 2.0), (1, 3.0), (1, 5.0), (1, 5.0), (1, 5.0), (6, 5.0)]
