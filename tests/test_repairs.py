"""Inputs that once lost rows, gave a value that could not be repeated, or stopped a run."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from meterlake.functions.numeric import exact_mean, exact_sum
from meterlake.operators.dedupe import one_per_key
from meterlake.operators.fill import fill_gaps, fill_with_medians, forward_fill, group_medians
from meterlake.operators.ranking import rank_values
from meterlake.operators.rolling import rolling_mean
from meterlake.plans import lakehouse
from meterlake.queries.landing import SCHEMAS
from meterlake.sinks.snapshots import read_snapshot
from meterlake.sources.streams import csv_stream, table_stream
from meterlake.streaming.bronze import ingest_csv, read_bronze
from meterlake.streaming.runners import stream_append


def test_columns_only_grow(spark, tmp_path):
    land, base = tmp_path / "land", str(tmp_path)
    land.mkdir()
    batches = ["id,extra\n1,7", "id\n2", "id,other\n3,8", "id\n4"]
    for number, text in enumerate(batches):
        (land / f"{number}.csv").write_text(text)
        ingest_csv(spark, str(land), f"{base}/t", f"{base}/store", f"{base}/cp", "run")
    rows = read_bronze(spark, f"{base}/t", f"{base}/store").collect()
    assert sorted((r.id, r.extra, r.other) for r in rows) == [(1, 7, None), (2, None, None), (3, None, 8), (4, None, None)]


def test_streams_take_old_files(spark, tmp_path):
    import os
    import time

    land = tmp_path / "land"
    land.mkdir()
    old = time.time() - 30 * 86_400
    for number in range(2):
        (land / f"{number}.csv").write_text(f"id\n{number}")
        if number:
            os.utime(land / f"{number}.csv", (old, old))
        stream_append(csv_stream(spark, str(land), "id int"), f"{tmp_path}/out", f"{tmp_path}/cp")
    table = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(r.id for r in table.collect()) == [0, 1]
    for part in (tmp_path / "out").glob("*.parquet"):
        os.utime(part, (old, old))
    stream = table_stream(spark, f"{tmp_path}/out", table.schema)
    stream_append(stream, f"{tmp_path}/copy", f"{tmp_path}/cp2")
    assert spark.read.parquet(f"{tmp_path}/copy").count() == 2


@pytest.mark.parametrize("parts", [1, 3, 7, 13])
def test_median_is_exact_however_rows_are_spread(spark, parts):
    values = [random.Random(1).gauss(0, 1e6) for _ in range(1)] + [((i * 7919) % 30011) / 8 for i in range(30_010)]
    rows = [("a", v) for v in values] + [("b", 1.0), ("b", 2.0), ("b", float("nan")), ("c", None), ("d", -1e308), ("d", 1e308)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(parts)
    got = {r.k: r.med_v for r in group_medians(df, "k", ["v"]).collect()}
    ordered = sorted(values)
    assert got == {"a": ordered[(len(ordered) - 1) // 2], "b": 2.0, "c": None, "d": -1e308}


def test_filling_in_one_go_equals_two_steps(spark):
    r = random.Random(2)
    rows = [(r.choice([1, 2, None]), dt.datetime(2024, 1, r.randint(1, 3), r.randint(0, 5)), r.choice([None, None, 1.0, 2.0, 5.0]))
            for _ in range(300)]
    rows += [(9, dt.datetime(2024, 1, 1), None)]
    df = spark.createDataFrame(rows, "k int, t timestamp, v double")
    two = fill_with_medians(forward_fill(df, "k", "t", ["v"]), "k", ["v"])
    one = fill_gaps(df, "k", "t", ["v"])
    key = lambda x: tuple((v is None, v) for v in x)
    assert sorted(map(tuple, one.select("k", "t", "v").collect()), key=key) == sorted(
        map(tuple, two.select("k", "t", "v").collect()), key=key
    )


@pytest.mark.parametrize("big", [1e27, -1e27, 1e308])
def test_values_too_large_for_a_decimal(spark, big):
    df = spark.createDataFrame([(1, 1.25), (1, big), (2, 1.0), (2, 2.0)], "k int, v double")
    got = {r.k: (r.s, r.m) for r in df.groupBy("k").agg(exact_sum(F.col("v")).alias("s"), exact_mean(F.col("v")).alias("m")).collect()}
    assert got == {1: (big + 1.25, (big + 1.25) / 2), 2: (3.0, 1.5)}
    times = spark.createDataFrame([(1, dt.datetime(2024, 1, d), v) for d, v in ((1, 1.0), (2, big), (20, 3.0))],
                                  "k int, t timestamp, v double")
    rolled = rolling_mean(times, ["k"], "t", "v", "m", 7 * 86_400).orderBy("t").collect()
    assert [r.m for r in rolled] == [1.0, (1.0 + big) / 2, 3.0]


def test_ranks_of_values_with_one_beginning(spark):
    values = [f"https://example.org/{i:05d}" for i in range(3000)]
    df = spark.createDataFrame([(v,) for v in values + values[:100] + [None]], "v string").repartition(5)
    got = {r.v: r.n for r in rank_values(df, "v", "n").collect()}
    assert got == {v: i + 1 for i, v in enumerate(values)}
    assert rank_values(df.limit(0), "v", "n").count() == 0


def test_duplicates_are_found_without_sort_aggregates(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (None, "d")], "k int, v string")
    once = one_per_key(df, ["k"])
    assert sorted(r.v for r in once.collect()) == ["a", "b", "c", "d"]
    assert "SortAggregate" not in once._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(Exception, match="duplicate k"):
        one_per_key(df.union(df.limit(1)), ["k"]).collect()


def lake(tmp_path, **settings):
    for feed, text in {
        "meter_readings": "building_id,meter,timestamp,meter_reading\n1,0,2026-01-05 01:00:00,5\n1,0,2026-01-06 01:00:00,6\n",
        "weather_readings": "site_id,timestamp,air_temperature,cloud_coverage,dew_temperature,precip_depth_1_hr,"
        "sea_level_pressure,wind_direction,wind_speed\n0,2026-01-05 01:00:00,20,1,1,1,1,1,1\n",
        "building_metadata": "site_id,building_id,primary_use,square_feet,year_built,floor_count\n0,1,Office,10,2000,2\n",
    }.items():
        folder = tmp_path / "landing" / feed
        folder.mkdir(parents=True, exist_ok=True)
        (folder / "1.csv").write_text(text)
    return lakehouse.LakeConfig(
        base=str(tmp_path), run_id="r", as_of=dt.date(2026, 1, 1), ingested_at=dt.datetime(2026, 2, 1),
        schemas={feed: SCHEMAS[feed] for feed in ("weather_readings", "building_metadata")}, **settings,
    )


def test_the_calendar_grows_with_the_configuration(spark, tmp_path):
    first = lake(tmp_path)
    lakehouse.run_lakehouse(spark, first)
    assert read_snapshot(spark, first.table("dim_date")).count() == 5844
    lakehouse.run_dimensions(spark, lake(tmp_path, last_day=dt.date(2026, 12, 31)))
    calendar = read_snapshot(spark, first.table("dim_date"))
    assert calendar.count() == 5844 + 365
    lakehouse.run_dimensions(spark, first)
    assert read_snapshot(spark, first.table("dim_date")).count() == 5844 + 365


def test_keys_don_t_depend_on_the_session_zone(spark, tmp_path):
    keys = []
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            cfg = lake(tmp_path / zone.replace("/", "_"), last_day=dt.date(2026, 12, 31))
            lakehouse.run_lakehouse(spark, cfg)
            fact = spark.read.parquet(cfg.table("fact_meter_readings"))
            keys.append(sorted((r.reading_key, r.date_key) for r in fact.collect()))
            daily = spark.read.parquet(cfg.table("fact_daily_building_summary"))
            assert daily.select("building_date_key").distinct().count() == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert keys[0] == keys[1] and all(date is not None for _, date in keys[0])
