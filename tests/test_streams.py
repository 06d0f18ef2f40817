"""Results do not depend on how the input was cut, and repeating work changes nothing."""

import datetime as dt
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from meterlake.operators.enrich import enrich_readings
from meterlake.operators.readings import detect_spikes, transform_readings
from meterlake.operators.scd2 import open_versions
from meterlake.operators.weather import clean_weather
from meterlake.plans import dims, lakehouse, quality
from meterlake.plans.facts import fact_daily_summary, fact_meter_readings
from meterlake.plans.lakehouse import BUILDING, METER, WEATHER
from meterlake.queries.landing import SCHEMAS, new_lake, write_landing
from meterlake.sinks import files
from meterlake.sinks.snapshots import read_snapshot
from meterlake.queries import registry
from meterlake.streaming import bronze, silver, weather
from meterlake.streaming.silver import on_dates, stored_table

START = dt.datetime(2024, 1, 1)


def feeds(spark):
    pick = random.Random(11)
    readings = [(n, pick.choice([1, 1, 2, 9]), n % 5, START + dt.timedelta(hours=n // 2, minutes=n % 2),
                 pick.choice([0.0, None, round(pick.expovariate(0.05), 2)])) for n in range(400)]
    weather = [(1, START + dt.timedelta(hours=h), float(h % 40), pick.choice([None, 1.0, 4.0]), 1.0,
                pick.choice([None, -1.0]), None if h < 100 else 1000.0 + h % 7, 90.0, 2.0) for h in range(200)]
    buildings = [(1, 1, "Office", 10, 2000, 2), (2, 1, "School", 0, None, None)]
    return {
        METER: spark.createDataFrame(readings, SCHEMAS[METER]),
        WEATHER: spark.createDataFrame(weather, SCHEMAS[WEATHER]),
        BUILDING: spark.createDataFrame(buildings, SCHEMAS[BUILDING]),
    }


def gold(spark, lake):
    drop = ["batch_id", "source_file_name"]
    fact = stored_table(spark, lake.table("fact_meter_readings")).drop(*drop)
    daily = stored_table(spark, lake.table("fact_daily_building_summary"))
    return bag(fact), bag(daily)


def bag(df):
    columns = sorted(df.columns)
    values = [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*columns).collect()]
    return sorted(values, key=str)


@pytest.fixture(scope="module")
def batch_result(spark):
    """The same tables computed in one go from the pure functions."""
    data = feeds(spark)
    readings = data[METER].withColumn("source_file_name", F.lit("f"))
    versions = open_versions(data[BUILDING], dt.date(2024, 1, 1))
    enriched = enrich_readings(detect_spikes(transform_readings(readings)), versions, clean_weather(data[WEATHER]))
    building = dims.dim_building(versions)
    fact = fact_meter_readings(enriched, dims.dim_date(spark), building, dims.dim_site(enriched),
                               dims.dim_meter_type(spark), dims.dim_time_of_day(spark), "run")
    return bag(fact.drop("batch_id", "source_file_name")), bag(fact_daily_summary(fact, building))


@pytest.mark.parametrize("splits", [1, 2, 5])
def test_batch_split_invariance(spark, batch_result, splits):
    """Each run delivers part of the readings and weather, the later part of time not always last."""
    lake, data = new_lake(spark), feeds(spark)
    write_landing(data[BUILDING], lake.landing(BUILDING))
    for n in reversed(range(splits)):
        mine = F.pmod(F.hash("timestamp"), F.lit(splits)) == n
        for feed in (METER, WEATHER):
            write_landing(data[feed].filter(mine), lake.landing(feed), parts=2)
        lakehouse.run_lakehouse(spark, lake)
    fact, daily = gold(spark, lake)
    assert daily == batch_result[1]
    assert fact == batch_result[0]


def test_replay_and_redelivery_change_nothing(spark, batch_result):
    lake, data = new_lake(spark, max_files=1, max_table_files=3), feeds(spark)
    for feed in (BUILDING, METER, WEATHER):
        write_landing(data[feed], lake.landing(feed), parts=1)
    lakehouse.run_lakehouse(spark, lake)
    assert gold(spark, lake) == batch_result
    lakehouse.run_lakehouse(spark, lake)
    assert gold(spark, lake) == batch_result
    later = replace(lake, ingested_at=lake.ingested_at + dt.timedelta(days=1), run_id="again")
    for feed in (METER, WEATHER):
        write_landing(data[feed], later.landing(feed), parts=1)
    lakehouse.run_lakehouse(spark, later)
    assert gold(spark, later) == batch_result


def report_by_scan(spark, lake):
    """The report's numbers of the dated tables, from the tables themselves."""
    out = {}
    for name, flags in lakehouse.FLAGS.items():
        df = stored_table(spark, lake.table(name))
        out[name, "total"] = df.count()
        for flag in ("zero_readings", "spikes", "unknown_buildings", "null_building_key", "null_date_key"):
            if flag in flags and name != quality.DAILY:
                out[name, flag] = df.filter(flags[flag]).count()
    return out


def test_counters_and_kept_checks_equal_the_tables(spark):
    """Two runs, so that most dates are replaced; then the report and the checks without a scan."""
    lake, data = new_lake(spark), feeds(spark)
    write_landing(data[BUILDING], lake.landing(BUILDING))
    for n in (1, 0):
        for feed in (METER, WEATHER):
            write_landing(data[feed].filter(F.pmod(F.hash("timestamp"), F.lit(2)) == n), lake.landing(feed), parts=1)
        lakehouse.run_lakehouse(spark, lake)
    report = lakehouse.lake_report(spark, lake)
    assert report._jdf.queryExecution().executedPlan().toString().startswith(("LocalTableScan", "*(1) Scan ExistingRDD", "Scan ExistingRDD"))
    got = {(r.table_name, r.metric): r.rows for r in report.collect()}
    want = report_by_scan(spark, lake)
    assert {k: got[k] for k in want} == want
    assert got["bronze_meter_readings", "total"] == 400 and got["bronze_meter_readings", "ingestion_dates"] == 1
    daily = stored_table(spark, lake.table(quality.DAILY)).agg(F.round(F.avg("data_completeness_pct"))).first()[0]
    assert got[quality.DAILY, "mean_completeness_pct"] == daily

    facts = [stored_table(spark, lake.table(name)) for name in (quality.FACT, quality.DAILY)]
    names = ("dim_date", "dim_building", "dim_site", "dim_meter_type", "dim_time_of_day")
    fresh = quality.gold_checks(*facts, *[read_snapshot(spark, lake.table(n)) for n in names])
    want = {r.check_name: (r.note, r.bad_rows == 0) for r in fresh.collect()}
    log = spark.read.parquet(lake.table("gold_quality_log")).collect()
    assert len(want) == 22 and len(log) == 44
    # Each run logged all checks; the last run's are those of the tables as they are.
    logged = [(r.check_name, r.details, r.passed) for r in log]
    assert all((name, *result) in logged for name, result in want.items())
    journal = lakehouse.batch_journal(spark, lake).collect()
    assert len({(r.stream, r.batch_id) for r in journal}) == len(journal) and all(r.seconds > 0 for r in journal)
    assert sum(r.rows for r in journal if r.stream == "bronze_meter_readings") == 400


def observed(hour, **values):
    row = {"cloud_coverage": 5.0, "precip_depth_1_hr": 1.0, "sea_level_pressure": 1000.0} | values
    return (1, START + dt.timedelta(hours=hour), 1.0, row["cloud_coverage"], 1.0, row["precip_depth_1_hr"],
            row["sea_level_pressure"], 90.0, 2.0)


class Weather:
    """Weather taken in and cleaned batch by batch, without the other layers."""

    def __init__(self, spark):
        self.spark, self.lake, self.rows = spark, new_lake(spark), []

    def take(self, *rows):
        spark, lake = self.spark, self.lake
        self.rows += rows
        write_landing(spark.createDataFrame(rows, SCHEMAS[WEATHER]), lake.landing(WEATHER), parts=1)
        places = [lake.table(f"bronze_{WEATHER}"), lake.store(WEATHER)]
        bronze.ingest_csv(spark, lake.landing(WEATHER), *places, lake.checkpoint("b"), "run",
                          schema=SCHEMAS[WEATHER], ingested_at=lake.ingested_at)
        before = self.files()
        weather.silver_weather(spark, *places, lake.table("w"), lake.checkpoint("w"))
        return sorted(int(day[-2:]) for day, names in self.files().items() if names != before.get(day))

    def files(self):
        days = [n for n in files.names(self.spark, self.lake.table("w")) if n.startswith("weather_date=")]
        return {day: files.names(self.spark, f"{self.lake.table('w')}/{day}") for day in days}

    def check(self):
        latest = {(r[0], r[1]): r for r in self.rows}.values()
        want = clean_weather(self.spark.createDataFrame(list(latest), SCHEMAS[WEATHER]))
        got = stored_table(self.spark, self.lake.table("w"))
        assert bag(got.select(*want.columns)) == bag(want)


def test_a_late_value_restates_days_up_to_that_of_the_next_known_one(spark):
    feed = Weather(spark)
    gap = {"cloud_coverage": None}
    assert feed.take(*[observed(24 * d + h, **(gap if 2 <= d <= 6 else {})) for d in range(10) for h in (0, 12)]) == list(range(1, 11))
    feed.check()
    # Day 4 gets a cloud value: days 5 to 7 take it over, and day 8 until its own. The median stays.
    assert feed.take(observed(24 * 3 + 6, cloud_coverage=7.0)) == [4, 5, 6, 7, 8]
    feed.check()
    # The next day reaches back to nothing; the same again changes only its own day's files.
    assert feed.take(observed(24 * 10, sea_level_pressure=None)) == [11]
    assert feed.take(observed(24 * 10, sea_level_pressure=None)) == [11]
    feed.check()


def test_a_moved_median_restates_the_days_it_fills(spark):
    feed = Weather(spark)
    unknown = {"sea_level_pressure": None}
    first = [observed(24 * d, **(unknown if d < 3 else {"sea_level_pressure": 1000.0 + d})) for d in range(8)]
    feed.take(*first)
    feed.check()
    # High values on the last day move the median, which fills the first three days, and the fourth
    # until its own value.
    assert feed.take(*[observed(24 * 7 + h, sea_level_pressure=1100.0) for h in (1, 2, 3, 4, 5)]) == [1, 2, 3, 4, 8]
    feed.check()
    # A correction to null takes a value away again.
    assert 4 in feed.take(observed(24 * 3, **unknown))
    feed.check()


def test_a_batch_repeated_after_any_step_counts_once(spark, monkeypatch):
    feed = Weather(spark)
    feed.take(*[observed(24 * d + h, **({"precip_depth_1_hr": None} if h else {})) for d in range(4) for h in (0, 9)])
    steps = ["overwrite_partitions", "publish", "replace_dates"]
    for n, step in enumerate(steps):
        whole = getattr(weather, step)

        def broken(*args, whole=whole, **more):
            whole(*args, **more)
            raise RuntimeError("lost")

        rows = [observed(24 * n + 3, precip_depth_1_hr=10.0 + n), observed(24 * n + 9, precip_depth_1_hr=None)]
        monkeypatch.setattr(weather, step, broken)
        with pytest.raises(Exception, match="lost"):
            feed.take(*rows)
        monkeypatch.setattr(weather, step, whole)
        feed.take(observed(24 * 5 + n))
        feed.check()


def test_dates_half_replaced_are_repaired_from_the_staged_rows(spark, monkeypatch):
    """Restated dates are written once, straight from the staged rows, and a batch that is lost
    between two dates is repeated with the same rows."""
    lake, data = new_lake(spark), feeds(spark)
    target, whole = lake.table("silver_readings"), silver.overwrite_partitions

    def take(rows):
        write_landing(rows, lake.landing(METER))
        repeat()

    def repeat():
        bronze.ingest_csv(spark, lake.landing(METER), lake.table(f"bronze_{METER}"), lake.store(METER),
                          lake.checkpoint("bronze"), lake.run_id, SCHEMAS[METER], lake.ingested_at)
        silver.silver_readings(spark, lake.table(f"bronze_{METER}"), lake.store(METER), target,
                               lake.checkpoint("silver_readings"))

    def broken(result, path, column, **more):
        whole(result.filter(on_dates(column, [START.date()])), path, column, **more)
        assert files.names(spark, f"{lake.checkpoint('silver_readings')}/stage/1") == ["rows"]
        raise RuntimeError("lost")

    take(data[METER].filter("meter < 2"))
    monkeypatch.setattr(silver, "overwrite_partitions", broken)
    with pytest.raises(Exception, match="lost"):
        take(data[METER].filter("meter >= 2"))
    monkeypatch.setattr(silver, "overwrite_partitions", whole)
    repeat()
    wanted = detect_spikes(transform_readings(data[METER]))
    assert bag(stored_table(spark, target).select(*wanted.columns)) == bag(wanted)


def test_readings_land_in_as_many_files_as_they_have_partitions(spark, monkeypatch, tmp_path):
    """The daily stream leaves it to Spark how many tasks write what it lands."""
    class Landed(Exception):
        pass

    def stop(*_):
        raise Landed

    events = [(n, START, n, "view", 1.0) for n in range(9)]
    customers = [(n, n % 3, "BUILDING") for n in range(9)]
    for name, rows, schema in (
        ("events", events, "event_id long, ts timestamp, user_id long, event_type string, value double"),
        ("customer", customers, "c_custkey long, c_nationkey int, c_mktsegment string"),
    ):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    landed = []
    monkeypatch.setattr(registry, "write_landing", lambda rows, path, parts=None: landed.append((path, parts)))
    monkeypatch.setattr(registry.lakehouse, "run_bronze", stop)
    with pytest.raises(Landed):
        registry.QUERIES["stream_daily"](spark, str(tmp_path))
    assert [path.rsplit("/", 1)[1] for path, _ in landed][-1] == METER and {parts for _, parts in landed} == {None}


def test_correction_and_building_change(spark):
    lake, data = new_lake(spark), feeds(spark)
    for feed in (BUILDING, METER, WEATHER):
        write_landing(data[feed], lake.landing(feed), parts=1)
    lakehouse.run_lakehouse(spark, lake)
    later = replace(lake, as_of=dt.date(2024, 6, 1), ingested_at=lake.ingested_at + dt.timedelta(days=1))
    change = spark.createDataFrame([(1, 1, "Lab", 10, 2000, 2)], SCHEMAS[BUILDING])
    write_landing(change, later.landing(BUILDING))
    first = data[METER].filter("building_id = 1 AND meter_reading IS NOT NULL").orderBy("timestamp").limit(1)
    write_landing(first.withColumn("meter_reading", F.lit(777.0)), later.landing(METER))
    before = stored_table(spark, lake.table("fact_meter_readings")).count()
    lakehouse.run_lakehouse(spark, later)

    fact = stored_table(spark, later.table("fact_meter_readings"))
    assert fact.count() == before and fact.filter("meter_reading = 777").count() == 1
    building = read_snapshot(spark, later.table("dim_building"))
    keys = {(r.primary_use, r.is_current): r.building_key for r in building.filter("building_id = 1").collect()}
    assert set(keys) == {("Office", False), ("Lab", True)}
    dates = {r.reading_date for r in fact.filter(F.col("building_key") == keys[("Lab", True)]).collect()}
    corrected = first.select(F.to_date("timestamp")).first()[0]
    assert min(dates) == corrected and max(dates) <= corrected + dt.timedelta(days=7)
    logs = spark.read.parquet(later.table("gold_quality_log"))
    assert logs.count() == 44
    assert logs.filter("check_name = 'dim_building_no_dup_current' AND passed").count() == 2


def test_fail_fast_stops_the_run(spark):
    lake, data = new_lake(spark, fail_fast=True), feeds(spark)
    for feed in (BUILDING, METER, WEATHER):
        write_landing(data[feed], lake.landing(feed), parts=1)
    with pytest.raises(RuntimeError, match="meter_reading_notnull"):
        lakehouse.run_lakehouse(spark, lake)
