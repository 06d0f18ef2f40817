"""Plans hold up when one key has a large share of the rows."""

import pytest
from pyspark.sql import functions as F

from meterlake.operators.enrich import with_building
from meterlake.operators.readings import detect_spikes, transform_readings
from meterlake.operators.scd2 import OPEN_END, open_versions
from meterlake.plans.facts import fact_daily_summary
from meterlake.streaming.silver import grow_table_schema, stored_dates
from meterlake.sinks.tables import append

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture
def tiny_thresholds(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def hot_readings(spark, path, same_time):
    """A third of the rows belong to building 1; with ``same_time`` they also share one second."""
    hot = F.col("id") % 3 == 0
    second = F.when(hot & F.lit(same_time), F.lit(0)).otherwise(F.col("id") * 60)
    rows = spark.range(0, 60_000, 1, 8).select(
        F.when(hot, 1).otherwise((F.col("id") % 997).cast("int")).alias("building_id"),
        F.when(hot, 0).otherwise((F.col("id") % 4).cast("int")).alias("meter"),
        F.timestamp_seconds(second).alias("timestamp"),
        F.round(F.rand(5) * 100, 2).alias("meter_reading"),
    )
    rows.write.parquet(path)
    return spark.read.parquet(path)


def test_copies_of_one_time_are_split_when_joined_back(tiny_thresholds, tmp_path):
    df = transform_readings(hot_readings(tiny_thresholds, str(tmp_path / "r"), True))
    assert "skew=true" in plan(detect_spikes(df))


def test_hot_building_is_split(tiny_thresholds, tmp_path):
    spark = tiny_thresholds
    buildings = spark.range(0, 2000).select(
        F.col("id").cast("int").alias("building_id"), F.lit(1).alias("site_id"), F.lit("Office").alias("primary_use"),
        F.lit(10).alias("square_feet"), F.lit(2000).alias("year_built"), F.lit(2).alias("floor_count"))
    versions = open_versions(buildings, OPEN_END)
    df = with_building(transform_readings(hot_readings(spark, str(tmp_path / "r"), False)), versions)
    assert "skew=true" in plan(df)


def test_daily_totals_are_combined_before_the_shuffle(spark):
    fact = spark.range(100).select(
        F.lit(20240101).alias("date_key"), F.lit("k").alias("building_key"), F.lit(1).alias("site_key"),
        F.to_date(F.lit("2024-01-01")).alias("reading_date"), (F.col("id") % 4).cast("int").alias("meter_type_key"),
        F.lit(1.0).alias("meter_reading"), F.lit(5.0).alias("air_temperature"),
        (F.col("id") % 24).cast("int").alias("time_of_day_key"), F.lit(False).alias("is_zero_reading"),
        F.lit(False).alias("is_spike"))
    building = spark.range(1).select(F.lit("k").alias("building_key"), F.lit(10).alias("square_feet"), F.lit(True).alias("is_current"))
    text = plan(fact_daily_summary(fact, building)).split("Initial Plan")[0]
    assert "partial_bit_or" in text and "Expand" not in text and text.count("Exchange hashpartitioning") == 1


def test_only_wanted_dates_are_listed(spark, tmp_path):
    path = str(tmp_path / "t")
    days = spark.range(30).select("id", F.date_add(F.to_date(F.lit("2024-01-01")), F.col("id").cast("int")).alias("d"))
    days = days.withColumn("d", F.when(F.col("id") < 29, F.col("d")))
    grow_table_schema(spark, path, days.schema)
    append(days, path, "d")
    wanted = [row.d for row in days.filter("id IN (3, 4, 29)").collect()]
    got = stored_dates(spark, path, "d", [*wanted, None])
    assert sorted(row.id for row in got.collect()) == [3, 4, 29]
    assert len(got.inputFiles()) == 3
    assert stored_dates(spark, path, "d", []).count() == 0
