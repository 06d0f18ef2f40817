import datetime as dt
import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from meterlake.operators.readings import detect_spikes, transform_readings
from meterlake.operators.rolling import rolling_mean

RAW = "building_id string, meter string, timestamp string, meter_reading string, _rescued_data string"
WEEK = 604_800


def one(spark, **values):
    row = {"building_id": "1", "meter": "0", "timestamp": "2024-01-06 13:00:00", "meter_reading": "5",
           "_rescued_data": None, **values}
    return transform_readings(spark.createDataFrame([row], RAW)).first()


def test_types_calendar_and_label(spark):
    row = one(spark)
    assert (row.building_id, row.meter, row.meter_reading) == (1, 0, 5.0)
    assert row.reading_date == dt.date(2024, 1, 6) and row.reading_hour == 13
    assert (row.reading_day_of_week, row.is_weekend, row.reading_month) == (7, True, 1)
    assert row.meter_label == "Electricity" and "_rescued_data" not in row
    assert one(spark, meter="4").meter_label is None


def test_zero_flag_follows_rounding(spark):
    row = one(spark, meter_reading="0.004")
    assert row.meter_reading == 0.0 and row.is_zero_reading is True
    assert one(spark, meter_reading=None).is_zero_reading is None


def test_bad_text_raises_or_becomes_null(spark):
    bad = spark.createDataFrame([("x", "0", "not a time", "n/a", None)], RAW)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CANNOT_PARSE"):
        transform_readings(bad).collect()
    row = transform_readings(bad, strict=False).first()
    assert (row.building_id, row.timestamp, row.meter_reading) == (None, None, None)


def readings(spark, rows):
    frame = spark.createDataFrame(rows, "building_id int, meter int, second long, meter_reading double")
    return frame.withColumn("timestamp", F.timestamp_seconds("second"))


def spikes(spark, rows):
    return {(r.second, r.meter_reading): r for r in detect_spikes(readings(spark, rows)).collect()}


def test_window_edges_and_peers(spark):
    end = 10 * WEEK
    at_edge = spikes(spark, [(1, 0, end, 1.0), (1, 0, end - WEEK, 3.0), (1, 0, end - WEEK - 1, 100.0)])
    assert at_edge[(end, 1.0)].rolling_avg_7d == 2.0
    peers = spikes(spark, [(1, 0, end, 1.0), (1, 0, end, 3.0)])
    assert {r.rolling_avg_7d for r in peers.values()} == {2.0}


@pytest.mark.parametrize("zeros, spike", [(4, False), (5, True)])
def test_short_window_cannot_spike(spark, zeros, spike):
    rows = [(1, 0, i, 0.0) for i in range(zeros)] + [(1, 0, zeros, 100.0)]
    assert spikes(spark, rows)[(zeros, 100.0)].is_spike is spike


def test_null_reading_has_null_flag(spark):
    assert spikes(spark, [(1, 0, 5, None)])[(5, None)].is_spike is None


def plain_window(df):
    frame = (
        Window.partitionBy("building_id", "meter")
        .orderBy(F.col("timestamp").cast("long"))
        .rangeBetween(-WEEK, 0)
    )
    return df.withColumn("plain", F.avg("meter_reading").over(frame))


def same(a, b):
    if a is None or b is None:
        return a is b
    return (math.isnan(a) and math.isnan(b)) or a == b or math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12)


def test_matches_plain_window_on_skewed_data(spark):
    """A third of the rows share one key, many share one second; keys, times and values may be null."""
    pick = random.Random(7)
    rows = [(None, 1, 10, 2.0), (None, 1, 20, 4.0), (1, None, 10, 6.0), (1, 1, None, 8.0), (1, 1, None, 2.0)]
    for _ in range(3000):
        hot = pick.random() < 0.33
        key = (1, 0) if hot else (pick.randrange(5), pick.randrange(3))
        second = 12345 if hot and pick.random() < 0.5 else pick.randrange(40 * 86_400) - 10 * 86_400
        rows.append((*key, second, None if pick.random() < 0.05 else round(pick.expovariate(0.02), 2)))
    df = plain_window(readings(spark, rows))
    got = rolling_mean(df, ["building_id", "meter"], "timestamp", "meter_reading", "mean", WEEK).collect()
    assert len(got) == len(rows)
    assert all(same(r.mean, r.plain) for r in got)


def test_special_values_match_plain_window(spark):
    special = [float("nan"), float("inf"), float("-inf")]
    rows = [(b, 0, day * 86_400, v) for b, (day0, v0) in enumerate([(3, s) for s in special])
            for day, v in [*((d, 1.0) for d in range(30) if d != day0), (day0, v0)]]
    rows += [(9, 0, 86_400, float("inf")), (9, 0, 2 * 86_400, float("-inf")), (9, 0, None, float("nan"))]
    df = plain_window(readings(spark, rows))
    got = rolling_mean(df, ["building_id", "meter"], "timestamp", "meter_reading", "mean", WEEK).collect()
    assert all(same(r.mean, r.plain) for r in got)


def test_no_task_gets_a_whole_hot_key(spark):
    """The window of the plan is keyed by chunk as well, on sums per second."""
    rows = [(1, 0, s * 3600, 1.0) for s in range(24 * 365)]
    df = rolling_mean(readings(spark, rows), ["building_id", "meter"], "timestamp", "meter_reading", "m", WEEK)
    plan = df._jdf.queryExecution().executedPlan().toString()
    window = next(line for line in plan.splitlines() if "Window [" in line)
    assert "chunk" in window
    assert sum("partial_sum" in line for line in plan.splitlines()) == 1
