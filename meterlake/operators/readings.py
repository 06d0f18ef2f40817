"""Cleaning of meter readings and spike detection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.functions.calendar import convert, is_weekend, to_moment
from meterlake.functions.labels import meter_label
from meterlake.operators.rolling import rolling_mean

RESCUED = "_rescued_data"
READING_GRAIN = ["building_id", "meter", "timestamp"]


def transform_readings(df: DataFrame, strict: bool = True) -> DataFrame:
    """Typed readings with calendar columns, meter label and zero flag.

    The zero flag looks at the value after rounding to two decimals, so 0.004 is zero.
    """
    return (
        df.drop(RESCUED)
        .withColumns(
            {
                "timestamp": to_moment(F.col("timestamp"), strict),
                "meter_reading": F.round(convert(F.col("meter_reading"), "double", strict), 2),
                "building_id": convert(F.col("building_id"), "int", strict),
                "meter": convert(F.col("meter"), "int", strict),
            }
        )
        .withColumns(
            {
                "reading_date": F.to_date("timestamp"),
                "reading_hour": F.hour("timestamp"),
                "reading_day_of_week": F.dayofweek("timestamp"),
                "is_weekend": is_weekend(F.col("timestamp")),
                "reading_month": F.month("timestamp"),
                "meter_label": meter_label(F.col("meter")),
                "is_zero_reading": F.col("meter_reading") == 0,
            }
        )
    )


def detect_spikes(df: DataFrame, factor: float = 5, window_days: int = 7) -> DataFrame:
    """Flag readings above ``factor`` times the rolling mean of their building and meter.

    The frame includes the reading itself, hence at least ``factor`` + 1 non-negative rows
    are needed before anything can be flagged.
    """
    rolled = rolling_mean(
        df,
        keys=["building_id", "meter"],
        ts="timestamp",
        value="meter_reading",
        out="rolling_avg_7d",
        seconds=window_days * 86_400,
    )
    reading, mean = F.col("meter_reading"), F.col("rolling_avg_7d")
    return rolled.withColumn("is_spike", (reading > 0) & (mean > 0) & (reading > factor * mean))
