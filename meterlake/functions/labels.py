"""Code-to-label rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Meter codes with their labels and units.
METER_TYPES = [
    (0, "Electricity", "kWh"),
    (1, "Chilled Water", "kBTU"),
    (2, "Steam", "kBTU"),
    (3, "Hot Water", "kBTU"),
]
# Upper bounds (exclusive, degrees Celsius) of the temperature bands.
TEMPERATURE_BANDS = [(0, "Freezing"), (10, "Cold"), (20, "Mild"), (30, "Warm")]
HOTTEST_BAND = "Hot"
# Last hour (inclusive) of each part of the day, and office hours.
DAY_PERIODS = [(5, "Night"), (11, "Morning"), (17, "Afternoon"), (23, "Evening")]
BUSINESS_HOURS = (9, 17)


def _banded(bands: list[tuple[int, str]], below, last: str | None) -> Column:
    column = None
    for bound, label in bands:
        test = below(bound)
        column = F.when(test, label) if column is None else column.when(test, label)
    return column.otherwise(last)


def meter_label(code: Column) -> Column:
    """Label of a meter code; null for a code outside the catalogue."""
    entries = [F.lit(v) for key, label, _ in METER_TYPES for v in (key, label)]
    return F.create_map(*entries)[code]


def temperature_band(celsius: Column) -> Column:
    """Band of a temperature. A missing temperature lands in the hottest band."""
    return _banded(TEMPERATURE_BANDS, lambda bound: celsius < bound, HOTTEST_BAND)


def day_period(hour: Column) -> Column:
    return F.when(hour >= 0, _banded(DAY_PERIODS, lambda bound: hour <= bound, None))


def is_business_hour(hour: Column) -> Column:
    return hour.between(*BUSINESS_HOURS)


def site_name(site_id: Column) -> Column:
    return F.concat(F.lit("Site_"), F.lpad(site_id.cast("string"), 2, "0"))
