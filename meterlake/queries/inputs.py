"""Tables of each layer built from the given tables, shared by the registered queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from meterlake.operators.audit import add_audit_columns
from meterlake.operators.enrich import enrich_readings
from meterlake.operators.readings import detect_spikes, transform_readings
from meterlake.operators.scd2 import open_versions, scd2_apply
from meterlake.operators.weather import clean_weather
from meterlake.plans import dims
from meterlake.plans.facts import fact_daily_summary, fact_meter_readings
from meterlake.queries.oracle import FIRST_LOAD, RUN_ID, SECOND_LOAD
from meterlake.session import configure, materialize
from meterlake.sources.fixtures import fixture

FIRST, SECOND = dt.date.fromisoformat(FIRST_LOAD), dt.date.fromisoformat(SECOND_LOAD)
INGESTED_AT = dt.datetime(2024, 2, 1, 6)


class Layers:
    """Lazy plans over one data folder. Only ``enriched`` and the facts are ever written out."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir

    def raw(self, name: str) -> DataFrame:
        return fixture(self.spark, self.sf_dir, name)

    def bronze_readings(self) -> DataFrame:
        feed = self.raw("readings").withColumn("feed", F.lit("events"))
        return add_audit_columns(feed, RUN_ID, "feed", INGESTED_AT).drop("feed")

    def readings(self) -> DataFrame:
        return transform_readings(self.raw("readings"))

    def spikes(self) -> DataFrame:
        return detect_spikes(self.readings())

    def weather(self) -> DataFrame:
        return clean_weather(self.raw("weather"))

    def versions(self) -> DataFrame:
        return open_versions(self.raw("buildings"), FIRST)

    def history(self, null_safe: bool = False) -> DataFrame:
        """Building versions after the second load."""
        changes = self.raw("changes")
        return scd2_apply(self.versions(), changes, "building_id", "primary_use", SECOND, null_safe)

    def enriched(self) -> DataFrame:
        silver = detect_spikes(transform_readings(self.bronze_readings()))
        return enrich_readings(silver, self.versions(), self.weather())

    def fact(self, enriched: DataFrame | None = None) -> DataFrame:
        """The hourly fact. The enriched readings are stored first: the site dimension and the
        fact both start from them."""
        stored = materialize(self.enriched(), "enriched") if enriched is None else enriched
        return fact_meter_readings(stored, *self.fact_dims(stored), run_id=RUN_ID)

    def fact_dims(self, enriched: DataFrame) -> list[DataFrame]:
        spark = self.spark
        return [
            dims.dim_date(spark),
            dims.dim_building(self.versions()),
            dims.dim_site(enriched),
            dims.dim_meter_type(spark),
            dims.dim_time_of_day(spark),
        ]

    def daily(self, fact: DataFrame | None = None) -> DataFrame:
        rows = self.fact() if fact is None else fact
        return fact_daily_summary(rows, dims.dim_building(self.versions()))


def portable(df: DataFrame) -> DataFrame:
    """Dates and times as text, so that they compare alike in any engine."""
    kinds = (DateType, TimestampType, TimestampNTZType)
    return df.withColumns(
        {f.name: F.col(f.name).cast("string") for f in df.schema.fields if isinstance(f.dataType, kinds)}
    )
