"""Bronze to silver weather: a batch reads its own days and small kept tables, not the history.

Beside the silver table lie
  ``.observed``  standardised observations before any filling, by date,
  ``.closings``  the last known values of each site and day, by month,
  ``.values``    how many filled rows of a site have each value,
  ``.medians``   the medians that follow from these counts.
A late value changes what later days take over up to that of the next known one, which the closing
values tell; it changes the counts by the difference of those days; and only where it moves a median
are the days filled with that median changed too.
"""

from __future__ import annotations

import datetime as dt
import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meterlake.functions.labels import temperature_band
from meterlake.operators import fill
from meterlake.operators.dedupe import latest_by
from meterlake.operators.fill import PLACE
from meterlake.operators.weather import GAP_FILLED, standardise_weather
from meterlake.sinks import files
from meterlake.sinks.counters import Flags
from meterlake.sinks.snapshots import publish, read_snapshot, snapshot_exists
from meterlake.sinks.tables import overwrite_partitions, table_exists
from meterlake.sources.schemas import cast_to, load_schema, widen_schema
from meterlake.streaming.bronze import bronze_stream, read_bronze_batch
from meterlake.streaming.runners import stream_apply
from meterlake.streaming.silver import (
    NEWEST,
    WEATHER_DATE,
    grow_table_schema,
    on_dates,
    replace_dates,
    stored_dates,
    stored_table,
    touched_dates,
)

SITE, TIME, MONTH = "site_id", "timestamp", "month"


def _empty(spark: SparkSession, schema) -> DataFrame:
    return spark.createDataFrame([], schema)


def _stored(df: DataFrame, path: str) -> DataFrame:
    """Written once for the several steps that start from it."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _of_dates(spark: SparkSession, table: str, dates: set, schema: StructType) -> DataFrame:
    """Dates of a kept table under the schema of now; nothing if there is no table yet."""
    if not table_exists(spark, table) or not dates:
        return _empty(spark, schema)
    return cast_to(stored_dates(spark, table, WEATHER_DATE, dates), schema)


def _snapshot(spark: SparkSession, table: str, schema: StructType) -> DataFrame:
    return read_snapshot(spark, table) if snapshot_exists(spark, table) else _empty(spark, schema)


def _dates_of(places: DataFrame) -> set[dt.date | None]:
    """Days of some places: at most one value a calendar day reaches the driver."""
    return {row[0] for row in places.select(f"{PLACE}.day").distinct().collect()}


def _takes_over(carried: DataFrame, prefix: str, columns: list[str]) -> DataFrame:
    """What places take over, before the batch or now, as ``fill_from`` wants it."""
    return carried.select(PLACE, "_key", *[F.col(f"_carry_{prefix}{c}").alias(f"_carry_{c}") for c in columns])


def silver_weather(
    spark: SparkSession,
    bronze: str,
    store: str,
    target: str,
    checkpoint: str,
    strict: bool = True,
    max_files: int | None = None,
    flags: Flags | None = None,
    gap_columns: list[str] | None = None,
) -> None:
    """Clean new observations and restate the days they change, equal to cleaning everything at once.

    The last arrived observation of a site and time counts. What a batch changes in the kept
    tables is first written to a stage. A batch repeated after a failure goes on from a
    complete stage, so the counts never take in a difference twice, and all steps from there
    on replace what they made before.
    """
    gaps = GAP_FILLED if gap_columns is None else gap_columns
    observed, closings, values, medians = (f"{target}.{n}" for n in ("observed", "closings", "values", "medians"))
    grain = [SITE, TIME]

    def days_then_and_now(rows: DataFrame, dates: set) -> DataFrame:
        """Every site and day with the closing values before the batch, now, and whether it is touched."""
        now = fill.closing_values(rows, SITE, TIME, gaps)
        now = now.select(PLACE, *[F.col(c).alias(f"new_{c}") for c in gaps])
        place = F.struct(F.col(SITE).alias("key"), F.col(WEATHER_DATE).alias("day")).alias(PLACE)
        if table_exists(spark, closings):
            known = stored_table(spark, closings).select(place, *[F.col(c).alias(f"old_{c}") for c in gaps])
        else:
            kinds = ", ".join(f"old_{c} double" for c in gaps)
            known = _empty(spark, f"{PLACE} struct<key:int,day:date>, {kinds}")
        restated = on_dates(f"{PLACE}.day", dates)
        kept = [F.when(restated, F.col(f"new_{c}")).otherwise(F.col(f"old_{c}")).alias(f"new_{c}") for c in gaps]
        touched = rows.where("_fresh").select(place).distinct().withColumn("_touched", F.lit(True))
        return (
            known.join(now, PLACE, "full")
            .join(touched, PLACE, "left")
            .select(PLACE, *[f"old_{c}" for c in gaps], *kept, F.coalesce("_touched", F.lit(False)).alias("touched"))
        )

    def counts_then_and_now(carried: DataFrame, before: DataFrame, rows: DataFrame, dates: set) -> DataFrame:
        """The value counts, changed by the days that are filled differently now."""
        changed = carried.where("changed")
        same = _of_dates(spark, observed, _dates_of(changed) - dates, before.schema)
        slim = [SITE, TIME, *gaps]

        def counted(of_dates: DataFrame, prefix: str, sign: int) -> DataFrame:
            place = F.struct(F.col(SITE).alias("key"), F.to_date(TIME).alias("day"))
            every = of_dates.select(slim).unionByName(same.select(slim)).withColumn(PLACE, place)
            own = every.join(changed.select(PLACE), PLACE, "left_semi").drop(PLACE)
            filled = fill.fill_from(own, _takes_over(changed, prefix, gaps), SITE, TIME, gaps)
            return fill.value_counts(filled, SITE, gaps, sign)

        difference = counted(rows, "new_", 1).unionByName(counted(before, "old_", -1))
        return fill.add_counts(_snapshot(spark, values, difference.schema), difference)

    def prepare(batch: DataFrame, stage: str) -> set[dt.date | None]:
        """Write what the batch changes to the stage; the dates whose rows are not the same any more."""
        incoming = standardise_weather(batch, strict).withColumn("_fresh", F.lit(True))
        dates = touched_dates(incoming, WEATHER_DATE)
        schema = widen_schema(load_schema(spark, f"{observed}.schema"), incoming.drop("_fresh").schema)
        before = _of_dates(spark, observed, dates, schema).withColumn("_fresh", F.lit(False))
        rows = latest_by(before.unionByName(cast_to(incoming, before.schema)), grain, NEWEST)
        rows = _stored(rows, f"{stage}/observed")

        days = days_then_and_now(rows, dates)
        carried = fill.carried_in(days, [f"{when}_{c}" for c in gaps for when in ("old", "new")])
        differs = reduce(
            lambda a, b: a | b,
            [~F.col(f"_carry_old_{c}").eqNullSafe(F.col(f"_carry_new_{c}")) for c in gaps],
            F.col("touched"),
        )
        now = [f"new_{c}" for c in gaps]
        carried = days.select(PLACE, "touched", *now).join(carried, PLACE).withColumn("changed", differs)
        carried = _stored(carried, f"{stage}/carried")
        counts = _stored(counts_then_and_now(carried, before, rows, dates), f"{stage}/values")
        found = _stored(fill.medians_of_counts(counts, SITE, gaps), f"{stage}/medians")

        # Days still open at their beginning take the median, so they change with it.
        last = _snapshot(spark, medians, found.schema).select(
            F.col(SITE).alias("_was"), *[F.col(f"med_{c}").alias(f"was_{c}") for c in gaps]
        )
        moved = found.join(last, F.col(SITE) == F.col("_was"), "full").withColumn("_site", F.coalesce(SITE, "_was"))
        opened = reduce(
            lambda a, b: a | b,
            [
                F.col(f"_carry_new_{c}").isNull() & ~F.col(f"med_{c}").eqNullSafe(F.col(f"was_{c}"))
                for c in gaps
            ],
        )
        return _dates_of(carried.join(moved, F.col("_key") == F.col("_site"), "left").where(F.col("changed") | opened))

    def restate(batch: DataFrame, batch_id: int) -> dict:
        stage = f"{checkpoint}/stage/{batch_id}"
        ready = files.read_text(spark, f"{stage}/_READY")
        if ready is None:
            dates = prepare(read_bronze_batch(spark, bronze, store, batch), stage)
            ready = json.dumps([d and d.isoformat() for d in sorted(dates, key=str)])
            files.write_text(spark, f"{stage}/_READY", ready)
        dates = {d and dt.date.fromisoformat(d) for d in json.loads(ready)}

        rows = spark.read.parquet(f"{stage}/observed").drop("_fresh")
        schema = grow_table_schema(spark, observed, rows.schema)
        overwrite_partitions(rows, observed, WEATHER_DATE)
        carried = spark.read.parquet(f"{stage}/carried")
        month = F.trunc(f"{PLACE}.day", "month").alias(MONTH)
        site_day = [F.col(f"{PLACE}.key").alias(SITE), F.col(f"{PLACE}.day").alias(WEATHER_DATE)]
        closing = carried.select(*site_day, month, *[F.col(f"new_{c}").alias(c) for c in gaps])
        months = {row[0] for row in carried.where("touched").select(month).distinct().collect()}
        grow_table_schema(spark, closings, closing.schema)
        overwrite_partitions(closing.where(on_dates(MONTH, months)), closings, MONTH)
        for name, table in (("values", values), ("medians", medians)):
            publish(spark, f"{stage}/{name}", table)

        # All rows of those dates, from the observations and what is carried into each day.
        carried = _takes_over(carried, "new_", gaps)
        med = read_snapshot(spark, medians).withColumnRenamed(SITE, "_med_key")
        carried = carried.where(on_dates(f"{PLACE}.day", dates)).join(med, F.col("_key") == F.col("_med_key"), "left")
        every = _of_dates(spark, observed, dates, schema)
        filled = fill.put_medians(fill.fill_from(every, carried.drop("_med_key"), SITE, TIME, gaps), gaps)
        result = filled.withColumn("temp_category", temperature_band(F.col("air_temperature")))
        counts = replace_dates(result, target, WEATHER_DATE, dates, flags)
        files.remove(spark, stage)
        return counts

    stream_apply(bronze_stream(spark, bronze, store, max_files), restate, checkpoint)
