"""Bronze to silver, incrementally but with results that do not depend on batch boundaries."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meterlake.operators.checks import key_surplus
from meterlake.operators.dedupe import latest_by
from meterlake.operators.enrich import BASE_YEAR, enrich_readings
from meterlake.operators.readings import READING_GRAIN, detect_spikes, transform_readings
from meterlake.sinks import files
from meterlake.sinks.counters import Flags, Watch, by_part, count_parts, save_counters
from meterlake.sinks.snapshots import read_snapshot
from meterlake.sinks.tables import (
    overwrite_partitions,
    read_partitions,
    table_exists,
)
from meterlake.sources.csv_landing import SOURCE_FILE, SOURCE_TIME
from meterlake.sources.schemas import cast_to, load_schema, promoted, save_schema, widen_schema
from meterlake.sources.streams import table_stream
from meterlake.streaming.bronze import BATCH, bronze_stream, read_bronze_batch
from meterlake.streaming.runners import stream_apply

READING_DATE, WEATHER_DATE = "reading_date", "weather_date"
# What arrived later: by ingestion, then batch, then the file's own time; its name breaks ties.
NEWEST = ["ingestion_timestamp", BATCH, SOURCE_TIME, SOURCE_FILE]


def on_dates(column: str, dates: Iterable[dt.date | None]) -> Column:
    """Filter by date; a null date stands for itself."""
    known = [d for d in dates if d is not None]
    matches = F.col(column).isin(known) if known else F.lit(False)
    return (matches | F.col(column).isNull()) if None in dates else matches


def touched_dates(batch: DataFrame, column: str) -> set[dt.date | None]:
    """Dates in a batch: at most one value per calendar day reaches the driver."""
    return {row[0] for row in batch.select(column).distinct().collect()}


def grow_table_schema(spark: SparkSession, table: str, schema: StructType) -> StructType:
    """Remember every column a table ever had, in a type that holds all its values, next to the table.

    Files of a type that Spark promotes while reading stay as they are. Growing by more than that
    (a long to a double, anything to text) takes a table written anew: such a batch fails
    before it has changed anything.
    """
    store = f"{table}.schema"
    known = load_schema(spark, store)
    grown = widen_schema(known, schema)
    for before in known.fields if known else []:
        if not promoted(before.dataType, grown[before.name].dataType) and table_exists(spark, table):
            raise ValueError(
                f"{table}: {before.name} is stored as {before.dataType.simpleString()}, "
                f"cannot take in {grown[before.name].dataType.simpleString()}"
            )
    if grown != known:
        save_schema(spark, store, grown)
    return grown


def stored_table(spark: SparkSession, table: str) -> DataFrame:
    """A table of this layer under its stored schema."""
    return spark.read.schema(load_schema(spark, f"{table}.schema")).parquet(table)


def stored_dates(
    spark: SparkSession, table: str, column: str, dates: Iterable[dt.date | None]
) -> DataFrame:
    """Some dates of a table that is partitioned by date."""
    return read_partitions(spark, table, load_schema(spark, f"{table}.schema"), column, dates)


def stored_stream(spark: SparkSession, table: str, max_files: int | None = None) -> DataFrame:
    return table_stream(spark, table, load_schema(spark, f"{table}.schema"), max_files)


def note_dates(
    spark: SparkSession,
    target: str,
    column: str,
    dates: Iterable[dt.date | None],
    flags: Flags | None,
    unique: str | None = None,
) -> None:
    """Keep the counters of replaced dates, which are the only ones read; with a ``unique`` key also
    its surplus rows. Rows of equal keys have to be of one date."""
    if not dates:
        return
    rows = stored_dates(spark, target, column, dates)
    parts = count_parts(rows, column, flags)
    if unique:
        for part, surplus in by_part(key_surplus(rows, unique, column), column).items():
            parts[part].update(surplus)
    save_counters(spark, target, parts)


def replace_dates(
    result: DataFrame,
    target: str,
    column: str,
    dates: Iterable[dt.date | None],
    flags: Flags | None,
    unique: str | None = None,
) -> dict:
    """Replace dates of a table with rows that do not come from it, and count them."""
    spark, watch = result.sparkSession, Watch(flags)
    grow_table_schema(spark, target, result.schema)
    overwrite_partitions(result, target, column, watch=watch)
    note_dates(spark, target, column, dates, flags, unique)
    return watch.counts


def silver_readings(
    spark: SparkSession,
    bronze: str,
    store: str,
    target: str,
    checkpoint: str,
    strict: bool = True,
    factor: float = 5,
    window_days: int = 7,
    max_files: int | None = None,
    flags: Flags | None = None,
) -> None:
    """Clean new readings and restate every date whose rolling mean they can change.

    A reading on day d enters the frames of days d to d + window, and those reach back
    another window. Stored rows of that range and the batch are put together, the last
    ingested row of a building, meter and time wins, and the dates from d on are replaced.
    """

    def restate(batch: DataFrame, batch_id: int) -> dict:
        incoming = transform_readings(read_bronze_batch(spark, bronze, store, batch), strict)
        touched = touched_dates(incoming, READING_DATE)
        days = [d for d in touched if d is not None]
        window = range(window_days + 1)
        changed = {d + dt.timedelta(n) for d in days for n in window}
        needed = changed | {d - dt.timedelta(n) for d in days for n in window}
        if None in touched:
            changed.add(None)
            needed.add(None)

        rows = incoming
        if table_exists(spark, target):
            history = stored_dates(spark, target, READING_DATE, needed)
            base = history.drop("rolling_avg_7d", "is_spike")
            rows = base.unionByName(incoming, allowMissingColumns=True)
        # Written once: the rolling mean and the join with it both start from these rows. They hold
        # all that the dates are made from, so a batch that failed while dates were replaced is
        # repeated from them.
        stage = f"{checkpoint}/stage/{batch_id}"
        rows = latest_by(rows, READING_GRAIN, NEWEST)
        if not files.exists(spark, f"{stage}/rows/_SUCCESS"):
            rows.write.mode("overwrite").parquet(f"{stage}/rows")
        rows = spark.read.schema(rows.schema).parquet(f"{stage}/rows")
        result = detect_spikes(rows, factor, window_days).filter(on_dates(READING_DATE, changed))
        grow_table_schema(spark, target, result.schema)
        watch = Watch(flags)
        overwrite_partitions(result, target, READING_DATE, watch=watch)
        note_dates(spark, target, READING_DATE, changed, flags)
        files.remove(spark, stage)
        return watch.counts

    stream_apply(bronze_stream(spark, bronze, store, max_files), restate, checkpoint)


def silver_enriched(
    spark: SparkSession,
    readings: str,
    weather: str,
    buildings: str,
    target: str,
    checkpoint: str,
    base_year: int = BASE_YEAR,
    max_files: int | None = None,
    flags: Flags | None = None,
) -> None:
    """Rebuild the enriched dates whose readings or weather changed.

    One stream follows both source tables and is used only for the dates it delivers. Later
    building versions do not touch dates that are not rebuilt.
    """

    def rebuild(batch: DataFrame, _: int) -> dict:
        dates = touched_dates(batch, READING_DATE)
        of_dates = stored_dates(spark, readings, READING_DATE, dates)
        at = stored_dates(spark, weather, WEATHER_DATE, dates)
        result = enrich_readings(of_dates, read_snapshot(spark, buildings), at, base_year)
        return replace_dates(result, target, READING_DATE, dates, flags)

    of_readings = stored_stream(spark, readings, max_files).select(READING_DATE)
    of_weather = stored_stream(spark, weather, max_files).select(F.col(WEATHER_DATE).alias(READING_DATE))
    stream_apply(of_readings.union(of_weather), rebuild, checkpoint)
