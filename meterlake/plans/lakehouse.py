"""The whole run, layer by layer."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from decimal import ROUND_HALF_UP, Decimal
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meterlake.operators.checks import SURPLUS, as_log, require_passed, write_check_log
from meterlake.operators.enrich import BASE_YEAR
from meterlake.operators.merge import upsert
from meterlake.plans import dims, quality
from meterlake.session import configure
from meterlake.sinks.counters import TOTAL, Aggregate, load_counters, summed
from meterlake.sinks.snapshots import (
    create_snapshot_if_missing,
    read_snapshot,
    refresh,
    snapshot_exists,
)
from meterlake.streaming import bronze, gold, silver
from meterlake.streaming.weather import silver_weather
from meterlake.streaming.runners import read_journal


@dataclass(frozen=True)
class LakeConfig:
    """Where the tables live and what is fixed for one run."""

    base: str
    run_id: str
    as_of: dt.date
    ingested_at: dt.datetime | None = None
    strict: bool = True
    null_safe: bool = False
    on_duplicate: str = "error"
    spike_factor: float = 5
    window_days: int = 7
    base_year: int = BASE_YEAR
    first_day: dt.date = dims.FIRST_DAY
    last_day: dt.date = dims.LAST_DAY
    expected_sites: int = 16
    expected_months: int = 12
    fail_fast: bool = False
    max_files: int = bronze.MAX_FILES
    max_table_files: int | None = None
    archive: str | None = None
    on_misfit: str = "rescue"
    schemas: dict[str, StructType] = field(default_factory=dict)

    def landing(self, feed: str) -> str:
        return f"{self.base}/landing/{feed}"

    def table(self, name: str) -> str:
        return f"{self.base}/tables/{name}"

    def store(self, feed: str) -> str:
        return f"{self.base}/schemas/{feed}"

    def checkpoint(self, name: str) -> str:
        return f"{self.base}/checkpoints/{name}"


METER, WEATHER, BUILDING = "meter_readings", "weather_readings", "building_metadata"

# What is counted as each table is written, for every date of it.
FLAGS = {
    "silver_readings": {"zero_readings": "is_zero_reading", "spikes": "is_spike"},
    "silver_weather": {"null_air_temperature": "air_temperature IS NULL"},
    "silver_enriched_readings": {
        "unknown_buildings": "is_building_unknown",
        "null_energy_per_sqft": "energy_per_sqft IS NULL",
        "spikes": "is_spike",
    },
    "fact_meter_readings": {
        "null_building_key": "building_key IS NULL",
        "null_date_key": "date_key IS NULL",
        "zero_readings": "is_zero_reading",
        "spikes": "is_spike",
    },
    "fact_daily_building_summary": {
        "null_building_date_key": "building_date_key IS NULL",
        **quality.DAILY_RULES,
        "completeness": Aggregate("sum(CAST(data_completeness_pct AS DECIMAL(28,2)))"),
    },
}


def _together(spark: SparkSession, *steps: Callable[[], None]) -> None:
    """Start steps that do not depend on each other at once, so small ones do not leave the
    cluster idle; the first error is raised once all have ended."""
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    for step in running:
        step.result()


def _record(spark: SparkSession, cfg: LakeConfig, layer: str, results: DataFrame) -> None:
    moment = cfg.ingested_at or dt.datetime.now(dt.UTC).replace(tzinfo=None)
    path = cfg.table(f"{layer}_quality_log")
    write_check_log(as_log(results, moment), path)
    if cfg.fail_fast:
        require_passed(spark.read.parquet(path).filter(f"checked_at = '{moment.isoformat()}'"))


def run_bronze(spark: SparkSession, cfg: LakeConfig) -> None:
    configure(spark)
    shared = {
        "run_id": cfg.run_id,
        "ingested_at": cfg.ingested_at,
        "max_files": cfg.max_files,
        "on_misfit": cfg.on_misfit,
    }

    def archive(feed: str) -> str | None:
        return cfg.archive and f"{cfg.archive}/{feed}"

    def places(feed: str) -> list[str]:
        return [cfg.landing(feed), cfg.table(f"bronze_{feed}"), cfg.store(feed), cfg.checkpoint(f"bronze_{feed}")]

    def append_feed(feed: str) -> None:
        bronze.ingest_csv(spark, *places(feed), schema=cfg.schemas.get(feed), archive=archive(feed), **shared)

    def version_buildings() -> None:
        bronze.ingest_versions(
            spark,
            *places(BUILDING),
            as_of=cfg.as_of,
            null_safe=cfg.null_safe,
            on_duplicate=cfg.on_duplicate,
            schema=cfg.schemas.get(BUILDING),
            archive=archive(BUILDING),
            **shared,
        )

    _together(spark, lambda: append_feed(METER), lambda: append_feed(WEATHER), version_buildings)


def bronze_table(spark: SparkSession, cfg: LakeConfig, feed: str) -> DataFrame:
    if feed == BUILDING:
        return read_snapshot(spark, cfg.table(f"bronze_{feed}"))
    return bronze.read_bronze(spark, cfg.table(f"bronze_{feed}"), cfg.store(feed))


def check_bronze(spark: SparkSession, cfg: LakeConfig) -> None:
    tables = [bronze_table(spark, cfg, feed) for feed in (METER, WEATHER, BUILDING)]
    _record(spark, cfg, "bronze", quality.bronze_checks(*tables))


def run_silver(spark: SparkSession, cfg: LakeConfig) -> None:
    configure(spark)

    def readings() -> None:
        silver.silver_readings(
            spark,
            cfg.table(f"bronze_{METER}"),
            cfg.store(METER),
            cfg.table("silver_readings"),
            cfg.checkpoint("silver_readings"),
            cfg.strict,
            cfg.spike_factor,
            cfg.window_days,
            cfg.max_table_files,
            FLAGS["silver_readings"],
        )

    def weather() -> None:
        silver_weather(
            spark,
            cfg.table(f"bronze_{WEATHER}"),
            cfg.store(WEATHER),
            cfg.table("silver_weather"),
            cfg.checkpoint("silver_weather"),
            cfg.strict,
            max_files=cfg.max_table_files,
            flags=FLAGS["silver_weather"],
        )

    _together(spark, readings, weather)
    silver.silver_enriched(
        spark,
        cfg.table("silver_readings"),
        cfg.table("silver_weather"),
        cfg.table(f"bronze_{BUILDING}"),
        cfg.table("silver_enriched_readings"),
        cfg.checkpoint("silver_enriched"),
        cfg.base_year,
        cfg.max_table_files,
        FLAGS["silver_enriched_readings"],
    )


def check_silver(spark: SparkSession, cfg: LakeConfig) -> None:
    names = ("silver_readings", "silver_weather", "silver_enriched_readings")
    tables = [silver.stored_table(spark, cfg.table(name)) for name in names]
    results = quality.silver_checks(*tables, bronze_table(spark, cfg, METER))
    _record(spark, cfg, "silver", results)


def run_dimensions(spark: SparkSession, cfg: LakeConfig) -> None:
    """Static dimensions are created once, type 1 replaced, and building versions upserted.

    The calendar grows when the configured span does; it never shrinks. The upsert lets a
    version that was closed since the last run lose its current flag here too.
    """
    configure(spark)
    enriched = silver.stored_table(spark, cfg.table("silver_enriched_readings"))
    weather = silver.stored_table(spark, cfg.table("silver_weather"))
    buildings = bronze_table(spark, cfg, BUILDING)

    static = {
        "dim_meter_type": dims.dim_meter_type(spark),
        "dim_time_of_day": dims.dim_time_of_day(spark),
    }
    path = cfg.table("dim_building")
    versions = dims.dim_building(buildings, cfg.base_year)
    if snapshot_exists(spark, path):
        versions = upsert(read_snapshot(spark, path), versions, ["building_key"])
    replaced = {
        "dim_site": dims.dim_site(enriched),
        "dim_building_use": dims.dim_building_use(buildings),
        "dim_weather_condition": dims.dim_weather_condition(weather),
        "dim_building": versions,
    }
    _together(
        spark,
        *[partial(create_snapshot_if_missing, df, cfg.table(name)) for name, df in static.items()],
        *[partial(refresh, df, cfg.table(name)) for name, df in replaced.items()],
        partial(_extend_calendar, spark, cfg),
    )


def _extend_calendar(spark: SparkSession, cfg: LakeConfig) -> None:
    path, first, last = cfg.table("dim_date"), cfg.first_day, cfg.last_day
    if snapshot_exists(spark, path):
        stored = read_snapshot(spark, path).agg(F.min("date"), F.max("date")).first()
        if stored[0] <= first and last <= stored[1]:
            return
        first, last = min(first, stored[0]), max(last, stored[1])
    refresh(dims.dim_date(spark, first, last), path)


DIMENSIONS = [
    "dim_date",
    "dim_meter_type",
    "dim_time_of_day",
    "dim_site",
    "dim_building_use",
    "dim_building",
    "dim_weather_condition",
]


def run_facts(spark: SparkSession, cfg: LakeConfig) -> None:
    configure(spark)
    gold.gold_fact_readings(
        spark,
        cfg.table("silver_enriched_readings"),
        {name: cfg.table(name) for name in DIMENSIONS},
        cfg.table("fact_meter_readings"),
        cfg.checkpoint("fact_meter_readings"),
        cfg.run_id,
        cfg.max_table_files,
        FLAGS["fact_meter_readings"],
    )
    gold.gold_fact_daily(
        spark,
        cfg.table("fact_meter_readings"),
        cfg.table("dim_building"),
        cfg.table("fact_daily_building_summary"),
        cfg.checkpoint("fact_daily_building_summary"),
        cfg.max_table_files,
        FLAGS["fact_daily_building_summary"],
    )


def check_gold(spark: SparkSession, cfg: LakeConfig) -> None:
    """The gold checks from what the dates of the facts are kept with; neither fact is read."""
    fact, daily = (load_counters(spark, cfg.table(name)) for name in (quality.FACT, quality.DAILY))

    def counted(parts: dict[str, dict], names: list[str]) -> DataFrame:
        counts = summed(parts, names)
        return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{name} long" for name in counts))

    names = ("dim_date", "dim_building", "dim_site", "dim_meter_type", "dim_time_of_day")
    results = quality.gold_checks_of(
        silver.stored_table(spark, f"{cfg.table(quality.FACT)}.summary"),
        counted(fact, [SURPLUS]),
        counted(daily, list(quality.DAILY_RULES)),
        counted(daily, [SURPLUS]),
        *[read_snapshot(spark, cfg.table(name)) for name in names],
        cfg.expected_sites,
        cfg.expected_months,
    )
    _record(spark, cfg, "gold", results)


def run_lakehouse(spark: SparkSession, cfg: LakeConfig) -> None:
    """Take in what is new in the landing folders and bring every table up to date."""
    configure(spark)
    run_bronze(spark, cfg)
    check_bronze(spark, cfg)
    run_silver(spark, cfg)
    check_silver(spark, cfg)
    run_dimensions(spark, cfg)
    run_facts(spark, cfg)
    check_gold(spark, cfg)


def _table_counters(spark: SparkSession, cfg: LakeConfig, name: str) -> dict[str, int]:
    """What a table's writes counted, over all its parts."""
    parts = load_counters(spark, cfg.table(name))
    flags = {
        f"bronze_{METER}": bronze.LANDED,
        f"bronze_{WEATHER}": bronze.LANDED,
        f"bronze_{BUILDING}": bronze.CURRENT,
        **FLAGS,
    }.get(name, {})
    rules = quality.DAILY_RULES if name == quality.DAILY else {}
    named = [flag for flag, rule in flags.items() if not isinstance(rule, Aggregate) and flag not in rules]
    counts = summed(parts, [TOTAL, *named])
    if "dates" in flags:
        counts["ingestion_dates"] = len({day for part in parts.values() for day in part["dates"]})
    if "completeness" in flags:
        # Sums of decimals come as texts; a table without rows has no mean.
        total = sum(Decimal(part["completeness"] or 0) for part in parts.values())
        rows = counts[TOTAL]
        mean = (total / rows).quantize(Decimal(1), ROUND_HALF_UP) if rows else None
        counts["mean_completeness_pct"] = None if mean is None else int(mean)
    return counts


REPORTED = [
    *[f"bronze_{feed}" for feed in (METER, WEATHER, BUILDING)],
    "silver_readings",
    "silver_weather",
    "silver_enriched_readings",
    "fact_meter_readings",
    "fact_daily_building_summary",
    *DIMENSIONS,
]


def lake_report(spark: SparkSession, cfg: LakeConfig) -> DataFrame:
    """Rows of every table and its flagged rows: ``table_name, metric, rows``.

    The numbers were counted while the tables were written, so no table is read.
    ``ingestion_dates`` counts days and ``mean_completeness_pct`` is a rounded per cent.
    """
    rows = [
        (name, metric, count)
        for name in REPORTED
        for metric, count in _table_counters(spark, cfg, name).items()
    ]
    return spark.createDataFrame(rows, "table_name string, metric string, rows long")


STREAMS = [
    *[f"bronze_{feed}" for feed in (METER, WEATHER, BUILDING)],
    "silver_readings",
    "silver_weather",
    "silver_enriched",
    "fact_meter_readings",
    "fact_daily_building_summary",
]


def batch_journal(spark: SparkSession, cfg: LakeConfig) -> DataFrame:
    """Every batch of every stream once: ``stream, batch_id, rows, seconds``; rows are those written."""
    rows = [(name, *entry) for name in STREAMS for entry in read_journal(spark, cfg.checkpoint(name))]
    return spark.createDataFrame(rows, "stream string, batch_id long, rows long, seconds double")
