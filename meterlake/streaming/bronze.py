"""Landing files to bronze tables."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from meterlake.operators.audit import add_audit_columns
from meterlake.operators.readings import RESCUED
from meterlake.operators.scd2 import scd2_apply
from meterlake.sinks import files
from meterlake.sinks.counters import Aggregate, Flags, Watch, load_counters, save_counters
from meterlake.sinks.snapshots import read_snapshot, refresh, snapshot_exists
from meterlake.sinks.tables import overwrite_partitions, table_exists
from meterlake.sources.csv_landing import RESCUE, SOURCE_FILE, SOURCE_TIME, discover_files, read_landed
from meterlake.sources.schemas import cast_to, widen_schema
from meterlake.sources.streams import table_stream
from meterlake.streaming.runners import stream_apply

INGEST, BATCH, TYPES = "ingest", "ingest_batch", "types"
# What is counted as landed rows are written. A batch carries few ingestion dates.
LANDED: Flags = {
    "rescued": f"{RESCUED} IS NOT NULL",
    "dates": Aggregate("collect_set(CAST(ingestion_date AS STRING))"),
}
CURRENT: Flags = {"current": "is_current"}
MAX_FILES = 1000
# Of a stored table at most so many files are one batch; what passes the driver is their paths.
FILES_A_BATCH = 10_000


def _stream_identity(spark: SparkSession, checkpoint: str) -> str:
    """A name that lives as long as the checkpoint."""
    path = f"{checkpoint}/ingest_identity"
    known = files.read_text(spark, path)
    if known is None:
        known = uuid.uuid4().hex
        files.write_text(spark, path, known)
    return known


def land_files(
    spark: SparkSession,
    source: str,
    store: str,
    checkpoint: str,
    run_id: str,
    apply: Callable[[DataFrame, int], dict | None],
    schema: StructType | None = None,
    ingested_at: dt.datetime | None = None,
    max_files: int = MAX_FILES,
    archive: str | None = None,
    on_misfit: str = RESCUE,
) -> None:
    """Hand every batch of new CSV files, with audit columns, to ``apply``.

    What passes the driver is the list of at most ``max_files`` paths per batch.
    """

    def on_paths(batch: DataFrame, batch_id: int) -> dict | None:
        paths = sorted(row.path for row in batch.select("path").collect())
        rows = read_landed(spark, paths, store, schema, on_misfit)
        if rows is None:
            return None
        return apply(add_audit_columns(rows, run_id, SOURCE_FILE, ingested_at), batch_id)

    stream_apply(discover_files(spark, source, max_files, archive=archive), on_paths, checkpoint)


def ingest_csv(
    spark: SparkSession,
    source: str,
    target: str,
    store: str,
    checkpoint: str,
    run_id: str,
    schema: StructType | None = None,
    ingested_at: dt.datetime | None = None,
    max_files: int = MAX_FILES,
    archive: str | None = None,
    on_misfit: str = RESCUE,
) -> None:
    """Append new CSV files to a bronze table.

    Rows carry the batch they came in and their file's modification time, which tell what
    arrived later. A batch owns one partition of the table, so repeating it replaces its own rows only.
    Files that were taken are moved to ``archive``, if there is one, once a later batch begins.
    ``on_misfit`` as in ``read_landed``: where a column's type grows, batches from then on go to a
    folder for the new types, and older files stay as they are.
    """
    identity = _stream_identity(spark, checkpoint)

    def write(rows: DataFrame, batch_id: int) -> dict:
        numbered = rows.withColumn(BATCH, F.lit(batch_id).cast("long"))
        tagged = numbered.withColumn(INGEST, F.lit(f"{identity}-{batch_id}"))
        version = _note_types(spark, store, tagged.schema)
        watch = Watch(LANDED)
        overwrite_partitions(tagged, f"{target}/{TYPES}={version}", INGEST, gather=False, watch=watch)
        save_counters(spark, target, {f"{identity}-{batch_id}": watch.counts})
        return watch.counts

    land_files(
        spark, source, store, checkpoint, run_id, write, schema, ingested_at, max_files, archive, on_misfit
    )


def _type_versions(spark: SparkSession, store: str) -> list[StructType]:
    text = files.read_text(spark, f"{store}.types")
    return [StructType.fromJson(version) for version in json.loads(text)] if text else []


def _note_types(spark: SparkSession, store: str, schema: StructType) -> int:
    """Number of the version of stored types that a batch is written in, a new one if a type grew.

    Within a version columns are only added, whatever columns a batch has.
    """
    versions = _type_versions(spark, store)
    widened = widen_schema(versions[-1] if versions else None, schema)
    if versions and all(f.dataType == widened[f.name].dataType for f in versions[-1].fields):
        versions[-1] = widened
    else:
        versions.append(widened)
    files.write_text(spark, f"{store}.types", json.dumps([v.jsonValue() for v in versions]))
    return len(versions) - 1


def read_bronze(spark: SparkSession, target: str, store: str) -> DataFrame:
    """A bronze table under its newest types; files of older types are read as what they are, and cast.

    No file footers need merging as every version of the schema is stored.
    """
    versions = _type_versions(spark, store)
    parts = []
    for number, schema in enumerate(versions):
        folder = f"{target}/{TYPES}={number}"
        if table_exists(spark, folder):
            parts.append(cast_to(spark.read.schema(schema).parquet(folder), versions[-1]))
    return reduce(DataFrame.unionByName, parts).drop(INGEST)


def bronze_stream(spark: SparkSession, target: str, store: str, max_files: int | None = None) -> DataFrame:
    """Stream of the ``path`` of every new file of a bronze table, as often as it has rows."""
    marks = StructType([StructField(TYPES, IntegerType()), StructField(INGEST, StringType())])
    # The file of a row is known on the stream only, not inside a batch.
    return table_stream(spark, target, marks, max_files or FILES_A_BATCH).select(F.col("_metadata.file_path").alias("path"))


def read_bronze_batch(spark: SparkSession, target: str, store: str, batch: DataFrame) -> DataFrame:
    """Rows of the files of a batch of ``bronze_stream``, under the newest types."""
    versions = _type_versions(spark, store)
    paths = sorted(row.path for row in batch.select("path").distinct().collect())
    parts = []
    for number, schema in enumerate(versions):
        own = [p for p in paths if f"/{TYPES}={number}/" in p]
        if own:
            plain = StructType([f for f in schema.fields if f.name != INGEST])
            parts.append(cast_to(spark.read.schema(plain).parquet(*own), versions[-1]))
    return reduce(DataFrame.unionByName, parts).drop(INGEST)


def ingest_versions(
    spark: SparkSession,
    source: str,
    target: str,
    store: str,
    checkpoint: str,
    run_id: str,
    as_of: dt.date,
    key: str = "building_id",
    tracked: str = "primary_use",
    null_safe: bool = False,
    on_duplicate: str = "error",
    schema: StructType | None = None,
    ingested_at: dt.datetime | None = None,
    max_files: int = MAX_FILES,
    archive: str | None = None,
    on_misfit: str = RESCUE,
) -> None:
    """Fold new CSV files into a type 2 version table."""

    def write(rows: DataFrame, batch_id: int) -> dict:
        known = read_snapshot(spark, target) if snapshot_exists(spark, target) else None
        incoming = rows.drop(RESCUED)
        if known is not None:
            known = cast_to(known, widen_schema(known.schema, incoming.schema))
        versions = scd2_apply(
            known, incoming, key, tracked, as_of, null_safe, on_duplicate, [SOURCE_TIME, SOURCE_FILE]
        )
        refresh(versions, target, flags=CURRENT)
        return load_counters(spark, target)["all"]

    land_files(
        spark, source, store, checkpoint, run_id, write, schema, ingested_at, max_files, archive, on_misfit
    )
