"""Landing folders written from the given tables, for the ingestion and streaming queries."""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.plans.lakehouse import BUILDING, METER, WEATHER, LakeConfig
from meterlake.queries.inputs import FIRST, INGESTED_AT
from meterlake.queries.oracle import RUN_ID
from meterlake.session import configure, scratch_dir
from meterlake.sinks import files


def _fields(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in types.items()])


# Declared feed types. An all-null column could not be inferred from text.
SCHEMAS = {
    METER: _fields(
        event_id=T.LongType(),
        building_id=T.IntegerType(),
        meter=T.IntegerType(),
        timestamp=T.TimestampType(),
        meter_reading=T.DoubleType(),
    ),
    WEATHER: _fields(
        site_id=T.IntegerType(),
        timestamp=T.TimestampType(),
        **{
            name: T.DoubleType()
            for name in (
                "air_temperature",
                "cloud_coverage",
                "dew_temperature",
                "precip_depth_1_hr",
                "sea_level_pressure",
                "wind_direction",
                "wind_speed",
            )
        },
    ),
    BUILDING: _fields(
        building_id=T.IntegerType(),
        site_id=T.IntegerType(),
        primary_use=T.StringType(),
        square_feet=T.IntegerType(),
        year_built=T.IntegerType(),
        floor_count=T.IntegerType(),
    ),
}


def write_landing(df: DataFrame, path: str, parts: int | None = None) -> None:
    """Add CSV files with a header; ``parts`` forces several files for a small table."""
    text = df.withColumns(
        {
            f.name: F.date_format(f.name, "yyyy-MM-dd HH:mm:ss.SSSSSS")
            for f in df.schema.fields
            if isinstance(f.dataType, T.TimestampType)
        }
    )
    text = text.repartition(parts) if parts else text
    text.write.mode("append").option("header", True).csv(path)


def land_as(df: DataFrame, path: str, name: str, suffix: str, days_old: int = 0) -> None:
    """Add files called ``name-<number><suffix>`` that are so many days old; ``.gz`` ones are packed."""
    spark = df.sparkSession
    stage = f"{scratch_dir(spark)}/landing"
    text = df.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    packed = "gzip" if suffix.endswith(".gz") else "none"
    text.repartition(2).write.options(header=True, compression=packed).csv(stage)
    to_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = to_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(to_path(path))
    written = [n for n in files.names(spark, stage) if n.startswith("part-")]
    moment = int(time.time() * 1000) - days_old * 86_400_000
    for number, part in enumerate(written):
        target = to_path(f"{path}/{name}-{number}{suffix}")
        fs.rename(to_path(f"{stage}/{part}"), target)
        fs.setTimes(target, moment, -1)
    files.remove(spark, stage)


def new_lake(spark: SparkSession, as_of: dt.date = FIRST, **settings) -> LakeConfig:
    """A fresh lake in the shared scratch folder."""
    configure(spark)
    return LakeConfig(
        base=scratch_dir(spark),
        run_id=RUN_ID,
        as_of=as_of,
        ingested_at=INGESTED_AT,
        schemas=SCHEMAS,
        **settings,
    )
