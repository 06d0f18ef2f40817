"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every plan in this library relies on. Surrogate keys hash the text of
# a timestamp, so the zone must be pinned. Adaptive execution splits a hot key's
# partition in sort-merge joins and re-checks measured sizes before broadcasting. A task of a
# partitioned write holds few dates, whose files it keeps open instead of sorting its rows.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.maxConcurrentOutputFileWriters": "4",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a session; sizes and partition counts stay the cluster's."""
    for name, value in DEFAULTS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: int | str = 8, app: str = "meterlake", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="meterlake-wh-"))
    )
    for name, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder under ``spark.checkpoint.dir``.

    Where the setting is absent a temporary folder is used, in local mode only: executors
    on other machines could not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="meterlake-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/meterlake-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "table", partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    Used where several plans start from one expensive result: lineage is cut, executors may
    be lost, and the readers still get column pruning and filter pushdown.
    """
    from meterlake.sinks.tables import append, read_table

    path = f"{scratch_dir(df.sparkSession)}/{name}"
    append(df, path, partition_by)
    return read_table(df.sparkSession, path, df.schema)
