"""Helpers that the operators of this folder share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.session import scratch_dir

# What `[^\x20\x09-\x0D]+` leaves out; the same bytes in UTF-8, where they never occur
# inside a longer character.
SPACES = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


# Texts are long: batches of the default number of rows would fill tens of MB on either side.
ARROW_BYTES = "4m"


def ship(spark: SparkSession) -> None:
    """Before Python runs on executors: bound the bytes of a batch, and send this library there,
    once a context, for those who don't have it installed."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    context = spark.sparkContext
    if getattr(context, "_meterlake_shipped", False):
        return
    root = Path(__file__).resolve().parent.parent
    path = Path(tempfile.mkdtemp(prefix="meterlake-")) / "meterlake.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    context.addPyFile(str(path))
    context._meterlake_shipped = True


def small_batches(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = 2 << 20
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``limit`` bytes of ``column``, or of one row."""
    for batch in batches:
        ends = np.cumsum(np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0)))
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(first, last - first)
            first = last


class Scratch:
    """Tables written during one run of an operator, under ``spark.checkpoint.dir``.

    Writing cuts the lineage, so a lost executor costs a re-read and not a re-run. ``drop``
    removes a table once nothing reads it any more.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.base, self.made = spark, scratch_dir(spark), 0

    def store(self, df: DataFrame) -> DataFrame:
        self.made += 1
        path = f"{self.base}/{self.made}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for table in tables:
            path = jvm.org.apache.hadoop.fs.Path(table._scratch_path)
            path.getFileSystem(conf).delete(path, True)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A column used inside a lambda may be computed again for each element, since projections
    are merged; a lambda's own variable is not.
    """
    return F.transform(F.array(value), body)[0]


def running_sums(lengths: Column, chunk: int = 256) -> Column:
    """For each element the sum of those before it.

    In two levels, sums of chunks and sums inside a chunk: about ``chunk`` steps an element,
    where growing an array by ``aggregate`` takes steps in the square of its length.
    """

    def inside(chunks: Column) -> Column:
        totals = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda s, x: s + x))
        return let(
            totals,
            lambda sums: F.flatten(
                F.transform(
                    chunks,
                    lambda c, i: let(
                        F.aggregate(F.slice(sums, 1, i), F.lit(0).cast("long"), lambda s, x: s + x),
                        lambda before: F.transform(
                            c, lambda _, j: F.aggregate(F.slice(c, 1, j), before, lambda s, x: s + x)
                        ),
                    ),
                )
            ),
        )

    def cut(all_: Column) -> Column:
        count = F.ceil(F.size(all_) / F.lit(chunk)).cast("int")
        return let(
            F.transform(F.sequence(F.lit(0), count - 1), lambda k: F.slice(all_, k * chunk + 1, F.lit(chunk))),
            inside,
        )

    return F.when(F.size(lengths) > 0, let(lengths, cut)).otherwise(
        F.array().cast("array<bigint>")
    )
