"""Numbering distinct values."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SAMPLE, RANGES = 4096, 64


def rank_values(df: DataFrame, column: str, out: str) -> DataFrame:
    """Distinct non-null values of a text column, numbered 1, 2, ... in order.

    Values are made distinct before any ordering, cut into ranges and ordered inside each; the
    only ungrouped window runs over the ranges. The bounds are taken from at most 4,096
    values, chosen by a hash, so that ranges are about even whatever the values begin with;
    they are a subquery of the plan, and the same wherever it is computed.
    """
    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    sample = values.orderBy(F.xxhash64(column), column).limit(SAMPLE)
    ordered = sample.agg(F.sort_array(F.collect_list(column)).alias("all"))
    step = F.greatest(F.lit(1), F.floor(F.size("all") / RANGES))
    bounds = ordered.select(F.filter("all", lambda _, k: (k > 0) & (k % step == 0))).scalar()
    ranged = values.withColumn("_bounds", bounds).select(
        column, F.size(F.filter("_bounds", lambda b: b <= F.col(column))).alias("_range")
    )
    preceding = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_range", F.coalesce(F.sum("_n").over(preceding), F.lit(0)).alias("_offset"))
    )
    place = F.row_number().over(Window.partitionBy("_range").orderBy(column))
    return (
        ranged.withColumn("_place", place)
        .join(offsets, "_range")
        .select((F.col("_offset") + F.col("_place")).cast("int").alias(out), column)
    )
