"""Filling gaps: carry the last known value forward, then fall back to a median.

A key's history is never gathered in one task: values are carried forward inside a key's day,
and what is carried in from earlier days comes from a table with one row a key and day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The key and day of a row as one value, never null itself, whose parts may be. Windows, joins
# and groups by it all fit one shuffle, which a null-safe join of two columns would not.
PLACE = "_place"


def _place(key: str, ts: str) -> Column:
    return F.struct(F.col(key).alias("key"), F.to_date(ts).alias("day"))


def closing_values(df: DataFrame, key: str, ts: str, columns: list[str]) -> DataFrame:
    """One row a key and day: ``_place`` and each column's last known value of that day.

    Of several values at the last time the largest counts.
    """

    def last(c: str) -> Column:
        # A struct keeps the order usable for rows without a time, which sort first.
        return F.max(F.when(F.col(c).isNotNull(), F.struct(F.col(ts).alias("t"), F.col(c).alias("v"))))["v"]

    return df.groupBy(_place(key, ts).alias(PLACE)).agg(*[last(c).alias(c) for c in columns])


def carried_in(closings: DataFrame, columns: list[str]) -> DataFrame:
    """What each place takes over from its key's days before: ``_place, _key, _carry_<column>``."""
    earlier = Window.partitionBy("_key").orderBy(f"{PLACE}.day").rowsBetween(Window.unboundedPreceding, -1)
    keyed = closings.withColumn("_key", F.col(f"{PLACE}.key"))
    return keyed.select(
        PLACE, "_key", *[F.last(c, ignorenulls=True).over(earlier).alias(f"_carry_{c}") for c in columns]
    )


def fill_from(df: DataFrame, carried: DataFrame, key: str, ts: str, columns: list[str]) -> DataFrame:
    """``df`` with gaps filled inside each day, then from ``carried``, whose further columns stay.

    Rows of one key and time count as ordered with their known values first, so a null takes a
    value of its own time if there is one (the largest, if they differ).
    """
    dealt = df.withColumn(PLACE, _place(key, ts)).repartition(PLACE)
    peers = Window.partitionBy(PLACE, ts)
    sofar = Window.partitionBy(PLACE).orderBy(ts).rowsBetween(Window.unboundedPreceding, 0)
    here = {c: f"_here_{c}" for c in columns}
    dealt = dealt.withColumns({h: F.max(c).over(peers) for c, h in here.items()})
    dealt = dealt.withColumns({h: F.last(h, ignorenulls=True).over(sofar) for h in here.values()})
    joined = dealt.join(carried, PLACE, "left")
    filled = joined.withColumns({c: F.coalesce(c, h, f"_carry_{c}") for c, h in here.items()})
    return filled.drop(PLACE, "_key", *here.values(), *[f"_carry_{c}" for c in columns])


def forward_fill(df: DataFrame, key: str, ts: str, columns: list[str]) -> DataFrame:
    """Replace nulls by the key's last non-null value in time order."""
    carried = carried_in(closing_values(df, key, ts, columns), columns)
    return fill_from(df, carried, key, ts, columns)


def value_counts(df: DataFrame, key: str, columns: list[str], sign: int = 1) -> DataFrame:
    """How many rows have each value: ``_key, _column, _value, _n``. Nulls and rows without a key don't count."""
    each = [F.struct(F.lit(c).alias("_column"), F.col(c).cast("double").alias("_value")) for c in columns]
    listed = df.select(F.col(key).alias("_key"), F.inline(F.array(*each)))
    known = listed.where("_value IS NOT NULL AND _key IS NOT NULL")
    return known.groupBy("_key", "_column", "_value").agg((sign * F.count(F.lit(1))).alias("_n"))


def add_counts(counts: DataFrame, more: DataFrame) -> DataFrame:
    """Value counts put together; a value that no row has any more drops out."""
    summed = counts.unionByName(more).groupBy("_key", "_column", "_value").agg(F.sum("_n").alias("_n"))
    return summed.where("_n <> 0")


# Buckets a doubling of the value; a bucket is less than a thousandth of its values wide.
PER_OCTAVE = 1024
_FAR = 1 << 40


def _bucket(value: Column) -> Column:
    """A number that grows with the value, the same for all data: steps of its logarithm."""
    # The smallest double is 2^-1074, so sizes are positive.
    size = F.floor((F.log2(F.abs(value)) + 1100) * PER_OCTAVE)
    positive = F.when(F.abs(value) == float("inf"), F.lit(_FAR)).otherwise(size)
    return (
        F.when(F.isnan(value), F.lit(2 * _FAR))
        .when(value == 0, F.lit(0).cast("long"))
        .when(value > 0, positive)
        .otherwise(-positive)
    )


def medians_of_counts(counts: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Exact discrete medians of value counts: ``<key>, med_<column>``.

    The smallest value that half of the rows don't exceed, as ``quantile_disc`` gives. Only the
    bucket that holds the middle is put in order, and buckets are narrow whatever the range
    of the values is; equal counts give the same median in any order or cut of the rows. NaN
    counts as the largest value.
    """
    group = ["_key", "_column"]
    # Dealt by bucket once: sums of buckets, the join and the order inside all start from that.
    placed = counts.withColumn("_bucket", _bucket(F.col("_value"))).repartition(*group, "_bucket")
    sums = placed.groupBy(*group, "_bucket").agg(F.sum("_n").alias("_inside"), F.min("_value").alias("_least"))
    all_ = Window.partitionBy(*group)
    middle = (
        sums.select(
            *group,
            "_bucket",
            "_least",
            "_inside",
            F.sum("_inside").over(all_.orderBy("_bucket")).alias("_upto"),
            F.sum("_inside").over(all_).alias("_rows"),
        )
        .withColumn("_before", F.col("_upto") - F.col("_inside"))
        .where("2 * _upto >= _rows AND 2 * _before < _rows")
        .select(*group, "_bucket", "_least", "_before", "_rows")
    )
    inside = Window.partitionBy(*group, "_bucket").orderBy("_value")
    # Always true, but both sides now need the same columns, so that they share one shuffle.
    chosen = placed.join(middle, [*group, "_bucket"]).where("_value >= _least")
    reached = chosen.withColumn("_reached", F.col("_before") + F.sum("_n").over(inside))
    return (
        reached.where("2 * _reached >= _rows")
        .groupBy(F.col("_key").alias(key))
        .agg(*[F.min(F.when(F.col("_column") == c, F.col("_value"))).alias(f"med_{c}") for c in columns])
    )


def group_medians(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Exact discrete median per key, as ``med_<column>``; a key without any value has none."""
    found = medians_of_counts(value_counts(df, key, columns), key, columns)
    return df.select(key).distinct().join(found, key, "left")


def put_medians(df: DataFrame, columns: list[str]) -> DataFrame:
    """Remaining nulls take ``med_<column>``, which is dropped."""
    return df.withColumns({c: F.coalesce(c, f"med_{c}") for c in columns}).drop(*[f"med_{c}" for c in columns])


def fill_with_medians(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Replace remaining nulls by the key's median. Rows without a key keep their gaps."""
    medians = medians_of_counts(value_counts(df, key, columns), key, columns)
    return put_medians(df.join(medians, key, "left"), columns)


def fill_gaps(df: DataFrame, key: str, ts: str, columns: list[str]) -> DataFrame:
    """``forward_fill``, then ``fill_with_medians`` of its result.

    Rows are shuffled once, by key and day: the medians are joined to the small table of what
    is carried into each key and day, and reach the rows with it.
    """
    slim = df.select(key, ts, *columns)
    carried = carried_in(closing_values(slim, key, ts, columns), columns)
    counts = value_counts(fill_from(slim, carried, key, ts, columns), key, columns)
    medians = medians_of_counts(counts, key, columns).withColumnRenamed(key, "_med_key")
    both = carried.join(medians, F.col("_key") == F.col("_med_key"), "left").drop("_med_key")
    return put_medians(fill_from(df, both, key, ts, columns), columns)
