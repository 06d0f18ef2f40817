"""One row per key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def any_null(columns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def latest_by(df: DataFrame, keys: list[str], newest_first: list[str]) -> DataFrame:
    """Keep the newest row of every key, by the given columns in descending order.

    All other columns break ties, so the choice never depends on row order. As in a MERGE, a
    null key equals nothing: such rows all stay, except for exact copies. The filter on the
    row number lets Spark keep one row per key in every map task before the shuffle, so a
    key with very many copies is not gathered.
    """
    order = [*newest_first, *[c for c in df.columns if c not in newest_first and c not in keys]]
    own_group = F.when(any_null(keys), F.struct(*df.columns))
    window = Window.partitionBy(*keys, own_group).orderBy(*[F.desc(c) for c in order])
    ranked = df.withColumn("_rank", F.row_number().over(window))
    return ranked.filter("_rank = 1").drop("_rank")


def one_per_key(
    df: DataFrame, keys: list[str], on_duplicate: str = "error", newest_first: list[str] | None = None
) -> DataFrame:
    """Rows with unique keys: a repeated key fails the job, or its newest row wins ("last")."""
    if on_duplicate == "last":
        return latest_by(df, keys, newest_first or [])
    if on_duplicate != "error":
        raise ValueError(f"on_duplicate must be 'error' or 'last', not {on_duplicate!r}")
    text = F.concat(F.lit(f"duplicate {', '.join(keys)}: "), F.to_json(F.struct(*keys)))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    # Two rows of a key are enough to tell, so a map task passes on no more than two.
    seen = df.filter(~any_null(keys)).withColumn("_copy", place).filter("_copy <= 2")
    checked = seen.withColumn("_copy", F.when(F.col("_copy") == 1, 1).otherwise(F.raise_error(text).cast("int")))
    unique = checked.filter(F.col("_copy") == 1).select(*df.columns)
    return unique.unionByName(df.filter(any_null(keys)))
