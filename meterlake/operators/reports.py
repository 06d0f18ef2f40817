"""Run reports: row counts, flagged rows, previews."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.functions.numeric import count_where


def run_report(df: DataFrame, **flags: str | Column) -> DataFrame:
    """Total rows and the rows meeting each predicate, in one pass: ``metric``, ``rows``. A
    column instead of a predicate is a whole number of its own, given as an aggregate."""
    measures = {n: p.cast("bigint") if isinstance(p, Column) else count_where(p) for n, p in flags.items()}
    counts = {"total": F.count(F.lit(1)), **measures}
    row = df.agg(*[column.alias(name) for name, column in counts.items()])
    pairs = [F.struct(F.lit(name).alias("metric"), F.col(name).alias("rows")) for name in counts]
    return row.select(F.inline(F.array(*pairs)))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of every table: ``table_name``, ``rows``."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def category_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("rows")).orderBy(column)


def global_mean(df: DataFrame, column: str, out: str) -> DataFrame:
    return df.agg(F.avg(column).alias(out))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """How many values a column has; null is one of them."""
    return df.select(column).distinct().agg(F.count(F.lit(1)).alias("values"))


def top_preview(df: DataFrame, order: list[Column | str], rows: int) -> DataFrame:
    """First rows in an order; each task keeps only its own first rows."""
    return df.orderBy(*order).limit(rows)


def preview(df: DataFrame, rows: int) -> DataFrame:
    """Any few rows; Spark stops reading once it has them."""
    return df.limit(rows)
