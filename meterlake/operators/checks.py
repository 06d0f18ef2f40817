"""Building blocks of data-quality checks.

Every block returns rows (check_name, table, bad_rows, note); a check passes with 0 bad rows.
All row rules of one table share one aggregation, so a table is scanned once for them.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.functions.numeric import count_where

# Columns of the check log.
LOG_COLUMNS = ["check_name", "checked_at", "details", "passed", "table"]
SURPLUS = "surplus_keys"


def _result(name: str, table: str, bad: Column, note: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check_name"),
        F.lit(table).alias("table"),
        bad.cast("bigint").alias("bad_rows"),
        note.alias("note"),
    )


def metric_checks(df: DataFrame, table: str, checks: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Checks from aggregates of ``df``: name -> (bad rows, note), all in one pass."""
    columns = {}
    for number, (bad, note) in enumerate(checks.values()):
        columns[f"bad_{number}"] = bad
        columns[f"note_{number}"] = note
    row = df.agg(*[column.alias(name) for name, column in columns.items()])
    results = [
        _result(name, table, F.col(f"bad_{number}"), F.col(f"note_{number}"))
        for number, name in enumerate(checks)
    ]
    return row.select(F.inline(F.array(*results)))


def violations(predicate: str, rows: str | None = None) -> tuple[Column, Column]:
    """Rows that break a rule, given as the predicate of a bad row. ``rows`` names the column that
    says how many rows each row stands for."""
    bad = count_where(predicate)
    if rows:
        bad = F.coalesce(F.sum(F.when(F.expr(predicate), F.col(rows))), F.lit(0))
    return bad, F.concat(F.lit("rows violating: "), bad.cast("string"))


def total(column: str, label: str = "rows violating: ") -> tuple[Column, Column]:
    """Bad rows that a column of a summary already counts."""
    bad = F.coalesce(F.sum(column), F.lit(0))
    return bad, F.concat(F.lit(label), bad.cast("string"))


def not_empty() -> tuple[Column, Column]:
    rows = F.count(F.lit(1))
    return F.when(rows > 0, 0).otherwise(1), F.concat(F.lit("rows="), rows.cast("string"))


def expected(measure: Column, wanted: int, label: str) -> tuple[Column, Column]:
    """A measure that must have one value; its distance from it counts as bad."""
    note = F.concat(F.lit(f"{label}="), measure.cast("string"), F.lit(f", expected {wanted}"))
    return F.abs(measure - wanted), note


def month_mask(day: str) -> Column:
    """The months of a date column as bits, the lowest one for null."""
    return F.bit_or(F.coalesce(F.call_function("shiftleft", F.lit(1), F.month(day)), F.lit(1)))


def months_in(masks: Column) -> Column:
    """Distinct months of month masks put together; null is a month of its own."""
    return F.coalesce(F.bit_count(F.bit_or(masks)), F.lit(0))


def distinct_months(day: str) -> Column:
    """Distinct months of a date column as a bit mask; null is a value of its own."""
    return F.coalesce(F.bit_count(month_mask(day)), F.lit(0))


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return counts.filter("copies > 1")


def distinct_check(df: DataFrame, column: str, table: str, name: str, wanted: int) -> DataFrame:
    """The column must have exactly so many values, null included."""
    values = df.select(column).distinct()
    return metric_checks(values, table, {name: expected(F.count(F.lit(1)), wanted, f"distinct {column}")})


def no_duplicates(df: DataFrame, keys: list[str], table: str, name: str) -> DataFrame:
    return metric_checks(duplicates(df, keys), table, {name: violations("true")})


def key_surplus(df: DataFrame, key: str, *parts: str) -> DataFrame:
    """Rows beyond the first of each key, of the table or of each part; only these columns are shuffled."""
    counts = df.groupBy(*parts, key).agg((F.count(F.lit(1)) - 1).alias("more"))
    return counts.groupBy(*parts).agg(F.coalesce(F.sum("more"), F.lit(0)).alias(SURPLUS))


def unique_key(df: DataFrame, key: str, table: str, name: str) -> DataFrame:
    """Rows equal distinct keys. Bad rows are the surplus."""
    return metric_checks(key_surplus(df, key), table, {name: total(SURPLUS, "surplus rows=")})


def orphans(fact: DataFrame, dim: DataFrame, key: str, rows: str | None = None) -> DataFrame:
    """Keys of the fact that the dimension lacks, with their rows; a null key is an orphan.

    The fact is reduced to one row per key before it meets the dimension, so a key with very
    many rows costs no more than a rare one. ``rows`` names a column with numbers of rows.
    """
    counts = fact.groupBy(key).agg((F.sum(rows) if rows else F.count(F.lit(1))).alias("rows"))
    return counts.join(dim.select(key), key, "left_anti")


def months_per_group(df: DataFrame, group: str, day: str) -> DataFrame:
    """Distinct months per group, with partial masks combined before the shuffle."""
    return df.groupBy(group).agg(distinct_months(day).alias("months"))


def at_least_share(
    part: DataFrame, whole: DataFrame, share: float, table: str, name: str
) -> DataFrame:
    """``part`` must have at least the given share of the rows of ``whole``."""
    def rows_of(df: DataFrame, name: str, other: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias(name)).withColumn(other, F.lit(0))

    both = rows_of(part, "part", "whole").unionByName(rows_of(whole, "whole", "part"))
    part_rows, whole_rows = F.sum("part"), F.sum("whole")
    missing = F.greatest(F.ceil(whole_rows * F.lit(share)) - part_rows, F.lit(0))
    note = F.concat_ws("", F.lit("rows="), part_rows.cast("string"), F.lit(" of "), whole_rows.cast("string"))
    return metric_checks(both, table, {name: (missing, note)})


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def as_log(results: DataFrame, checked_at: dt.datetime | str) -> DataFrame:
    """Results as log rows, with columns in alphabetical order."""
    moment = checked_at if isinstance(checked_at, str) else checked_at.isoformat()
    return results.select(
        "check_name",
        F.lit(moment).alias("checked_at"),
        F.col("note").alias("details"),
        (F.col("bad_rows") == 0).alias("passed"),
        "table",
    )


def write_check_log(log: DataFrame, path: str) -> None:
    log.select(*LOG_COLUMNS).coalesce(1).write.mode("append").parquet(path)


def require_passed(log: DataFrame) -> None:
    """Raise if any check failed. The log has one row per check."""
    failed = [row.check_name for row in log.filter(~F.col("passed")).collect()]
    if failed:
        raise RuntimeError(f"failed checks: {', '.join(sorted(failed))}")
