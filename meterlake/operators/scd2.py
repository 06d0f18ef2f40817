"""Slowly changing history (type 2): versions with a validity interval and a current flag."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.operators.dedupe import one_per_key

OPEN_END = dt.date(9999, 12, 31)


def open_versions(rows: DataFrame, as_of: dt.date) -> DataFrame:
    """Mark rows as the current version from ``as_of`` on."""
    return rows.withColumns(
        {
            "effective_from": F.lit(as_of),
            "effective_to": F.lit(OPEN_END),
            "is_current": F.lit(True),
        }
    )


def _differs(old: Column, new: Column, null_safe: bool) -> Column:
    return ~old.eqNullSafe(new) if null_safe else F.coalesce(old != new, F.lit(False))


def scd2_apply(
    versions: DataFrame | None,
    incoming: DataFrame,
    key: str,
    tracked: str,
    as_of: dt.date,
    null_safe: bool = False,
    on_duplicate: str = "error",
    newest_first: list[str] | None = None,
) -> DataFrame:
    """New content of the version table after one batch.

    A key whose tracked value changed has its current version closed at ``as_of`` and a new
    one opened; an unknown key is opened; an unchanged one is left alone, so a replay does
    nothing. Closing and opening are one result and so cannot be seen apart. A change from
    or to null counts only with ``null_safe``. Intervals are half-open; a second change of a
    key on its ``effective_from`` day would give two versions the same identity and fails.
    """
    batch = one_per_key(incoming, [key], on_duplicate, newest_first)
    opened = open_versions(batch, as_of)
    if versions is None:
        return opened

    seen = batch.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("_key"), F.col(tracked).alias("_new"), F.lit(True).alias("_seen")
    )
    matched = versions.join(seen, versions[key] == seen["_key"], "left")
    change = (
        F.col("is_current")
        & F.col("_seen").isNotNull()
        & _differs(F.col(tracked), F.col("_new"), null_safe)
    )
    twice = F.raise_error(
        F.concat(F.lit(f"second change on one day for {key} "), F.col(key).cast("string"))
    )
    closed_at = F.when(F.col("effective_from") == F.lit(as_of), twice.cast("date")).otherwise(F.lit(as_of))
    kept = (
        matched.withColumn("_change", change)
        .withColumns(
            {
                "effective_to": F.when(F.col("_change"), closed_at).otherwise(F.col("effective_to")),
                "is_current": F.col("is_current") & ~F.col("_change"),
            }
        )
        .select(*versions.columns)
    )

    current = versions.filter("is_current").select(
        F.col(key).alias("_key"), F.col(tracked).alias("_old"), F.lit(True).alias("_known")
    )
    fresh = opened.join(current, opened[key] == current["_key"], "left").filter(
        F.col("_known").isNull() | _differs(F.col("_old"), F.col(tracked), null_safe)
    )
    return kept.unionByName(fresh.select(*opened.columns), allowMissingColumns=True)
