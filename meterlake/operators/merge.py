"""MERGE variants as plain joins: each takes the target and the source and returns the new target."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.operators.dedupe import any_null, one_per_key


def merge_update(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    assign: dict[str, str],
    when: str | Column | None = None,
    on_duplicate: str = "error",
    newest_first: list[str] | None = None,
) -> DataFrame:
    """WHEN MATCHED [AND ``when``] THEN UPDATE. Expressions name columns as ``tgt.x``, ``src.x``."""
    matchable = source.filter(~any_null(keys))
    src = one_per_key(matchable, keys, on_duplicate, newest_first)
    src = src.withColumn("_matched", F.lit(True)).alias("src")
    tgt = target.alias("tgt")
    on = [F.col(f"tgt.{k}") == F.col(f"src.{k}") for k in keys]
    condition = F.lit(True) if when is None else (F.expr(when) if isinstance(when, str) else when)
    hit = F.col("src._matched") & condition
    new = {
        c: F.when(hit, F.expr(assign[c])).otherwise(F.col(f"tgt.{c}")) if c in assign else F.col(f"tgt.{c}")
        for c in target.columns
    }
    return tgt.join(src, on, "left").select(*[column.alias(c) for c, column in new.items()])


def unmatched(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows whose key the target lacks; a null key is never matched."""
    return source.join(target.select(*keys), keys, "left_anti").select(*source.columns)


def merge_insert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """WHEN NOT MATCHED THEN INSERT *. Columns new in the source are added."""
    return target.unionByName(unmatched(source, target, keys), allowMissingColumns=True)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    on_duplicate: str = "error",
    newest_first: list[str] | None = None,
) -> DataFrame:
    """WHEN MATCHED THEN UPDATE *, WHEN NOT MATCHED THEN INSERT *."""
    src = one_per_key(source, keys, on_duplicate, newest_first)
    return unmatched(target, source, keys).unionByName(src, allowMissingColumns=True)
