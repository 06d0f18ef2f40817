"""Counters that tables are written with, kept beside the table.

A write counts its rows while they pass (Spark's observed metrics), so a report afterwards reads
no table. What is kept is a small text per table: for each part of the table, by which it
is replaced (an ingest batch, a date, a whole version), the name and value of each counter.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from meterlake.functions.numeric import count_where
from meterlake.sinks import files

TOTAL = "total"


class Aggregate(str):
    """The text of an aggregate, where a plain text is the predicate of the rows to count."""


Flags = dict[str, str]


def measures(flags: Flags | None) -> list[Column]:
    """All rows, and for each flag the rows meeting the predicate, or the aggregate."""
    each = {TOTAL: Aggregate("count(1)"), **(flags or {})}
    return [(F.expr(m) if isinstance(m, Aggregate) else count_where(m)).alias(name) for name, m in each.items()]


class Watch:
    """Counters that fill while a frame is written.

    ``on`` has to be the last step before the write. Spark counts the tasks of a job's last stage
    once each, but those of earlier stages again if a lost executor makes it repeat them.
    """

    def __init__(self, flags: Flags | None = None):
        self.columns, self.observation = measures(flags), None

    def on(self, df: DataFrame) -> DataFrame:
        self.observation = Observation()
        return df.observe(self.observation, *self.columns)

    @property
    def counts(self) -> dict:
        """The counters, once the write has ended."""
        return dict(self.observation.get)


def _place(table: str) -> str:
    return f"{table}.counters"


def _versions(spark: SparkSession, table: str) -> list[int]:
    names = [n for n in files.names(spark, _place(table)) if n.endswith(".json")]
    return sorted(int(n.removesuffix(".json")) for n in names)


def load_counters(spark: SparkSession, table: str) -> dict[str, dict]:
    """Counters of each part, from the newest text that was written to its end."""
    for version in reversed(_versions(spark, table)):
        text = files.read_text(spark, f"{_place(table)}/{version}.json") or ""
        if text.endswith("}\n"):
            return json.loads(text)
    return {}


def save_counters(spark: SparkSession, table: str, parts: dict[str, dict], keep_others: bool = True) -> None:
    """Replace the counters of some parts, or of the whole table; repeating it changes nothing."""
    known = load_counters(spark, table) if keep_others else {}
    versions = _versions(spark, table)
    text = json.dumps({**known, **parts}, default=str, sort_keys=True) + "\n"
    files.write_text(spark, f"{_place(table)}/{max(versions, default=0) + 1}.json", text)
    for old in versions[:-1]:
        files.remove(spark, f"{_place(table)}/{old}.json")


def by_part(counted: DataFrame, column: str) -> dict[str, dict]:
    """Counters as kept, from one row a value of a column with few values, such as dates."""
    return {
        str(row[column]): {name: value for name, value in row.asDict().items() if name != column}
        for row in counted.collect()
    }


def count_parts(df: DataFrame, column: str, flags: Flags | None = None) -> dict[str, dict]:
    """Counters of each value of such a column."""
    return by_part(df.groupBy(column).agg(*measures(flags)), column)


def summed(parts: dict[str, dict], names: Iterable[str]) -> dict[str, int]:
    """Each counter over all parts; a part without it counts as 0."""
    return {name: sum(part.get(name) or 0 for part in parts.values()) for name in names}
