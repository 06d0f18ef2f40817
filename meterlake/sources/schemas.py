"""Stored schemas that only ever grow."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from meterlake.sinks import files

_WIDER = [IntegerType(), LongType(), DoubleType()]


def common_type(a: DataType, b: DataType) -> DataType:
    """Narrowest of the inferred types that can hold both."""
    if a == b:
        return a
    if a in _WIDER and b in _WIDER:
        return _WIDER[max(_WIDER.index(a), _WIDER.index(b))]
    if {type(a), type(b)} == {DateType, TimestampType}:
        return TimestampType()
    return StringType()


def merge_inferred(schemas: list[StructType]) -> StructType:
    """One schema for several inferred ones; names match without regard to case."""
    merged: dict[str, StructField] = {}
    for field in (f for schema in schemas for f in schema.fields):
        known = merged.get(field.name.lower())
        data_type = field.dataType if known is None else common_type(known.dataType, field.dataType)
        merged[field.name.lower()] = StructField(known.name if known else field.name, data_type, True)
    return StructType(list(merged.values()))


def evolve_schema(stored: StructType | None, seen: StructType) -> StructType:
    """Stored columns unchanged, followed by the seen columns it lacks."""
    fields = list(stored.fields) if stored else []
    known = {f.name.lower() for f in fields}
    return StructType(fields + [f for f in seen.fields if f.name.lower() not in known])


def widen_schema(stored: StructType | None, seen: StructType) -> StructType:
    """``evolve_schema``, with the type of a column that both have grown to hold both."""
    types = {f.name.lower(): f.dataType for f in seen.fields}
    fields = [
        StructField(f.name, common_type(f.dataType, types.get(f.name.lower(), f.dataType)), True)
        for f in (stored.fields if stored else [])
    ]
    return evolve_schema(StructType(fields), seen)


def wider_types(stored: DataType) -> list[DataType]:
    """A number's type and the types it may grow to, narrowest first; other types stay."""
    return _WIDER[_WIDER.index(stored) :] if stored in _WIDER else [stored]


# What Spark reads from a file of the first type under a schema of the second.
_PROMOTED = {(IntegerType(), LongType()), (IntegerType(), DoubleType())}


def promoted(stored: DataType, wanted: DataType) -> bool:
    """Whether files of a type can be read as another one without being written again."""
    return stored == wanted or (stored, wanted) in _PROMOTED


def cast_to(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` with the columns of ``schema`` only, in its types; a column that is missing is null."""
    have = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            (F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def load_schema(spark: SparkSession, store: str) -> StructType | None:
    text = files.read_text(spark, store)
    return None if text is None else StructType.fromJson(json.loads(text))


def save_schema(spark: SparkSession, store: str, schema: StructType) -> None:
    files.write_text(spark, store, schema.json())


def infer_or_load_schema(spark: SparkSession, path: str | list[str], store: str) -> StructType:
    """The stored schema if there is one, else the schema inferred from CSV and stored."""
    schema = load_schema(spark, store)
    if schema is None:
        schema = spark.read.csv(path, header=True, inferSchema=True).schema
        save_schema(spark, store, schema)
    return schema
