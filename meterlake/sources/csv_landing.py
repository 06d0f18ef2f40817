"""CSV files whose columns may come in any order, and with columns not seen before."""

from __future__ import annotations

import csv
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from meterlake.operators.readings import RESCUED
from meterlake.sinks import files
from meterlake.sources.schemas import evolve_schema, load_schema, merge_inferred, save_schema, wider_types
from meterlake.sources.streams import ANY_AGE

SOURCE_FILE, SOURCE_TIME = "source_file_name", "source_modified_at"
_DISCOVERY_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def discover_files(
    spark: SparkSession, path: str, max_files: int, pattern: str | None = None, archive: str | None = None
) -> DataFrame:
    """Stream of the paths of new files. Only the listing is read, never a file's content.

    Every file is taken whatever its suffix, but for names that begin with ``_`` or ``.``;
    ``pattern`` narrows that. A file delivered late with an old time stamp is still taken. The
    stream remembers every path it has seen; with ``archive``, files are moved there once a
    later batch has begun, so that neither the folder nor that memory grows for ever.
    """
    reader = (
        spark.readStream.format("binaryFile")
        .schema(_DISCOVERY_SCHEMA)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files)
        .option("maxFileAge", ANY_AGE)
    )
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if archive:
        reader = reader.options(cleanSource="archive", sourceArchiveDir=archive)
    return reader.load(path).select("path")


def group_by_header(spark: SparkSession, paths: list[str]) -> dict[tuple[str, ...], list[str]]:
    """Files by their header. Reads one line per file, like a listing; empty files drop out."""
    with ThreadPoolExecutor(16) as pool:
        lines = list(pool.map(lambda p: files.first_line(spark, p), paths))
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for path, line in zip(paths, lines, strict=True):
        header = next(csv.reader([line.removeprefix("\ufeff")]), [])
        if header:
            groups[tuple(name.strip() for name in header)].append(path)
    return dict(groups)


def _unseen(header: tuple[str, ...], stored: StructType | None) -> bool:
    known = {f.name.lower() for f in stored.fields} if stored else set()
    return any(name.lower() not in known for name in header)


# Under this name the rescue column holds a line with more or fewer fields than its header.
WHOLE_LINE = "_line"
RESCUE, WIDEN, WIDEN_TO_TEXT = "rescue", "widen", "widen_to_text"


def _texts(spark: SparkSession, groups: dict[tuple[str, ...], list[str]], names: dict[str, str]) -> DataFrame:
    """All fields as text. A CSV reader maps columns by position, so files are read per distinct
    header and put together by name."""
    result = None
    for header, group in groups.items():
        fields = [StructField(names[name.lower()], StringType(), True) for name in header]
        part = (
            spark.read.schema(StructType([*fields, StructField(WHOLE_LINE, StringType(), True)]))
            .options(header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=WHOLE_LINE)
            .csv(group)
            .selectExpr(
                "*",
                f"_metadata.file_path AS {SOURCE_FILE}",
                f"_metadata.file_modification_time AS {SOURCE_TIME}",
            )
        )
        result = part if result is None else result.unionByName(part, allowMissingColumns=True)
    return result


def _given(column: str) -> Column:
    """Whether a field holds anything; for other types than text, blanks are nothing."""
    return F.trim(F.col(f"`{column}`")) != ""


def _fits(column: str, data_type) -> Column:
    return F.col(f"`{column}`").try_cast(data_type)


def _widened(texts: DataFrame, schema: StructType, to_text: bool) -> StructType:
    """The schema with each number column in the narrowest type that holds all its fields.

    One pass over the batch. A field that is no number at all turns the column into text if
    that is wanted, and else has no say.
    """
    steps = {f.name: wider_types(f.dataType) for f in schema.fields if f.name in texts.columns}
    steps = {name: types for name, types in steps.items() if len(types) > 1 or (to_text and types[0] != StringType())}
    if not steps:
        return schema
    counts = [
        F.count_if(_given(name) & _fits(name, types[-1]).isNotNull() & _fits(name, t).isNull()).alias(f"{name} {k}")
        for name, types in steps.items()
        for k, t in enumerate(types[:-1])
    ] + [F.count_if(_given(name) & _fits(name, types[-1]).isNull()).alias(f"{name} none") for name, types in steps.items()]
    misfits = texts.agg(*counts).first()
    grown = {}
    for name, types in steps.items():
        unfit = [misfits[f"{name} {k}"] for k in range(len(types) - 1)]
        grown[name] = types[next((k for k, n in enumerate(unfit) if not n), len(types) - 1)]
        if to_text and misfits[f"{name} none"]:
            grown[name] = StringType()
    return StructType([StructField(f.name, grown.get(f.name, f.dataType), True) for f in schema.fields])


def read_landed(
    spark: SparkSession,
    paths: list[str],
    store: str,
    schema: StructType | None = None,
    on_misfit: str = RESCUE,
) -> DataFrame | None:
    """Rows of the given files under the stored schema, which first takes in new columns.

    Types are inferred only from files that hold a column not stored yet. Fields are read as
    text and tried one by one: where one does not fit its column's type, the value is null and
    the rescue column holds the field's name and text, as JSON; a line with more or fewer
    fields than its header is there whole. With ``on_misfit="widen"`` a number column whose
    fields are wider numbers grows (int, long, double), so that these are values; with
    ``"widen_to_text"`` it turns into text where a field is no number. Files that lack a column
    give null, and so does a batch of files that all lack it.
    """
    if on_misfit not in (RESCUE, WIDEN, WIDEN_TO_TEXT):
        raise ValueError(f"on_misfit must be {RESCUE!r}, {WIDEN!r} or {WIDEN_TO_TEXT!r}, not {on_misfit!r}")
    groups = group_by_header(spark, paths)
    if not groups:
        return None
    stored = load_schema(spark, store) or schema
    new_headers = [h for h in groups if _unseen(h, stored)]
    inferred = [spark.read.csv(groups[h], header=True, inferSchema=True).schema for h in new_headers]
    evolved = evolve_schema(stored, merge_inferred(inferred))
    texts = _texts(spark, groups, {f.name.lower(): f.name for f in evolved.fields})
    if on_misfit != RESCUE:
        evolved = _widened(texts, evolved, on_misfit == WIDEN_TO_TEXT)
    save_schema(spark, store, evolved)

    there = [f for f in evolved.fields if f.name in texts.columns]
    typed = [f for f in there if f.dataType != StringType()]
    misfits = [F.when(_given(f.name) & _fits(f.name, f.dataType).isNull(), F.col(f"`{f.name}`")) for f in typed]
    # The map is made for lines with a misfit only.
    any_misfit = F.coalesce(*misfits, F.col(WHOLE_LINE)).isNotNull()
    names = F.array(*[F.lit(f.name) for f in typed], F.lit(WHOLE_LINE))
    fields = F.map_from_arrays(names, F.array(*misfits, F.col(WHOLE_LINE)))
    rescued = F.map_filter(fields, lambda _, text: text.isNotNull())

    def value(field: StructField) -> Column:
        if field not in there:
            return F.lit(None).cast(field.dataType).alias(field.name)
        return _fits(field.name, field.dataType).alias(field.name)

    return texts.select(
        *[value(f) for f in evolved.fields],
        F.when(any_misfit, F.to_json(rescued)).alias(RESCUED),
        SOURCE_FILE,
        SOURCE_TIME,
    )
