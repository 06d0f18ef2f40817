"""Removal of byte strings that earlier documents hold, by bucket-pointer refinement."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.bytestext import flat, grams, runs, window_minima
from meterlake.llm.common import let, ship, small_batches

# A bucket's name is 48 bits of its gram's hash: two grams of one name are told apart later on.
KEY = np.uint64((1 << 48) - 1)
LOW, HIGH = np.uint64(0xFFFFFFFF), np.uint64(0xFFFFFFFF00000000)
# Marks the name of a bucket that is too large for one task.
HOT = 1 << 60


def sampled_suffixes(
    data: np.ndarray, begins: np.ndarray, lengths: np.ndarray, size: int, gram: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, key, first window and number of windows for the suffixes to be sorted.

    Of the suffixes that begin inside a string of ``size`` bytes, and have a whole gram in it,
    the one with the least gram hash stands for the string (leftmost if tied). Equal strings
    choose the same one. ``key`` is its initial bucket; the strings it stands for begin at
    ``first window`` and the places after.
    """
    hashes = grams(data, gram)
    order = (hashes & HIGH) | np.arange(len(hashes), dtype=np.uint64)
    chosen = window_minima(order, size - gram + 1)
    has = lengths >= size
    step = np.zeros(len(data) + 1, np.int8)
    np.add.at(step, begins[has], 1)
    np.add.at(step, begins[has] + lengths[has] - size + 1, -1)
    places = np.flatnonzero(np.cumsum(step[:-1]))
    if not len(places):
        none = np.zeros(0, np.int64)
        return none, none, none, none
    at = (chosen[places] & LOW).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (places[1:] != places[:-1] + 1))))
    first = places[new]
    row = np.searchsorted(begins, first, "right") - 1
    # Empty texts share their begin with the next one; the last of them is the text meant.
    return row, (hashes[at[new]] & KEY).view(np.int64), first, np.diff(np.append(new, len(places)))


def repeated_spans(
    docs: DataFrame,
    size: int = 50,
    gram: int = 20,
    doc_id: str = "doc_id",
    text: str = "text",
    hot: int = 500_000,
) -> DataFrame:
    """``doc_id, text, others, removed``: the maximal spans of bytes, ``array<struct<begin, end>>``, that
    are covered by a string of ``size`` bytes which also starts in a document with a smaller id.

    Bucket-pointer refinement over sampled suffixes:

    1. Sampling. Every string of ``size`` bytes is represented by one of its suffixes, chosen
       by its own bytes alone. About one suffix in fifteen is left to sort.
    2. Distribution. Suffixes with the same first ``gram`` bytes meet in one task. Such groups of
       a single document need no refinement and go, which is most of them. A group of more than
       ``hot`` suffixes is parted further, by the bytes of the strings themselves, so that no
       task holds it.
    3. Refinement (``bucket_pointers``). The suffixes left get their bytes back. Pieces of equal
       bytes are one class, of which only the smallest document is refined further. All places
       of the pieces are sorted into buckets by 8 bytes; then the members of each bucket that
       isn't single are sorted by the bucket pointers of the places 8, 16 and 18 bytes on, which
       the round before has refined itself, until buckets are single or ``size`` bytes deep. The
       least document of each last bucket decides.

    Exact copies of a whole text are settled first, by SHA-256, and stay out of the buckets. The
    order of the steps is fixed by content, nothing depends on how rows are spread. Hashes only
    decide where suffixes meet; strings are equal if their bytes are.

    Documents with an equal id don't remove from one another. A null id neither removes nor
    loses bytes. Texts under ``size`` bytes, empty or null (as empty) lose nothing. Repeated rows
    come out as often as they went in. An empty table gives no rows. Ids are integers. ``others``
    is a struct of the remaining columns, whatever their names, and is missing if there are none.
    """
    spark = docs.sparkSession
    ship(spark)
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in (doc_id, text)]
    others = ["others"] if rest else []
    ids = F.col(doc_id)
    if doc_id != "doc_id" or docs.schema[doc_id].dataType.simpleString() != "bigint":
        # Not where it changes nothing: an idle alias makes the three plans differ.
        ids = ids.cast("long").alias("doc_id")
    clean = docs.select(
        ids,
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        *([F.struct(*rest).alias("others")] if rest else []),
    )
    # The one shuffle of texts; the three uses below read it again, with all of its columns
    # and the same filter, without which it would be written twice.
    named = clean.where(F.col("doc_id").isNotNull())
    placed = named.repartition("doc_id")
    known = named.select(
        "doc_id", F.xxhash64("text").alias("tag"), F.unhex(F.sha2("text", 256)).alias("digest")
    )
    # Ids that several different texts carry, as a rule none: these texts need a tag.
    shared_ids = (
        known.groupBy("doc_id")
        .agg((F.min("tag") != F.max("tag")).alias("several"))
        .where("several")
        .select(F.col("doc_id").alias("shared_id"))
    )
    least = known.groupBy("digest").agg(F.min("doc_id").alias("least"))
    copies = (
        known.join(least, "digest")
        .where(F.col("doc_id") > F.col("least"))
        .select(F.col("doc_id").alias("copy_id"), F.col("tag").alias("copy_tag"))
        .distinct()
    )

    def tagged(df: DataFrame) -> DataFrame:
        tag = F.when(F.col("shared_id").isNotNull(), F.xxhash64("text")).otherwise(F.lit(0).cast("long"))
        joined = df.join(shared_ids, F.col("doc_id") == F.col("shared_id"), "left")
        return joined.withColumn("tag", tag).drop("shared_id")

    def same(left: str, right: str) -> Column:
        # Not an equality, so that the join keeps to the shuffle by id alone.
        return F.col(left).bitwiseXOR(F.col(right)) == 0

    singles = (
        placed.withColumn("own_tag", F.xxhash64("text"))
        .join(copies, (F.col("doc_id") == F.col("copy_id")) & same("own_tag", "copy_tag"), "left_anti")
        .select("doc_id", "text", *others)
    )

    def sampled(batch: pa.RecordBatch):
        data, begins, lengths = flat(batch.column("text"))
        row, key, first, n = sampled_suffixes(data, begins, lengths, size, gram)
        return data, begins, row, key, first, n

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, limit=1 << 19):
            _, _, row, key, _, _ = sampled(batch)
            ids = np.asarray(batch.column("doc_id"))
            yield pa.record_batch([pa.array(ids[row]), pa.array(key)], names=["doc_id", "key"])

    bucket = Window.partitionBy("key")
    shared = (
        singles.mapInArrow(sample, "doc_id long, key long")
        .withColumns(
            {
                "low": F.min("doc_id").over(bucket),
                "high": F.max("doc_id").over(bucket),
                "n": F.count("*").over(bucket),
            }
        )
        .where("low < high")
        .withColumn("key", F.when(F.col("n") > hot, F.col("key").bitwiseOR(F.lit(HOT))).otherwise(F.col("key")))
        .select("doc_id", "key")
    )
    by_doc = shared.groupBy("doc_id").agg(F.collect_list("key").alias("keys"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The same suffixes again, which is cheaper than to carry their places through the sort.
        for batch in small_batches(batches, limit=1 << 19):
            data, begins, row, key, first, n = sampled(batch)
            # Who has a shared key is in its bucket, so the keys of a batch can be looked up together.
            wanted = np.unique(np.asarray(batch.column("keys").flatten()))
            found = np.isin(key, wanted & ~HOT)
            row, key, first, n = row[found], key[found], first[found], n[found]
            large = np.isin(key | HOT, wanted)
            if large.any():
                row, key, first, n = _parted(grams(data, size), large, row, key, first, n)
            lengths = n + size - 1
            ends = np.cumsum(lengths)
            source = np.repeat(first - (ends - lengths), lengths) + np.arange(lengths.sum())
            offsets = np.concatenate(([0], ends)).astype(np.int32)
            pieces = pa.BinaryArray.from_buffers(
                pa.binary(), len(row), [None, pa.py_buffer(offsets), pa.py_buffer(data[source])]
            )
            at = pa.array(row)
            yield pa.record_batch(
                [
                    batch.column("doc_id").take(at),
                    batch.column("tag").take(at),
                    pa.array(key),
                    pa.array(first - begins[row]),
                    pieces,
                ],
                names=["doc_id", "tag", "key", "begin", "piece"],
            )

    pieces = (
        tagged(placed.join(by_doc, "doc_id"))
        .select("doc_id", "tag", "text", *others, "keys")
        .mapInArrow(cut, "doc_id long, tag long, key long, begin long, piece binary")
    )
    ordered = (
        pieces.repartition("key")
        .withColumn("least", F.min("doc_id").over(Window.partitionBy("key", "piece")))
        .sortWithinPartitions("key")
    )

    def refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            ids, least_ids = np.asarray(batch.column("doc_id")), np.asarray(batch.column("least"))
            repeated = ids > least_ids
            if repeated.any():
                again = batch.filter(pa.array(repeated))
                lengths = flat(again.column("piece"))[2]
                yield _spans(again, np.asarray(again.column("begin")), lengths)
            batch = batch.filter(pa.array(~repeated)).drop_columns(["least"])
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            # The last bucket may go on; while it is the only one, there is nothing to refine yet.
            if rows > 20_000 and held[0].column("key")[0] != batch.column("key")[-1]:
                table = pa.Table.from_batches(held).combine_chunks()
                keys = np.asarray(table["key"])
                whole = int(np.searchsorted(keys, keys[-1]))
                yield from _refined(table.slice(0, whole), size)
                held = table.slice(whole).to_batches()
                rows = len(keys) - whole
        if held:
            yield from _refined(pa.Table.from_batches(held).combine_chunks(), size)

    found = ordered.mapInArrow(refine, "doc_id long, tag long, begin long, length long")
    by_text = found.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("begin", "length")).alias("spans"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            merged = [_merged(x) for x in batch.column("spans").to_pylist()]
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("tag"), pa.array(merged, kind)],
                names=["span_id", "span_tag", "removed"],
            )

    spans = by_text.mapInArrow(merge, "span_id long, span_tag long, removed array<struct<begin: long, end: long>>")
    n_bytes = F.octet_length("text").cast("long")
    none = F.array().cast("array<struct<begin: bigint, end: bigint>>")
    everything = F.array(F.struct(F.lit(0).cast("long").alias("begin"), n_bytes.alias("end")))
    # New names for the columns: a union of the same ones would change the plan of the texts'
    # shuffle, which could not be read again then.
    nameless = clean.where(F.col("doc_id").isNull()).select(
        F.lit(None).cast("long").alias("doc_id"), *[F.col(c).alias(c) for c in ("text", *others)], none.alias("removed")
    )
    return (
        tagged(placed)
        .withColumn("own_tag", F.xxhash64("text"))
        .join(spans, (F.col("doc_id") == F.col("span_id")) & same("tag", "span_tag"), "left")
        .join(copies, (F.col("doc_id") == F.col("copy_id")) & same("own_tag", "copy_tag"), "left")
        .select(
            "doc_id",
            "text",
            *others,
            F.when(F.col("copy_id").isNotNull() & (n_bytes >= size), everything)
            .otherwise(F.coalesce("removed", none))
            .alias("removed"),
        )
        .unionByName(nameless)
    )


def _spans(rows: pa.RecordBatch | pa.Table, begins: np.ndarray, lengths: np.ndarray) -> pa.RecordBatch:
    def whole(name: str) -> pa.Array:
        column = rows.column(name)
        return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column

    return pa.record_batch(
        [whole("doc_id"), whole("tag"), pa.array(begins, pa.int64()), pa.array(lengths, pa.int64())],
        names=["doc_id", "tag", "begin", "length"],
    )


def _parted(strings: np.ndarray, large: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """``row, key, first, n`` with the suffixes of large buckets as single strings, each in a bucket
    named by the hash of its bytes."""
    row, key, first, n = columns
    times = np.where(large, n, 1)
    ends = np.cumsum(times)
    at = np.repeat(np.arange(len(row)), times)
    large, begin = large[at], first[at] + np.arange(len(at)) - (ends - times)[at]
    key = key[at]
    key[large] = (strings[begin[large]] & KEY).view(np.int64)
    return row[at], key, begin, np.where(large, 1, n[at])


def bucket_pointers(data: np.ndarray, begins: np.ndarray, lengths: np.ndarray, size: int) -> np.ndarray:
    """For each place the pointer to its bucket: equal for two places, with ``size`` bytes left in
    their pieces, exactly if those bytes are equal.

    A pointer is the rank of the bucket's first member. The first buckets are of 8 bytes (or
    ``size``). Places equal in ``depth`` bytes are put in order by the pointers of the places
    ``step <= depth`` on, and then agree in ``depth + step`` bytes. A single place is done: its
    pointer is its own, at any depth.
    """
    depth = min(8, size)
    left = np.repeat(begins + lengths, lengths) - np.arange(len(data))
    words = np.zeros(max(0, len(data) - depth + 1), np.uint64)
    for j in range(depth):
        words = (words << np.uint64(8)) | data[j : j + len(words)]
    places = np.flatnonzero(left >= depth)
    pointer = np.zeros(len(data), np.int64)
    keys, base = words[places], np.zeros(len(places), np.int64)
    while True:
        order = np.argsort(keys, kind="stable")
        places, keys, base = places[order], keys[order], base[order]
        index = np.arange(len(places))
        parent = np.maximum.accumulate(np.where(_begins(base), index, 0))
        new = _begins(keys)
        # Where the bucket was, and how many of its members come before.
        pointer[places] = base + np.maximum.accumulate(np.where(new, index, 0)) - parent
        if depth >= size:
            return pointer
        step = min(depth, size - depth)
        single = new & np.append(new[1:], True)
        places = places[~single]
        places = places[left[places] >= depth + step]
        base = pointer[places]
        keys = (base << np.int64(32)) | pointer[places + step]
        depth += step


def _begins(values: np.ndarray) -> np.ndarray:
    """Which of sorted values differ from the one before."""
    return np.concatenate((np.ones(min(1, len(values)), bool), values[1:] != values[:-1]))


def _refined(table: pa.Table, size: int) -> Iterator[pa.RecordBatch]:
    """Spans of the rows whose strings a smaller document of their bucket holds."""
    keys, ids = np.asarray(table["key"]), np.asarray(table["doc_id"])
    if not len(keys):
        return
    first = np.concatenate(([True], keys[1:] != keys[:-1]))
    starts = np.flatnonzero(first)
    bucket = np.cumsum(first) - 1
    mixed = np.minimum.reduceat(ids, starts) < np.maximum.reduceat(ids, starts)
    table = table.filter(pa.array(mixed[bucket]))
    if not table.num_rows:
        return
    ids = np.asarray(table["doc_id"])
    data, begins, lengths = flat(table["piece"])
    pointer = bucket_pointers(data, begins, lengths, size)
    counts = lengths - size + 1
    row = np.repeat(np.arange(len(counts)), counts)
    ends = np.cumsum(counts)
    place = begins[row] + np.arange(len(row)) - (ends - counts)[row]
    order = np.argsort(pointer[place], kind="stable")
    owner = ids[row][order]
    new = _begins(pointer[place][order])
    least = np.minimum.reduceat(owner, np.flatnonzero(new))[np.cumsum(new) - 1]
    covered = np.empty(len(row), bool)
    covered[order] = least < owner
    # A gap after each piece keeps runs apart.
    spread = np.zeros(len(row) + len(counts), bool)
    spread[np.arange(len(row)) + row] = covered
    run_begin, run_end = runs(spread)
    if not len(run_begin):
        return
    which = np.searchsorted(ends + np.arange(1, len(counts) + 1), run_begin, "right")
    offset = run_begin - (ends - counts)[which] - which
    yield _spans(
        table.take(pa.array(which)),
        np.asarray(table["begin"])[which] + offset,
        run_end - run_begin + size - 1,
    )


def _merged(spans: list[dict]) -> list[dict]:
    out: list[dict] = []
    for begin, end in sorted((s["begin"], s["begin"] + s["length"]) for s in spans):
        if out and begin <= out[-1]["end"]:
            out[-1]["end"] = max(end, out[-1]["end"])
        else:
            out.append({"begin": begin, "end": end})
    return out


def kept_ranges(removed: Column, n_bytes: Column) -> Column:
    """What lies between removed spans, ``array<struct<begin, end>>``."""
    zero = F.lit(0).cast("long")
    return F.transform(
        F.sequence(F.lit(0), F.size(removed)),
        lambda i: F.struct(
            F.coalesce(F.get(removed, i - 1)["end"], zero).alias("begin"),
            F.coalesce(F.get(removed, i)["begin"], n_bytes).alias("end"),
        ),
    )


def kept_text(text: Column, removed: Column) -> Column:
    """The bytes left, concatenated; a string column may hold any bytes."""
    row = F.struct(
        text.cast("binary").alias("all"),
        removed.alias("removed"),
        F.octet_length(text).cast("long").alias("size"),
    )
    return let(
        row,
        lambda v: F.array_join(
            F.transform(
                kept_ranges(v["removed"], v["size"]),
                lambda r: F.substr(
                    v["all"], (r["begin"] + 1).cast("int"), (r["end"] - r["begin"]).cast("int")
                ).cast("string"),
            ),
            "",
        ),
    )


def remove_repeated_bytes(
    docs: DataFrame, size: int = 50, gram: int = 20, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows and columns of ``docs``, texts without their repeated spans. A span gives up the bytes
    of a character that it holds in part, so that texts stay valid."""
    found = repeated_spans(docs, size, gram, doc_id, text)
    kind = found.schema["doc_id"].dataType.simpleString()
    rest = found.columns[2:-1]
    others = "".join(f", others {found.schema[c].dataType.simpleString()}" for c in rest)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts = [
                _without(t.encode(), spans).decode()
                for t, spans in zip(batch.column("text").to_pylist(), batch.column("removed").to_pylist(), strict=True)
            ]
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(texts, pa.string()), *[batch.column(c) for c in rest]],
                names=["doc_id", "text", *rest],
            )

    out = found.mapInArrow(cut, f"doc_id {kind}, text string{others}")
    columns = {doc_id: F.col("doc_id"), text: F.col("text")}
    return out.select(
        *[columns[c].alias(c) if c in columns else F.col(f"others.`{c}`") for c in docs.columns]
    )


def _without(data: bytes, spans: list[dict]) -> bytes:
    kept, at = [], 0
    for span in spans:
        begin, end = span["begin"], span["end"]
        while begin < end and data[begin] & 0xC0 == 0x80:
            begin += 1
        while begin < end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        kept.append(data[at:begin])
        at = end
    return b"".join([*kept, data[at:]])
