"""Near-duplicate documents by bottom-k sketches."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.bytestext import flat, scramble, shingle_sets
from meterlake.llm.common import Scratch, ship, small_batches
from meterlake.llm.components import components

KEY = "doc_id long, n_shingles long, set_a long, set_b long"
# A frequent shingle lies in SEEN documents at least; at most LISTED shingles are frequent.
SEEN, LISTED = 96, 1 << 20
BUCKETS, BLOCK, SHIFT = 1 << 22, 1 << 14, np.uint64(42)
# Sketches are stored with the top bit flipped: signed longs then have the order of the hashes.
TOP = np.uint64(1 << 63)


def _sets(batches: Iterator[pa.RecordBatch], words: int):
    for batch in small_batches(batches, limit=1 << 18):
        yield batch, shingle_sets(*flat(batch.column("text")), words)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.view(np.int64)))


def bucket_counts(clean: DataFrame, words: int) -> np.ndarray:
    """How many shingles of all documents fall into each of ``BUCKETS`` buckets, by their first bits.

    Each task counts its own documents and hands on packed blocks of counters, which are added up
    block by block. What passes the driver has a fixed size.
    """

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.uint32)
        for _, sets in _sets(batches, words):
            for s in sets:
                np.add.at(counts, (s >> SHIFT).astype(np.int64), np.uint32(1))
        blocks = counts.reshape(-1, BLOCK)
        used = np.flatnonzero(blocks.any(axis=1))
        packed = [zlib.compress(blocks[k].tobytes(), 1) for k in used]
        yield pa.record_batch([pa.array(used, pa.int64()), pa.array(packed, pa.binary())], names=["block", "counts"])

    def add(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        total = np.zeros(BLOCK, np.int64)
        for packed in rows.column("counts"):
            total += np.frombuffer(zlib.decompress(packed.as_py()), np.uint32)
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "counts": [zlib.compress(total.tobytes(), 1)]})

    kind = "block long, counts binary"
    counts = np.zeros((BUCKETS // BLOCK, BLOCK), np.int64)
    for row in clean.mapInArrow(tally, kind).groupBy("block").applyInArrow(add, kind).collect():
        counts[row["block"]] = np.frombuffer(zlib.decompress(row["counts"]), np.int64)
    return counts.ravel()


def frequent_shingles(clean: DataFrame, words: int) -> np.ndarray:
    """Hashes of the shingles that many documents share, the most frequent last.

    All shingles of all documents are counted. Frequent is what ``SEEN`` documents hold or more, and
    a ``LISTED``-th part of all shingles or more: so many can't be more than ``LISTED``, and every
    task can hold the list. A shingle is no more frequent than its bucket (``bucket_counts``), so
    only those of buckets that reach the limit are counted one by one. The list decides the order in
    which values are retained, which any order does rightly, and so only the length of inverted lists.
    """
    buckets = bucket_counts(clean, words)
    limit = max(SEEN, -(-int(buckets.sum()) // LISTED))
    full = buckets >= limit
    if not full.any():
        return np.zeros(0, np.int64)
    marked = clean.sparkSession.sparkContext.broadcast(np.packbits(full))

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        may_be = np.unpackbits(marked.value).view(bool)
        for _, sets in _sets(batches, words):
            values = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            values = values[may_be[(values >> SHIFT).astype(np.int64)]]
            yield pa.record_batch([pa.array(values.view(np.int64))], names=["value"])

    counts = clean.mapInArrow(explode, "value long").groupBy("value").count().where(F.col("count") >= limit)
    return counts.orderBy("count", F.desc("value")).select("value").toArrow().column("value").to_numpy()


def signatures(
    clean: DataFrame, frequent: np.ndarray, words: int, sketch: int, rare: int, common: int
) -> DataFrame:
    """For each document: size and two checksums of its set, its bottom-k sketch, and the values
    it retains for the inverted lists.

    The sketch is the ``sketch`` least hashes, as signed longs of the same order. For the lists the
    same hashes are ordered with the frequent ones behind all others. The least ``rare`` of the
    others are retained, and, where frequent ones make up half of the set or more, the least
    ``common`` of those too.
    """
    ranked = clean.sparkSession.sparkContext.broadcast(np.sort(frequent.view(np.uint64)))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = ranked.value
        for batch, sets in _sets(batches, words):
            low, kept, first, second = [], [], [], []
            for s in sets:
                low.append(s[:sketch] ^ TOP)
                if len(hot) and len(s):
                    at = np.minimum(np.searchsorted(hot, s), len(hot) - 1)
                    often = hot[at] == s
                    few = s[~often][:rare]
                    kept.append(np.concatenate((few, s[often][:common])) if 2 * often.sum() >= len(s) else few)
                else:
                    kept.append(s[:rare])
                first.append(scramble(s).sum(dtype=np.uint64))
                second.append(scramble(s ^ np.uint64(0x5DEECE66D)).sum(dtype=np.uint64))
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(np.array(first, np.uint64).view(np.int64)),
                    pa.array(np.array(second, np.uint64).view(np.int64)),
                    _lists(low),
                    _lists(kept),
                ],
                names=["doc_id", "n_shingles", "set_a", "set_b", "sketch", "retained"],
            )

    return clean.mapInArrow(sign, f"{KEY}, sketch array<long>, retained array<long>")


def may_link(percent: int, sketch: int, a: str = "a", b: str = "b") -> Column:
    """Whether a pair can be alike enough: by the sizes, then by the sketch of the union.

    The least values of both sketches together are a sample of the union; those that both hold
    estimate the Jaccard index. A pair passes down to five standard deviations under the
    limit, so of true links right at it up to 1.4 in a million fail the estimate; a union no
    larger than its sketch is judged exactly.
    """
    size_a, size_b = F.col(f"{a}.n"), F.col(f"{b}.n")
    sizes = 100 * F.least(size_a, size_b) >= percent * F.greatest(size_a, size_b)
    sa, sb = F.col(f"{a}.sketch"), F.col(f"{b}.sketch")
    union = F.slice(F.array_sort(F.array_union(sa, sb)), 1, sketch)
    both = F.size(F.array_intersect(union, F.array_intersect(sa, sb)))
    share = percent / 100
    slack = F.when(F.size(union) < sketch, F.lit(0.0)).otherwise(
        5 * F.sqrt(F.lit(share * (1 - share)) / F.size(union))
    )
    return sizes & (both >= (share - slack) * F.size(union))


def near_duplicates(
    docs: DataFrame,
    percent: int = 75,
    words: int = 5,
    sketch: int = 64,
    rare: int = 32,
    common: int = 16,
    short: int = 32,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id, n_shingles, component_id``: documents joined by links of ``percent`` or more.

    1. Documents with the same set of shingles become one node, their smallest id.
    2. Nodes retain values of one hash function (``signatures``); the inverted list of a value
       names the nodes that share it. Two sets with a Jaccard index of 3/4 share none of 32
       retained values with a chance under 1e-19, or, where nearly half of a set is frequent
       shingles left out of the lists, under three in a million.
    3. A list of up to ``short`` nodes gives its pairs. Of longer ones each
       node meets three of their leaders, so n nodes make 3 n pairs, however long the lists.
    4. Pairs pass by the estimate on the union's sketch, then by exact comparison of full sets.
    5. Nodes of long lists that still hold several components are taken up again with their full
       sets: once more with leaders, now those that have fewest shingles of their own, then,
       for what is left, with the nodes of other components that the sets don't rule out
       (``_prefix_pairs``). A pair left out would join what is joined already, so no link
       between components is lost and nothing is capped.

    A null or empty text, or one without words, has an empty set and no links. Rows that share an
    id count as one document for the links. A null id is a node of no component (null). Repeated
    rows come out as often as they went in. An empty table gives no rows. Ids are integers. Other
    columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark)
    clean = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    signed = scratch.store(
        signatures(clean, frequent_shingles(clean, words), words, sketch, rare, common)
    )
    filled = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    same_set = ["n_shingles", "set_a", "set_b"]
    least = filled.groupBy(*same_set).agg(F.min("doc_id").alias("node"))
    members = scratch.store(
        filled.select("doc_id", *same_set).join(least, same_set).select("doc_id", "node").distinct()
    )
    nodes = (
        filled.join(members.where("doc_id = node").select("doc_id"), "doc_id")
        .select(F.col("doc_id").alias("node"), F.col("n_shingles").alias("n"), "sketch", "retained", *same_set)
        .dropDuplicates(["node", *same_set])
        .drop("set_a", "set_b")
    )
    listed = nodes.select("node", F.explode("retained").alias("value"))
    sizes = listed.groupBy("value").agg(F.count("*").alias("size")).where("size > 1")
    lists = scratch.store(listed.join(sizes, "value"))
    signs = scratch.store(nodes.select("node", "n", "sketch").join(lists.select("node").distinct(), "node"))

    def pairs(found: DataFrame) -> DataFrame:
        """Pairs of nodes that pass the estimate."""
        near = F.struct("node", "n", "sketch")
        known = signs.select("node", near.alias("sign"))
        a = known.withColumnsRenamed({"node": "x", "sign": "a"})
        b = known.withColumnsRenamed({"node": "y", "sign": "b"})
        return (
            found.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
            .distinct()
            .join(a, "x")
            .join(b, "y")
            .where(may_link(percent, sketch))
            .select("x", "y")
        )

    few = (
        lists.where(F.col("size") <= short)
        .groupBy("value")
        .agg(F.sort_array(F.collect_set("node")).alias("m"))
        .select(
            F.explode(
                F.flatten(
                    F.transform(
                        "m",
                        lambda x, i: F.transform(
                            F.slice("m", i + 2, short), lambda y: F.struct(x.alias("x"), y.alias("y"))
                        ),
                    )
                )
            ).alias("p")
        )
        .select("p.x", "p.y")
    )
    long_ = lists.where(F.col("size") > short).select("value", "node")
    # The node of a list with most values in long lists has least of its own: it lies in the
    # middle of a group of copies, where most links are.
    stars = _best_leaders(long_, long_.groupBy("node").agg(F.count("*").alias("rank")))
    candidates = scratch.store(pairs(few.unionByName(stars)))
    # The full sets that any later step needs, in one pass over the texts.
    needed = candidates.select(F.explode(F.array("x", "y")).alias("node")).union(long_.select("node")).distinct()
    sets = scratch.store(_full_sets(clean, needed, words))
    links = scratch.store(_verified(candidates, sets, percent))
    labels = scratch.store(components(links, scratch))

    # Long lists with several components left.
    left = scratch.store(_unsettled(long_, labels))
    if not left.where("outside").isEmpty():
        rows = scratch.store(
            sets.join(left.select("node"), "node", "left_semi").select(
                "node", F.size("all").cast("long").alias("n"), F.explode("all").alias("value")
            )
        )
        counts = scratch.store(rows.groupBy("value").agg(F.count("*").alias("often")))
        # Once more by leaders, now those with fewest shingles of their own in their full sets.
        own = rows.join(counts, "value").groupBy("node").agg(F.count_if(F.col("often") == 1).alias("own"))
        outside = left.where("outside").select(F.col("node").alias("y"))
        stars = _best_leaders(long_, own.select("node", (-F.col("own")).alias("rank"))).join(outside, "y", "left_semi")
        stars = stars.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
        stars = scratch.store(stars.join(candidates, ["x", "y"], "left_anti"))
        links = scratch.store(links.unionByName(_verified(stars, sets, percent)))
        labels = scratch.store(components(links, scratch))
        left = scratch.store(_unsettled(long_, labels))
        seen = candidates.select("x", "y").unionByName(stars)
        rest = _prefix_pairs(left, rows, counts, percent).join(seen, ["x", "y"], "left_anti")
        more = scratch.store(_verified(scratch.store(rest), sets, percent))
        if not more.isEmpty():
            labels = scratch.store(components(links.unionByName(more), scratch))

    of_doc = members.groupBy("doc_id").agg(F.min("node").alias("node"))
    found = of_doc.join(labels, "node", "left").select(
        "doc_id", F.coalesce("component", "node").alias("component_id")
    )
    return signed.select("doc_id", "n_shingles").join(found, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def _best_leaders(lists: DataFrame, ranks: DataFrame) -> DataFrame:
    """Pairs ``x, y``: each node ``y`` and, of the leaders of its lists, the three of highest rank.

    A list's leader is its node of highest ``rank``. So n nodes make 3 n pairs at most, however
    long and many the lists are.
    """
    by_value = Window.partitionBy("value").orderBy(F.desc("rank"), F.xxhash64("node"), "node")
    leaders = (
        lists.join(ranks, "node")
        .withColumn("r", F.row_number().over(by_value))
        .where("r = 1")
        .select("value", F.col("node").alias("x"), "rank")
    )
    by_node = Window.partitionBy("y").orderBy(F.desc("rank"), F.xxhash64("x"), "x")
    return (
        lists.join(leaders, "value")
        .select("x", F.col("node").alias("y"), "rank")
        .where("x <> y")
        .distinct()
        .withColumn("r", F.row_number().over(by_node))
        .where("r <= 3")
        .select("x", "y")
    )


def _unsettled(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """``node, component, outside``: the nodes of lists that hold several components, and whether a
    node is outside the largest one of such a list."""
    placed = lists.join(labels, "node", "left").select(
        "value", "node", F.coalesce("component", "node").alias("component")
    )
    shares = placed.groupBy("value", "component").agg(F.count("*").alias("n"))
    largest = shares.groupBy("value").agg(
        F.max_by("component", F.struct("n", "component")).alias("largest"), F.count("*").alias("parts")
    )
    return (
        placed.join(largest.where("parts > 1"), "value")
        .groupBy("node")
        .agg(
            F.max("component").alias("component"),
            F.bool_or(F.col("component") != F.col("largest")).alias("outside"),
        )
    )


def _full_sets(clean: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """``node, all``: the whole shingle sets of some nodes."""

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in _sets(batches, words):
            yield pa.record_batch([batch.column("doc_id"), _lists(sets)], names=["node", "all"])

    wanted = clean.join(nodes, F.col("doc_id") == F.col("node"), "left_semi")
    return wanted.mapInArrow(full, "node long, all array<long>")


def _prefix_pairs(left: DataFrame, rows: DataFrame, counts: DataFrame, percent: int) -> DataFrame:
    """Pairs ``x, y`` of different components that full sets don't rule out.

    Each set is ordered from its rarest shingle on. Sets of sizes a and b with a Jaccard index
    of p per cent share p / (100 + p) of a + b shingles, so the first they share must leave as many
    after it in both. Copies with a good part of shingles of their own drop out here before they
    meet anything; no link is lost.
    """
    rare_first = Window.partitionBy("node").orderBy("often", "value")
    prefix = (
        rows.join(counts, "value")
        .withColumn("before", F.row_number().over(rare_first) - 1)
        .where(100 * (F.col("n") - F.col("before")) >= percent * F.col("n"))
        .where("often > 1")
        .select("node", "n", "value", "before")
        .join(left, "node")
    )
    a = prefix.where("outside").select(
        "value", F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("before").alias("before_a"),
        F.col("component").alias("component_a"),
    )
    b = prefix.select(
        "value", F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("before").alias("before_b"),
        F.col("component").alias("component_b"),
    )
    most = F.least(F.col("n_a") - F.col("before_a"), F.col("n_b") - F.col("before_b"))
    return (
        a.join(b, "value")
        .where("component_a <> component_b")
        .where((100 + percent) * most >= percent * (F.col("n_a") + F.col("n_b")))
        .select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"))
        .distinct()
    )


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b``: the pairs whose full sets are alike enough."""
    a = sets.withColumnsRenamed({"node": "x", "all": "all_x"})
    b = sets.withColumnsRenamed({"node": "y", "all": "all_y"})
    both = F.size(F.array_intersect("all_x", "all_y"))
    union = F.size("all_x") + F.size("all_y") - both
    return (
        pairs.join(a, "x").join(b, "y")
        .where(100 * both >= percent * union)
        .select(F.col("x").alias("a"), F.col("y").alias("b"))
    )
