"""Approximate nearest neighbours by inner product, along several space-filling curves."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.common import Scratch, ship


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each cell (one row of ``bits``-bit coordinates) along the Hilbert curve.

    The coordinates are turned bit by bit into the curve's own axes, then interleaved.
    """
    axes = cells.T.astype(np.uint64).copy()
    zero = np.uint64(0)
    for bit in range(bits - 1, 0, -1):
        here, below = np.uint64(1 << bit), np.uint64((1 << bit) - 1)
        for i in range(len(axes)):
            flip = (axes[i] & here) != 0
            swap = np.where(flip, zero, (axes[0] ^ axes[i]) & below)
            axes[0] ^= np.where(flip, below, swap)
            axes[i] ^= swap
    for i in range(1, len(axes)):
        axes[i] ^= axes[i - 1]
    carry = np.zeros_like(axes[0])
    for bit in range(bits - 1, 0, -1):
        carry ^= np.where((axes[-1] & np.uint64(1 << bit)) != 0, np.uint64((1 << bit) - 1), zero)
    axes ^= carry
    keys = np.zeros_like(axes[0])
    for bit in range(bits - 1, -1, -1):
        for axis in axes:
            keys = keys << np.uint64(1) | (axis >> np.uint64(bit)) & np.uint64(1)
    return keys.view(np.int64)


@dataclass(frozen=True)
class Curves:
    """Random projections, each to a few axes, and a shift of the grid for each."""

    axes: np.ndarray  # curve, dimension, axis
    centre: np.ndarray  # curve, axis
    spread: np.ndarray
    shift: np.ndarray
    bits: int
    top: float  # the largest squared norm

    def keys(self, vectors: np.ndarray, as_query: bool) -> np.ndarray:
        """Keys by curve and row. One more coordinate makes all rows equally long, so that the
        nearest by distance is the one of largest inner product; a query has none of it."""
        norm2 = (vectors**2).sum(1)
        if as_query:
            vectors, extra = vectors * np.sqrt(self.top / norm2)[:, None], np.zeros(len(vectors))
        else:
            extra = np.sqrt(np.maximum(self.top - norm2, 0))
        whole = np.hstack([vectors, extra[:, None]])
        out = []
        for axes, centre, spread, shift in zip(self.axes, self.centre, self.spread, self.shift, strict=True):
            unit = 1 / (1 + np.exp(-1.7 * (whole @ axes - centre) / spread))  # about even cells
            cells = ((unit + shift) / 2 * (1 << self.bits)).astype(np.int64)
            out.append(hilbert_keys(np.minimum(cells, (1 << self.bits) - 1), self.bits))
        return np.array(out)


def fit_curves(sample: np.ndarray, top: float, curves: int, axes: int, bits: int, seed: int) -> Curves:
    random = np.random.default_rng(seed)
    size = sample.shape[1] + 1
    axes = min(axes, size)
    turned = np.array([np.linalg.qr(random.standard_normal((size, size)))[0][:, :axes] for _ in range(curves)])
    whole = np.hstack([sample, np.sqrt(np.maximum(top - (sample**2).sum(1), 0))[:, None]])
    placed = np.einsum("nd,cda->nca", whole, turned)
    return Curves(
        turned, placed.mean(0), np.maximum(placed.std(0), 1e-12), random.random((curves, axes)), bits, top
    )


def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    values = np.asarray(column.flatten(), np.float64)
    return values.reshape(n, -1) if n else values.reshape(0, 1)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the k best finite scores of each row, ties to the smaller id."""
    rows, columns = [], []
    for i, line in enumerate(scores):
        usable = np.flatnonzero(line > -np.inf)
        if len(usable) > k:
            least = np.partition(line[usable], -k)[-k]
            usable = usable[line[usable] >= least]
            usable = usable[np.lexsort((ids[usable], -line[usable]))[:k]]
        rows.append(np.full(len(usable), i))
        columns.append(usable)
    return np.concatenate(rows), np.concatenate(columns)


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    curves: int = 8,
    axes: int = 8,
    bits: int = 7,
    recall: float = 0.95,
    fit_rows: int = 4096,
    trial_queries: int = 128,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    seed: int = 5,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each id of ``queries`` (one column ``vec_id``, ids
    of ``vectors``) its ``k`` nearest other rows by inner product in double precision.

    Vectors are projected to a few random axes, several times, and ordered along a Hilbert curve
    over a shifted grid of each. An ordering is range-partitioned and cut into blocks; a query
    meets the rows up to ``window`` places away on either side, in every ordering, and what
    the orderings find is merged and ranked by exact scores. The window is set by measuring:
    for ``trial_queries`` queries, chosen by a hash, the true neighbours are found by one scan,
    and the window is the least that would have found ``recall`` of them. It is narrow on data
    with structure and wide where there is none to use. Axes are fitted to ``fit_rows`` rows;
    every row is indexed.

    Equal vectors are one entry of the index with their k + 1 smallest ids, which is all that
    can appear, so copies fill no window. Vectors that are null, zero, hold a null or a
    non-finite component, or are not of the most frequent length take no part, neither do null
    ids. Ties go to the smaller id. A repeated id counts once for each different vector. With no
    vectors or no queries there are no rows. Other columns are not read.
    """
    spark = vectors.sparkSession
    ship(spark)
    scratch = Scratch(spark)
    usable = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v")
    ).where(
        "vec_id IS NOT NULL AND v IS NOT NULL AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) "
        "AND abs(x) < double('Infinity')) AND exists(v, x -> x <> 0)"
    )
    sizes = usable.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    kind = "query_id long, rank int, vec_id long, score double"
    if sizes is None:
        return spark.createDataFrame([], kind)
    # Negative zero is zero, as grouping takes it.
    usable = usable.where(F.size("v") == sizes["n"]).withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))

    equal = Window.partitionBy("v")
    asked = queries.select(F.col("vec_id").cast("long").alias("vec_id")).distinct().withColumn("asked", F.lit(True))
    marked = scratch.store(
        usable.distinct()
        .join(asked, "vec_id", "left")
        .withColumn("entry", F.min("vec_id").over(equal))
        .withColumn("place", F.row_number().over(equal.orderBy("vec_id")))
        .select("vec_id", "v", "entry", "place", F.coalesce("asked", F.lit(False)).alias("asked"))
    )
    wanted = marked.where("asked").select(F.col("vec_id").alias("query_id"), F.col("entry").alias("q"))
    ids = marked.where(F.col("place") <= k + 1).select("entry", "vec_id")
    entries = scratch.store(
        marked.where("place = 1").select("entry", "v").join(
            wanted.select(F.col("q").alias("entry")).distinct().withColumn("is_query", F.lit(True)), "entry", "left"
        ).withColumn("is_query", F.coalesce("is_query", F.lit(False)))
    )

    def chosen(df: DataFrame, n: int) -> list:
        return df.orderBy(F.xxhash64("entry", F.lit(seed)), "entry").limit(n).collect()

    trial = chosen(entries.where("is_query"), trial_queries)
    if not trial:
        return spark.createDataFrame([], kind)
    top = entries.agg(F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).first()[0]
    sample = np.array([r["v"] for r in chosen(entries, fit_rows)])
    fitted = fit_curves(sample, top, curves, axes, bits, seed)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["curve", "key", "query", "entry", "v"]
        for batch in batches:
            asked_rows = np.flatnonzero(np.asarray(batch.column("is_query")))
            for rows, as_query in ((np.arange(batch.num_rows), False), (asked_rows, True)):
                if not len(rows):
                    continue
                part = batch.take(pa.array(rows))
                for curve, keys in enumerate(fitted.keys(_matrix(part.column("v")), as_query)):
                    n = len(rows)
                    yield pa.record_batch(
                        [
                            pa.array(np.full(n, curve, np.int32)),
                            pa.array(keys),
                            pa.array(np.full(n, as_query)),
                            part.column("entry"),
                            part.column("v"),
                        ],
                        names=names,
                    )

    placed = entries.mapInArrow(place, "curve int, key long, query boolean, entry long, v array<double>")
    order = ["curve", "key", "query", "entry"]
    # Written before it is numbered: bounds of ranges may differ from one run to the next.
    ordered = scratch.store(
        placed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    )
    # One row a partition and curve: how many vectors come before it on that curve.
    counts = ordered.groupBy("curve", "part").agg(F.count_if(~F.col("query")).alias("n"))
    so_far = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col("curve").alias("c"), F.col("part").alias("p"), F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias("start")
    )
    inside = Window.partitionBy("curve", "part").orderBy("key", "query", "entry")
    # A vector's rank is the number of vectors before it, a query's likewise.
    ranked = scratch.store(
        ordered.withColumn(
            "within", F.sum(F.when(F.col("query"), 0).otherwise(1)).over(inside) - F.when(F.col("query"), 0).otherwise(1)
        )
        .join(starts, (F.col("curve") == F.col("c")) & (F.col("part") == F.col("p")))
        .select("curve", "query", "entry", "v", (F.col("start") + F.col("within")).alias("rank"))
    )
    window = _window(entries, ranked, trial, k, recall)

    block = int(min(max(window, 1024), 8192))
    rows = ranked.where("NOT query").withColumn("block", F.expr(f"rank div {block}"))
    visits = (
        ranked.where("query")
        .withColumn(
            "block",
            F.explode(
                F.sequence(F.expr(f"greatest(rank - {window}, 0) div {block}"), F.expr(f"(rank + {window}) div {block}"))
            ),
        )
    )

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows and right.num_rows:
            ids, at = np.asarray(right["entry"]), np.asarray(right["rank"])
            mine = np.asarray(left["rank"])
            data = _matrix(right["v"])
            found = []
            for first in range(0, len(mine), 256):
                some = slice(first, first + 256)
                scores = _matrix(left["v"].slice(first, 256)) @ data.T
                scores[np.abs(mine[some, None] - at[None, :]) > window] = -np.inf
                row, column = _best(scores, ids, k + 1)
                found.append((row + first, column, scores[row, column]))
            row, column, value = (np.concatenate(x) for x in zip(*found, strict=True))
            return pa.table(
                {"q": pa.array(np.asarray(left["entry"])[row]), "entry": pa.array(ids[column]), "score": pa.array(value)}
            )
        return pa.table({"q": pa.array([], pa.int64()), "entry": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})

    met = (
        visits.groupBy("curve", "block")
        .cogroup(rows.groupBy("curve", "block"))
        .applyInArrow(score, "q long, entry long, score double")
    )
    # Orderings may differ in a score's last bit; the largest stands for all.
    merged = met.groupBy("q", "entry").agg(F.max("score").alias("score"))
    ranks = Window.partitionBy("q").orderBy(F.desc("score"), "entry")
    best = merged.withColumn("r", F.row_number().over(ranks)).where(F.col("r") <= k + 1).drop("r")
    expanded = (
        wanted.join(best, "q").join(ids, "entry").where("vec_id <> query_id").select("query_id", "vec_id", "score")
    )
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        expanded.withColumn("rank", F.row_number().over(final))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _window(entries: DataFrame, ranked: DataFrame, trial: list, k: int, recall: float) -> int:
    """The least distance, along the nearest curve, within which ``recall`` of the trial
    queries' true neighbours lie. What reaches the driver is bounded by the trial's size."""
    asked, names = np.array([r["v"] for r in trial]), np.array([r["entry"] for r in trial])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column("entry"))
            scores = asked @ _matrix(batch.column("v")).T
            scores[names[:, None] == ids[None, :]] = -np.inf
            row, column = _best(scores, ids, k)
            yield pa.record_batch(
                [pa.array(names[row]), pa.array(ids[column]), pa.array(scores[row, column])],
                names=["q", "entry", "score"],
            )

    per_query = Window.partitionBy("q").orderBy(F.desc("score"), "entry")
    true = (
        entries.select("entry", "v")
        .mapInArrow(scan, "q long, entry long, score double")
        .withColumn("r", F.row_number().over(per_query))
        .where(F.col("r") <= k)
        .select("q", "entry")
    )
    found = ranked.where("NOT query").select("curve", "entry", "rank").join(true, "entry")
    own = ranked.where("query").select("curve", F.col("entry").alias("q"), F.col("rank").alias("own"))
    distances = (
        found.join(own, ["curve", "q"])
        .groupBy("q", "entry")
        .agg(F.min(F.abs(F.col("rank") - F.col("own"))).alias("d"))
        .select("d")
        .collect()
    )
    if not distances:
        return 1
    return int(np.quantile([r["d"] for r in distances], recall, method="higher")) + 1
