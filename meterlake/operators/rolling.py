"""Rolling mean over a time range, for keys of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.functions.numeric import SCALE, as_exact, is_finite

# Windows per chunk: a quarter of the sums is copied, a chunk spans five windows at most.
CHUNK_WINDOWS = 4
NAN, PLUS, MINUS = float("nan"), float("inf"), float("-inf")


def join_back(df: DataFrame, small: DataFrame, keys: dict[str, str]) -> DataFrame:
    """Left join on null-safe equality of ``df`` columns with ``small`` columns, which are dropped."""
    condition = F.lit(True)
    for left, right in keys.items():
        condition = condition & df[left].eqNullSafe(small[right])
    return df.join(small, condition, "left").drop(*keys.values())


def rolling_mean(
    df: DataFrame,
    keys: list[str],
    ts: str,
    value: str,
    out: str,
    seconds: int,
    scale: int = SCALE,
) -> DataFrame:
    """Mean of ``value`` per key over rows from ``seconds`` before to the row's own second.

    Both ends count, and so do all rows of the same second. Values are taken to ``scale``
    decimals; sums are exact. Values of 10^26 and more are summed as doubles and count only in
    frames that hold one.

    A window over the raw rows would put a key's whole history into one task and re-add the
    frame for every row. Instead rows are first summed per key and second, with partial
    sums before the shuffle. The sums are cut into chunks of a few windows; the sums in the
    last window of a chunk are also copied to the next one, whose frames can reach them.
    Inside a chunk the frame is the difference of two running totals, linear in the number
    of seconds, and the number of seconds in a chunk is bounded whatever the number of
    rows. The result, one row per key and second, is joined back.
    """
    second = f"_{out}_second"
    df = df.withColumn(second, F.col(ts).cast("long"))
    groups = {k: f"_{out}_{k}" for k in keys}
    raw = F.col(value).cast("double")
    exact = as_exact(raw, scale)
    huge = F.when(is_finite(raw) & exact.isNull(), raw)
    marks = F.when(F.isnan(raw), 1).when(raw == PLUS, 2).when(raw == MINUS, 4).otherwise(0)
    per_second = (
        df.select(*[F.col(k).alias(g) for k, g in groups.items()], F.col(second).alias("s"), value)
        .groupBy(*groups.values(), "s")
        .agg(
            F.sum(exact).alias("total"),
            F.count(F.when(is_finite(raw), raw)).alias("n"),
            F.bit_or(marks).alias("marks"),
            F.sum(huge).alias("huge"),
            F.count(huge).alias("n_huge"),
        )
    )
    span = CHUNK_WINDOWS * seconds
    own, last = F.floor(F.col("s") / span), F.floor((F.col("s") + seconds) / span)
    # The outer form keeps rows without a time, which have only each other as peers.
    chunks = per_second.select("*", F.explode_outer(F.sequence(own, last)).alias("chunk"))

    in_chunk = Window.partitionBy(*groups.values(), "chunk").orderBy("s")
    upto = in_chunk.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = in_chunk.rangeBetween(Window.unboundedPreceding, -seconds - 1)

    def in_frame(column: str) -> Column:
        earlier = F.when(F.col("s").isNotNull(), F.sum(column).over(before))
        reached = F.sum(column).over(upto)
        return F.coalesce(reached - earlier, reached)

    def marked(bit: int) -> Column:
        here = F.col("marks").bitwiseAND(bit) > 0
        latest = F.max(F.when(here, F.col("s"))).over(upto)
        return F.when(F.col("s").isNull(), here).otherwise(latest >= F.col("s") - seconds)

    framed = chunks.select(
        *groups.values(),
        "s",
        "chunk",
        in_frame("total").alias("total"),
        in_frame("n").alias("n"),
        in_frame("huge").alias("huge"),
        in_frame("n_huge").alias("n_huge"),
        marked(1).alias("nan"),
        marked(2).alias("plus"),
        marked(4).alias("minus"),
    ).filter(F.col("chunk").eqNullSafe(own))
    mean = (
        F.when(F.col("nan") | (F.col("plus") & F.col("minus")), F.lit(NAN))
        .when(F.col("plus"), F.lit(PLUS))
        .when(F.col("minus"), F.lit(MINUS))
        .when(F.col("n_huge") > 0, (F.coalesce(F.col("total").cast("double"), F.lit(0.0)) + F.col("huge")) / F.col("n"))
        .when(F.col("n") > 0, F.col("total").cast("double") / F.col("n"))
    )
    means = framed.select(*groups.values(), F.col("s").alias(f"{second}_r"), mean.alias(out))
    return join_back(df, means, groups | {second: f"{second}_r"}).drop(second)
