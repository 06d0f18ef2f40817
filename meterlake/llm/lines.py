"""Removal of runs of lines that came before, by winnowing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.common import let
from meterlake.llm.suffixes import kept_ranges

HAS_WORD = r"[^\x20\x09-\x0D]"


def _selected(lines: Column, size: int, long_words: int | None = None) -> Column:
    """The minima that winnowing selects among the hashes of lines that hold a word, one entry each:
    its hash as ``fingerprint``, and of the windows of ``size`` lines whose least hash it is (the last
    of equal ones) all ``lines`` by number and their ``hashes``; a window has ``width`` lines.

    With ``long_words`` also each single line of as many words, and as one window all lines of a
    text that has fewer than ``size``.
    """

    def entry(ls: Column, fingerprint: Column, width: Column) -> Column:
        return F.struct(
            F.transform(ls, lambda x: x["line"]).alias("lines"),
            F.transform(ls, lambda x: x["hash"]).alias("hashes"),
            fingerprint.alias("fingerprint"),
            width.alias("width"),
        )

    def least(ls: Column, i: Column) -> Column:
        # The place of the least hash of the window that begins at i.
        return -F.array_min(
            F.transform(F.slice(ls, i + 1, F.lit(size)), lambda x, j: F.struct(x["hash"], -(i + j)))
        )["col2"]

    def winnowed(ls: Column) -> Column:
        def entries(minima: Column) -> Column:
            # Windows of one minimum are neighbours, so each selected place is a stretch of windows.
            begins = F.filter(
                F.sequence(F.lit(0), F.size(minima) - 1),
                lambda i: (i == 0) | (F.get(minima, i) != F.get(minima, i - 1)),
            )

            def stretches(firsts: Column) -> Column:
                return F.transform(
                    firsts,
                    lambda i, k: entry(
                        F.slice(ls, i + 1, F.coalesce(F.get(firsts, k + 1), F.size(minima)) - i + size - 1),
                        F.get(ls, F.get(minima, i))["hash"],
                        F.lit(size),
                    ),
                )

            return let(begins, stretches)

        places = F.transform(F.sequence(F.lit(0), F.size(ls) - size), lambda i: least(ls, i))
        return F.when(F.size(ls) >= size, let(places, entries))

    def with_single(ls: Column) -> Column:
        # A text of one line is taken as a whole, so no window comes twice.
        single = F.transform(
            F.filter(ls, lambda x: x["long"] & (F.size(ls) > 1)),
            lambda x: entry(F.array(x), x["hash"], F.lit(1)),
        )
        whole = F.when(
            (F.size(ls) > 0) & (F.size(ls) < size),
            F.array(entry(ls, F.array_min(F.transform(ls, lambda x: x["hash"])), F.size(ls))),
        )
        parts = F.array(winnowed(ls), single, whole)
        return F.flatten(F.filter(parts, lambda p: p.isNotNull()))

    def fields(x: Column, i: Column) -> Column:
        known = [i.alias("line"), F.xxhash64(x).alias("hash")]
        if long_words:
            # So many words take so many characters at least.
            enough = F.when(
                F.length(x) >= 2 * long_words - 1, F.regexp_count(x, F.lit(HAS_WORD + "+")) >= long_words
            )
            known.append(F.coalesce(enough, F.lit(False)).alias("long"))
        return F.struct(*known)

    numbered = F.transform(lines, lambda x, i: F.when(x.rlike(HAS_WORD), fields(x, i)))
    return let(F.filter(numbered, lambda x: x.isNotNull()), with_single if long_words else winnowed)


def repeated_lines(
    docs: DataFrame,
    window: int = 2,
    doc_id: str = "doc_id",
    text: str = "text",
    long_words: int | None = None,
) -> DataFrame:
    """``doc_id, tag, removed, n_removed``: runs of line numbers (``begin`` to before ``end``) that
    repeat an earlier run of at least ``window`` lines. With ``long_words`` a single line of as many
    words is a run too, and so are all lines of a text that has fewer than ``window``.

    Lines are what ``\\n`` parts; lines without a word are passed over and stay. Earlier means in
    a document of smaller id, or further up in the same one; what is earlier is judged on the
    input. Winnowing: of each window of ``window`` lines the least line hash is selected, one row a
    selected place, so two equal runs of ``window`` lines or more hold the same fingerprint at the
    same line. Places are joined with the fingerprints that stand at two places or more; most
    leave here. From a place left a match is extended both ways, over the windows that its line
    was selected for, which its row carries; their first place in the corpus is found by
    aggregation, so a line found everywhere makes no pairs. Matches that touch grow together
    into the longest runs. Equal means equal 64-bit hashes of all lines of a window.

    Documents without repeats have no row. Rows of equal id remove nothing from one another,
    unless within one text; a null id takes no part. ``tag`` is a hash of the text, which tells rows of one
    id apart. Null text counts as empty. Ids can be of any type that has an order.
    """
    lines = F.split("text", "\n")
    clean = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where(
        "doc_id IS NOT NULL AND text IS NOT NULL"
    )
    # Outer, since for an inner one Spark also filters by the array's size, and makes it twice.
    found = (
        clean.select(
            "doc_id", F.xxhash64("text").alias("tag"), _selected(lines, window, long_words).alias("places")
        )
        .select("doc_id", "tag", F.inline_outer("places"))
        .where("fingerprint IS NOT NULL")
    )
    fingerprint = ["fingerprint", "width"]
    often = found.groupBy(*fingerprint).agg(F.count("*").alias("n")).where("n > 1").select(*fingerprint)
    windows = F.transform(
        F.sequence(F.lit(0), F.size("lines") - F.col("width")),
        lambda i: F.struct(
            F.slice("lines", i + 1, F.col("width")).alias("lines"),
            F.slice("hashes", i + 1, F.col("width")).alias("hashes"),
        ),
    )
    matches = found.join(often, fingerprint).select("doc_id", "tag", F.inline_outer(windows))
    # The tag goes along in both uses of the matches, so that they read one shuffle.
    place = F.struct("doc_id", F.col("lines")[0].alias("line"), "tag")
    later = "struct({0}.doc_id, {0}.line) > struct({1}.doc_id, {1}.line)"
    first = (
        matches.groupBy("hashes")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .where(later.format("last", "first"))
        .select("hashes", "first")
    )
    covered = (
        matches.withColumn("place", place)
        .join(first, "hashes")
        .where(later.format("place", "first"))
        .select("doc_id", "tag", F.explode("lines").alias("line"))
        .distinct()
    )
    in_order = Window.partitionBy("doc_id", "tag").orderBy("line")
    runs = (
        covered.withColumn("run", F.col("line") - F.row_number().over(in_order))
        .groupBy("doc_id", "tag", "run")
        .agg(F.min("line").cast("long").alias("begin"), (F.max("line") + 1).cast("long").alias("end"))
    )
    return runs.groupBy("doc_id", "tag").agg(
        F.sort_array(F.collect_list(F.struct("begin", "end"))).alias("removed"),
        F.sum(F.col("end") - F.col("begin")).cast("long").alias("n_removed"),
    )


def remove_repeated_lines(
    docs: DataFrame,
    window: int = 2,
    doc_id: str = "doc_id",
    text: str = "text",
    long_words: int | None = None,
    counts: bool = True,
) -> DataFrame:
    """The same rows and columns, texts without their repeated runs, and columns ``n_removed``
    and ``n_runs``. A null text stays null, an empty table stays empty; repeated rows come out as
    often as they went in. A column of the input that has the name of a new one is replaced;
    without ``counts`` there are no new ones. Other names don't clash with anything."""
    runs = repeated_lines(docs, window, doc_id, text, long_words)
    row = F.struct(*[F.col(f"`{c}`").alias(c) for c in docs.columns]).alias("row")
    packed = docs.select(row, F.col(f"`{doc_id}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("own"))
    joined = packed.join(runs, (packed["id"] == runs["doc_id"]) & (packed["own"] == runs["tag"]), "left")

    def kept(v: Column) -> Column:
        ranges = kept_ranges(v["removed"], F.size(v["lines"]).cast("long"))
        parts = F.transform(
            ranges,
            lambda r: F.slice(
                v["lines"], (r["begin"] + 1).cast("int"), (r["end"] - r["begin"]).cast("int")
            ),
        )
        return F.array_join(F.flatten(parts), "\n")

    whole = F.col("row").getField(text)
    cut = let(F.struct(F.split(whole, "\n").alias("lines"), "removed"), kept)
    new = {
        "n_removed": F.coalesce("n_removed", F.lit(0).cast("long")),
        "n_runs": F.coalesce(F.size("removed"), F.lit(0)).cast("long"),
    }
    values = {c: F.col("row").getField(c) for c in docs.columns}
    values |= {text: F.when(F.col("removed").isNull(), whole).otherwise(cut), **(new if counts else {})}
    return joined.select(*[value.alias(name) for name, value in values.items()])
