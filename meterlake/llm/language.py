"""Language identification: words first, then ever shorter character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.bytestext import flat, range_hashes
from meterlake.llm.common import ship, small_batches

UNKNOWN = "und"
# Bytes of words: ASCII letters and every byte of a longer character. Digits, marks and white
# space part words.
IN_WORD = np.zeros(256, bool)
IN_WORD[65:91] = IN_WORD[97:123] = True
IN_WORD[128:] = True


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a text column in lower case: all bytes, each word's begin, end and row."""
    data, begins, lengths = flat(pc.utf8_lower(column))
    inside = IN_WORD[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts = begins[lengths > 0]
    first[starts] = inside[starts]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return data, begin, end, np.searchsorted(begins + lengths, begin, "right")


def _pieces(data: np.ndarray, begin: np.ndarray, end: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of ``size`` characters inside the given words, and each one's word."""
    # Characters begin where a byte is no 10xxxxxx; a word ends where one begins.
    heads = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    low, high = np.searchsorted(heads, begin), np.searchsorted(heads, end)
    counts = np.maximum(high - low - size + 1, 0)
    word = np.repeat(np.arange(len(begin)), counts)
    ends = np.cumsum(counts)
    at = low[word] + np.arange(len(word)) - (ends - counts)[word]
    return range_hashes(data, heads[at], heads[at + size]), word


@dataclass(frozen=True)
class Level:
    """Sorted hashes of units (words, or n-grams of one length), and log frequency by language."""

    keys: np.ndarray
    logs: np.ndarray  # unit, language

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each hash, or -1."""
        if not len(self.keys):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, at, -1)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    sizes: tuple[int, ...]
    levels: list[Level]  # words first, then the n-grams by ``sizes``

    def scores(self, column: pa.Array) -> np.ndarray:
        """Sum of log frequencies by row and language.

        A known word counts with its own log frequency. An unseen one falls back to the longest
        n-grams of it that are known at all, and to shorter ones where none is; their mean
        counts, so that a word weighs as much either way.
        """
        data, begin, end, row = _words(column)
        out = np.zeros((len(column), len(self.languages)))
        found = self.levels[0].find(range_hashes(data, begin, end))
        known = found >= 0
        self._add(out, row[known], self.levels[0].logs[found[known]])
        left = np.flatnonzero(~known)
        for size, level in zip(self.sizes, self.levels[1:], strict=True):
            if not len(left):
                break
            hashes, word = _pieces(data, begin[left], end[left], size)
            found = level.find(hashes)
            word, found = word[found >= 0], found[found >= 0]
            n = np.bincount(word, minlength=len(left))
            sums = np.zeros((len(left), len(self.languages)))
            self._add(sums, word, level.logs[found])
            hit = n > 0
            self._add(out, row[left[hit]], sums[hit] / n[hit, None])
            left = left[~hit]
        return out

    @staticmethod
    def _add(out: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
        for language in range(out.shape[1]):
            out[:, language] += np.bincount(rows, values[:, language], len(out))


def fit(
    labelled: DataFrame,
    sizes: tuple[int, ...] = (5, 4, 3, 2, 1),
    max_docs: int = 4_000,
    max_words: int = 100_000,
    max_grams: int = 50_000,
    least: int = 3,
    text: str = "text",
    lang: str = "lang",
    order: str = "doc_id",
) -> Model | None:
    """Counts over at most ``max_docs`` labelled documents of each language, the first by a hash of
    ``order``. Words or n-grams seen fewer than ``least`` times, and all but the ``max_words`` and
    ``max_grams`` most frequent ones, are left to the shorter n-grams. None without any labels.
    """
    spark = labelled.sparkSession
    ship(spark)
    some = labelled.select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(order, F.lit(3)).alias("h")
    ).where("lang IS NOT NULL AND text IS NOT NULL")
    # The bound is found on hashes alone; one row a language comes to the driver.
    by_hash = Window.partitionBy("lang").orderBy("h")
    limits = (
        some.select("lang", "h")
        .withColumn("r", F.row_number().over(by_hash))
        .where(F.col("r") <= max_docs)
        .groupBy("lang")
        .agg(F.max("h").alias("h"))
        .collect()
    )
    if not limits:
        return None
    languages = sorted(r["lang"] for r in limits)
    inside = F.lit(False)
    for r in limits:
        inside = inside | ((F.col("lang") == r["lang"]) & (F.col("h") <= r["h"]))
    bounded = some.where(inside)

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, limit=8 << 20):
            data, begin, end, row = _words(batch.column("text"))
            languages = batch.column("lang").dictionary_encode()
            code = np.asarray(languages.indices)[row].astype(np.int64)
            names = languages.dictionary
            for level, size in enumerate((0, *sizes)):
                if size:
                    hashes, word = _pieces(data, begin, end, size)
                    where = code[word]
                else:
                    hashes, where = range_hashes(data, begin, end), code
                pairs, n = _counted(hashes, where)
                yield pa.record_batch(
                    [
                        pa.array(np.full(len(n), level, np.int32)),
                        pa.array(pairs[0].view(np.int64)),
                        names.take(pa.array(pairs[1])),
                        pa.array(n),
                    ],
                    names=["level", "unit", "lang", "n"],
                )

    counts = (
        bounded.select("lang", "text")
        .mapInArrow(units, "level int, unit long, lang string, n long")
        .groupBy("level", "unit")
        .pivot("lang", languages)
        .agg(F.sum("n"))
    )
    by_language = [F.coalesce(F.col(f"`{name}`"), F.lit(0)) for name in languages]
    total = sum(by_language[1:], by_language[0])
    listed = counts.select("level", "unit", F.array(*by_language).alias("n"), total.alias("total"))
    frequent = Window.partitionBy("level").orderBy(F.desc("total"), "unit")
    limit = F.when(F.col("level") == 0, max_words).otherwise(max_grams)
    kept = (
        listed.where(F.col("total") >= least)
        .withColumn("r", F.row_number().over(frequent))
        .where(F.col("r") <= limit)
        .select("level", "unit", "n")
        .toArrow()
    )
    sums = listed.groupBy("level").agg(*[F.sum(F.col("n")[i]).alias(f"s{i}") for i in range(len(languages))])
    totals = {r["level"]: np.array(list(r)[1:], np.float64) for r in sums.collect()}
    level_of, unit = np.asarray(kept["level"]), np.asarray(kept["unit"]).view(np.uint64)
    n = np.asarray(kept["n"].combine_chunks().flatten(), np.float64).reshape(-1, len(languages))
    levels = []
    for level in range(len(sizes) + 1):
        mine = level_of == level
        order_ = np.argsort(unit[mine])
        all_ = totals.get(level, np.ones(len(languages)))
        # Half a count more for each unit, so that none is impossible.
        logs = np.log((n[mine][order_] + 0.5) / (all_ + 0.5 * max(1, mine.sum())))
        levels.append(Level(unit[mine][order_], logs))
    return Model(languages, sizes, levels)


def _counted(hashes: np.ndarray, where: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    order = np.lexsort((where, hashes))
    hashes, where = hashes[order], where[order]
    if not len(hashes):
        return (hashes, where), np.zeros(0, np.int64)
    new = np.flatnonzero(np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (where[1:] != where[:-1]))))
    return (hashes[new], where[new]), np.diff(np.append(new, len(hashes)))


def identify(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score``: the most likely language and its share among all, 0 to 1.

    ``und`` with score 0 if the text is null or has no letter, or nothing was learned. A text
    whose words are all unknown at every length goes to the first language by name, as ties do.
    Repeated rows come out as often as they went in. An empty table gives no rows. Other
    columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    clean = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = clean.schema["doc_id"].dataType.simpleString()
    if model is None:
        return clean.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    # Bounded by max_words and max_grams.
    shared = spark.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in small_batches(batches, limit=2 << 20):
            column = batch.column("text")
            letters = np.asarray(pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False))
            sums = model.scores(column)
            best = sums.argmax(1)
            share = 1 / np.exp(sums - sums.max(1, keepdims=True)).sum(1)
            names = pa.array(model.languages).take(pa.array(best))
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pc.if_else(pa.array(letters), names, UNKNOWN),
                    pa.array(np.where(letters, share, 0.0)),
                ],
                names=["doc_id", "lang_pred", "score"],
            )

    return clean.mapInArrow(predict, f"doc_id {kind}, lang_pred string, score double")
