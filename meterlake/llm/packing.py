"""Packing of token ids into sequences of one length."""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import ship, small_batches

CACHE_WORDS, CACHE_CHARS = 400_000, 64


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _byte_letters() -> list[str]:
    """The character that stands for each byte in the vocabulary: printable ones for themselves,
    the others, in order, for the characters from 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


class WordEncoder(dict):
    """Ids of whole texts, each word encoded once while it is remembered.

    The tokenizer drops white space and no token spans it, so a text's ids are those of its
    words in a row. Words are cut at the four ASCII white spaces only; whatever else lies
    inside a word is the tokenizer's own business. Words of plain western letters, digits and
    marks are cut and written as the tokenizer's rules say, and only their merges are asked
    for, which is three times as fast. The dictionary itself maps words to ids. Two generations
    of about ``CACHE_WORDS`` words are remembered, none over ``CACHE_CHARS`` characters: a word
    not seen during one generation is forgotten.
    """

    PLAIN = re.compile(r"[!-&(-~À-ÿ]+")  # no apostrophe, which opens contractions
    PARTS = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.old: dict[str, bytes] = {}
        self.letters = _byte_letters()

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self) > CACHE_WORDS:
            self.old = dict(self)
            self.clear()
        return [b"".join(map(self.__getitem__, self._words(t))) for t in texts]

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self._ids(word)
        if len(word) <= CACHE_CHARS:
            self[word] = ids
        return ids

    def _ids(self, word: str) -> bytes:
        if not self.PLAIN.fullmatch(word) or "<|" in word:
            found = self.tokenizer.encode(word, add_special_tokens=False).ids
            return array(self.dtype.char, found).tobytes()
        parts = self.PARTS.findall(word.lower())
        if len(parts) > 1:
            return b"".join(map(self.__getitem__, parts))
        letters = parts[0]
        if letters != word:
            return self[letters]
        if not letters.isascii():
            letters = "".join([self.letters[b] for b in letters.encode()])
        return array(self.dtype.char, [t.id for t in self.tokenizer.model.tokenize(letters)]).tobytes()

    @staticmethod
    def _words(text: str) -> list[str]:
        # Plain ASCII is lower-cased first, as the tokenizer would; not where a special string
        # might be, which is matched as written.
        if text.isascii() and "<|" not in text:
            text = text.lower()
        return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


class TournamentTree:
    """The first bin with enough room, in a number of steps that is the log of the bins.

    A node holds the largest room below it; bins are opened from the left.
    """

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> int:
        room, at = self.room, 1
        while at < self.leaves:
            at *= 2
            at += room[at] < size
        leaf = at
        room[at] -= size
        while at > 1:
            at //= 2
            room[at] = max(room[2 * at], room[2 * at + 1])
        return leaf - self.leaves


def pack_lengths(lengths: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Bins of (item, begin, length). Items come longest first, ties in the given order.

    First-fit decreasing places whole items. What room is left is then filled by cutting up
    the emptiest bins, so that one bin at most stays short.
    """
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    tree = TournamentTree(len(lengths), capacity)
    bins: dict[int, list[tuple[int, int, int]]] = {}
    for i in order:
        bins.setdefault(tree.place(lengths[i]), []).append((i, 0, lengths[i]))
    fill = {b: sum(x[2] for x in items) for b, items in bins.items()}
    short = sorted((b for b in bins if fill[b] < capacity), key=lambda b: (-fill[b], b))
    while len(short) > 1:
        to, source = short[0], short[-1]
        item, begin, length = bins[source].pop()
        take = min(length, capacity - fill[to])
        bins[to].append((item, begin + length - take, take))
        if take < length:
            bins[source].append((item, begin, length - take))
        fill[to] += take
        fill[source] -= take
        if fill[to] == capacity:
            short.pop(0)
        if not fill[source]:
            short.pop()
            del bins[source]
    return [bins[b] for b in sorted(bins)]


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 4096,
    end_id: int = 2,
    doc_id: str = "doc_id",
    text: str = "text",
    group_bytes: int = 4 << 20,
    seed: int = 7,
) -> DataFrame:
    """One row a piece: ``doc_id, start, length, doc_tokens, sequence_id, offset, ids``.

    A document's ids and ``end_id`` are cut at multiples of ``capacity``; the pieces are dealt
    to groups by a hash of document, start and ids, and each group is packed on its own. The
    number of groups follows from the bytes of all texts, so a group holds about ``group_bytes``
    of text at any size of the corpus. One sequence a group at most is short. ``ids`` holds
    unsigned 32-bit little-endian integers. A sequence is named by its group and its number
    there.

    A null or empty text is the one token ``end_id``. Repeated rows are packed as often as they
    come. An empty table gives no rows. Other columns are not read.
    """
    ship(docs.sparkSession)
    clean = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = clean.agg((F.sum(F.octet_length("text").cast("long")) + F.count("*")).alias("n")).first()["n"]
    groups = max(1, -(-(size or 0) // group_bytes))
    id_type = clean.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path)
        width, close = encoder.dtype.itemsize, np.array([end_id], encoder.dtype).tobytes()
        for batch in small_batches(batches):
            row, start, length, total, ids = [], [], [], [], []
            for i, found in enumerate(encoder.encode(batch.column("text").to_pylist())):
                found += close
                n = len(found) // width
                for first in range(0, n, capacity):
                    row.append(i)
                    start.append(first)
                    length.append(min(capacity, n - first))
                    total.append(n)
                    ids.append(found[first * width : (first + capacity) * width])
            yield pa.record_batch(
                [
                    batch.column("doc_id").take(pa.array(row, pa.int64())),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(total, pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                names=["doc_id", "start", "length", "doc_tokens", "ids"],
            )

    def fill(key: tuple, pieces: pa.Table) -> pa.Table:
        order = [(c, "ascending") for c in ("doc_id", "start", "ids")]
        pieces = pieces.sort_by(order)
        group, sizes = key[0].as_py(), pieces["length"].to_pylist()
        item, begin, length, sequence, offset = [], [], [], [], []
        for k, content in enumerate(pack_lengths(sizes, capacity)):
            at = 0
            for i, b, n in content:
                item.append(i)
                begin.append(b)
                length.append(n)
                sequence.append((group << 32) + k)
                offset.append(at)
                at += n
        ids = pieces["ids"].to_pylist()
        cut_ids = [
            np.frombuffer(ids[i], f"<u{len(ids[i]) // sizes[i]}")[b : b + n].astype("<u4").tobytes()
            for i, b, n in zip(item, begin, length, strict=True)
        ]
        out = pieces.select(["doc_id", "start", "doc_tokens"]).take(pa.array(item, pa.int64()))
        start = np.array(out["start"]) + np.array(begin, np.int64)
        return pa.table(
            {
                "doc_id": out["doc_id"],
                "start": pa.array(start, pa.int64()),
                "length": pa.array(length, pa.int64()),
                "doc_tokens": out["doc_tokens"],
                "sequence_id": pa.array(sequence, pa.int64()),
                "offset": pa.array(offset, pa.int64()),
                "ids": pa.array(cut_ids, pa.binary()),
            }
        )

    piece = f"doc_id {id_type}, start long, length long, doc_tokens long"
    pieces = clean.mapInArrow(cut, f"{piece}, ids binary")
    dealt = pieces.withColumn(
        "group", F.pmod(F.xxhash64("doc_id", "start", F.crc32("ids"), F.lit(seed)), F.lit(groups))
    )
    return dealt.groupBy("group").applyInArrow(
        fill, f"{piece}, sequence_id long, offset long, ids binary"
    )
