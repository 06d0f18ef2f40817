"""Byte-level BPE over a shuffle of distinct words, and its inverse."""

from __future__ import annotations

import base64
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import ship, small_batches


@lru_cache(maxsize=2)
def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def _encoding(path: str, pattern: str):
    import tiktoken

    return tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=_ranks(path), special_tokens={})


def _below_256(kind: str) -> str:
    """The characters under 256 of a Unicode class, as the inside of a bracket."""
    white = [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0]
    places = white if kind == "s" else [i for i in range(256) if unicodedata.category(chr(i))[0] == kind]
    return "".join(f"\\x{i:02x}" for i in places)


@lru_cache(maxsize=2)
def _splitter(pattern: str):
    """Finds the matches of ``pattern`` in a text.

    Texts whose characters are all under 256 go through the built-in engine, with the Unicode
    classes written out, which is twice as fast; the matches are the same.
    """
    import regex

    def written_out(m: re.Match) -> str:
        part = m.group()
        if part.startswith("["):
            return re.sub(r"\\p\{([LN])\}|\\(s)", lambda x: _below_256(x[1] or x[2]), part)
        if part == r"\S":
            return f"[^{_below_256('s')}]"
        return f"[{_below_256(part[3] if part.startswith(r'\p') else 's')}]"

    narrow = re.compile(re.sub(r"\[\^?[^\]]*\]|\\p\{[LN]\}|\\[sS]", written_out, pattern))
    wide = regex.compile(pattern)

    def find(text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return wide.findall(text)
        return narrow.findall(text)

    return find


@lru_cache(maxsize=2)
def _token_bytes(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The token-byte table: all bytes in a row, and begin and length by id (length -1: no such id)."""
    ranks = _ranks(path)
    length = np.full(max(ranks.values()) + 1, -1, np.int64)
    begin = np.zeros(len(length), np.int64)
    at, parts = 0, []
    for token, rank in ranks.items():
        begin[rank], length[rank] = at, len(token)
        at += len(token)
        parts.append(token)
    return np.frombuffer(b"".join(parts), np.uint8), begin, length


class _Numbers(dict):
    """Words by the order in which they first come."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


def _cut(batches: Iterator[pa.RecordBatch], group_chars: int) -> Iterator[tuple[Iterator, object]]:
    """Runs of texts of about ``group_chars`` in all: their ids and texts, to be read once and in
    order, and a hash that names the run (``_name``) once they are read. No run is held whole. The
    cut depends on the rows alone, so a task that runs again gives the same names."""
    from xxhash import xxh3_64

    def numbered():
        run = size = rows = 0
        for batch in batches:
            for doc, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                text = text.as_py()
                if rows and size + len(text) > group_chars:
                    run, size, rows = run + 1, 0, 0
                size, rows = size + len(text), rows + 1
                yield run, doc.as_py(), text

    def read(rows, name):
        for _, doc, text in rows:
            name.update(f"{doc!r} {len(text)} ")
            name.update(text)
            yield doc, text

    for _, rows in groupby(numbered(), key=itemgetter(0)):
        name = xxh3_64()
        yield read(rows, name), name


def _name(name) -> int:
    return name.intdigest() - (1 << 63)


def _planes(values: np.ndarray) -> bytes:
    """32-bit integers as four rows of bytes; the rows of high bytes compress to almost nothing."""
    return values.astype("<u4", copy=False).view(np.uint8).reshape(-1, 4).T.tobytes()


def _values(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").ravel()


# Words of a batch of documents that are put together, and of a step inside a longer document.
BATCH_WORDS, STEP_WORDS = 1 << 18, 1 << 16


def _spelled(left: pa.Table, right: pa.Table, kind: np.dtype, id_arrow: pa.DataType) -> pa.Table:
    """One group's documents, from its positions (left) and the ids of its words (right).

    The result is made of batches of about ``BATCH_WORDS`` words, so neither side of the stream
    that carries it holds a second copy of the group.
    """
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    size = max(left["n_words"].to_pylist(), default=0)
    # By word: where its ids begin among those of all words, and how many they are.
    begin, count = np.full(size, -1, np.int64), np.zeros(size, np.int64)
    parts, at = [np.zeros(0, kind)], 0
    for numbers, counts, ids in zip(*(right[c].to_pylist() for c in ("numbers", "counts", "ids")), strict=True):
        numbers, counts = np.cumsum(_values(unpack(numbers))), _values(unpack(counts)).astype(np.int64)
        parts.append(np.frombuffer(unpack(ids), kind))
        known = numbers < size
        begin[numbers[known]] = (at + np.cumsum(counts) - counts)[known]
        count[numbers[known]] = counts[known]
        at += len(parts[-1])
    if (begin < 0).any():
        raise ValueError("the input came in another order when it was read again")
    known_ids = np.concatenate(parts)
    del parts

    def put_together(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some documents in a row, and where each document's end; by its last word."""
        n = count[words]
        upto = np.concatenate(([0], np.cumsum(n)))
        out = np.empty(upto[-1], "<u4")
        for a in range(0, len(words), STEP_WORDS):
            b = min(a + STEP_WORDS, len(words))
            shift = np.repeat(begin[words[a:b]] - upto[a:b], n[a:b])
            out[upto[a] : upto[b]] = known_ids[shift + np.arange(upto[a], upto[b])]
        return out, upto[ends]

    batches = []
    for doc_ids, lengths, numbers in zip(left["doc_ids"], left["lengths"], left["numbers"], strict=True):
        doc_ids, words = doc_ids.values, _values(unpack(numbers.as_py()))
        ends = np.cumsum(np.asarray(lengths.values))
        first = 0
        while first < len(ends):
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + BATCH_WORDS, "right")))
            ids, upto = put_together(words[before : ends[last - 1]], ends[first:last] - before)
            offsets = np.concatenate(([0], 4 * upto)).astype(np.int32)
            batches.append(
                pa.record_batch(
                    [
                        doc_ids.slice(first, last - first).cast(id_arrow),
                        pa.array(np.diff(offsets) // 4, pa.int64()),
                        pa.Array.from_buffers(
                            pa.binary(), last - first, [None, pa.py_buffer(offsets), pa.py_buffer(ids)]
                        ),
                    ],
                    names=["doc_id", "n_tokens", "ids"],
                )
            )
            first = last
    schema = pa.schema([("doc_id", id_arrow), ("n_tokens", pa.int64()), ("ids", pa.binary())])
    return pa.Table.from_batches(batches, schema)


def encode(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    doc_id: str = "doc_id",
    text: str = "text",
    group_chars: int = 16 << 20,
) -> DataFrame:
    """``doc_id, n_tokens, ids``; ids as unsigned 32-bit little-endian integers.

    Pre-tokens are numbered inside groups of about ``group_chars`` characters: a group is its
    distinct words and, for each position, the number of its word, which is the exploded table
    of (document, position, word) in columnar form. The words of all groups are shuffled
    together, each distinct one is encoded once, and its ids go back to the groups it came
    from, packed to one row a group and task, where positions are put together again. So what is shuffled by word is one row for a
    word and group, however often the word occurs: no word is hot.

    The input is read twice and has to come in the same order, as from files; where it does not,
    groups don't match and the run fails.

    A null or empty text has no ids. Repeated rows come out as often as they went in. An empty
    table gives no rows. Other columns are not read.
    """
    import zstandard

    ship(docs.sparkSession)
    clean = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    id_type = clean.schema["doc_id"].dataType.simpleString()
    id_arrow = _arrow_type(clean)
    kind = np.dtype("<u2" if max(_ranks(ranks_path).values()) < 1 << 16 else "<u4")
    width = kind.itemsize

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = _splitter(pattern)

        def distinct(rows: Iterator) -> pa.Array:
            found: dict[str, None] = {}
            for _, text in rows:
                found.update(dict.fromkeys(find(text)))
            return pa.array(list(found), pa.string())

        for rows, name in _cut(batches, group_chars):
            found = distinct(rows)
            yield pa.record_batch(
                [
                    found,
                    pa.array(np.full(len(found), _name(name), np.int64)),
                    pa.array(np.arange(len(found), dtype=np.int32)),
                ],
                names=["word", "group", "number"],
            )

    def positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, pack = _splitter(pattern), zstandard.ZstdCompressor(level=3).compress

        def placed(rows: Iterator, name) -> pa.RecordBatch:
            words, ids, numbers = _Numbers(), [], []
            for doc, text in rows:
                found = find(text)
                ids.append(doc)
                numbers.append(np.fromiter(map(words.__getitem__, found), np.uint32, len(found)))
            n_words, lengths = len(words), [len(x) for x in numbers]
            del words
            numbers = np.concatenate(numbers)
            return pa.record_batch(
                [
                    pa.array([_name(name)], pa.int64()),
                    pa.array([n_words], pa.int64()),
                    pa.array([ids], pa.list_(id_arrow)),
                    pa.array([lengths], pa.list_(pa.int64())),
                    pa.array([pack(_planes(numbers))], pa.binary()),
                ],
                names=["group", "n_words", "doc_ids", "lengths", "numbers"],
            )

        for rows, name in _cut(batches, group_chars):
            yield placed(rows, name)

    def encode_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = _encoding(ranks_path, pattern)._core_bpe.encode_single_piece
        pack = zstandard.ZstdCompressor(level=1).compress
        last, ids = None, b""
        group, number, found = [], [], []

        def packed() -> pa.RecordBatch:
            """One row a group: numbers of its words, how many ids each has, and the ids."""
            groups, numbers = np.concatenate(group), np.concatenate(number)
            order = np.lexsort((numbers, groups))
            lengths = np.array([len(x) // width for x in found])[order]
            cuts = np.flatnonzero(np.diff(groups[order])) + 1
            names, blobs = [], []
            for part in np.split(np.arange(len(order)), cuts):
                rows = order[part]
                names.append(groups[rows[0]])
                blobs.append(
                    [
                        pack(_planes(np.diff(numbers[rows], prepend=0))),
                        pack(_planes(lengths[part])),
                        pack(b"".join([found[i] for i in rows.tolist()])),
                    ]
                )
            return pa.record_batch(
                [pa.array(names, pa.int64()), *(pa.array(x, pa.binary()) for x in zip(*blobs, strict=True))],
                names=["group", "numbers", "counts", "ids"],
            )

        for batch in batches:
            group.append(np.asarray(batch.column("group")))
            number.append(np.asarray(batch.column("number")))
            for word in batch.column("word").to_pylist():
                if word != last:
                    last, ids = word, np.array(once(word.encode()), kind).tobytes()
                found.append(ids)
            if len(found) > 200_000:
                yield packed()
                group, number, found = [], [], []
        if found:
            yield packed()

    def assemble(left: pa.Table, right: pa.Table) -> pa.Table:
        return _spelled(left, right, kind, id_arrow)

    spelled = clean.mapInArrow(words, "word string, group long, number int")
    by_word = spelled.repartition("word").sortWithinPartitions("word")
    word_ids = by_word.mapInArrow(encode_words, "group long, numbers binary, counts binary, ids binary")
    placed = clean.mapInArrow(
        positions, f"group long, n_words long, doc_ids array<{id_type}>, lengths array<long>, numbers binary"
    )
    return (
        placed.groupBy("group")
        .cogroup(word_ids.groupBy("group"))
        .applyInArrow(assemble, f"doc_id {id_type}, n_tokens long, ids binary")
    )


def _arrow_type(df: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema["doc_id"].dataType)


def _decoded(batches: Iterator[pa.RecordBatch], ranks_path: str) -> Iterator[pa.RecordBatch]:
    """``doc_id, ids, decoded``, in small batches: looking up takes 24 bytes a byte of text."""
    data, begin, length = _token_bytes(ranks_path)
    for batch in small_batches(batches, "ids", 1 << 20):
        decoded = []
        for one in batch.column("ids").to_pylist():
            tokens = np.frombuffer(one or b"", "<u4")
            if len(tokens) and (tokens.max() >= len(length) or (length[tokens] < 0).any()):
                raise ValueError("an id is not in the vocabulary")
            sizes = length[tokens]
            ends = np.cumsum(sizes)
            shift = np.repeat(begin[tokens] - (ends - sizes), sizes)
            decoded.append(data[shift + np.arange(len(shift))].tobytes())
        yield pa.record_batch(
            [batch.column("doc_id"), batch.column("ids"), pa.array(decoded, pa.binary())],
            names=["doc_id", "ids", "decoded"],
        )


def decode(encoded: DataFrame, ranks_path: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``doc_id, ids, decoded``: the bytes behind the ids, each id joined to the token-byte table.

    The table is fixed by the vocabulary, so every task holds it and looks ids up by position,
    a batch at a time. Null ids decode to no bytes. An id outside the table is an error. Other
    columns are not read.
    """
    ship(encoded.sparkSession)
    kind = encoded.schema[doc_id].dataType.simpleString()
    return encoded.select(F.col(doc_id).alias("doc_id"), F.col(ids).alias("ids")).mapInArrow(
        lambda batches: _decoded(batches, ranks_path), f"doc_id {kind}, ids binary, decoded binary"
    )


def digests(encoded: DataFrame, ranks_path: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: decodes as ``decode`` does and keeps the
    SHA-256 of the decimal ids joined by one space and of the decoded bytes."""
    ship(encoded.sparkSession)
    kind = encoded.schema[doc_id].dataType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256

        written: list[str] = []
        for batch in _decoded(batches, ranks_path):
            ids = [np.frombuffer(x or b"", "<u4") for x in batch.column("ids").to_pylist()]
            most = max((int(x.max()) for x in ids if len(x)), default=-1)
            written.extend(map(str, range(len(written), most + 1)))
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pa.array(map(len, ids), pa.int64()),
                    pa.array(
                        [sha256(" ".join(map(written.__getitem__, x.tolist())).encode()).hexdigest() for x in ids]
                    ),
                    pa.array([sha256(x).hexdigest() for x in batch.column("decoded").to_pylist()]),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return encoded.select(F.col(doc_id).alias("doc_id"), F.col(ids).alias("ids")).mapInArrow(
        digest, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
