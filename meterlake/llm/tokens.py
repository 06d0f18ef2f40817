"""Token counts of whole texts, huge ones in overlapping chunks."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import Scratch, ship

SPACE = "▁"  # the library's mark for a space (fixed value)


@lru_cache(maxsize=2)
def _model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@lru_cache(maxsize=2)
def _joined_pairs(path: str) -> frozenset[str]:
    """Neighbouring characters that lie together inside some piece of the vocabulary."""
    model = _model(path)
    return frozenset(
        piece[i : i + 2]
        for piece in map(model.id_to_piece, range(model.vocab_size()))
        for i in range(len(piece) - 1)
    )


def stable_boundary(text: str, begin: int, end: int, joined: frozenset[str]) -> int:
    """The first place in (begin, end) that no token can span, or -1.

    A token, and every merge on the way to it, is a piece of the vocabulary. Where no piece
    holds the two characters beside each other, no merge crosses, so the tokens on either side
    do not depend on the other side. The proof needs the text alone, so both chunks that hold
    the place find the same one.
    """
    marked = text[begin:end].replace(" ", SPACE)
    for i in range(1, len(marked)):
        if marked[i - 1 : i + 1] not in joined:
            return begin + i
    return -1


def tokens_before(pieces: list[str], place: int, text: str, dummy: bool) -> int:
    """Tokens of ``text`` that end at or before the character ``place``, from the pieces alone."""
    at, spare, n = (-1 if dummy else 0), 0, 0
    for piece in pieces:
        if at >= place and not spare:
            break
        if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
            # One byte of a character that has no piece; the character counts at its last byte.
            if not spare:
                spare = len(text[at].encode())
            spare -= 1
            at += not spare
        else:
            at += len(piece)
        n += 1
    return n


def token_counts(
    docs: DataFrame,
    model_path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    chunk_chars: int = 1 << 16,
    overlap_chars: int = 256,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens``, one row a row of the input.

    Texts of up to ``chunk_chars`` characters are encoded as they are. Longer ones are cut into
    chunks that overlap by ``overlap_chars``; the chunks are spread over all tasks and encoded
    with offsets, and two neighbours are spliced at the first place of their overlap that no
    token can span. If an overlap has no such place, that text is taken up again with overlaps
    (and chunks) four times as long, until at last the text is one chunk, so the counts are
    exact for any text.

    A null or empty text has 0 tokens. Rows that are repeated come out as often as they went
    in. An empty table gives an empty result. Other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    clean = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    whole = clean.where(F.length("text") <= chunk_chars)
    long_ = clean.where(F.length("text") > chunk_chars)

    def count_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(model_path)
        for batch in batches:
            found = model.encode(batch.column("text").to_pylist(), num_threads=1)
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(map(len, found), pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    id_type = clean.schema["doc_id"].dataType.simpleString()
    result = f"doc_id {id_type}, n_bytes long, n_tokens long"
    sized = whole.withColumn("n_bytes", F.octet_length("text").cast("long"))
    parts = [sized.mapInArrow(count_whole, result)]
    scratch = Scratch(spark)
    chunk, overlap = chunk_chars, overlap_chars
    while True:
        # Chunk results are small; storing them lets the driver ask whether any splice failed.
        done = scratch.store(_spliced(long_, model_path, id_type, chunk, overlap))
        parts.append(
            done.where("not failed")
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .select("doc_id", "n_bytes", F.expr("n_tokens div copies").alias("n_tokens"))
        )
        failed = done.where("failed").select("doc_id", "digest")
        if failed.isEmpty():
            break
        long_ = (
            long_.withColumn("digest", F.xxhash64("text"))
            .join(failed.withColumnRenamed("doc_id", "id"), "digest")
            .where(F.col("doc_id").eqNullSafe(F.col("id")))
            .select("doc_id", "text")
        )
        chunk, overlap = 4 * chunk, 4 * overlap
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _spliced(docs: DataFrame, model_path: str, id_type: str, chunk: int, overlap: int) -> DataFrame:
    """Counts of long texts for one width of chunk and overlap; ``failed`` where a splice is missing."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, doc in enumerate(batch.column("text").to_pylist()):
                starts = range(0, max(1, len(doc) - overlap), chunk)
                for k, start in enumerate(starts):
                    last = k == len(starts) - 1
                    yield pa.record_batch(
                        [
                            batch.column("doc_id").slice(i, 1),
                            batch.column("digest").slice(i, 1),
                            pa.array([k], pa.int64()),
                            pa.array([last]),
                            pa.array([doc[start : None if last else start + chunk + overlap]]),
                        ],
                        names=["doc_id", "digest", "k", "last", "text"],
                    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, joined = _model(model_path), _joined_pairs(model_path)
        dummy = bool(model.encode("a", out_type=str)[0].startswith(SPACE))
        for batch in batches:
            counts, failed = [], []
            for k, last, part in zip(
                *(batch.column(c).to_pylist() for c in ("k", "last", "text")), strict=True
            ):
                left = 0 if k == 0 else stable_boundary(part, 0, overlap, joined)
                right = len(part) if last else stable_boundary(part, chunk, len(part), joined)
                failed.append(left < 0 or right < 0)
                if failed[-1]:
                    counts.append(0)
                    continue
                pieces = model.encode(part, out_type=str)
                before = tokens_before(pieces, left, part, dummy) if k else 0
                upto = len(pieces) if last else tokens_before(pieces, right, part, dummy)
                counts.append(upto - before)
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    batch.column("digest"),
                    batch.column("k"),
                    pa.array([len(t.encode()) for t in batch.column("text").to_pylist()], pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array(failed),
                ],
                names=["doc_id", "digest", "k", "size", "n", "bad"],
            )

    key = f"doc_id {id_type}, digest long, k long"
    tagged = docs.withColumn("digest", F.xxhash64("text"))
    sizes = tagged.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes"))
    chunks = tagged.mapInArrow(cut, f"{key}, last boolean, text string")
    counted = chunks.repartition("doc_id", "digest", "k").mapInArrow(
        encode, f"{key}, size long, n long, bad boolean"
    )
    per_text = counted.groupBy("doc_id", "digest").agg(
        F.count_if(F.col("k") == 0).alias("copies"),
        F.sum("n").alias("n_tokens"),
        F.bool_or("bad").alias("failed"),
    )
    known = sizes.groupBy("doc_id", "digest").agg(F.max("n_bytes").alias("n_bytes"))
    same = (per_text["digest"] == known["digest"]) & per_text["doc_id"].eqNullSafe(known["doc_id"])
    return per_text.join(known, same).select(
        per_text["doc_id"], per_text["digest"], "copies", "n_tokens", "failed", "n_bytes"
    )
