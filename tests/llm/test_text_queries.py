"""The registered queries on the small tables: against SQL where there is one, else brute force."""

import base64
import zlib
from collections import defaultdict

import brute
import numpy as np
import public_tokenizers
import pytest
from compare import differences

import corpus_pipeline
from meterlake.llm.oracle import ORACLE
from meterlake.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]


def test_one_query_an_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    assert differences(QUERIES[name](spark, SF_DIR), ORACLE[name], SF_DIR) == []


def test_repeated_bytes(spark, texts):
    rows = QUERIES["op1_suffix_dedup"](spark, SF_DIR).collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows}
    assert got == brute.removed_bytes(texts)


def test_near_duplicates(spark, texts):
    rows = QUERIES["op4_minhash_neardup"](spark, SF_DIR).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute.linked(texts)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_byte_bpe(spark, texts):
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding(
        "test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    want = {}
    for d, t in texts:
        ids = library.encode_ordinary(t)
        want[d] = (len(ids), brute.sha(" ".join(map(str, ids)).encode()), brute.sha(t.encode()))
    rows = QUERIES["op5_byte_bpe"](spark, SF_DIR).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows} == want


def test_language(spark):
    labels = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = QUERIES["op7_language_id"](spark, SF_DIR).collect()
    assert len(rows) == len(labels)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    held = [labels[r.doc_id] == r.lang_pred for r in rows if r.held_out]
    assert np.mean(held) >= 0.95


def test_nearest(spark):
    vectors = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    ids = np.array([r.vec_id for r in vectors])
    matrix = np.array([r.embedding for r in vectors], np.float64)
    found = defaultdict(list)
    for r in sorted(QUERIES["op8_hilbert_nearest"](spark, SF_DIR).collect(), key=lambda r: r["rank"]):
        found[r.query_id].append((r.vec_id, r.score))
    assert set(found) == {i for i in ids.tolist() if i % 20 == 0}
    hits = []
    for i, near in found.items():
        scores = matrix @ matrix[ids == i][0]
        scores[ids == i] = -np.inf
        true = set(ids[np.lexsort((ids, -scores))[:20]].tolist())
        assert len(near) == 20 and i not in dict(near)
        assert near == sorted(near, key=lambda x: (-x[1], x[0]))
        assert all(abs(s - scores[ids == v][0]) < 1e-12 for v, s in near)
        hits.append(len(true & set(dict(near))) / 20)
    assert np.mean(hits) >= 0.9


def test_token_counts(spark, texts):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = QUERIES["op9_token_counts"](spark, SF_DIR).collect()
    want = {d: (len(t.encode()), len(model.encode(t))) for d, t in texts}
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in rows} == want
    assert all(r.over_limit == (r.n_tokens > 4096) for r in rows)


def pieces_are_whole(rows, texts, crc):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == {d for d, _ in texts}
    for d, t in texts:
        ids = np.array([*library.encode(t, add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for p in sorted(pieces[d], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids) and p.length > 0
            assert crc(p) == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for members in sequences.values():
        at = 0
        for p in sorted(members, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 4096
    return len(sequences)


def test_packing(spark, texts):
    rows = QUERIES["op10_packing"](spark, SF_DIR).collect()
    n = pieces_are_whole(rows, texts, lambda p: p.ids_crc32)
    assert n <= -(-sum(p.length for p in rows) // 4096) + 1


def test_pipeline_against_its_parts(spark, texts):
    """The rows of run() are those of brute force over the kept documents."""
    con_rows = {r.doc_id for r in QUERIES["op3_quality_rules"](spark, SF_DIR).collect() if r.kept}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["quality rules"](spark, docs, SF_DIR)
    assert {r.doc_id for r in kept.collect()} == con_rows and kept.columns == docs.columns
    lines = stages["line dedup"](spark, kept, SF_DIR)
    assert lines.columns == docs.columns
    after_lines = {r.doc_id: r.text for r in lines.collect()}
    assert set(after_lines) == con_rows
    groups = brute.linked(list(after_lines.items()))
    unique = {d: t for d, t in after_lines.items() if groups[d][1] == d}
    cut = {}
    first: dict[bytes, int] = {}
    for d, t in sorted(unique.items()):
        b = t.encode()
        for p in range(len(b) - 49):
            first.setdefault(b[p : p + 50], d)
        cover = bytearray(len(b))
        for p in range(len(b) - 49):
            if first[b[p : p + 50]] < d:
                cover[p : p + 50] = b"\1" * 50
        # A character that is removed in part goes on as a whole.
        at = 0
        for ch in t:
            n = len(ch.encode())
            if 0 in cover[at : at + n]:
                cover[at : at + n] = bytes(n)
            at += n
        cut[d] = bytes(x for x, c in zip(b, cover, strict=True) if not c).decode()
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    pieces_are_whole(rows, list(cut.items()), lambda p: zlib.crc32(p.ids))
