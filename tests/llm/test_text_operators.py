"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import random
import zlib
from collections import Counter

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from meterlake.llm import bpe, chat, language, lines, nearest, neardup, packing, quality, suffixes, tokens
from meterlake.llm.common import Scratch, running_sums
from meterlake.llm.components import components

DOC = "doc_id long, text string"
WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one two three"),
    (4, "one two three"),
    (None, "no id but some words to read here"),
    (5, "é" * 3000),
    (6, "\U0001f600 日本語 \x00 <|endoftext|> don't IT'S 12a3.., ½ ﬁ İ"),
]


def frame(spark, rows, schema=DOC):
    return spark.createDataFrame(rows, schema)


def clashing(df):
    """Columns with names that operators use inside."""
    names = ["value", "node", "key", "tag", "removed", "n", "others", "component_id", "line", "ids", "lang_pred"]
    return df.withColumns({name: F.lit(f"own {name}") for name in names})


# Chat formatting

TURNS = "conv_id long, turn long, role string, text string"


def formatted(spark, rows):
    out = chat.format_chat(frame(spark, rows, TURNS))
    return out.select(
        "conv_id",
        "formatted",
        "n_blocks",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss_texts(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    ).collect()


def test_chat_reads_back_what_went_in(spark):
    nasty = ["<|im_end|>\n", r"<\|im_sep|>", r"<\\|", "<", "|im_start|>", "", None, "a\nb", "é<|", "\\"]
    rows = [(1, i, "assistant" if i % 3 else "user", t) for i, t in enumerate(nasty)]
    rows += [(2, 0, "us\ner<nl>", "x"), (2, 1, r"<\nl>", None), (None, 0, None, "no role"), (3, None, "user", "t")]
    got = {r.conv_id: r for r in formatted(spark, rows)}
    assert [(t.role, t.text) for t in got[1].turns] == [(r[2], r[3] or "") for r in rows[:10]]
    assert got[1].loss == [r[3] or "" for r in rows[:10] if r[2] == "assistant"]
    assert [(t.role, t.text) for t in got[2].turns] == [("us\ner<nl>", "x"), (r"<\nl>", "")]
    assert [(t.role, t.text) for t in got[None].turns] == [("", "no role")]
    assert got[1].n_blocks == 7


def test_chat_ties_repeats_and_long_conversations(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a")]
    rows += [(2, i, "user" if i % 2 else "assistant", f"t{i}") for i in range(3000)]
    got = {r.conv_id: r for r in formatted(spark, rows)}
    assert [t.text for t in got[1].turns] == ["a", "a", "b"] and got[1].n_blocks == 1
    assert "".join(got[2].loss) == "".join(f"t{i}" for i in range(0, 3000, 2))
    assert formatted(spark, []) == []


def test_running_sums(spark):
    for n in (0, 1, 256, 257, 1000):
        df = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(max(n, 1))), lambda x: x.cast("long")).alias("x"))
        df = df.select(F.slice("x", 1, n).alias("x"))
        assert df.select(running_sums(F.col("x"))).first()[0] == [sum(range(1, i + 1)) for i in range(n)]


# Quality

def test_ledger_measures_and_policies(spark):
    good = " ".join(f"word{i}" for i in range(60))
    rows = [*ODD, (7, good), (8, "same words again " * 40), (9, "ab #$ " * 60), (10, (good + "\n") * 3)]
    got = {r.doc_id: r for r in quality.ledger(clashing(frame(spark, rows))).collect()}
    assert got[1].n_words == 0 and got[2].n_words == 0 and got[3].n_lines == 0 and got[1].failed & 1
    assert got[7].failed == 0 and got[8].failed == 2 | 0 and got[8].n_repeat_words == 120
    assert got[9].n_symbols == 120 and got[10].n_dup_lines == 2 and got[10].n_repeat_words == 180
    assert quality.ledger(frame(spark, [])).count() == 0
    kept = quality.filter_documents(clashing(frame(spark, rows)))
    assert [r.doc_id for r in kept.collect()] == [7] and kept.columns == clashing(frame(spark, rows)).columns


def test_ablations_count_what_each_rule_rejects(spark):
    entries = spark.createDataFrame([(b,) for b in (0, 0, 1, 1, 3, 2, 4, 64)], "failed long")
    got = {r.rule: r for r in quality.ablations(entries, "v1").collect()}
    assert (got["few_words"].n_failed, got["few_words"].n_only, got["few_words"].n_kept_without) == (3, 2, 5)
    assert (got["symbols"].n_failed, got["symbols"].n_only, got["symbols"].n_kept_without) == (1, 1, 4)


# Lines

def test_runs_of_lines(spark):
    rows = [
        (1, "a b\nc d\ne f\nown"),
        (2, "x\na b\n\nc d\ne f\ny"),
        (3, "e f\nz\na b"),
        (4, "l\nl\nl\nl"),
        (5, None),
        (6, ""),
        (None, "a b\nc d"),
        (7, "a b\nc d"),
        (7, "a b\nc d"),
    ]
    out = lines.remove_repeated_lines(clashing(frame(spark, rows)))
    got = Counter((r.doc_id, r.text, r.n_removed) for r in out.collect())
    assert got == Counter(
        [
            (1, rows[0][1], 0),
            (2, "x\n\ny", 3),
            (3, rows[2][1], 0),
            (4, "l", 3),
            (5, None, 0),
            (6, "", 0),
            (None, "a b\nc d", 0),
            (7, "", 2),
            (7, "", 2),
        ]
    )
    assert lines.remove_repeated_lines(frame(spark, [])).count() == 0


@pytest.mark.parametrize("window", [1, 2, 3, 5])
def test_winnowed_windows_find_all_runs(spark, window):
    rng = random.Random(window)
    rows = []
    for i in range(120):
        text = [rng.choice("abcd") if i % 3 else rng.choice("abcdefghijklmnop") for _ in range(rng.randint(0, 14))]
        rows.append((i, "\n".join(x if rng.random() < 0.9 else " " for x in text)))
    seen, want = set(), {}
    for doc, text in rows:
        filled = [(k, x) for k, x in enumerate(text.split("\n")) if x.strip()]
        gone = set()
        for k in range(len(filled) - window + 1):
            held = tuple(x for _, x in filled[k : k + window])
            if held in seen:
                gone.update(n for n, _ in filled[k : k + window])
            seen.add(held)
        if gone:
            want[doc] = gone
    found = lines.repeated_lines(frame(spark, rows), window).collect()
    assert {r.doc_id: {n for x in r.removed for n in range(x.begin, x.end)} for r in found} == want


def test_long_lines_and_short_texts_are_runs(spark):
    long_, under = " ".join(f"w{i}" for i in range(50)), " ".join(f"w{i}" for i in range(49))
    rows = [
        (1, f"own\n{long_}\nelse"),
        (2, long_),
        (3, f"x\n{long_}\ny\n{long_}"),
        (4, f"p\n{under}\nq"),
        (5, under),
        (6, f"r\n{under}\ns"),
        (7, under),
        (8, ""),
        (9, None),
        (None, long_),
        (10, " \n "),
    ]
    out = lines.remove_repeated_lines(clashing(frame(spark, rows)), long_words=50)
    got = {r.doc_id: (r.text, r.n_removed, r.n_runs) for r in out.collect()}
    want = {d: (t, 0, 0) for d, t in rows} | {2: ("", 1, 1), 3: ("x\ny", 2, 2), 7: ("", 1, 1)}
    assert got == want
    assert lines.remove_repeated_lines(frame(spark, []), long_words=50).count() == 0
    three = frame(spark, [(1, "a b\nc d"), (2, "a b\nc d"), (3, "c d\na b"), (4, "z\na b\nc d")])
    got = {r.doc_id: r.text for r in lines.remove_repeated_lines(three, 3, long_words=50).collect()}
    assert got == {1: "a b\nc d", 2: "", 3: "c d\na b", 4: "z\na b\nc d"}


def test_pipeline_takes_long_lines(spark):
    """A one-line text that copies an earlier one, and a long line between unique ones."""
    long_ = " ".join(f"w{i}" for i in range(60))
    rows = [(1, long_), (2, long_), (3, f"x\n{long_}\ny"), (4, "z")]
    out = corpus_pipeline.line_dedup(spark, frame(spark, rows), "")
    assert {r.doc_id: r.text for r in out.collect()} == {1: long_, 2: "", 3: "x\ny", 4: "z"}


# Repeated bytes

def spans_of(df):
    return Counter((r.doc_id, r.text, tuple((s.begin, s.end) for s in r.removed)) for r in df.collect())


def test_repeated_bytes_edge_cases(spark):
    passage = "".join(random.Random(1).choices("abcdefghij klmno", k=200))
    rows = [*ODD, (20, passage), (21, "x" + passage[:49]), (22, "y" + passage[10:60] + "z"), (23, passage), (23, passage)]
    rows += [(None, passage), (24, passage + passage[:60])]
    got = spans_of(suffixes.repeated_spans(clashing(frame(spark, rows))))
    assert got[(21, rows[9][1], ())] == 1 and got[(22, rows[10][1], ((1, 51),))] == 1
    assert got[(23, passage, ((0, 200),))] == 2 and got[(None, passage, ())] == 1
    assert got[(24, rows[-1][1], ((0, 260),))] == 1
    assert spans_of(suffixes.repeated_spans(frame(spark, []))) == Counter()


def test_repeated_bytes_of_one_id_and_degenerate_texts(spark):
    rows = [(1, "a" * 300), (1, "b" * 120), (2, "c" + "a" * 80), (2, "b" * 60 + "d"), (3, "ab" * 100), (4, "ba" * 40)]
    got = spans_of(suffixes.repeated_spans(frame(spark, rows)))
    want = {0: (), 1: (), 2: ((1, 81),), 3: ((0, 60),), 4: (), 5: ((0, 80),)}
    assert got == Counter((d, t, want[i]) for i, (d, t) in enumerate(rows))


def test_repeated_bytes_random(spark):
    random_ = random.Random(7)
    parts = ["".join(random_.choices("ab ", k=random_.randint(20, 90))) for _ in range(12)]
    rows = [(i, "".join(random_.choices(parts, k=random_.randint(1, 6)))) for i in range(80)]
    found = suffixes.repeated_spans(frame(spark, rows)).collect()
    want = brute.removed_bytes(rows)
    for r in found:
        assert sum(s.end - s.begin for s in r.removed) == want[r.doc_id][1]
        assert len(r.removed) == want[r.doc_id][2]


def test_large_buckets_are_parted(spark):
    """A gram that a third of all texts hold, with other bytes around it in each."""
    rng = random.Random(11)
    rows = []
    for i in range(300):
        own = "".join(rng.choice("abcdefgh") for _ in range(60))
        rows.append((i, own + ("-" * 40 if i % 3 else own[:20]) + own[::-1][: 30 + i % 7]))
    rows += [(1000 + i, rows[i][1][:90]) for i in range(0, 300, 5)]
    want = brute.removed_bytes(rows)
    for hot in (1, 20, 10**6):
        for r in suffixes.repeated_spans(frame(spark, rows), hot=hot).collect():
            assert (sum(s.end - s.begin for s in r.removed), len(r.removed)) == want[r.doc_id][1:3]


@pytest.mark.parametrize("size", [3, 8, 20, 50])
def test_bucket_pointers_are_equal_for_equal_bytes_only(size):
    rng = np.random.default_rng(size)
    lengths = rng.integers(0, 120, 200)
    begins = np.cumsum(lengths) - lengths
    data = rng.integers(97, 99, lengths.sum()).astype(np.uint8)
    data[begins[50] : begins[50] + lengths[50]] = 97
    pointer = suffixes.bucket_pointers(data, begins, lengths, size)
    names = {}
    for begin, length in zip(begins.tolist(), lengths.tolist(), strict=True):
        for at in range(begin, begin + length - size + 1):
            names.setdefault(data[at : at + size].tobytes(), set()).add(int(pointer[at]))
    assert all(len(found) == 1 for found in names.values())
    assert len(set.union(*names.values())) == len(names)


def test_later_buckets_are_sorted_by_pointers_of_later_offsets(monkeypatch):
    """Every round after the first sorts the members of buckets that are not single by two pointers."""
    text = b"x" * 30 + b"the same fifty bytes stand here twice, and then some more" + b"y" * 30
    data = np.frombuffer(text + text, np.uint8)
    begins, lengths = np.array([0, len(text)]), np.array([len(text)] * 2)
    sorted_keys, argsort = [], np.argsort

    def noted(keys, **options):
        sorted_keys.append(keys.copy())
        return argsort(keys, **options)

    monkeypatch.setattr(np, "argsort", noted)
    suffixes.bucket_pointers(data, begins, lengths, 50)
    assert len(sorted_keys) == 4  # 8 bytes, then 16, 32, 50
    for keys in sorted_keys[1:]:
        assert (keys >> 32).max() < len(data) and (keys & 0xFFFFFFFF).max() < len(data)
        assert len(keys) < len(sorted_keys[0])


def test_texts_stay_valid_when_bytes_go(spark):
    shared = "ü" * 40
    rows = [(1, "a" + shared), (2, "é" + shared + "ö"), (3, "plain"), (4, None)]
    df = clashing(frame(spark, rows))
    out = suffixes.remove_repeated_bytes(df)
    assert out.columns == df.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert got == {1: "a" + shared, 2: "éö", 3: "plain", 4: ""}


# Near duplicates

def near(spark, rows, **settings):
    found = neardup.near_duplicates(clashing(frame(spark, rows)), **settings).collect()
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in found)


def test_near_duplicate_edge_cases(spark):
    rows = [*ODD, (7, "One  two\nTHREE"), (8, "three two one")]
    got = near(spark, rows)
    assert got[(1, 0, 1)] == 1 and got[(3, 0, 3)] == 1 and got[(4, 1, 4)] == 2 and got[(7, 1, 4)] == 1
    assert got[(8, 1, 8)] == 1 and got[(None, 4, None)] == 1
    assert near(spark, []) == Counter()


def test_frequent_shingles_are_counted_in_all_documents(spark, monkeypatch):
    """A line in 96 documents is frequent and one in 95 is not, whatever their ids."""
    r = random.Random(5)
    often, seldom, ever = ("a b c d e f", "g h i j k l", "m n o p q r")
    rows = []
    for i in range(200):
        shared = [ever, *([often] if i % 2 == 0 and i < 192 else []), *([seldom] if i % 2 and i < 190 else [])]
        rows.append((i, " ".join([f"w{r.randrange(10**9)}", *(f"{s} x{r.randrange(10**9)}" for s in shared)])))
    clean = frame(spark, rows)

    def hashes(text):
        return set(neardup.shingle_sets(*neardup.flat(neardup.pa.array([text])))[0].view(np.int64).tolist())

    found = list(neardup.frequent_shingles(clean, 5))
    assert len(found) == 4 and set(found) == hashes(often) | hashes(ever) and set(found[2:]) == hashes(ever)
    assert list(neardup.frequent_shingles(clean.where("doc_id < 100"), 5)) == found[2:]
    assert list(neardup.frequent_shingles(clean.limit(0), 5)) == []
    # With more shingles the limit grows, so that the list stays short and nothing is cut off it.
    monkeypatch.setattr(neardup, "LISTED", 16)
    assert set(neardup.frequent_shingles(clean, 5)) == hashes(ever)


def group_of_copies(n, words=80, seed=3):
    """Copies of one text with few to many words changed, and texts that share half of it."""
    r = random.Random(seed)
    base = [f"w{r.randrange(10**6)}" for _ in range(words)]
    rows = []
    for i in range(n):
        copy = list(base)
        for _ in range(r.choice([0, 1, 1, 2, 3, 4, 6])):
            copy[r.randrange(words)] = f"c{r.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    for i in range(n, n + n // 3):
        own = [f"o{r.randrange(10**6)}" for _ in range(words // 2)]
        rows.append((i, " ".join(base[: words // 2] + own)))
    return rows


@pytest.mark.parametrize("short", [4, 32])
def test_large_groups_lose_no_link(spark, short):
    rows = group_of_copies(150)
    want = brute.linked(rows)
    assert near(spark, rows, short=short) == Counter((d, n, c) for d, (n, c) in want.items())


def test_no_link_between_a_text_and_its_prefix_is_lost(spark):
    """Sketches of 85 to 140 shingles reach past the middle of the range of hashes."""
    r = random.Random(11)
    rows = []
    for i in range(1500):
        n = r.randint(85, 140)
        words = [f"w{r.randrange(10**9)}" for _ in range(n + 4)]
        part = min(n, -(-n * r.choice([75, 76, 77]) // 100))
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[: part + 4]))]
    want = brute.linked(rows)
    assert all(want[2 * i + 1][1] == 2 * i for i in range(1500))
    got = {d: c for d, _, c in near(spark, rows)}
    assert [d for d in got if got[d] != want[d][1]] == []


def test_components_of_a_long_path(spark):
    scratch = Scratch(spark)
    order = list(range(200))
    random.Random(2).shuffle(order)
    edges = spark.createDataFrame(list(zip(order, order[1:], strict=False)) + [(900, 901), (5, 5)], "a long, b long")
    got = {r.node: r.component for r in components(edges, scratch).collect()}
    assert got == {**dict.fromkeys(order, 0), 900: 900, 901: 900}
    assert components(edges.limit(0), scratch).count() == 0


# Tokens

def test_byte_bpe_round_trip(spark):
    for size in (16 << 20, 40):
        encoded = bpe.encode(clashing(frame(spark, ODD)), RANKS, public_tokenizers.PATTERN, group_chars=size)
        decoded = bpe.decode(encoded, RANKS).collect()
        assert Counter((r.doc_id, bytes(r.decoded).decode()) for r in decoded) == Counter((d, t or "") for d, t in ODD)
    assert bpe.encode(frame(spark, []), RANKS, public_tokenizers.PATTERN).count() == 0
    bad = spark.createDataFrame([(1, bytearray(b"\xff\xff\xff\x00"))], "doc_id long, ids binary")
    with pytest.raises(Exception, match="vocabulary"):
        bpe.decode(bad, RANKS).collect()


def test_byte_bpe_holds_no_group_of_texts_whole():
    """A group's texts are read one by one: only one batch of them is there at a time."""
    import tracemalloc

    def batches():
        for k in range(80):
            texts = [f"{i} ".ljust(20_000, "x") for i in range(k * 5, k * 5 + 5)]
            ids = bpe.pa.array(range(k * 5, k * 5 + 5))
            yield bpe.pa.record_batch([ids, bpe.pa.array(texts)], names=["doc_id", "text"])

    def read(group_chars):
        return [([(d, len(t)) for d, t in rows], bpe._name(name)) for rows, name in bpe._cut(batches(), group_chars)]

    read(1 << 20)
    tracemalloc.start()
    one = read(8 << 20)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [rows for rows, _ in one] == [[(i, 20_000) for i in range(400)]] and peak < 1 << 20
    several = read(50_000)
    assert [len(rows) for rows, _ in several] == [2] * 200 and len({name for _, name in several}) == 200
    assert read(50_000) == several


def test_byte_bpe_puts_documents_together_in_small_batches(monkeypatch):
    import zstandard

    monkeypatch.setattr(bpe, "BATCH_WORDS", 50)
    monkeypatch.setattr(bpe, "STEP_WORDS", 7)
    pack, r, kind = zstandard.compress, random.Random(8), np.dtype("<u2")
    words = [[r.randrange(60_000) for _ in range(r.randint(1, 5))] for _ in range(40)]
    docs = [(i if i % 9 else None, [r.randrange(40) for _ in range(r.choice([0, 1, 12, 30, 120]))]) for i in range(60)]
    right = {"numbers": [], "counts": [], "ids": []}
    for part in (range(0, 40, 2), range(1, 40, 2)):
        right["numbers"].append(pack(bpe._planes(np.diff(np.array(part), prepend=0))))
        right["counts"].append(pack(bpe._planes(np.array([len(words[w]) for w in part]))))
        right["ids"].append(pack(np.array(sum((words[w] for w in part), []), kind).tobytes()))
    left = {"n_words": [], "doc_ids": [], "lengths": [], "numbers": []}
    for part in (docs, docs[:7], []):
        left["n_words"].append(40)
        left["doc_ids"].append([d for d, _ in part])
        left["lengths"].append([len(w) for _, w in part])
        left["numbers"].append(pack(bpe._planes(np.array(sum((w for _, w in part), []), np.uint32))))
    long = bpe.pa.int64()
    for name in ("doc_ids", "lengths"):
        left[name] = bpe.pa.array(left[name], bpe.pa.list_(long))
    left = bpe.pa.table(left)
    out = bpe._spelled(left, bpe.pa.table(right), kind, long)
    got = [(d, n, np.frombuffer(i, "<u4").tolist()) for d, n, i in zip(*(c.to_pylist() for c in out.columns), strict=True)]
    want = [(d, sum((words[x] for x in w), [])) for d, w in docs + docs[:7]]
    assert got == [(d, len(i), i) for d, i in want]
    assert all(b.num_rows == 1 or sum(b["n_tokens"].to_pylist()) <= 50 * 5 for b in out.to_batches())
    with pytest.raises(ValueError, match="another order"):
        bpe._spelled(left, bpe.pa.table(right).slice(0, 1), kind, long)


def test_narrow_pattern_finds_the_same_matches():
    import regex

    text = "".join(map(chr, range(256))) + " don't WE'LL x'd  \n\n a\x1cb 12²³ ¼a  "
    assert bpe._splitter(public_tokenizers.PATTERN)(text) == regex.findall(public_tokenizers.PATTERN, text)


@pytest.mark.parametrize(("chunk", "overlap"), [(1 << 16, 256), (60, 4), (50, 1)])
def test_token_counts_by_chunks(spark, chunk, overlap):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = [*ODD, (7, "x" * 700), (7, "x" * 700), (8, "▁ ▁" * 90), (9, "  a  b" * 80), (None, "日本" * 100)]
    got = tokens.token_counts(clashing(frame(spark, rows)), PIECES, chunk_chars=chunk, overlap_chars=overlap).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == Counter(
        (d, len((t or "").encode()), len(model.encode(t or ""))) for d, t in rows
    )
    assert tokens.token_counts(frame(spark, []), PIECES).count() == 0


# Packing

def test_tournament_tree_is_first_fit():
    r = random.Random(4)
    sizes = [r.randint(1, 100) for _ in range(300)]
    tree, room = packing.TournamentTree(len(sizes), 100), [100] * len(sizes)
    for s in sizes:
        first = next(i for i, left in enumerate(room) if left >= s)
        room[first] -= s
        assert tree.place(s) == first


def test_one_bin_stays_short():
    r = random.Random(5)
    for n in (0, 1, 2, 50):
        sizes = [r.randint(1, 100) for _ in range(n)]
        bins = packing.pack_lengths(sizes, 100)
        fill = [sum(x[2] for x in b) for b in bins]
        assert sum(f < 100 for f in fill) <= 1 and sum(fill) == sum(sizes) and all(f <= 100 for f in fill)
        parts = Counter()
        for item, _, length in (x for b in bins for x in b):
            parts[item] += length
        assert [parts[i] for i in range(n)] == sizes


def test_packing_edge_cases(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORDS)
    out = packing.pack(clashing(frame(spark, ODD)), WORDS, capacity=64, group_bytes=500)
    got = Counter()
    for r in out.collect():
        got[r.doc_id] += r.length
    want = Counter()
    for d, t in ODD:
        want[d] += len(library.encode(t or "", add_special_tokens=False).ids) + 1
    assert got == want
    assert packing.pack(frame(spark, []), WORDS).count() == 0


def test_words_are_encoded_as_by_the_library():
    from tokenizers import Tokenizer

    texts = [t or "" for _, t in ODD] + ["".join(map(chr, range(1, 0x500))), " ".join(map(chr, range(1, 0x250)))]
    library = Tokenizer.from_file(WORDS)
    encoder = packing.WordEncoder(WORDS)
    for t, ids in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(ids, encoder.dtype).tolist() == library.encode(t, add_special_tokens=False).ids


# Language

def test_language_edge_cases(spark):
    train = [(i, "the cat and the dog " * 3, "en") for i in range(20)]
    train += [(i, "le chat et le chien " * 3, "fr") for i in range(20, 40)]
    model = language.fit(frame(spark, [*train, (50, "x", None), (51, None, "de")], DOC + ", lang string"))
    assert model.languages == ["en", "fr"]
    rows = [*ODD, (7, "The dogs"), (8, "les chiens"), (9, "123 ... 456")]
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(clashing(frame(spark, rows)), model).collect()}
    assert got[1] == got[2] == got[3] == got[9] == ("und", 0.0)
    assert got[7][0] == "en" and got[8][0] == "fr" and got[5][0] in ("en", "fr")
    assert all(0 <= score <= 1 for _, score in got.values())
    none = language.fit(frame(spark, [], DOC + ", lang string"))
    assert none is None
    assert {r.lang_pred for r in language.identify(frame(spark, ODD), none).collect()} == {"und"}


# Nearest

def test_hilbert_keys_visit_neighbours():
    for axes, bits in ((2, 3), (3, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes), -1).reshape(-1, axes)
        keys = nearest.hilbert_keys(cells, bits)
        assert sorted(keys) == list(range(len(cells)))
        walk = cells[np.argsort(keys)]
        assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


VECTOR = "vec_id long, embedding array<float>"


def test_nearest_edge_cases(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [3.0, 0.0]), (3, [0.0, 1.0]), (4, [1.0, 0.0]), (5, None)]
    rows += [(6, [0.0, 0.0]), (7, [float("nan"), 1.0]), (8, [1.0, None]), (9, [1.0]), (None, [1.0, 1.0]), (10, [-1.0, -0.0])]
    df = clashing(frame(spark, rows, VECTOR))
    found = nearest.nearest(df, spark.createDataFrame([(0,), (5,), (2,), (77,)], "vec_id long"), k=3).collect()
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in found}
    assert got == {
        (0, 1): (2, 3.0),
        (0, 2): (1, 1.0),
        (0, 3): (4, 1.0),
        (2, 1): (0, 3.0),
        (2, 2): (1, 3.0),
        (2, 3): (4, 3.0),
    }
    empty = frame(spark, [], VECTOR)
    assert nearest.nearest(empty, empty.select("vec_id")).count() == 0
    assert nearest.nearest(df, empty.select("vec_id")).count() == 0


def test_checksums_of_pieces(spark):
    out = packing.pack(frame(spark, [(1, "hello world")]), WORDS).first()
    assert zlib.crc32(bytes(out.ids)) == zlib.crc32(np.frombuffer(bytes(out.ids), "<u4").tobytes())
    assert out.length == 3 and out.doc_tokens == 3 and out.start == 0 and out.offset == 0


def test_columns_of_any_name_pass_the_filters(spark):
    """Own columns with names that the operators use inside come out as they went in."""
    names = ["n_removed", "n_runs", "a.b", "__n", "__row", "row", "id", "own", "tag", "removed", "failed"]
    line = "one two three four five six seven eight nine ten\n"
    rows = [(d, line * 2 + " ".join(f"word of {d}x{i}" for i in range(60))) for d in range(4)] + [(None, None)]
    df = frame(spark, rows).withColumns({n: F.lit(f"own {n}") for n in names})
    for out in (quality.filter_documents(df), lines.remove_repeated_lines(df, counts=False)):
        assert out.columns == df.columns
        got = out.select(*[F.col(f"`{n}`") for n in names]).distinct().collect()
        assert [tuple(r) for r in got] == [tuple(f"own {n}" for n in names)]


def test_language_model_uses_whole_characters():
    import pyarrow as pa

    data, begin, end, _ = language._words(pa.array(["aé日 x", None, "", "日本語"]))
    for size, want in ((1, 7), (2, 4), (3, 2), (4, 0)):
        hashes, word = language._pieces(data, begin, end, size)
        assert len(hashes) == len(word) == want
    first, _ = language._pieces(data, begin, end, 1)
    # The character that the first and the third word share has one hash, whatever stands before it.
    assert first[2] == first[4] and len(set(first.tolist())) == 6
