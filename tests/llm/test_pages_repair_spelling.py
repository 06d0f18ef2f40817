"""Main text of pages, repair of conversations, spelling variants."""

import random
import re
from html import unescape

import brute
import pytest
from pyspark.sql import functions as F

from meterlake.llm import pages, repair, spelling
from meterlake.llm.common import Scratch
from meterlake.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
PAGE = "page_id long, url string, html string"
TURNS = "conv_id long, turn long, role string, text string"
DOC = "doc_id long, text string"

RUNNING = "The house by the river is one of the oldest in the town and it was built for a miller and his family."


# Pages


def text_of(page):
    return pages.main_text(page)[0]


def test_every_page_gives_its_article(spark):
    rows = spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()
    got = {r.page_id: r for r in QUERIES["op11_html_extraction"](spark, SF_DIR).collect()}
    assert len(got) == len(rows)
    for r in rows:
        inside = re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.S).group(1)
        want = " ".join(unescape(re.sub(r"<[^>]*>", "", re.sub(r"<(/?(p|h1)|br)>", " ", inside))).split())
        assert (got[r.page_id].text, got[r.page_id].n_chars, got[r.page_id].url) == (want, len(want), r.url)


def test_pages_without_an_article_element():
    page = f"""<html><head><title>T</title></head><body><header><h2>The Site of the Town</h2></header>
        <div id="main-menu"><a href=/a>One</a> <a href=/b>Two</a></div>
        <div class="content"><h1>An old house</h1><p>{RUNNING}<p>Short one.<p>zzgr qwx vbn plk mnh wqe rty uio pas dfg hjk lmn opq
        <ul><li>{RUNNING}</li></ul></div>
        <div class="cookie-notice"><p>{RUNNING}</p></div><div class="sidebar"><p>{RUNNING}</p></div>
        <section id="comments"><article class="comment"><p>{RUNNING}</p></article></section>
        <form><p>{RUNNING}</p><textarea>{RUNNING}</textarea></form>
        <div><a href="/x">See the other houses of the town and of the valley by the river here</a></div>
        <p>&copy; the town</p><footer>{RUNNING}</footer></body></html>"""
    junk = "zzgr qwx vbn plk mnh wqe rty uio pas dfg hjk lmn opq"
    assert text_of(page) == f"An old house {RUNNING} Short one. {junk} {RUNNING}"


def test_an_article_is_kept_whole_but_for_its_furniture():
    page = f"""<nav><ul><li><a href=x>Home</a><article><header><h1>Title</h1></header><p>One &lt;two&gt; &amp;amp; three&nbsp;four
        <script>document.write("<p>no</p>")</script><!-- <p>no --><div class="ad banner">{RUNNING}</div>
        <aside>{RUNNING}</aside><blockquote>x<b>y</b>z</blockquote><table><tr><td>1<td>2</table>
        <footer>By the author</footer></article><p>{RUNNING}</p><article><p>Second."""
    assert text_of(page) == "Title One <two> &amp; three four xyz 1 2 Second."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("just words", "just words"),
        ("<p>", ""),
        ("a < b & c > d", "a < b & c > d"),
        ("<!-- never closed <p>x", ""),
        ("<script>never closed <p>x", ""),
        ("<p>x<a href='y", "x"),
        ("<p title='a>b'>x</p>", "x"),
        ("<p title=it's>x</p><p>y</p>", "x y"),
        (f"<body class='ads'><div class='ad'><p>{RUNNING}</p></div></body>", RUNNING),
        ("<div>" * 50_000 + "deep" + "</p></ul>" * 50_000, "deep"),
    ],
)
def test_odd_pages(page, text):
    assert text_of(page) == text


def test_pages_table_with_nulls_repeats_and_names_that_clash(spark):
    long_ = "<article>" + f"<p>{RUNNING}" * 20_000 + "</article>"
    rows = [(1, None, None), (1, None, None), (None, "u", "<p>x"), (2, "v", long_), (3, None, "")]
    df = spark.createDataFrame(rows, PAGE).withColumns({c: F.lit("own") for c in ("text", "n_chars", "a.b", "__n")})
    got = sorted((r.page_id or 0, r.url or "", r.text) for r in pages.extract_main_text(df).collect())
    assert got == [(0, "u", "x"), (1, "", ""), (1, "", ""), (2, "v", " ".join([RUNNING] * 20_000)), (3, "", "")]
    assert pages.extract_main_text(df.limit(0)).collect() == []


# Conversations


def repaired(spark, rows, **more):
    df = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit("own") for c in ("seg", "digest", "part", "n", "a.b")})
    out = repair.repair(repair.damaged(df), **more).collect()
    assert len(out) == len({r.conv_id for r in out})
    return {r.conv_id: tuple(r)[1:] for r in out}


def wanted(rows):
    return {conv: brute.repaired(turns) for conv, turns in brute.after_damage(rows).items()}


def odd_conversations(seed, count):
    pick = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "a"]
    texts = ["hi.", "yes", "no!", "  ", "a b?", "x", "same.", None, "", " "]
    rows = []
    for c in range(count):
        for t in range(pick.choice([1, 2, 3, 5, 8, 30])):
            rows.append((c or None, pick.choice([t, t, t, None, 3]), pick.choice(roles), pick.choice([*texts, f"turn {t}."])))
    return rows + pick.sample(rows, len(rows) // 10)


def test_every_conversation_is_repaired(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r)[1:] for r in QUERIES["op12_structure_repair"](spark, SF_DIR).collect()}
    assert got == wanted(rows)


@pytest.mark.parametrize("max_rows", [512, 3])
def test_odd_conversations_in_segments_of_any_size(spark, max_rows):
    rows = odd_conversations(7, 120)
    assert repaired(spark, rows, max_rows=max_rows) == wanted(rows)


def test_one_long_conversation_in_many_tasks(spark):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pick = random.Random(5)
        rows = [(5, t, pick.choice(["user", "assistant", "system"]), pick.choice(["a.", "b", f"{t}!"])) for t in range(3000)]
        rows += [(c, 0, "user", "x.") for c in range(6, 40)]
        assert repaired(spark, rows, max_rows=50) == wanted(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_no_conversations_and_very_long_texts(spark):
    assert repaired(spark, []) == {}
    rows = [(1, 0, "user", "w " * 1_000_000), (1, 1, "assistant", "v" * 2_000_000 + ".")]
    assert repaired(spark, rows, max_chars=1000) == wanted(rows)
    # Every row of this conversation is dropped.
    gone = next(c for c in range(1000) if all(brute.zlib.crc32(f"{c}:{t}".encode()) % 20 == 0 for t in (0,)))
    assert repaired(spark, [(gone, 0, "user", "x.")]) == {gone: (0, 0, 0, 0, 0, 0, "", brute.sha(b""))}


def test_ranks_pick_the_least_path():
    """Least letters over all cheapest edits of short conversations, by trying all of them."""
    import itertools

    pick = random.Random(3)
    for _ in range(60):
        rows = [(t, pick.choice(["user", "assistant", "system"]), pick.choice(["a.", "b", ""])) for t in range(pick.randint(0, 4))]
        codes = bytes("sua".index(r[1][0]) for r in rows)
        faults = bytes(repair.BLANK if not r[2] else repair.TRUNCATED if r[2] == "b" else repair.SOUND for r in rows)
        turns = repair.Turns([codes], [faults])
        costs = turns.costs_to_go(repair.np.array([repair.CLOSING])[:, :, None])[:, :, 0]
        arcs = turns.optimal_arcs(costs, repair.np.array([True]))
        _, arc, _ = repair.least_paths(arcs, repair.np.array([0]))
        audit = "".join(repair.LETTERS[a % 4] for a in arc.tolist())

        def cost_of(word, codes=codes, faults=faults):
            state, k, cost = repair.EMPTY, 0, 0
            for letter in word:
                if letter == "I":
                    state, cost = repair.TURNED[state], cost + 2
                    continue
                if k == len(codes):
                    return None
                lost, extra = faults[k] == repair.BLANK, faults[k] == repair.TRUNCATED
                if letter == "D":
                    cost += 3
                elif lost:
                    return None
                elif letter == "R":
                    state, cost = repair.TURNED[state], cost + 2 + extra
                else:
                    state, cost = repair.KEPT[codes[k]][state], cost + extra
                    if state < 0:
                        return None
                k += 1
            return cost if k == len(codes) and state in (repair.EMPTY, repair.ASSISTANT) else None

        every = ((cost_of(w), "".join(w)) for n in range(len(rows) + 4) for w in itertools.product("DIKR", repeat=n))
        assert (int(costs[0, 0]), audit) == min(e for e in every if e[0] is not None)


# Spelling


def near_pairs(spark, words):
    df = spark.createDataFrame([(w,) for w in words], "word string")
    got = [(r.word, r.near) for r in spelling.neighbours(df, Scratch(spark)).collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_every_word_and_form(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    got = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in QUERIES["op13_spelling_variants"](spark, SF_DIR).collect()}
    assert got == brute.spelling_variants(brute.word_counts(texts))


def test_neighbours_of_dense_words(spark):
    """Words of few letters, where nearly all are near one another, repeated letters and long ones."""
    pick = random.Random(1)
    words = {"".join(pick.choice("abé") for _ in range(pick.randint(6, 9))) for _ in range(400)}
    words |= {"a" * n for n in range(6, 14)} | {"ab" * n for n in range(3, 8)} | {"z" * 300, "z" * 299, "z" * 150 + "y" + "z" * 149}
    counts = dict.fromkeys(words, 5)
    want = brute.spelling_variants(counts)
    pairs = near_pairs(spark, words)
    assert {w: len([1 for a, _ in pairs if a == w]) for w in words} == {w: v[1] for w, v in want.items()}


def test_forms_follow_the_most_frequent_word(spark):
    counts = {"abcdef": 5, "abcdeg": 25, "abcdeh": 25, "abcdegh": 125, "abxdegh": 700, "zzzzzz": 24, "zzzzzy": 5, "qqqqqq": 9}
    df = spark.createDataFrame([(w,) for w, n in counts.items() for _ in range(n)] + [(None,), ("short",)], "word string")
    rows = spelling.variants(df.withColumn("n", F.lit("own"))).collect()
    assert {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in rows} == brute.spelling_variants(counts)
    assert {r.word: r.root for r in rows}["abcdef"] == "abxdegh"


def test_words_of_odd_texts(spark):
    pick = random.Random(4)
    vocabulary = ["Straße", "élèvesÀ", "ÉLÈVES×÷", "naïveté", "abcdefg", "ABCDEFG", "abcdef", "x" * 40]
    rows = [(None if d % 7 == 0 else d, " ".join(pick.choices(vocabulary, k=60))) for d in range(300)]
    rows += [(1, None), (2, ""), (3, "1234 .,;"), (4, "long" * 20_000), (4, "long" * 20_000)] + [(d, "long" * 500) for d in range(5)]
    df = spark.createDataFrame(rows, DOC).withColumns({c: F.lit("own") for c in ("word", "run", "h", "a.b")})
    out = spelling.variants(spelling.damaged_words(df))
    got = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in out.collect()}
    assert got == brute.spelling_variants(brute.word_counts(rows))
    assert spelling.variants(spelling.damaged_words(df.limit(0))).collect() == []
