"""Spelling variants: words one edit apart, found by walking tries that are tables of edges.

A trie's node is a beginning that words share and where they part or one ends; its edges bear
the characters up to the next node. States (word, position, node, edits) are joined with the
edges level by level, all words at once.

Two words one edit apart share at least the first or the last half of the longer one. So there
are two tries, of the words and of the words reversed, and a word leaves its own path only
behind its middle, where few words are left on it, instead of at the root, where all are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.common import Scratch

WORD = r"[A-Za-zÀ-ÿ]+"
FOLD = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LEAST_LENGTH = 6
LONG_KEY = 40  # a longer beginning is known by its digest


def damaged_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word``, a row an occurrence in the texts: letter runs, A-Z lower-cased, some with a typo.

    The hash of ``<doc_id>:<run>`` decides whether, and where, a run loses a character. A null
    text has no words, a null id is hashed as an empty one.
    """
    runs = docs.select(
        F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).alias("doc"),
        F.explode(F.regexp_extract_all(F.col(f"`{text}`"), F.lit(WORD), F.lit(0))).alias("run"),
    )
    # Deleting leaves at most one character less, so shorter runs are no words either way.
    runs = runs.where(F.length("run") >= LEAST_LENGTH).select("doc", F.translate("run", *FOLD).alias("run"))
    hashed = runs.select("run", F.crc32(F.concat("doc", F.lit(":"), "run")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return hashed.select(F.when(F.col("h") % 199 == 0, cut).otherwise(F.col("run")).alias("word"))


def _key(beginning: Column) -> Column:
    return F.when(F.length(beginning) <= LONG_KEY, beginning).otherwise(F.sha2(beginning, 256))


def _part(string: str, start: Column, length: Column) -> Column:
    """Characters of a column from a place counted from 0."""
    return F.substring(F.col(string), (start + 1).cast("int"), length.cast("int"))


def neighbours(words: DataFrame, scratch: Scratch) -> DataFrame:
    """``word, near``: every ordered pair of ``words`` that differ by one edit, once.

    The words must be distinct, and of two code points at least.

    Each pair is met from its longer word, by leaving out a character, or, of two of a length,
    from the one whose character is the smaller. A word leaves its own path at the first place
    where the two spellings part, which is a node of the trie, and from there on every character
    must agree; so each state that is made has a beginning of its rest in the trie, and no pair
    is met twice in one trie.
    """
    forward = words.select(F.lit(0).alias("way"), F.col("word").alias("spell"))
    spelled = forward.unionByName(words.select(F.lit(1).alias("way"), F.reverse("word").alias("spell")))
    size = F.length("spell")
    # The first place where a word may leave its path: behind the half that the other trie takes.
    half = F.floor(size / 2)
    middle = F.when(F.col("way") == 0, half).otherwise(size - half).cast("int")
    least = F.floor(F.lit(LEAST_LENGTH) / 2)
    # Beginnings are tables' rows from the shortest middle on; nearer to the root nothing is met.
    depths = F.sequence(F.least(least, middle).cast("int"), size)
    beginnings = spelled.select("way", "spell", F.explode(depths).alias("depth")).select(
        "way", "spell", "depth",
        _key(F.expr("substring(spell, 1, depth)")).alias("node"),
        F.expr("substring(spell, depth + 1, 1)").alias("next"),
    )
    nodes = (
        beginnings.groupBy("way", "node", "depth")
        .agg(F.min("next").alias("low"), F.max("next").alias("high"))
        # The empty character after a word's end is the least there is.
        .where("low <> high or low = ''")
        .select("way", "node", "depth", (F.col("low") == "").alias("ends"))
    )
    nodes = scratch.store(nodes)
    paths = scratch.store(beginnings.join(nodes, ["way", "node", "depth"]))
    by_word = Window.partitionBy("way", "spell").orderBy("depth")
    edges = (
        paths.select(
            "way", "node", "depth", "spell",
            F.lead("node").over(by_word).alias("child"),
            F.lead("depth").over(by_word).alias("child_depth"),
            F.lead("ends").over(by_word).alias("child_ends"),
        )
        .where("child is not null")
        .select(
            "way", "node", "child", "child_depth", "child_ends",
            F.expr("substring(spell, depth + 1, child_depth - depth)").alias("label"),
        )
        .distinct()
        .withColumn("first", F.substring("label", 1, 1))
    )
    edges = scratch.store(edges)

    # Level 1: words leave their own path, one edit made.
    leaving = paths.where(F.col("depth") >= middle).where("depth < length(spell)")
    shorter = leaving.select(
        "way", "spell", (F.col("depth") + 1).alias("position"), "node", F.col("depth").alias("edit"), F.lit("").alias("put"), "ends",
    )
    following = _part("spell", F.col("position"), F.lit(1))
    passed = _part("spell", F.col("edit"), F.lit(1))
    met = [_met(shorter.where("position = length(spell) and ends"))]
    shorter = shorter.where("position < length(spell)").where(following != passed).drop("ends")
    own = leaving.select("way", "spell", "node", "depth", "next")
    rest = F.expr("substring(spell, depth + 2, length(label) - 1)")
    replaced = (
        own.join(edges, ["way", "node"])
        .where((F.col("first") > F.col("next")) & (rest == F.expr("substring(label, 2)")))
        .select(
            "way", "spell", F.col("child_depth").alias("position"), F.col("child").alias("node"),
            F.col("depth").alias("edit"), F.col("first").alias("put"), F.col("child_ends").alias("ends"),
        )
    )
    replaced = scratch.store(replaced)
    met.append(_met(replaced.where("position = length(spell) and ends")))
    frontier = shorter.unionByName(replaced.where("position < length(spell)").drop("ends"))
    # Further levels: one edge each, by all its characters.
    while True:
        step = frontier.withColumn("first", _part("spell", F.col("position"), F.lit(1))).join(
            edges, ["way", "node", "first"]
        )
        same = F.expr("substring(spell, position + 1, length(label))") == F.col("label")
        stored = scratch.store(
            step.where(same).select(
                "way", "spell", (F.col("position") + F.length("label")).alias("position"),
                F.col("child").alias("node"), "edit", "put", F.col("child_ends").alias("ends"),
            )
        )
        if stored.isEmpty():
            break
        met.append(_met(stored.where("position = length(spell) and ends")))
        frontier = stored.where("position < length(spell)").drop("ends")
    pairs = met[0]
    for more in met[1:]:
        pairs = pairs.unionByName(more)
    pairs = pairs.distinct()
    return pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("word").alias("near")))


def _met(states: DataFrame) -> DataFrame:
    """The pair of words behind each terminal state."""
    near = F.concat(
        F.expr("substring(spell, 1, edit)"), F.col("put"), F.expr("substring(spell, edit + 2)")
    )
    turn = lambda c: F.when(F.col("way") == 1, F.reverse(c)).otherwise(c)
    return states.select(turn(F.col("spell")).alias("word"), turn(near).alias("near"))


def variants(occurrences: DataFrame, least_n: int = 5, ratio: int = 5, least_length: int = LEAST_LENGTH) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word of ``occurrences`` (``word``).

    Words have at least ``least_length`` code points and occur at least ``least_n`` times. A
    word's form is its most frequent near word, the smallest of several, if that occurs
    ``ratio`` times as often; its root is where the forms end. Null words are passed over, an
    empty table gives an empty result, other columns are not read. Long words are taken whole:
    a word takes as many levels as it has places where other words part from it.
    """
    scratch = Scratch(occurrences.sparkSession)
    words = scratch.store(
        occurrences.where(F.length("word") >= least_length)
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= least_n)
    )
    pairs = neighbours(words, scratch)
    counted = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    # A max over structs takes the greater count; the smaller word wins among equals as a min.
    best = (
        pairs.join(counted, "near")
        .groupBy("word")
        .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    )
    large = -F.col("best.less") >= ratio * F.col("n")
    forms = scratch.store(
        words.join(best, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(large, F.col("best.near")).alias("form"),
            F.when(large, -F.col("best.less")).alias("form_n"),
        )
    )
    roots = _roots(forms.where("form is not null").select("word", "form"), scratch)
    return forms.join(roots, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )


def _roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """``word, root``: where the forms of each word end, by pointers that double their reach.

    Each form is several times as frequent as its word, so chains are short and never close.
    """
    now = scratch.store(forms.select("word", F.col("form").alias("root")))
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        after = scratch.store(
            now.join(further, "root", "left").select(
                "word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")
            )
        )
        if after.where("moved").isEmpty():
            return after.select("word", "root")
        now = after.select("word", "root")
