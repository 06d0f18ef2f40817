"""Quality rules as a ledger of failure bits."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import SPACES, let

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """A rule fails where ``fails`` is true of the measurements. ``bit`` is its place in the ledger."""

    name: str
    bit: int
    fails: Column

    @property
    def mask(self) -> int:
        return 1 << self.bit


def rules() -> list[Rule]:
    """Every rule, each evaluated once a document. Bits are never reused for another meaning."""
    c = F.col
    return [
        Rule("few_words", 0, c("n_words") < 50),
        Rule("repeated_words", 1, 100 * c("n_repeat_words") > 50 * c("n_words")),
        Rule("symbols", 2, 10 * c("n_symbols") > c("word_chars")),
        Rule("duplicate_lines", 3, 100 * c("n_dup_lines") > 60 * c("n_lines")),
        Rule("word_length", 4, (c("word_chars") < 2 * c("n_words")) | (c("word_chars") > 25 * c("n_words"))),
        Rule("no_letters", 5, 2 * c("n_letters") < c("word_chars")),
    ]


# Versions of the policy: the names of the rules that reject. Old versions stay, so that a
# ledger written once can be judged by any of them.
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols"),
    "v2": ("few_words", "repeated_words", "symbols", "duplicate_lines", "word_length", "no_letters"),
}
CURRENT = "v2"


def policy_mask(policy: str) -> int:
    return sum(rule.mask for rule in rules() if rule.name in POLICIES[policy])


def repeat_words(words: Column) -> Column:
    """Words that lie in a three-word window found twice or more in the same text.

    Windows are compared by a 64-bit hash. Only texts with a repeated window are sorted;
    sorting brings equal windows together, so no pair of windows is ever formed.
    """
    size = F.size(words)
    grams = F.when(
        size >= 3,
        let(
            words,
            lambda w: F.transform(
                F.sequence(F.lit(0), F.size(w) - 3),
                lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)),
            ),
        ),
    ).otherwise(F.array().cast("array<bigint>"))

    def covered(s: Column) -> Column:
        def same(k: Column, other: Column) -> Column:
            return F.coalesce(F.get(s, other)["h"] == F.get(s, k)["h"], F.lit(False))

        repeated = F.filter(
            F.sequence(F.lit(0), F.size(s) - 1), lambda k: same(k, k - 1) | same(k, k + 1)
        )
        positions = F.flatten(
            F.transform(
                repeated,
                lambda k: let(F.get(s, k)["i"], lambda p: F.array(p, p + 1, p + 2)),
            )
        )
        return F.size(F.array_distinct(positions))

    def counted(g: Column) -> Column:
        placed = F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(
            let(F.sort_array(placed), covered)
        )

    return let(grams, counted)


def measure(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and the measurements, all long. A null text measures as an empty one."""
    words = F.array_remove(F.split("text", SPACES), "")
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def of_words(w: Column) -> list[Column]:
        return [
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeat_words(w).cast("long").alias("n_repeat_words"),
        ]

    def of_lines(ls: Column) -> list[Column]:
        n = F.size(ls)
        return [
            n.cast("long").alias("n_lines"),
            (n - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
        ]

    clean = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return clean.select(
        "doc_id",
        let(words, lambda w: F.struct(*of_words(w))).alias("w"),
        let(lines, lambda ls: F.struct(*of_lines(ls))).alias("l"),
        F.length(F.regexp_replace("text", rf"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace("text", r"\P{L}+", "")).cast("long").alias("n_letters"),
    ).select("doc_id", "w.*", "l.*", "n_symbols", "n_letters")


def ledger(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Measurements and ``failed``, a long with one bit a rule.

    One row a row of the input, repeated ids included. An empty or null text has no words and
    fails ``few_words``. An empty table gives an empty ledger. Other columns are not read.
    """
    bits = [F.when(rule.fails, F.lit(rule.mask)).otherwise(F.lit(0)) for rule in rules()]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measure(docs, doc_id, text).withColumn("failed", failed.cast("long"))


def keeps(failed: Column, policy: str = CURRENT) -> Column:
    """Whether a policy keeps a document, from its ledger entry alone."""
    return failed.bitwiseAND(F.lit(policy_mask(policy)).cast("long")) == 0


def ablations(entries: DataFrame, policy: str = CURRENT) -> DataFrame:
    """For each rule of a policy: documents it fails, fails alone, and kept without it.

    The ledger shrinks to one row for each bit pattern first, so the size of the corpus no
    longer matters. ``n_only`` counts documents that the rule alone rejects.
    """
    mask = policy_mask(policy)
    patterns = entries.groupBy(F.col("failed").bitwiseAND(F.lit(mask).cast("long")).alias("bits")).agg(
        F.count("*").alias("n")
    )
    listed = F.explode(
        F.array(
            *[
                F.struct(F.lit(r.name).alias("rule"), F.lit(r.mask).cast("long").alias("mask"))
                for r in rules()
                if r.mask & mask
            ]
        )
    )
    each = patterns.select("bits", "n", listed.alias("r"))
    left = F.col("bits").bitwiseAND(F.bitwise_not(F.col("r.mask")))

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0)).cast("long")

    return each.groupBy(F.col("r.rule").alias("rule")).agg(
        total(F.col("bits").bitwiseAND(F.col("r.mask")) != 0).alias("n_failed"),
        total(F.col("bits") == F.col("r.mask")).alias("n_only"),
        total(left == 0).alias("n_kept_without"),
        F.bit_or("bits").alias("seen_with"),
    )


def filter_documents(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The documents that a policy keeps, with all their columns."""
    row = F.struct(*[F.col(f"`{c}`").alias(c) for c in docs.columns])
    measured = ledger(docs.select(row.alias("row"), "text"), "row")
    kept = measured.where(keeps(F.col("failed"), policy))
    return kept.select(*[F.col("doc_id").getField(c).alias(c) for c in docs.columns])
