"""Chat formatting: conversations to one marked text each, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import let, running_sums

# The template's control strings (fixed values).
START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    """Text without ``<|``: one backslash more between ``<`` and ``|``, however many there are."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escape_role(role: Column) -> Column:
    """As ``escape``, and without line ends, which close a role."""
    marked = F.regexp_replace(escape(role), r"<(\\*)nl>", r"<\\$1nl>")
    return F.regexp_replace(marked, "\n", "<nl>")


def unescape_role(role: Column) -> Column:
    lines = F.regexp_replace(role, "<nl>", "\n")
    return unescape(F.regexp_replace(lines, r"<\\(\\*)nl>", "<$1nl>"))


def format_chat(
    turns: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    loss_role: str = "assistant",
) -> DataFrame:
    """One row a conversation: ``conv_id, n_blocks, formatted, loss_spans``.

    Turns are collected as structs and sorted by turn, then role, then text (ties and repeated
    rows stay, nulls first). Adjacent turns of one role share a block, their texts parted by a
    control string, so that every turn can be read back. ``loss_spans`` holds start and length,
    in UTF-8 bytes of ``formatted``, of the texts of ``loss_role``. A null text or role counts
    as empty, a null ``conv_id`` is a conversation of its own, no rows give no rows. Other
    columns of the input are not read. A conversation is one row by definition and has to fit
    in memory; turns are collected on the map side first.
    """
    item = F.struct(
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    sorted_turns = turns.groupBy(F.col(conv_id).alias("conv_id")).agg(
        F.sort_array(F.collect_list(item)).alias("turns")
    )

    def blocks(t: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(t) - 1),
            lambda i: (i == 0) | (F.get(t, i)["role"] != F.get(t, i - 1)["role"]),
        )
        return let(
            starts,
            lambda s: F.transform(
                s,
                lambda first, k: F.struct(
                    F.get(t, first)["role"].alias("role"),
                    F.transform(
                        F.slice(t, first + 1, F.coalesce(F.get(s, k + 1), F.size(t)) - first),
                        lambda x: escape(x["text"]),
                    ).alias("texts"),
                ),
            ),
        )

    def head(b: Column) -> Column:
        return F.concat(F.lit(START), escape_role(b["role"]), F.lit("\n"))

    def pieces(bs: Column) -> Column:
        """Of each text: bytes of markers before it, its own bytes, whether it is learned."""
        return F.flatten(
            F.transform(
                bs,
                lambda b, k: F.transform(
                    b["texts"],
                    lambda x, j: F.struct(
                        F.when(j > 0, F.lit(len(SEPARATOR)))
                        .otherwise(F.octet_length(head(b)) + F.when(k > 0, F.lit(len(END))).otherwise(0))
                        .cast("long")
                        .alias("lead"),
                        F.octet_length(x).cast("long").alias("length"),
                        (b["role"] == loss_role).alias("loss"),
                    ),
                ),
            )
        )

    def spans(ps: Column) -> Column:
        placed = let(
            running_sums(F.transform(ps, lambda p: p["lead"] + p["length"])),
            lambda before: F.transform(
                ps,
                lambda p, i: F.struct(
                    (F.get(before, i) + p["lead"]).alias("start"), p["length"].alias("length"), p["loss"].alias("loss")
                ),
            ),
        )
        return F.transform(
            F.filter(placed, lambda p: p["loss"]),
            lambda p: F.struct(p["start"].alias("start"), p["length"].alias("length")),
        )

    def written(bs: Column) -> Column:
        parts = F.transform(
            bs, lambda b: F.concat(head(b), F.array_join(b["texts"], SEPARATOR), F.lit(END))
        )
        return F.struct(
            F.size(bs).cast("long").alias("n_blocks"),
            F.array_join(parts, "").alias("formatted"),
            let(pieces(bs), spans).alias("loss_spans"),
        )

    out = let(F.col("turns"), lambda t: let(blocks(t), written))
    return sorted_turns.select("conv_id", out.alias("out")).select("conv_id", "out.*")


def read_turns(formatted: Column) -> Column:
    """The turns, ``array<struct<role, text>>``, read back from a formatted text."""

    def texts(b: Column) -> Column:
        return let(
            F.substring_index(b, "\n", 1),
            lambda r: F.transform(
                F.split(F.substr(b, F.length(r) + 2), r"<\|im_sep\|>"),
                lambda t: F.struct(
                    unescape_role(F.substr(r, F.lit(len(START) + 1))).alias("role"), unescape(t).alias("text")
                ),
            ),
        )

    return let(
        F.split(formatted, r"<\|im_end\|>\n"),
        lambda bs: F.flatten(F.transform(F.slice(bs, 1, F.size(bs) - 1), texts)),
    )


def read_loss_texts(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, unescaped. Bytes are cut, which needs no scan from the start."""
    return let(
        F.struct(formatted.cast("binary").alias("all"), spans.alias("spans")),
        lambda v: F.transform(
            v["spans"],
            lambda s: unescape(
                F.substr(v["all"], (s["start"] + 1).cast("int"), s["length"].cast("int")).cast("string")
            ),
        ),
    )
