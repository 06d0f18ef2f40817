"""Repair of conversation structure by cheapest edits, the least of them by prefix doubling.

A conversation is cut into segments of bounded size, so one that holds a third of all rows is
the work of many tasks. Between segments only the state of the role pattern passes: forward as
the state a segment is entered in, backward as the cost of all that follows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.common import Scratch, let, ship, small_batches

# The role pattern (s?(ua)+)? read so far: nothing, a system turn, a user turn, an assistant turn.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
NEVER = 1 << 40  # a cost that no edits have
# Cost of what is still missing at the end: nothing, an inserted pair, an inserted assistant turn.
CLOSING = (0, 4, 2, 0)
# Where an inserted turn, or one given a new role, leads: the pattern leaves no choice of role.
TURNED = (USER, USER, ASSISTANT, USER)
ROLE_OF = ("", "", "user", "assistant")
# Where a kept turn leads, by its role's initial: s, u, a, another, none (an empty role).
NOWHERE = -1
KEPT = (
    (SYSTEM, NOWHERE, NOWHERE, NOWHERE),
    (USER, USER, NOWHERE, USER),
    (NOWHERE, NOWHERE, ASSISTANT, NOWHERE),
    (NOWHERE, NOWHERE, NOWHERE, NOWHERE),
    (EMPTY, SYSTEM, USER, ASSISTANT),
)
# Edits in the order of their initials, with their costs.
DELETE, INSERT, KEEP, REROLE = range(4)
LETTERS = "DIKR"
TURNS_A_BATCH = 1 << 14  # a turn has 16 arcs, each in about a dozen arrays
COSTS = (3, 2, 0, 2)

SPACES = r"[\x20\x09-\x0D]"
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)


def damaged(turns: DataFrame) -> DataFrame:
    """The rows of ``conv_id, turn, role, text`` with faults put in by a hash of their place.

    ``gone`` rows stay, without a text, so that their conversation is not forgotten; ``copy`` is
    1 for the second row of a pair. Null roles and texts become one space, as nulls do in the
    text that is hashed.
    """
    space = F.lit(" ")
    place = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), space),
        F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), space),
    )
    kind = F.crc32(place) % 20
    text = F.coalesce("text", space)
    return (
        turns.select("conv_id", "turn", F.coalesce("role", space).alias("role"), text.alias("text"), kind.alias("kind"))
        .withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .select(
            "conv_id",
            "turn",
            F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("kind").isin(0, 1), "")
            .when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text"))
            .alias("text"),
            "copy",
            (F.col("kind") == 0).alias("gone"),
        )
    )


def _faults(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows with ``fault``: blank, duplicate (but for equal rows of one turn), truncated, or sound."""
    nulls_first = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    digest = F.sha2(F.concat_ws("\n", F.hex("role"), "text"), 256)
    rows = rows.withColumn("digest", F.when(~F.col("gone"), digest)).withColumn("place", nulls_first)
    # Only what was said twice is looked up again; equal rows are counted before the shuffle. The
    # second row of a pair needs no look. Stored, so that its size is known before the texts move.
    again = scratch.store(
        rows.where("not gone and copy = 0")
        .groupBy(F.col("conv_id").alias("conv"), F.col("digest").alias("said"))
        .agg(F.min("place").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
    )
    same = rows["conv_id"].eqNullSafe(again["conv"]) & (rows["digest"] == again["said"])
    bare = F.regexp_replace("text", SPACES, "")
    fault = (
        F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), BLANK)
        .when((F.col("copy") == 1) | (F.col("place") > F.col("first")), DUPLICATE)
        .when(~F.substring(bare, -1, 1).isin(".", "!", "?"), TRUNCATED)
        .otherwise(SOUND)
    )
    return rows.join(again, same, "left").select(
        "conv_id", "turn", "role", "text", "copy", "gone", fault.cast("byte").alias("fault")
    )


SEGMENT = (
    "part int, at long, n long, first_turn long, last_turn long, n_turns long, blank long, duplicate long, "
    "truncated long, illegal long, opens string, closes string, roles array<string>, texts array<string>, "
    "codes binary, faults binary"
)


def _segments(rows: DataFrame, max_rows: int, max_chars: int) -> DataFrame:
    """Rows in order, cut into segments: one row each with its turns as arrays.

    Rows are dealt to tasks by ranges of (conversation, turn, role, text), so a long
    conversation lies in many tasks. Equal rows are in one task, one after the other, which
    shows that they are duplicates.
    """
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    order = ["conv_id", "turn", "role", "text", "copy"]
    dealt = rows.repartitionByRange(*order[:4]).sortWithinPartitions(*order)
    dealt = dealt.drop("copy").withColumn("part", F.spark_partition_id())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        taken: list[tuple] = []
        ready: list[dict] = []
        made, chars, waiting, current, before = 0, 0, 0, None, None

        def finish() -> None:
            nonlocal made, chars, waiting
            there = [r for r in taken if not r[4]]
            roles, texts = [r[2] for r in there], [r[3] for r in there]
            faults = bytes(r[5] for r in there)
            known = [r[1] for r in there if r[1] is not None]
            initials = [r[:1] for r in roles]
            pairs = zip(initials, initials[1:], strict=False)
            one = {
                "conv_id": taken[0][0],
                "part": taken[0][6],
                "at": made,
                "n": len(there),
                "first_turn": known[0] if known else None,
                "last_turn": known[-1] if known else None,
                "n_turns": len(set(known)),
                "blank": faults.count(BLANK),
                "duplicate": faults.count(DUPLICATE),
                "truncated": faults.count(TRUNCATED),
                "illegal": sum(a + b not in ("su", "ua", "au") for a, b in pairs),
                "opens": initials[0] if there else None,
                "closes": initials[-1] if there else None,
                "roles": roles,
                "texts": texts,
                "codes": bytes("sua".find(i) if i in ("s", "u", "a") else 3 + (i == "") for i in initials),
                "faults": faults,
            }
            ready.append(one)
            made, waiting, chars = made + 1, waiting + chars + 100 * len(taken), 0
            taken.clear()

        schema = None
        for batch in batches:
            if schema is None:
                schema = _arrow_schema(batch.schema.field("conv_id").type)
            for row in zip(*(batch.column(c).to_pylist() for c in batch.schema.names), strict=True):
                conv, turn, role, text, gone, fault, part = row
                if taken and (conv != current or len(taken) >= max_rows or chars >= max_chars):
                    finish()
                    if waiting > 1 << 20:
                        yield pa.RecordBatch.from_pylist(ready, schema=schema)
                        ready, waiting = [], 0
                current = conv
                if not gone:
                    if before == (conv, turn, role, text) and fault != BLANK:
                        fault = DUPLICATE
                    before = (conv, turn, role, text)
                    chars += len(text)
                taken.append((conv, turn, role, text, gone, fault, part))
        if taken:
            finish()
        if ready:
            yield pa.RecordBatch.from_pylist(ready, schema=schema)

    return dealt.mapInArrow(cut, f"conv_id {types['conv_id']}, {SEGMENT}")


def _arrow_schema(conv: pa.DataType) -> pa.Schema:
    long_ = pa.int64()
    names = "n first_turn last_turn n_turns blank duplicate truncated illegal".split()
    return pa.schema(
        [("conv_id", conv), ("part", pa.int32()), ("at", long_)]
        + [(name, long_) for name in names]
        + [("opens", pa.string()), ("closes", pa.string())]
        + [("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))]
        + [("codes", pa.binary()), ("faults", pa.binary())]
    )


def _numbered(segments: DataFrame, scratch: Scratch) -> DataFrame:
    """Segments with their number in the conversation and ``n_segments``.

    Counted per task first; the window runs over one row a task of a conversation, so it never
    sees more rows of one conversation than there are tasks. Conversations of one segment, by
    far the most, are those that the stored list of the others lacks, so texts need not move.
    """
    parts = segments.groupBy("conv_id", "part").agg(F.count("*").alias("here"), F.min("at").alias("least"))
    by_conv = Window.partitionBy("conv_id")
    parts = parts.select(
        F.col("conv_id").alias("conv"),
        F.col("part").alias("task"),
        "least",
        (F.sum("here").over(by_conv.orderBy("part")) - F.col("here")).alias("before"),
        F.sum("here").over(by_conv).alias("n_segments"),
    )
    parts = scratch.store(parts.where("n_segments > 1"))
    same = segments["conv_id"].eqNullSafe(parts["conv"]) & (segments["part"] == parts["task"])
    one = F.lit(1).cast("long")
    return segments.join(parts, same, "left").select(
        segments["*"],
        F.coalesce(F.col("before") + F.col("at") - F.col("least"), one - 1).alias("seg"),
        F.coalesce("n_segments", one).alias("n_segments"),
    )


# Costs and choices inside a segment


class Turns:
    """The turns of several segments as one array each, with the segments' borders."""

    def __init__(self, codes: list[bytes], faults: list[bytes]):
        self.sizes = np.array([len(c) for c in codes], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)
        code = np.frombuffer(b"".join(codes), np.uint8).astype(np.int64)
        fault = np.frombuffer(b"".join(faults), np.uint8)
        self.kept_to = np.array(KEPT, np.int64)[code]
        self.kept_to[(fault == BLANK) | (fault == DUPLICATE)] = NOWHERE
        self.lost = (fault == BLANK) | (fault == DUPLICATE)
        self.extra = (fault == TRUNCATED).astype(np.int64)
        # A segment of m turns has m + 1 places between them; place p of segment k is a row here.
        self.first = self.starts[:-1] + np.arange(len(codes))
        self.n_places = int(self.starts[-1]) + len(codes)

    def costs_to_go(self, tails: np.ndarray) -> np.ndarray:
        """(places, states, columns): least cost from each place and state to the tails.

        ``tails`` (segments, states, columns) holds the costs at each segment's last place.
        All segments take a step back together, the longest first.
        """
        out = np.full((self.n_places, *tails.shape[1:]), NEVER, np.int64)
        out[self.first + self.sizes] = tails
        turned = np.array(TURNED)
        by_size = np.argsort(-self.sizes, kind="stable")
        sorted_sizes = -self.sizes[by_size]
        for back in range(1, int(self.sizes.max(initial=0)) + 1):
            now = by_size[: np.searchsorted(sorted_sizes, -back, "right")]
            turn = self.starts[now] + self.sizes[now] - back
            place = self.first[now] + self.sizes[now] - back
            after = out[place + 1]
            best = after + COSTS[DELETE]
            extra = self.extra[turn][:, None, None]
            to = self.kept_to[turn]
            kept = np.take_along_axis(after, np.maximum(to, 0)[:, :, None], 1) + extra
            best = np.where((to >= 0)[:, :, None], np.minimum(best, kept), best)
            new_role = after[:, turned] + COSTS[REROLE] + extra
            best = np.where(self.lost[turn][:, None, None], best, np.minimum(best, new_role))
            # Two insertions reach every state there is, so two looks are enough.
            for _ in range(2):
                best = np.minimum(best, best[:, turned] + COSTS[INSERT])
            out[place] = np.minimum(best, NEVER)
        return out

    def optimal_arcs(self, costs: np.ndarray, closing: np.ndarray) -> np.ndarray:
        """(places, states, letters): where each edit that keeps the least cost leads, or -1.

        A target is the node place * 4 + state. ``closing`` tells which segments end their
        conversation; turns may be inserted at the end of those only.
        """
        arcs = np.full((self.n_places, STATES, len(LETTERS)), -1, np.int64)
        state = np.arange(STATES)
        turned = np.array(TURNED)
        place = np.arange(self.n_places)
        last = np.zeros(self.n_places, bool)
        last[self.first + self.sizes] = True
        may_insert = ~last
        may_insert[(self.first + self.sizes)[closing]] = True
        reachable = costs < NEVER
        good = may_insert[:, None] & reachable & (costs[:, turned] + COSTS[INSERT] == costs)
        arcs[:, :, INSERT] = np.where(good, place[:, None] * STATES + turned, -1)
        at = place[~last]  # the places before a turn, in the order of turns
        here, after = costs[at], costs[at + 1]
        node = (at + 1)[:, None] * STATES
        free = reachable[at]
        arcs[at, :, DELETE] = np.where(free & (after + COSTS[DELETE] == here), node + state, -1)
        to = np.maximum(self.kept_to, 0)
        kept = np.take_along_axis(after, to, 1) + self.extra[:, None]
        arcs[at, :, KEEP] = np.where(free & (self.kept_to >= 0) & (kept == here), node + to, -1)
        new_role = after[:, turned] + COSTS[REROLE] + self.extra[:, None]
        good = free & ~self.lost[:, None] & (new_role == here)
        arcs[at, :, REROLE] = np.where(good, node + turned, -1)
        return arcs


def least_paths(arcs: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The path of least letters from each start node: (number of the start, arc, node it leads to).

    The nodes that are ranked are the optimal arcs, by the audits that begin with them: first by
    one letter, then by 2, 4, 8, ... letters, as a pair of the rank of an arc and the rank of the
    arc that its audit reaches after half of them. The edits of one letter at one node lead to
    one place only, so an arc's least audit goes on with the arc of least rank at its target,
    and that pointer is doubled with the ranks. Rows come in order of start and step.
    """
    flat = arcs.reshape(-1)
    end = len(flat)  # stands for "no further letter", which is less than any
    exists = np.flatnonzero(flat >= 0)
    rank = np.zeros(end + 1, np.int64)
    rank[exists] = exists % len(LETTERS) + 1

    def best(nodes: np.ndarray) -> np.ndarray:
        """The arc of least rank out of each node."""
        out = nodes[:, None] * len(LETTERS) + np.arange(len(LETTERS))
        ranks = np.where(flat[out] >= 0, rank[out], np.iinfo(np.int64).max)
        pick = out[np.arange(len(nodes)), ranks.argmin(1)]
        return np.where(flat[pick] >= 0, pick, end)

    pointer = np.full(end + 1, end, np.int64)
    pointer[exists] = best(flat[exists])
    pointers = [pointer]
    while (pointers[-1][exists] != end).any():
        pointer = pointers[-1]
        pairs = rank[exists] * (rank.max() + 1) + rank[pointer[exists]]
        rank[exists] = np.unique(pairs, return_inverse=True)[1] + 1
        pointers.append(pointer[pointer])
    owner, arc = np.arange(len(starts)), best(starts)
    keep = arc != end
    owner, arc = owner[keep], arc[keep]
    step = np.zeros(len(arc), np.int64)
    for k, pointer in enumerate(pointers):
        further = pointer[arc]
        keep = further != end
        owner = np.concatenate([owner, owner[keep]])
        step = np.concatenate([step, step[keep] + (1 << k)])
        arc = np.concatenate([arc, further[keep]])
    order = np.lexsort((step, owner))
    return owner[order], arc[order], flat[arc[order]]


def _repaired(turns: Turns, arcs: np.ndarray, entries: np.ndarray, roles: list, texts: list):
    """For each segment and entry state (``entries``: pairs): exit state, audit, repaired lines."""
    starts = turns.first[entries[:, 0]] * STATES + entries[:, 1]
    owner, arc, target = least_paths(arcs, starts)
    audits: list[list[str]] = [[] for _ in starts]
    lines: list[list[str]] = [[] for _ in starts]
    exits = entries[:, 1].copy()
    for o, letter, place, to in zip(
        owner.tolist(),
        (arc % len(LETTERS)).tolist(),
        (arc // (len(LETTERS) * STATES)).tolist(),
        (target % STATES).tolist(),
        strict=True,
    ):
        audits[o].append(LETTERS[letter])
        exits[o] = to
        if letter == DELETE:
            continue
        segment = entries[o, 0]
        k = place - turns.first[segment]
        role = roles[segment][k] if letter == KEEP else ROLE_OF[to]
        lines[o].append(f"{role}:{'' if letter == INSERT else texts[segment][k]}")
    return exits, ["".join(a) for a in audits], ["\n".join(x) for x in lines], [len(x) for x in lines]


def _single(segments: DataFrame, conv: str) -> DataFrame:
    """Conversations of one segment: cost, audit and digest at once."""

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "codes", TURNS_A_BATCH):
            columns = {c: batch.column(c).to_pylist() for c in ("codes", "faults", "roles", "texts")}
            turns = Turns(columns["codes"], columns["faults"])
            count = batch.num_rows
            tails = np.repeat(np.array(CLOSING, np.int64)[None, :, None], count, 0)
            costs = turns.costs_to_go(tails)[:, :, 0]
            arcs = turns.optimal_arcs(costs, np.ones(count, bool))
            entries = np.stack([np.arange(count), np.zeros(count, np.int64)], 1)
            _, audits, lines, _ = _repaired(turns, arcs, entries, columns["roles"], columns["texts"])
            yield pa.record_batch(
                [
                    batch.column("conv_id"),
                    pa.array(costs[turns.first, EMPTY], pa.int64()),
                    pa.array(audits, pa.string()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in lines], pa.string()),
                ],
                names=["conv_id", "cost", "audit", "repaired_sha256"],
            )

    taken = segments.select("conv_id", "codes", "faults", "roles", "texts")
    return taken.mapInArrow(solve, f"conv_id {conv}, cost long, audit string, repaired_sha256 string")


def _scan(table: DataFrame, value: str, join, backward: bool, rounds: int, scratch: Scratch) -> DataFrame:
    """``conv_id, seg, value``: values of a conversation's segments joined from one end to each.

    By doubling: after k rounds a value covers 2^k segments, so a conversation of any number of
    segments takes the logarithm of that many joins of one row with one row.
    """
    now = table.select("conv_id", "seg", value)
    for k in range(rounds):
        step = (1 << k) if backward else -(1 << k)
        other = now.select(
            F.col("conv_id").alias("conv"), (F.col("seg") - step).alias("s"), F.col(value).alias("far")
        )
        same = now["conv_id"].eqNullSafe(other["conv"]) & (now["seg"] == other["s"])
        joined = F.when(F.col("far").isNull(), F.col(value)).otherwise(join(F.col(value), F.col("far")))
        now = scratch.store(now.join(other, same, "left").select("conv_id", "seg", joined.alias(value)))
    return now


def _product(a: Column, b: Column) -> Column:
    """The least sums of two 4 x 4 tables of costs, each a flat array."""
    return let(
        F.struct(a.alias("a"), b.alias("b")),
        lambda m: F.transform(
            F.sequence(F.lit(0), F.lit(STATES * STATES - 1)),
            lambda i: F.least(
                F.lit(NEVER),
                *[
                    F.element_at(m["a"], (i - i % STATES + j + 1).cast("int"))
                    + F.element_at(m["b"], (i % STATES + j * STATES + 1).cast("int"))
                    for j in range(STATES)
                ],
            ),
        ),
    )


def _long(segments: DataFrame, conv: str, scratch: Scratch) -> DataFrame:
    """Conversations of several segments: cost, audit and digest."""
    rounds = int(segments.agg(F.max("n_segments")).first()[0] or 1).bit_length()

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "codes", TURNS_A_BATCH):
            turns = Turns(batch.column("codes").to_pylist(), batch.column("faults").to_pylist())
            free = np.full((STATES, STATES), NEVER, np.int64)
            np.fill_diagonal(free, 0)
            costs = turns.costs_to_go(np.repeat(free[None], batch.num_rows, 0))[turns.first]
            yield pa.record_batch(
                [batch.column("conv_id"), batch.column("seg"), pa.array(costs.reshape(-1, 16).tolist(), pa.list_(pa.int64()))],
                names=["conv_id", "seg", "costs"],
            )

    slim = segments.select("conv_id", "seg", "codes", "faults")
    costs = scratch.store(slim.mapInArrow(tables, f"conv_id {conv}, seg long, costs array<long>"))
    # What follows a segment is what its successor and all behind it cost.
    behind = _scan(costs, "costs", _product, True, rounds, scratch)
    closed = F.transform(
        F.sequence(F.lit(0), F.lit(STATES - 1)),
        lambda q: F.least(*[F.element_at("costs", (q * STATES + j + 1).cast("int")) + CLOSING[j] for j in range(STATES)]),
    )
    tails = behind.select(F.col("conv_id").alias("conv"), F.col("seg").alias("s"), closed.alias("to_go"))
    same = segments["conv_id"].eqNullSafe(tails["conv"]) & (segments["seg"] + 1 == tails["s"])
    known = segments.join(tails, same, "left").select(
        "conv_id", "seg", (F.col("seg") + 1 == F.col("n_segments")).alias("closes_it"), "to_go", "codes", "faults", "roles", "texts"
    )

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "codes", TURNS_A_BATCH):
            columns = {c: batch.column(c).to_pylist() for c in batch.schema.names if c not in ("conv_id", "seg")}
            turns = Turns(columns["codes"], columns["faults"])
            tails = np.array([t or CLOSING for t in columns["to_go"]], np.int64)[:, :, None]
            closing = np.array(columns["closes_it"], bool)
            costs_here = turns.costs_to_go(tails)[:, :, 0]
            arcs = turns.optimal_arcs(costs_here, closing)
            entries = np.stack([np.repeat(np.arange(batch.num_rows), STATES), np.tile(np.arange(STATES), batch.num_rows)], 1)
            exits, audits, lines, counts = _repaired(turns, arcs, entries, columns["roles"], columns["texts"])
            shape = (batch.num_rows, STATES)
            yield pa.record_batch(
                [
                    batch.column("conv_id"),
                    batch.column("seg"),
                    pa.array(exits.reshape(shape).tolist(), pa.list_(pa.int64())),
                    *(
                        pa.array([values[STATES * k : STATES * (k + 1)] for k in range(batch.num_rows)], pa.list_(kind))
                        for values, kind in ((audits, pa.string()), (lines, pa.string()), (counts, pa.int64()))
                    ),
                ],
                names=["conv_id", "seg", "exits", "audits", "lines", "n_lines"],
            )

    solved = scratch.store(
        known.mapInArrow(
            solve, f"conv_id {conv}, seg long, exits array<long>, audits array<string>, lines array<string>, n_lines array<long>"
        )
    )
    # The state a segment is entered in is where all before it lead from an empty pattern.
    follow = lambda later, earlier: let(
        F.struct(later.alias("l"), earlier.alias("e")),
        lambda m: F.transform(m["e"], lambda q: F.element_at(m["l"], (q + 1).cast("int"))),
    )
    exits = _scan(solved, "exits", follow, False, rounds, scratch)
    entered = exits.select(
        F.col("conv_id").alias("conv"), (F.col("seg") + 1).alias("s"), F.col("exits")[0].alias("state")
    )
    same = solved["conv_id"].eqNullSafe(entered["conv"]) & (solved["seg"] == entered["s"])
    at = (F.coalesce("state", F.lit(EMPTY).cast("long")) + 1).cast("int")
    chosen = solved.join(entered, same, "left").select(
        "conv_id", "seg", *[F.element_at(c, at).alias(c) for c in ("audits", "lines", "n_lines")]
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A digest is made in order, so a conversation's lines pass through one task, a segment
        # at a time; only its audit is held.
        current, hashed, audit, any_line, schema = None, None, [], False, None

        def emit() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(
                [{"conv_id": current, "audit": "".join(audit), "repaired_sha256": hashed.hexdigest()}], schema=schema
            )

        for batch in batches:
            schema = schema or pa.schema(
                [batch.schema.field("conv_id"), ("audit", pa.string()), ("repaired_sha256", pa.string())]
            )
            for conv_id, _, piece, lines, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if hashed is None or conv_id != current:
                    if hashed is not None:
                        yield emit()
                    current, hashed, audit, any_line = conv_id, hashlib.sha256(), [], False
                audit.append(piece)
                if n:
                    hashed.update((("\n" if any_line else "") + lines).encode())
                    any_line = True
        if hashed is not None:
            yield emit()

    told = (
        chosen.repartition("conv_id")
        .sortWithinPartitions("conv_id", "seg")
        .mapInArrow(digest, f"conv_id {conv}, audit string, repaired_sha256 string")
    )
    total = (
        behind.where("seg = 0")
        .select(
            F.col("conv_id").alias("conv"),
            F.least(*[F.element_at("costs", j + 1) + CLOSING[j] for j in range(STATES)]).alias("cost"),
        )
    )
    return told.join(total, told["conv_id"].eqNullSafe(total["conv"])).select("conv_id", "cost", "audit", "repaired_sha256")


def repair(turns: DataFrame, max_rows: int = 512, max_chars: int = 1 << 20) -> DataFrame:
    """Faults and cheapest repair of every conversation of ``conv_id, turn, role, text, copy, gone``.

    Returns ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256``, one row a conversation; rows that are ``gone`` (see ``damaged``) only
    make their conversation known. Rows are taken by turn, nulls first, then by role and text,
    so rows of one turn have a defined order and repeated rows stand side by side. Roles and
    texts must not be null. Rows without ``conv_id`` are a conversation of their own. A role
    whose initial is none of s, u, a cannot be kept; an empty role can, and says nothing.
    Very long conversations and texts are cut into segments of at most ``max_rows`` rows and
    about ``max_chars`` characters. An empty table gives an empty result. Other columns are
    not read.
    """
    spark = turns.sparkSession
    ship(spark)
    scratch = Scratch(spark)
    conv = turns.schema["conv_id"].dataType.simpleString()
    rows = _faults(
        turns.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text", "copy", "gone"), scratch
    )
    segments = _numbered(scratch.store(_segments(rows, max_rows, max_chars)), scratch)
    found = _single(segments.where("n_segments = 1"), conv)
    many = scratch.store(segments.where("n_segments > 1"))
    if not many.isEmpty():
        found = found.unionByName(_long(many, conv, scratch))
    # Turns and initials on both sides of a border.
    told = _counts(segments.where("n_segments = 1"), many)
    same = told["conv"].eqNullSafe(found["conv_id"])
    return told.join(found, same).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    )


COUNTED = ["blank", "duplicate", "truncated", "illegal"]


def _counts(single: DataFrame, many: DataFrame) -> DataFrame:
    """Counts of every conversation, with what spans the borders of its segments."""
    slim = many.where("n > 0").select(
        "conv_id", "seg", "first_turn", "last_turn", "n_turns", *COUNTED, "opens", "closes"
    )
    # Segments of gone rows only have no turns, so neighbours are the nearest with any.
    before = Window.partitionBy("conv_id").orderBy("seg")
    bordered = slim.withColumns(
        {
            "left_turn": F.lag("last_turn").over(before),
            "left_initial": F.lag("closes").over(before),
        }
    )
    pair = F.concat("left_initial", "opens")
    broken = (F.col("left_initial").isNotNull() & ~pair.isin("su", "ua", "au")).cast("long")
    again = F.coalesce((F.col("left_turn") == F.col("first_turn")).cast("long"), F.lit(0))
    joined = bordered.groupBy("conv_id").agg(
        F.min("first_turn").alias("least"),
        F.max("last_turn").alias("most"),
        F.sum(F.col("n_turns") - again).alias("n_turns"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
        F.sum(F.col("illegal") + broken).alias("illegal"),
    )
    none = many.groupBy("conv_id").agg(F.sum("n").alias("n")).where("n = 0").select("conv_id")
    alone = single.select(
        "conv_id", F.col("first_turn").alias("least"), F.col("last_turn").alias("most"), "n_turns", *COUNTED
    )
    every = alone.unionByName(joined).unionByName(none, allowMissingColumns=True)
    gaps = F.coalesce(F.col("most") - F.col("least") + 1 - F.col("n_turns"), F.lit(0).cast("long"))
    zero = F.lit(0).cast("long")
    return every.select(
        F.col("conv_id").alias("conv"), gaps.alias("gaps"), *[F.coalesce(c, zero).alias(c) for c in COUNTED]
    )
