"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

SPACES = re.compile(rb"[\x20\x09-\x0d]+")
FOLD = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def removed_bytes(rows, size=50):
    """id -> (bytes, removed, spans, digest of the rest), for (id, text) rows."""
    data = sorted((d, (t or "").encode()) for d, t in rows)
    first: dict[bytes, int] = {}
    for d, b in data:
        for p in range(len(b) - size + 1):
            first.setdefault(b[p : p + size], d)
    out = {}
    for d, b in data:
        cover = bytearray(len(b))
        for p in range(len(b) - size + 1):
            if first[b[p : p + size]] < d:
                cover[p : p + size] = b"\1" * size
        spans = sum(c and not (i and cover[i - 1]) for i, c in enumerate(cover))
        out[d] = (len(b), sum(cover), spans, sha(bytes(x for x, c in zip(b, cover, strict=True) if not c)))
    return out


def shingles(text):
    words = [w for w in SPACES.split((text or "").encode().translate(FOLD)) if w]
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def linked(rows, percent=75):
    """id -> (set size, component)."""
    sets = {d: shingles(t) for d, t in rows}
    holders: dict[tuple, list] = {}
    for d, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(d)
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for d, s in sets.items():
        shared = Counter(o for x in s for o in holders[x] if o < d)
        for o, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[o]) - n):
                a, b = find(d), find(o)
                parent[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), find(d)) for d in sets}


def after_damage(rows):
    """conv_id -> rows (turn, role, text) in order, for (conv_id, turn, role, text) rows."""
    out = {}
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        place = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(place.encode()) % 20
        kept = out.setdefault(conv, [])
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        kept += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    for kept in out.values():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    return out


def repaired(rows):
    """gaps, blank, duplicate, truncated, illegal, cost, audit, digest of rows (turn, role, text).

    Holds the least (cost, audit) for every number of rows taken and every list of initials'
    last two, so it knows nothing of states, segments or ranks.
    """
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    faults, seen = [], set()
    for _, role, text in rows:
        bare = re.sub(r"[\x20\x09-\x0D]", "", text)
        faults.append(
            "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
        )
        seen.add((role, text))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    begins = re.compile(r"(s?(ua)*u?)?")
    ends = re.compile(r"(s?(ua)+)?")
    # Initials so far are held by their length up to 2 and their parity: "s", "su", "sua", ... are alike.
    best = {"": (0, "", ())}

    def short(initials):
        return initials if len(initials) < 4 else initials[:1] + initials[1 + 2 * ((len(initials) - 2) // 2) :]

    def offer(table, initials, entry):
        if begins.fullmatch(initials):
            key = short(initials)
            if key not in table or entry[:2] < table[key][:2]:
                table[key] = entry
                return True
        return False

    def insert(table):
        waiting = list(table)
        while waiting:
            key = waiting.pop()
            cost, audit, lines = table[key]
            for role in ("user", "assistant"):
                if offer(table, key + role[0], (cost + 2, audit + "I", (lines, role + ":"))):
                    waiting.append(short(key + role[0]))

    insert(best)
    for (_, role, text), fault in zip(rows, faults, strict=True):
        after = {}
        for key, (cost, audit, lines) in best.items():
            offer(after, key, (cost + 3, audit + "D", lines))
            if fault not in ("blank", "duplicate"):
                more = cost + (fault == "truncated")
                offer(after, key + role[:1], (more, audit + "K", (lines, f"{role}:{text}")))
                for other in ("user", "assistant"):
                    offer(after, key + other[0], (more + 2, audit + "R", (lines, f"{other}:{text}")))
        best = after
        insert(best)
    cost, audit, lines = min((e for k, e in best.items() if ends.fullmatch(k)), key=lambda e: e[:2])
    told = []
    while lines:
        lines, line = lines
        told.append(line)
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, sha("\n".join(reversed(told)).encode()))


def word_counts(rows, least_n=5, least_length=6):
    """Words of (doc_id, text) rows with their counts, some runs with a character lost."""
    found = Counter()
    for d, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if n >= least_n and len(w) >= least_length}


def spelling_variants(counts, ratio=5):
    """word -> (n, n_near, form, form_n, root)."""
    near = {w: set() for w in counts}
    shapes: dict[str, set] = {}
    for w in counts:
        for i in range(len(w)):
            if (cut := w[:i] + w[i + 1 :]) in counts:
                near[w].add(cut)
                near[cut].add(w)
            shapes.setdefault(w[:i] + "\0" + w[i + 1 :], set()).add(w)
    for alike in shapes.values():
        for w in alike:
            near[w] |= alike - {w}
    form = {}
    for w, others in near.items():
        if others:
            top = min(others, key=lambda o: (-counts[o], o))
            if counts[top] >= ratio * counts[w]:
                form[w] = top
    out = {}
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        top = form.get(w)
        out[w] = (n, len(near[w]), top, counts.get(top), root)
    return out
