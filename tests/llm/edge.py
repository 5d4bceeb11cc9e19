"""Small tables with every awkward case, and plain-Python reference versions."""

from __future__ import annotations

import collections
import hashlib

from pyspark.sql import types as T

COLUMNS = T.StructType([T.StructField(n, t) for n, t in (
    ("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()),
    ("n_chars", T.LongType()),
    # names that the operators use themselves
    ("n", T.LongType()), ("sig", T.StringType()), ("band", T.LongType()), ("label", T.LongType()), ("score", T.DoubleType()),
    ("parts", T.StringType()), ("weight", T.DoubleType()), ("component", T.LongType()), ("host", T.StringType()),
    ("__at", T.LongType()), ("__all", T.StringType()), ("__parts", T.StringType()), ("mix_epoch", T.LongType()),
    ("tokens", T.LongType()), ("size", T.LongType()))])

PASSAGE = ("the quick brown fox jumps over the lazy dog while seven tired clerks count the spoons "
           "in the drawer and nobody asks them why they do so on a rainy day in march")


def texts() -> list[tuple[int | None, str | None, str | None]]:
    """(doc_id, text, source): nulls, empty, blank, short, very long, repeated rows, equal ids, copies, shared passages."""
    long_ = " ".join(f"word{i % 977}x{i % 31}" for i in range(40_000))
    return [
        (7, PASSAGE + " first ending here", "a"), (3, "Opening words before it. " + PASSAGE, "a"),
        (7, PASSAGE + " first ending here", "a"),                   # repeated row
        (7, "another text under the same id", "b"),                 # equal id
        (None, PASSAGE + " first ending here", "a"), (None, None, None), (None, "text without an id", None),
        (2, None, "b"), (4, "", "b"), (5, "   \n\t ", None), (6, "a", "c"), (8, "a", "c"),
        (9, "two words", "c"), (10, "two words", "c"), (11, "b" * 5000, "d"), (12, "b" * 4000, "d"),
        (13, long_, "d"), (14, long_ + " tail", "d"), (15, "Zoë “ünïcode” ß 漢字 😀 " * 40, "e"),
        (16, "x" + "Zoë “ünïcode” ß 漢字 😀 " * 40, "e"), (17, "<|endoftext|> a  b\n\n c<|endoftext|>", "e"),
        (18, PASSAGE.upper(), "a"), (1 << 40, PASSAGE + " first ending there", "a"), (-5, "negative id", "a"),
        (20, "It is worthless.", "e"), (21, "All rights reserved.", "e"),
    ]


def documents(spark, rows=None):
    rows = texts() if rows is None else rows
    extra = (1, "s", 2, 1, 0.5, "p", 0.25, 3, "h", 9, "all", "pp", 8, 5, 6)
    return spark.createDataFrame(
        [(i, t, "en" if s else None, s, len(t) if t is not None else None, *extra) for i, t, s in rows], COLUMNS)


def order_of(doc_id):
    return (1 << 63) - 1 if doc_id is None else doc_id


def repeated_bytes(rows, length=50):
    """For each row (id, bytes): a mask of the bytes under strings that start in a row with a smaller id."""
    first: dict[bytes, int] = {}
    for i, t in sorted(rows, key=lambda r: order_of(r[0])):
        for p in range(len(t) - length + 1):
            first.setdefault(t[p:p + length], order_of(i))
    masks = []
    for i, t in rows:
        mask = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if first[t[p:p + length]] < order_of(i):
                mask[p:p + length] = b"\1" * length
        masks.append(bytes(mask))
    return masks


def dedup_rows(rows, length=50):
    out = []
    for (i, t), m in zip(rows, repeated_bytes(rows, length), strict=True):
        kept = bytes(b for b, x in zip(t, m, strict=True) if not x)
        spans = sum(1 for p in range(len(m)) if m[p] and (p == 0 or not m[p - 1]))
        out.append((i, len(t), sum(m), spans, hashlib.sha256(kept).hexdigest()))
    return out


def shingle_set(text, size):
    words = (text or "").encode().lower().split()
    return {tuple(words[j:j + size]) for j in range(max(1, len(words) - size + 1))} if words else set()


def near_rows(rows, size, percent=80):
    """(id, set size, component) per row, by comparing all pairs that share a shingle."""
    sets = [shingle_set(t, size) for _, t in rows]
    holders = collections.defaultdict(list)
    for n, s in enumerate(sets):
        for x in s:
            holders[x].append(n)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    shared = collections.Counter((a, b) for v in holders.values() for k, b in enumerate(v) for a in v[:k])
    for (a, b), c in shared.items():
        if 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c):
            parent[find(a)] = find(b)
    lowest = {}
    for n, (i, _) in enumerate(rows):
        lowest[find(n)] = min(lowest.get(find(n), (1 << 63) - 1), order_of(i))
    return [(i, len(sets[n]), lowest[find(n)]) for n, (i, _) in enumerate(rows)]
