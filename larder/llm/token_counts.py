"""Token counts by heap-and-linked-list byte-pair merging.

A text is cut at special strings (one token each) and then into pieces by the
vocabulary's pattern. The bytes of a piece form a doubly linked list of symbols;
a heap holds every adjacent pair that has a merge, by rank and position. The
lowest pair is popped and merged again and again; its neighbours give new pairs.
The count is the number of initial symbols minus the number of merges; no token
identifiers are produced. A piece of n bytes costs O(n log n), so a very long
piece (no spaces) is no special case.

Counts of words and pieces are kept in bounded per-process tables.

Nulls, edges: NULL and empty texts have 0 bytes and 0 tokens. Every row gives
one row (repeated rows and NULL ids included).
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import bounded_batches
from larder.llm.word_table import RecentValues

_SHIFT = 20             # symbols are numbered below 2^20
_WHOLE = -(1 << 50)     # marks a word that can't be counted on its own

# Fixed value: the piece pattern of byte-level vocabularies that name no pattern of their own.
BYTE_LEVEL_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


@dataclass(frozen=True)
class MergeTable:
    """Symbol of each byte; (left, right) -> rank and merged symbol; special strings."""
    symbols: tuple[int, ...]
    merges: dict[int, tuple[int, int]]
    special: tuple[str, ...]
    pattern: str
    digest: str = ""


def byte_letters() -> dict[str, int]:
    """The printable letter that byte-level vocabularies write for each byte value."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


def load_merges(path: str) -> MergeTable:
    """Read a byte-level BPE vocabulary file (tokenizer JSON) given by its path."""
    with open(path, "rb") as f:
        raw = f.read()
    spec = json.loads(raw)
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    if model["type"] != "BPE" or before.get("type") != "ByteLevel" or before.get("add_prefix_space") \
            or model.get("ignore_merges") or spec.get("normalizer") or not before.get("use_regex", True):
        raise ValueError(f"{path}: only plain byte-level BPE vocabularies are supported")
    letters = byte_letters()
    number = {bytes([b]): b for b in range(256)}
    merges: dict[int, tuple[int, int]] = {}
    for rank, pair in enumerate(model["merges"]):
        left, right = (bytes(letters[c] for c in s) for s in (pair.split(" ") if isinstance(pair, str) else pair))
        joined = number.setdefault(left + right, len(number))
        merges.setdefault(number[left] << _SHIFT | number[right], (rank, joined))
    special = tuple(t["content"] for t in spec.get("added_tokens", []))
    return MergeTable(tuple(range(256)), merges, special, BYTE_LEVEL_PATTERN, hashlib.sha256(raw).hexdigest())


def count_piece(piece: bytes, merges: dict[int, tuple[int, int]]) -> int:
    """Symbols left after all merges of one piece."""
    n = len(piece)
    if n < 2:
        return n
    symbol = list(piece)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        key = symbol[i] << _SHIFT | symbol[i + 1]
        if key in merges:
            heap.append((merges[key][0], i, key))
    heapify(heap)
    left = n
    while heap:
        _, i, key = heappop(heap)
        j = after[i]
        if symbol[i] < 0 or j >= n or symbol[i] << _SHIFT | symbol[j] != key:
            continue                                    # one side has been merged meanwhile
        symbol[i], symbol[j] = merges[key][1], -1
        left -= 1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            new = symbol[i] << _SHIFT | symbol[k]
            if new in merges:
                heappush(heap, (merges[new][0], i, new))
        h = before[i]
        if h >= 0:
            new = symbol[h] << _SHIFT | symbol[i]
            if new in merges:
                heappush(heap, (merges[new][0], h, new))
    return left


_counters: dict[str, tuple[RecentValues, RecentValues]] = {}


def counter(table: MergeTable, name: str):
    """Function text -> token count; its word and piece tables are shared by the tasks of one process.

    ``name`` stands for the vocabulary; a process keeps the tables of the last one only.

    A text is cut at single spaces first. A word between them (no white space at
    its ends) is cut into the same pieces alone, with its leading space, as within
    the text; its count is looked up as a whole. Texts with other white space next
    to a space take the pattern over the whole text.
    """
    pieces = regex.compile(table.pattern)
    cut = regex.compile("|".join(regex.escape(s) for s in sorted(table.special, key=len, reverse=True))) \
        if table.special else None
    if name not in _counters:
        by_piece = RecentValues(lambda piece: count_piece(piece.encode(), table.merges))

        def count_word(word: str) -> int:
            if not word or word[0].isspace() or word[-1].isspace():
                return _WHOLE
            return sum(map(by_piece.__getitem__, pieces.findall(" " + word)))
        _counters.clear()
        _counters[name] = RecentValues(count_word), by_piece
    by_word, by_piece = _counters[name]

    def plain(text: str) -> int:
        first, *rest = text.split(" ")
        total = sum(map(by_word.__getitem__, rest))
        if total < 0 or rest and (not first or first[-1].isspace()):
            return sum(map(by_piece.__getitem__, pieces.findall(text)))
        return total + sum(map(by_piece.__getitem__, pieces.findall(first)))

    def count(text: str) -> int:
        by_word.trim()
        by_piece.trim()
        if cut is None or not cut.search(text):
            return plain(text)
        return len(cut.findall(text)) + sum(plain(part) for part in cut.split(text) if part)
    return count


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > ``limit``) for every row of ``docs``."""
    bounded_batches(docs.sparkSession)
    table = load_merges(vocabulary)
    shared, name = docs.sparkSession.sparkContext.broadcast(table), table.digest      # one vocabulary: fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(shared.value, name)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            tokens = pa.array([count(t) if t else 0 for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), tokens],
                                             names=["doc_id", "n_bytes", "n_tokens"])

    return (docs.select(F.col("doc_id").cast("bigint"), "text",
                        F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"))
            .mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint")
            .withColumn("over_limit", F.col("n_tokens") > limit))
