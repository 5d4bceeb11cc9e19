"""Removal of repeated passages by blockwise suffix sorting.

Every byte covered by a ``length``-byte string that also starts in a document
with a smaller id is removed. Matches never cross documents and strings are
judged on the input.

1. *Blocks.* The suffixes (all positions with ``length`` bytes after them) of a
   document are cut into runs that share the smallest hash among their inner
   24-byte strings. Equal suffixes have equal smallest hashes, so dealing the runs
   to buckets by that hash brings all suffixes that tie on ``length`` bytes into
   one bucket. A run is stored once as its bytes, about 4.5 bytes per suffix, and
   a task packs its runs per bucket and compresses them.
2. *Filter.* A first pass sends only the hashes of the runs, sorted and packed, and
   finds those that occur in two documents. They set bits in a filter of at most
   ``filter_bytes``; runs that it does not pass have no tie and stay where they are.
   A fuller filter passes more runs, which costs shuffle but no result.
3. *Pre-aggregation.* Of equal runs within a unit of text only those of the
   smallest document travel; the others are settled at once (a run whose bytes
   also stand in a smaller document is repeated as a whole). Runs seen repeated
   are remembered by the task, so a passage in every document reaches a bucket
   about once per task.
   A passage in very many documents leaves runs at its edges that hold each document's own
   context: all different, with one smallest hash. Where a hash has more than ``hot_runs``
   runs, each of its suffixes travels as a run of its own, dealt by a hash of all its
   bytes, so equal ones still meet and the others spread over the buckets.
4. *Sorting.* A task sorts one bucket at a time (about ``bucket_bytes`` of text to a
   bucket; buckets grow in number, not in size): equal runs are merged, and the suffixes of runs
   that share their smallest hash with another run are sorted by difference cover
   (``suffix_sort``), which gives for each the smallest document that has it.
5. *Removal.* The repeated ranges, packed for many documents at a time, and the
   documents are dealt to the same blocks of about ``block_bytes`` of text, where the ranges are
   cut out of the texts. Texts are shuffled once. The number of blocks follows the text, not the
   number of tasks, so the packed rows (one per task and block) stay few.

Nulls, edges: a NULL text is empty. Documents shorter than ``length`` are never
touched. Rows with a NULL id come after all others (they remove nothing from rows
with an id); rows that share an id remove nothing from each other. Repeated rows
stay, one result row per input row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm.common import bounded_batches, input_bytes, mix64, partitions_for, sliding_min, utf8_column
from larder.llm.suffix_sort import lowest_owner

GRAM = 24
_UNIT = 1 << 20             # bytes of text cut into runs at a time
_REMEMBERED = 30_000       # repeated runs a task keeps (for pre-aggregation only)
_LAST = (1 << 63) - 1


@dataclass(frozen=True)
class DedupParams:
    length: int = 50
    bucket_bytes: int = 24 << 20
    filter_bytes: int = 48 << 20
    hot_runs: int = 4096
    hot_bytes: int = 16 << 20
    block_bytes: int = 4 << 20


def gram_hashes(text: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes at each position."""
    n = len(text) - GRAM + 1
    return gram_hash(text, slice(0, n), lambda at, j: slice(j, j + n)) if n > 0 else np.zeros(0, np.uint64)


def gram_hash(text: np.ndarray, at, moved=lambda at, j: at + j) -> np.ndarray:
    """Hash of the three 8-byte words of the grams at ``at`` (positions or a slice)."""
    view = np.ndarray((len(text) - 7,), "<u8", text, 0, (1,))
    out = view[at] * np.uint64(0x9E3779B97F4A7C15)
    out = (out ^ (out >> np.uint64(29)) ^ view[moved(at, 8)]) * np.uint64(0xBF58476D1CE4E5B9)
    return mix64(out ^ (out >> np.uint64(32)) ^ view[moved(at, 16)])


@dataclass
class Runs:
    """Runs of suffixes: piece, first suffix, number of suffixes, place of the smallest hash, its value."""
    piece: np.ndarray
    start: np.ndarray
    count: np.ndarray
    place: np.ndarray
    value: np.ndarray

    def where(self, keep: np.ndarray) -> Runs:
        return Runs(*(getattr(self, f)[keep] for f in ("piece", "start", "count", "place", "value")))


def cut_runs(text: np.ndarray, offsets: np.ndarray, length: int) -> Runs:
    """Runs of the pieces ``text[offsets[i]:offsets[i + 1]]``; positions are within ``text``."""
    hashes = gram_hashes(text)
    width = length - GRAM + 1
    low = sliding_min(hashes, width)
    none = np.zeros(0, np.int64)
    long_enough = np.flatnonzero(np.diff(offsets) >= length)
    if not len(long_enough) or not len(low):
        return Runs(none, none, none, none, none.astype(np.uint64))
    first, stop = offsets[long_enough], offsets[long_enough + 1] - length + 1    # suffix starts of a piece
    change = np.zeros(len(low) + 1, np.int8)
    change[1:-1] = low[1:] != low[:-1]
    change[first] = 1
    inside = np.zeros(len(low) + 1, np.int32)
    np.add.at(inside, first, 1)
    np.add.at(inside, np.minimum(stop, len(low)), -1)
    start = np.flatnonzero((change[:-1] > 0) & (np.cumsum(inside[:-1]) > 0))
    which = np.searchsorted(first, start, side="right") - 1
    following = np.append(start[1:], len(low))
    count = np.minimum(following, stop[which]) - start
    value = low[start]
    place = np.full(len(start), -1, np.int64)
    for j in range(width):
        open_ = np.flatnonzero(place < 0)
        if not len(open_):
            break
        place[open_[hashes[start[open_] + j] == value[open_]]] = j
    return Runs(long_enough[which], start, count, place, value)


def single_suffixes(text: np.ndarray, runs: Runs, which: np.ndarray, length: int) -> tuple[Runs, np.ndarray]:
    """The runs ``which`` cut into runs of one suffix each, and a hash of all ``length`` bytes of each.

    ``text`` must have 8 spare bytes at its end.
    """
    counts = runs.count[which]
    each = np.repeat(which, counts)
    ends = np.cumsum(counts)
    start = runs.start[each] + np.arange(len(each)) - np.repeat(ends - counts, counts)
    # the run's smallest hash may stand at several places: take one within the suffix's own bytes
    place = runs.start[each] + runs.place[each] - start
    for j in range(length - GRAM + 1):
        lost = np.flatnonzero(place < 0)
        if not len(lost):
            break
        at = start[lost] + j
        hit = gram_hash(text, at) == runs.value[each[lost]]
        place[lost[hit]] = j
    view = np.ndarray((len(text) - 7,), "<u8", text, 0, (1,))
    key = np.zeros(len(start), np.uint64)
    for j in sorted({*range(0, length - 7, 8), length - 8}):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) ^ view[start + j])
    return Runs(runs.piece[each], start, np.ones(len(each), np.int64), place, runs.value[each]), key


def joined(a: Runs, b: Runs) -> Runs:
    return Runs(*(np.concatenate([getattr(a, f), getattr(b, f)]) for f in ("piece", "start", "count", "place", "value")))


@dataclass
class Remembered:
    """Runs a task has seen repeated, with the smallest document so far, and their signs."""
    owner: dict[bytes, int]
    signs: set[int]


def runs_equal_to_earlier(raw: bytes, start: np.ndarray, size: np.ndarray, owner: np.ndarray,
                          remembered: Remembered) -> np.ndarray:
    """Which runs have bytes that also stand in a smaller document, as far as this task knows.

    Candidates agree in a sign made of three places and the size; they are compared whole.
    The run of the smallest document is never settled here, so it always reaches its bucket.
    """
    text = np.frombuffer(raw, np.uint8)
    view = np.ndarray((len(text) - 7,), "<u8", text, 0, (1,))
    sign = mix64(view[start] ^ mix64(view[start + size - 8] + size.astype(np.uint64))
                 ^ mix64(view[start + size // 2 - 4]))
    order = np.argsort(sign)
    same = sign[order][1:] == sign[order][:-1]
    candidate = np.zeros(len(start), bool)
    candidate[order[1:][same]] = True
    candidate[order[:-1][same]] = True
    if remembered.signs:
        candidate |= np.isin(sign, np.fromiter(remembered.signs, np.uint64, len(remembered.signs)))
    seen = np.flatnonzero(candidate).tolist()
    keys = [raw[start[i]:start[i] + size[i]] for i in seen]
    lowest: dict[bytes, int] = {}
    several: set[bytes] = set()
    for i, key in zip(seen, keys, strict=True):
        if key in lowest:
            several.add(key)
            lowest[key] = min(lowest[key], int(owner[i]))
        else:
            lowest[key] = min(remembered.owner.get(key, _LAST), int(owner[i]))
    settled = np.zeros(len(start), bool)
    for i, key in zip(seen, keys, strict=True):
        settled[i] = int(owner[i]) > lowest[key]
        if key in remembered.owner or key in several and len(remembered.owner) < _REMEMBERED:
            remembered.owner[key] = lowest[key]
            remembered.signs.add(int(sign[i]))
    return settled


def pack(raw: np.ndarray, docs: np.ndarray, doc: np.ndarray, begin: np.ndarray, start: np.ndarray,
         size: np.ndarray, place: np.ndarray, squeeze: zstandard.ZstdCompressor) -> bytes:
    """One bucket's runs of a unit: document table, then per run its document, place in it, size and bytes."""
    used, local = np.unique(doc, return_inverse=True)
    ends = np.cumsum(size)
    index = np.arange(ends[-1]) + np.repeat(start - (ends - size), size)
    head = np.array([len(used), len(doc)], np.int64)
    return squeeze.compress(b"".join([
        head.tobytes(), docs[used].tobytes(), local.astype(np.uint32).tobytes(), begin.astype(np.uint64).tobytes(),
        size.astype(np.uint32).tobytes(), place.astype(np.uint16).tobytes(), raw[index].tobytes()]))


def unpack(payload: bytes, open_: zstandard.ZstdDecompressor) -> tuple[np.ndarray, ...]:
    data = open_.decompress(payload)
    n_docs, n = np.frombuffer(data, np.int64, 2)
    at, out = 16, []
    for kind, count in ((np.int64, 3 * n_docs), (np.uint32, n), (np.uint64, n), (np.uint32, n), (np.uint16, n)):
        out.append(np.frombuffer(data, kind, count, at))
        at += int(count) * np.dtype(kind).itemsize
    out.append(np.frombuffer(data, np.uint8, -1, at))
    docs, local, begin, size, place, raw = out
    return (docs.reshape(-1, 3)[local], begin.astype(np.int64), size.astype(np.int64), place.astype(np.int64), raw)


def merged(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Union of ranges as sorted, non-touching [begin, end) rows."""
    if not len(begin):
        return np.zeros((0, 2), np.int64)
    order = np.argsort(begin, kind="stable")
    b, e = begin[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], b[1:] > e[:-1]])
    first = np.flatnonzero(new)
    return np.stack([b[first], e[np.append(first[1:], len(b)) - 1]], axis=1)


Found = tuple[np.ndarray, np.ndarray, np.ndarray]       # keys (id, text hash, block), begins, ends


def pack_ranges(found: list[Found], squeeze: zstandard.ZstdCompressor) -> list[tuple[int, bytes]]:
    """(block, payload) rows of ranges: each payload has the ranges of many documents, by document."""
    keys, begin, end = (np.concatenate([f[i] for f in found]) for i in range(3))
    order = np.lexsort((begin, keys[:, 1], keys[:, 0], keys[:, 2]))
    keys, begin, end = keys[order], begin[order], end[order]
    rows = []
    for block, (lo, hi) in zip(*parts_of(keys[:, 2]), strict=True) if len(keys) else ():
        part = np.stack([keys[lo:hi, 0], keys[lo:hi, 1], begin[lo:hi], end[lo:hi]])
        rows.append((block, squeeze.compress(part.tobytes())))
    return rows


def unpack_ranges(payloads: list[bytes]) -> dict[tuple[int, int], np.ndarray]:
    """Merged ranges by (id, text hash)."""
    open_ = zstandard.ZstdDecompressor()
    parts = [np.frombuffer(open_.decompress(p), np.int64).reshape(4, -1) for p in payloads]
    if not parts:
        return {}
    at, fp, begin, end = np.concatenate(parts, axis=1)
    order = np.lexsort((begin, fp, at))
    at, fp, begin, end = at[order], fp[order], begin[order], end[order]
    first = [0, *(np.flatnonzero((at[1:] != at[:-1]) | (fp[1:] != fp[:-1])) + 1).tolist()]
    return {(int(at[lo]), int(fp[lo])): merged(begin[lo:hi], end[lo:hi])
            for lo, hi in zip(first, [*first[1:], len(at)], strict=True)}


def repeated_in_bucket(payloads: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Repeated ranges within one bucket: document keys, begins, ends."""
    open_ = zstandard.ZstdDecompressor()
    parts = [unpack(p, open_) for p in payloads]
    keys, begin, size, place = (np.concatenate([p[i] for p in parts]) for i in range(4))
    raw = np.concatenate([*(p[4] for p in parts), np.zeros(16, np.uint8)])
    start = np.cumsum(size) - size
    owner = keys[:, 0]
    # runs whose smallest hash occurs in two documents at least
    value = gram_hash(raw, start + place)
    order = np.argsort(value, kind="stable")
    group = np.concatenate([[True], value[order][1:] != value[order][:-1]])
    first = np.flatnonzero(group)
    low, high = np.minimum.reduceat(owner[order], first), np.maximum.reduceat(owner[order], first)
    number = np.cumsum(group) - 1
    shared = np.sort(order[(low < high)[number]])
    nothing = np.zeros((0, 3), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(shared):
        return nothing
    # equal runs become one text with its smallest owner
    data = raw.tobytes()
    distinct: dict[bytes, int] = {}
    text_of = np.empty(len(shared), np.int64)
    for n, (s, z) in enumerate(zip(start[shared].tolist(), size[shared].tolist(), strict=True)):
        text_of[n] = distinct.setdefault(data[s:s + z], len(distinct))
    lowest = np.full(len(distinct), _LAST, np.int64)
    np.minimum.at(lowest, text_of, owner[shared])
    example = np.empty(len(distinct), np.int64)
    example[text_of] = shared
    # suffixes of the distinct runs, sorted with the difference cover; runs alone under their hash have no tie
    alike = refined_counts(value[example]) > 1
    chosen = np.flatnonzero(alike)
    counts = size[example[chosen]] - length + 1
    ends = np.cumsum(counts)
    within = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)
    windows = within + np.repeat(start[example[chosen]], counts)
    best = lowest_owner(raw, windows, np.repeat(lowest[chosen], counts), length)
    better = best < np.repeat(lowest[chosen], counts)
    # occurrences after the smallest owner are repeated as a whole
    later = owner[shared] > lowest[text_of]
    out_keys, out_begin = [keys[shared[later]]], [begin[shared[later]]]
    out_end = [begin[shared[later]] + size[shared[later]]]
    # occurrences in the smallest owner: the suffixes that tie with a smaller document
    slot = np.full(len(distinct), -1, np.int64)
    slot[chosen] = np.arange(len(chosen))
    some = np.zeros(len(chosen), bool)
    np.logical_or.at(some, np.repeat(np.arange(len(chosen)), counts), better)
    own = np.flatnonzero(~later & (slot[text_of] >= 0))
    own = own[some[slot[text_of[own]]]]
    for n in own.tolist():
        c = slot[text_of[n]]
        hit = np.flatnonzero(better[ends[c] - counts[c]:ends[c]])
        runs = merged(hit, hit + 1) + begin[shared[n]]
        out_keys.append(np.repeat(keys[shared[n]][None], len(runs), axis=0))
        out_begin.append(runs[:, 0])
        out_end.append(runs[:, 1] + length - 1)
    return np.concatenate(out_keys), np.concatenate(out_begin), np.concatenate(out_end)


def refined_counts(values: np.ndarray) -> np.ndarray:
    """How often each value occurs."""
    _, inverse, counts = np.unique(values, return_inverse=True, return_counts=True)
    return counts[inverse]


_EMIT = 200_000         # ranges gathered before they are written out
_HASHES = 500_000     # run hashes gathered before they are written out
_BITS = 32              # filter bits per hash, while they fit


def planes(values: np.ndarray) -> bytes:
    """Sorted numbers as differences, byte plane by byte plane (high planes compress to nothing)."""
    steps = np.diff(values, prepend=np.uint64(0))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()


def from_planes(data: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()
    return np.cumsum(steps, dtype=np.uint64)


@dataclass
class BitSlices:
    """A bit array for hashes in slices, one per part of the hashes; it never misses a hash that was put in."""
    bits: np.ndarray
    start: np.ndarray
    size: np.ndarray

    @staticmethod
    def of(slices: list[bytes]) -> BitSlices:
        size = np.array([8 * len(x) for x in slices], np.int64)
        return BitSlices(np.frombuffer(b"".join(slices) or b"\0", np.uint8), np.cumsum(size) - size, size)

    def passes(self, values: np.ndarray) -> np.ndarray:
        part, rest = split_hash(values, len(self.size))
        size = self.size[part]
        at = self.start[part] + (mix64(rest) % np.maximum(size, 1).astype(np.uint64)).astype(np.int64)
        return (size > 0) & (self.bits[np.minimum(at >> 3, len(self.bits) - 1)] >> (at & 7).astype(np.uint8) & 1 > 0)


def slice_of(hashes: np.ndarray, most: int) -> bytes:
    """The bit array of some hashes of one part, of at most ``most`` bytes."""
    bits = np.zeros(min(most, -(-len(hashes) * _BITS // 8)) * 8, bool)
    if len(bits):
        bits[(mix64(hashes) % np.uint64(len(bits))).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


@dataclass
class HashFilter:
    """``shared``: run hashes that occur in two documents; ``hot``: those with very many runs."""
    shared: BitSlices
    hot: BitSlices


def split_hash(values: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    short = values >> np.uint64(16)
    return (short % np.uint64(parts)).astype(np.int64), short // np.uint64(parts)


def runs_of(batch: pa.RecordBatch, length: int):
    """(ids of rows, document, begin, bytes, bounds, runs) for each unit of a batch (__at, __fp, __blk, text)."""
    text, offsets = utf8_column(batch, "text")
    ids = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)], axis=1).astype(np.int64)
    for doc, begin, piece, bounds in units(text, offsets, length):
        runs = cut_runs(piece, bounds, length)
        if len(runs.start):
            yield ids, doc, begin, piece, bounds, runs


def shared_hashes(docs: DataFrame, params: DedupParams, parts: int) -> HashFilter:
    """Filters over the run hashes that occur in two documents, and those of more than ``hot_runs`` runs.

    Both have a bound in bytes. A hash that a full filter passes for another's sake is shipped, or
    dealt suffix by suffix, without need; results are the same.
    """
    length = params.length

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        hashes, owners = [], []

        def packed() -> pa.RecordBatch:
            value, owner = np.concatenate(hashes), np.concatenate(owners)
            hashes.clear()
            owners.clear()
            part, rest = split_hash(value, parts)
            order = np.lexsort((rest, part))
            part, rest, owner = part[order], rest[order], owner[order]
            first = np.flatnonzero(np.concatenate([[True], (rest[1:] != rest[:-1]) | (part[1:] != part[:-1])]))
            several = np.minimum.reduceat(owner, first) < np.maximum.reduceat(owner, first)
            times = np.diff(np.append(first, len(part))).astype(np.uint32)
            part, rest = part[first], rest[first]
            rows = []
            for p, (lo, hi) in zip(*parts_of(part), strict=True):
                rows.append((p, squeeze.compress(planes(rest[lo:hi])), np.packbits(several[lo:hi]).tobytes(),
                             squeeze.compress(times[lo:hi].tobytes())))
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])],
                names=["part", "hashes", "several", "times"])

        for batch in batches:
            for ids, doc, _, _, _, runs in runs_of(batch, length):
                hashes.append(runs.value)
                owners.append(ids[doc[runs.piece], 0])
                if sum(map(len, hashes)) > _HASHES:
                    yield packed()
        if hashes:
            yield packed()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor()
        current, held = None, []

        def bitmap() -> pa.RecordBatch:
            value, known, times = (np.concatenate([h[i] for h in held]) for i in range(3))
            held.clear()
            order = np.argsort(value)
            value, known, times = value[order], known[order], times[order]
            again = np.concatenate([value[1:] == value[:-1], [False]])
            shared = np.unique(value[again | known])
            first = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
            hot = value[first][np.add.reduceat(times.astype(np.int64), first) > params.hot_runs]
            return pa.RecordBatch.from_arrays(
                [pa.array([current], pa.int32()), pa.array([slice_of(shared, params.filter_bytes // parts)], pa.binary()),
                 pa.array([slice_of(hot, params.hot_bytes // parts)], pa.binary())], names=["part", "bits", "hot"])

        for batch in batches:
            for part, hashes, several, times in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if held and part != current:
                    yield bitmap()
                current = part
                value = from_planes(open_.decompress(hashes))
                held.append((value, np.unpackbits(np.frombuffer(several, np.uint8), count=len(value)).astype(bool),
                             np.frombuffer(open_.decompress(times), np.uint32)))
        if held:
            yield bitmap()

    rows = (docs.select("__at", "__fp", "__blk", "text").mapInArrow(send, "part int, hashes binary, several binary, times binary")
            .repartition(parts, "part").sortWithinPartitions("part")
            .mapInArrow(count, "part int, bits binary, hot binary").collect())     # at most filter_bytes + hot_bytes
    shared, hot = [b""] * parts, [b""] * parts
    for row in rows:
        shared[row["part"]], hot[row["part"]] = bytes(row["bits"]), bytes(row["hot"])
    return HashFilter(BitSlices.of(shared), BitSlices.of(hot))


def parts_of(part: np.ndarray) -> tuple[list[int], list[tuple[int, int]]]:
    """Numbers and bounds of the stretches of equal values."""
    first = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist()]
    return part[first].tolist(), list(zip(first, [*first[1:], len(part)], strict=True))


def repeated_ranges(docs: DataFrame, params: DedupParams, n_parts: int, n_bytes: int) -> DataFrame:
    """Rows (__blk, __payload): packed repeated ranges of documents (columns __at, __fp, __blk, text)."""
    length = params.length
    n_buckets = max(4 * n_parts, -(-n_bytes // params.bucket_bytes))
    shared = docs.sparkSession.sparkContext.broadcast(shared_hashes(docs, params, n_parts))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remembered = Remembered({}, set())
        squeeze = zstandard.ZstdCompressor(level=3)
        settled_ranges: list[Found] = []
        for batch in batches:
            for ids, doc, begin, piece, bounds, runs in runs_of(batch, length):
                runs = runs.where(shared.value.shared.passes(runs.value))
                if not len(runs.start):
                    continue
                padded = np.concatenate([piece, np.zeros(8, np.uint8)])
                raw = padded.tobytes()

                def settle(runs: Runs) -> np.ndarray:
                    """Which runs are not settled within the task; the ranges of the others are kept."""
                    size, in_doc = runs.count + length - 1, doc[runs.piece]
                    at = runs.start - bounds[runs.piece] + begin[runs.piece]
                    settled = runs_equal_to_earlier(raw, runs.start, size, ids[in_doc, 0], remembered)
                    settled_ranges.append((ids[in_doc[settled]], at[settled], (at + size)[settled]))
                    return np.flatnonzero(~settled)

                runs = runs.where(settle(runs))
                key, hot = runs.value, shared.value.hot.passes(runs.value)
                if hot.any():
                    single, own = single_suffixes(padded, runs, np.flatnonzero(hot), length)
                    left = settle(single)
                    runs = joined(runs.where(~hot), single.where(left))
                    key = np.concatenate([key[~hot], own[left]])
                size = runs.count + length - 1
                in_doc = doc[runs.piece]
                place_in_doc = runs.start - bounds[runs.piece] + begin[runs.piece]
                send = np.arange(len(runs.start))
                bucket = (mix64(key) % np.uint64(n_buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                rows = []
                for b, (lo, hi) in zip(*parts_of(bucket[order]), strict=True) if len(send) else ():
                    part = send[order[lo:hi]]
                    rows.append((b, pack(padded, ids, in_doc[part], place_in_doc[part], runs.start[part],
                                         size[part], runs.place[part], squeeze)))
                yield packed_rows(rows, "bucket")
                if sum(len(f[1]) for f in settled_ranges) > _EMIT:
                    yield packed_rows([(-1 - b, p) for b, p in pack_ranges(settled_ranges, squeeze)], "bucket")
                    settled_ranges.clear()
        if settled_ranges:
            yield packed_rows([(-1 - b, p) for b, p in pack_ranges(settled_ranges, squeeze)], "bucket")

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        found: list[Found] = []
        current, payloads = None, []
        for batch in batches:
            for bucket, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if bucket < 0:                                  # settled already: on to its block
                    yield packed_rows([(-1 - bucket, payload)], "__blk")
                    continue
                if payloads and bucket != current:
                    found.append(repeated_in_bucket(payloads, length))
                    payloads = []
                current = bucket
                payloads.append(payload)
                if sum(len(f[1]) for f in found) > _EMIT:
                    yield packed_rows(pack_ranges(found, squeeze), "__blk")
                    found.clear()
        if payloads:
            found.append(repeated_in_bucket(payloads, length))
        if found:
            yield packed_rows(pack_ranges(found, squeeze), "__blk")

    runs = docs.select("__at", "__fp", "__blk", "text").mapInArrow(cut, "bucket int, __payload binary")
    return (runs.repartition(n_parts, "bucket").sortWithinPartitions("bucket")
            .mapInArrow(sort, "__blk int, __payload binary"))


def packed_rows(rows: list[tuple[int, bytes]], key: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())],
                                      names=[key, "__payload"])


def units(text: np.ndarray, offsets: np.ndarray, length: int):
    """Cut a batch into units of about ``_UNIT`` bytes: (document, begin within it, bytes, bounds of pieces).

    Documents longer than a unit are cut into pieces that overlap by ``length - 1`` bytes.
    """
    pieces = []
    for d, (lo, hi) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        for b in range(0, max(1, hi - lo), _UNIT):
            pieces.append((d, b, lo + b, min(hi, lo + b + _UNIT + length - 1)))
            if lo + b + _UNIT >= hi:
                break
    at = 0
    while at < len(pieces):
        end, total = at, 0
        while end < len(pieces) and (end == at or total + pieces[end][3] - pieces[end][2] <= _UNIT):
            total += pieces[end][3] - pieces[end][2]
            end += 1
        part = pieces[at:end]
        yield (np.array([p[0] for p in part]), np.array([p[1] for p in part]),
               np.concatenate([text[p[2]:p[3]] for p in part]),
               np.concatenate([[0], np.cumsum([p[3] - p[2] for p in part])]).astype(np.int64))
        at = end


Finish = Callable[[pa.Array, dict[str, pa.Array], list[bytes | None]], pa.RecordBatch]


def with_ranges(docs: DataFrame, params: DedupParams, finish: Finish, schema: T.StructType | str) -> DataFrame:
    """``finish(texts, other columns by name, repeated ranges of each row or None)`` applied to batches of ``docs``.

    Documents and packed ranges are dealt to the same blocks by hash of the document key;
    within a block the ranges come first and then its documents stream past them.
    """
    if params.length < 29:
        raise ValueError("length must be at least 29")
    bounded_batches(docs.sparkSession)
    n_bytes = input_bytes(docs, "text")
    n_parts = partitions_for(docs.sparkSession, n_bytes)
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LAST)).alias("__at"), F.xxhash64("text").alias("__fp"),
        F.col("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("__rest")) \
        .withColumn("__blk", F.pmod(F.xxhash64("__at", "__fp"), F.lit(max(1, -(-n_bytes // params.block_bytes)))).cast("int"))
    ranges = repeated_ranges(rows, params, n_parts, n_bytes)
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.select("__at", "__fp", "text", "__rest").schema]
    both = rows.select("__blk", F.lit(1).alias("__kind"), F.lit(None).cast("binary").alias("__payload"),
                       "__at", "__fp", "text", "__rest").unionByName(
        ranges.select("__blk", F.lit(0).alias("__kind"), "__payload", *empty))

    others = [c for c in docs.columns if c != "text"]

    def attach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, payloads, known = None, [], None
        for batch in batches:
            blocks, kinds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            is_doc = kinds == 1
            parts: list[bytes | None] = []
            payload, ids, prints = (batch.column(i) for i in (2, 3, 4))
            for n in range(batch.num_rows):
                if blocks[n] != block:
                    block, payloads, known = blocks[n], [], None
                if not is_doc[n]:
                    payloads.append(payload[n].as_py())
                    continue
                if known is None:
                    known = unpack_ranges(payloads)
                mine = known.get((ids[n].as_py(), prints[n].as_py())) if known else None
                parts.append(None if mine is None else mine.tobytes())
            mine_ = batch.filter(pa.array(is_doc))
            rest = dict(zip(others, mine_.column(6).flatten(), strict=True))
            yield finish(mine_.column(5), rest, parts)

    return both.repartition(n_parts, "__blk").sortWithinPartitions("__blk", "__kind").mapInArrow(attach, schema)


def kept_bytes(text: bytes, parts: bytes | None) -> tuple[bytes, int, int]:
    """The text without its repeated ranges, bytes removed, number of removed runs."""
    if not parts:
        return text, 0, 0
    spans = np.frombuffer(parts, np.int64).reshape(-1, 2).tolist()
    kept, at = [], 0
    for b, e in spans:
        kept.append(text[at:b])
        at = e
    kept.append(text[at:])
    return b"".join(kept), sum(e - b for b, e in spans), len(spans)


def dedup_report(docs: DataFrame, params: DedupParams = DedupParams()) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row of ``docs``."""
    def report(texts: pa.Array, rest: dict[str, pa.Array], parts: list[bytes | None]) -> pa.RecordBatch:
        out = []
        for text, mine in zip(texts.cast(pa.binary()).to_pylist(), parts, strict=True):
            kept, removed, spans = kept_bytes(text, mine)
            out.append((len(text), removed, spans, hashlib.sha256(kept).hexdigest()))
        columns = list(zip(*out, strict=True)) if out else [()] * 4
        return pa.RecordBatch.from_arrays(
            [rest["doc_id"], *(pa.array(c, t) for c, t in zip(
                columns, (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True))],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return with_ranges(rows, params, report,
                       "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def remove_repeats(docs: DataFrame, params: DedupParams = DedupParams()) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text`` (and ``n_chars`` set anew, if there).

    Characters cut in two lose their remaining bytes. Documents left without any
    character are dropped; empty or NULL texts that lost nothing stay as they are.
    All other columns stay.
    """
    columns = docs.columns

    def strip(texts: pa.Array, rest: dict[str, pa.Array], parts: list[bytes | None]) -> pa.RecordBatch:
        kept = texts.to_pylist()
        for n, mine in enumerate(parts):
            if mine:
                kept[n] = kept_bytes(kept[n].encode(), mine)[0].decode("utf-8", "ignore")
        keep = pa.array([not mine or bool(kept[n]) for n, mine in enumerate(parts)], pa.bool_())
        cleaned = rest | {"text": pa.array(kept, texts.type)}
        return pa.RecordBatch.from_arrays([cleaned[c] for c in columns], names=columns).filter(keep)

    done = with_ranges(docs, params, strip, docs.schema)
    if "n_chars" in columns:
        done = done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return done
