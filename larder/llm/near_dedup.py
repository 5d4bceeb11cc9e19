"""Near-duplicate detection with HyperMinHash sketches and exact confirmation.

1. Each document becomes its set of word shingles and a HyperMinHash sketch
   (``hyperminhash``). Equal sets collapse to one numbered node at once, by a digest of
   the set, with partial aggregation: copies never meet in one task.
2. Bands of compressed registers bring candidates together. Within a band's bucket
   sketches are compared in numpy (size bound, register bound, collision-corrected
   estimate). Only the trees that the surviving pairs span are written, as stars, so
   output stays linear. Buckets of more than ``block`` nodes are dealt to tasks by pairs
   of blocks; the estimate is the only thing that drops a pair.
3. The components of these trees are the clusters outside of which no link can lie. Each
   node's full set is shipped once, to its cluster. There every pair that the sketches
   allow and that is not linked through others is checked exactly on the full sets; again
   only the trees that confirmed links span are written. Sets are taken in a second pass
   over the documents, only for rows that a bounded Bloom filter passes; an exact join
   follows. A cluster of more than ``block`` nodes is confirmed in rounds
   (``large_cluster_links``): chunks first, then one node for each part found, together
   with the nodes that had most links; only parts still apart are compared pair by pair.
4. Components of the confirmed links give the result. The last join, of all rows with the
   components by set digest, has a hot key where a text has very many copies; the adaptive
   skew join splits it.

At similarity 0.8 a pair shares no band with a chance of about (1 - 0.8^4)^32 = 5e-8.

Words are runs of bytes other than ASCII white space, A-Z lower-cased.

Nulls, edges: NULL or empty texts (and texts without words) have empty sets; they
are linked with nothing. A NULL ``doc_id`` sorts last; a component of such rows
only has a NULL id. Rows with one id and different texts are separate members.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm import hyperminhash as hmh
from larder.llm.bloom import filter_words, key_hashes, probe
from larder.llm.common import bounded_batches, input_bytes, packed, partitions_for, utf8_column, written
from larder.llm.components import components, tasks_for
from larder.llm.word_table import RecentValues

_LAST = (1 << 63) - 1
_TASK_NODES = 1 << 19
_SMALL = 48             # groups up to this size are compared together


@dataclass(frozen=True)
class NearParams:
    """``percent``: links need 100 * intersection >= percent * union. ``max_blocks`` bounds the Bloom filter (64 bytes each).

    ``hubs``, ``rounds``: see ``large_cluster_links``; they change its work, not its links.
    """
    words: int = 5
    percent: int = 80
    block: int = 1000
    hubs: int = 16
    rounds: int = 12
    max_blocks: int = 1 << 18


def shingler(size: int) -> Callable[[bytes], np.ndarray]:
    """Function text bytes -> sorted distinct shingle hashes, with its own bounded word table."""
    words = RecentValues(hmh.word_hash, 150_000)

    def shingles(text: bytes) -> np.ndarray:
        words.trim()
        tokens = text.lower().split()               # bytes: ASCII letters and ASCII white space only
        return hmh.shingle_hashes(np.fromiter(map(words.__getitem__, tokens), np.uint64, len(tokens)), size)
    return shingles


def texts_of(batch: pa.RecordBatch, name: str) -> Iterator[bytes]:
    buffer, offsets = utf8_column(batch, name)
    for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        yield buffer[lo:hi].tobytes()


def keyed(docs: DataFrame) -> DataFrame:
    """Adds ``__at`` (the id, NULL last) and ``__fp`` (text hash): together the key of a row up to exact repeats."""
    return docs.withColumn("__at", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LAST))) \
        .withColumn("__fp", F.xxhash64("text"))


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """__at, __fp, sig (digest of the set), n (its size), regs (sketch) per row of keyed documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = shingler(words)
        for batch in batches:
            sigs, sizes, regs = [], [], []
            for text in texts_of(batch, "text"):
                found = shingles(text)
                sigs.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                sizes.append(len(found))
                regs.append(hmh.registers(found).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sigs, pa.binary()), pa.array(sizes, pa.int64()),
                 pa.array(regs, pa.binary())], names=["__at", "__fp", "sig", "n", "regs"])

    return docs.select("__at", "__fp", "text").mapInArrow(
        run, "__at bigint, __fp bigint, sig binary, n bigint, regs binary")


def band_rows(nodes: DataFrame) -> DataFrame:
    """(band, node) for each band of each node that holds a register."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [hmh.band_keys(np.frombuffer(r, np.uint16)) for r in batch.column(1).to_pylist()]
            counts = [len(k) for k in keys]
            flat = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(flat.view(np.int64)), batch.column(0).take(pa.array(np.repeat(np.arange(len(keys)), counts)))],
                names=["band", "node"])

    return nodes.select("node", "regs").mapInArrow(run, "band bigint, node bigint")


class Forest:
    """Union-find over row numbers; ``join`` tells whether two rows were apart."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)
        return a != b

    def stars(self, node: np.ndarray) -> pa.RecordBatch:
        """Each tree as links from its smallest node to the others, so that trees found twice give equal rows."""
        trees: dict[int, list[int]] = {}
        for x in range(len(self.parent)):
            if self.parent[x] != x:
                trees.setdefault(self.find(x), []).append(x)
        left, right = [], []
        for root, rest in trees.items():
            nodes = sorted(set(node[[root, *rest]].tolist()))
            left += [nodes[0]] * (len(nodes) - 1)
            right += nodes[1:]
        return pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])


def groups(batches: Iterator[pa.RecordBatch], column: int, target: int = 4000) -> Iterator[pa.Table]:
    """Cut rows sorted by a key column into tables of whole groups, about ``target`` rows each."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        for at in range(0, batch.num_rows, target):
            part = batch.slice(at, target)
            held.append(part)
            rows += part.num_rows
            if rows < target:
                continue
            table = pa.Table.from_batches(held)
            keys = table.column(column).to_numpy()
            cut = len(keys) - int(np.argmax(np.append(keys[::-1] != keys[-1], True)))    # start of the last group
            if cut:
                yield table.slice(0, cut)
            held, rows = table.slice(cut).to_batches(), table.num_rows - cut
    if rows:
        yield pa.Table.from_batches(held)


def bounds_of(keys: np.ndarray) -> list[tuple[int, int]]:
    cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    edges = [0, *cuts.tolist(), len(keys)]
    return list(zip(edges[:-1], edges[1:], strict=True))


def allowed_pairs(regs: np.ndarray, sizes: np.ndarray, threshold: float, lo: int, hi: int, labels: np.ndarray,
                  counts: Callable[[int, np.ndarray], np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """For each row of a group the later rows not yet in its tree (``labels``) that count and that the sketches allow.

    Rows come in order of size, so only rows up to size / threshold are looked at.
    """
    order = lo + np.argsort(sizes[lo:hi], kind="stable")
    by_size = sizes[order]
    ends = np.searchsorted(by_size, by_size / threshold + 1e-9, side="right").tolist()
    for at, i in enumerate(order[:-1].tolist()):
        rest = order[at + 1:ends[at]]
        rest = rest[(labels[rest] != labels[i]) & counts(i, rest)]
        if len(rest):
            me = np.full(len(rest), i)
            rest = rest[hmh.may_reach(regs[me], regs[rest], sizes[me], sizes[rest], threshold)]
            if len(rest):
                yield i, rest


def unite(labels: np.ndarray, lo: int, hi: int, rows: np.ndarray) -> None:
    """Gives the trees of the named rows of the group lo..hi one label."""
    old = np.unique(labels[rows])
    group = labels[lo:hi]
    group[np.isin(group, old)] = old[0]


def in_blocks(rows: DataFrame, key: str, count: str, block: int) -> DataFrame:
    """Deal rows to comparison groups (``grp``): their key, or for large keys every pair of its blocks.

    Columns added: grp, blk (the row's own block), across (only pairs of different blocks count).
    """
    n = F.ceil(F.col(count) / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64("node"), F.greatest(n, F.lit(1))).cast("int")
    dealt = rows.withColumn("blk", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1)))
    low, high = F.least("blk", "other"), F.greatest("blk", "other")
    return dealt.withColumn("grp", F.xxhash64(F.col(key), low, high)).withColumn("across", low != high).drop("other")


def candidate_forest(members: DataFrame, threshold: float, parts: int) -> DataFrame:
    """Links (a, b): per group the trees that the pairs allowed by the sketches span, as stars."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, 0):
            key, node, sizes = (table.column(i).to_numpy() for i in range(3))
            regs = np.frombuffer(b"".join(table.column(3).to_pylist()), np.uint16).reshape(-1, hmh.REGISTERS)
            blk, across = table.column(4).to_numpy(), table.column(5).to_pylist()
            forest, small, labels = Forest(len(node)), [], np.arange(len(node))
            for lo, hi in bounds_of(key):
                if hi - lo < 2:
                    continue
                if hi - lo <= _SMALL and not across[lo]:
                    i, j = np.triu_indices(hi - lo, 1)
                    small.append((lo + i, lo + j))
                    continue
                def counts(i: int, rest: np.ndarray, every: bool = not across[lo]) -> np.ndarray:
                    return every | (blk[rest] != blk[i])
                for i, rest in allowed_pairs(regs, sizes, threshold, lo, hi, labels, counts):
                    for j in rest[np.unique(labels[rest], return_index=True)[1]].tolist():
                        forest.join(i, j)
                    unite(labels, lo, hi, np.append(rest, i))
            if small:
                i, j = (np.concatenate(x) for x in zip(*small, strict=True))
                for at in range(0, len(i), 50_000):
                    a, b = i[at:at + 50_000], j[at:at + 50_000]
                    ok = hmh.may_reach(regs[a], regs[b], sizes[a], sizes[b], threshold)
                    for x, y in zip(a[ok].tolist(), b[ok].tolist(), strict=True):
                        forest.join(x, y)
            yield forest.stars(node)

    return (members.select("grp", "node", "n", "regs", "blk", "across").repartition(parts, "grp")
            .sortWithinPartitions("grp").mapInArrow(run, "a bigint, b bigint").distinct())


def confirmed_forest(members: DataFrame, percent: int, parts: int) -> DataFrame:
    """Links (a, b) that span the trees of the pairs whose full sets reach the threshold, within each ``grp``.

    Columns: grp, node, n, set, part (rows with the same are linked already), low (only
    pairs with such a row count).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, 0, 1000):
            key, node, sizes = (table.column(i).to_numpy() for i in range(3))
            sets = [np.frombuffer(s, np.uint64) for s in table.column(3).to_pylist()]
            regs = np.stack([hmh.registers(s) for s in sets])
            labels = np.unique(table.column(4).to_numpy(), return_inverse=True)[1]
            low = table.column(5).to_numpy()
            left, right = [], []
            for lo, hi in bounds_of(key):
                for i, rest in allowed_pairs(regs, sizes, percent / 100, lo, hi, labels, lambda i, rest: low[rest] | low[i]):
                    for j in rest.tolist():
                        if labels[i] == labels[j]:
                            continue
                        both = common(sets[i], sets[j])
                        if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                            unite(labels, lo, hi, np.array([i, j]))
                            left.append(node[i])
                            right.append(node[j])
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    return (members.select("grp", "node", "n", "set", "part", "low").repartition(parts, "grp")
            .sortWithinPartitions("grp").mapInArrow(run, "a bigint, b bigint"))


def large_cluster_links(rows: DataFrame, params: NearParams, parts: int) -> DataFrame:
    """Links (a, b) that span the confirmed components of clusters with more than ``block`` nodes (node, label, n, set).

    A round deals one node of each part (at first every node is one) to chunks of about
    ``block`` and compares each chunk, to which the cluster's ``hubs`` nodes with most links
    of the round before go as well; so copies that are like one original, but not like each
    other, find it. Rounds end when no cluster has two parts, or when a round joins less than
    a tenth of them. A round ships a node's set once and a hub's once per chunk. What is
    still apart then is compared exactly: the nodes outside a cluster's largest part with all
    its nodes, block by block, which ships the cluster once per ``block`` such nodes.
    """
    state = rows.select("node", "label", F.col("node").alias("part"))
    hubs = state.select("node").limit(0)
    links, before = [], None
    for _ in range(params.rounds):
        heads = state.where("node = part")
        apart = heads.groupBy("label").agg(F.count("*").alias("heads")).where("heads > 1").select(
            "label", F.ceil(F.col("heads") / F.lit(params.block)).cast("int").alias("chunks"), "heads")
        left = apart.agg(F.sum("heads")).first()[0] or 0
        if not left or (len(links) > 1 and left > 0.9 * before):
            break
        before = left
        chunk = F.pmod(F.xxhash64("node", F.lit(len(links))), F.col("chunks")).cast("int")
        dealt = heads.join(apart, "label").withColumn("chunk", chunk).unionByName(
            state.join(hubs, "node").join(apart, "label")
            .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))))
        dealt = dealt.select("node", "part", F.xxhash64("label", "chunk").alias("grp"), F.lit(True).alias("low")).distinct()
        tasks = tasks_for(rows, left, params.block)
        new = written(confirmed_forest(dealt.join(rows.drop("label"), "node"), params.percent, min(parts, tasks)), "confirmed")
        links.append(new)
        state, degrees = parts_of(state, new), new.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").count()
        rank = F.row_number().over(Window.partitionBy("label").orderBy(F.desc("count"), "node"))
        hubs = written(degrees.join(state, "node").withColumn("rank", rank).where(F.col("rank") <= params.hubs)
                       .select("node").coalesce(min(parts, tasks)), "hubs")
    found = state.groupBy("label", "part").agg(F.count("*").alias("size")).groupBy("label").agg(
        F.sum("size").alias("cnt"), F.max(F.struct("size", "part")).alias("largest"), F.count("*").alias("many")).where("many > 1")
    apart = written(found.select("label", "largest.part", F.ceil(F.col("cnt") / params.block).cast("int").alias("blocks"),
                                 F.ceil((F.col("cnt") - F.col("largest.size")) / params.block).cast("int").alias("lows"))
                    .withColumnRenamed("part", "largest"), "apart")
    nodes = state.join(apart, "label")
    every = nodes.withColumn("blk", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn(
        "lo", F.explode(F.sequence(F.lit(0), F.col("lows") - 1))).withColumn("low", F.lit(False))
    outside = nodes.where("part != largest").withColumn("lo", F.pmod(F.xxhash64("node"), F.col("lows")).cast("int")).withColumn(
        "blk", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("low", F.lit(True))
    dealt = every.unionByName(outside, allowMissingColumns=True).select(
        "node", "part", F.xxhash64("label", "lo", "blk").alias("grp"), "low")
    links.append(confirmed_forest(dealt.join(rows.drop("label"), "node"), params.percent, parts))
    return reduce(DataFrame.unionByName, links)


def parts_of(state: DataFrame, links: DataFrame) -> DataFrame:
    """(node, label, part) after further links: ``part`` is the smallest node of the part; links may name any of its nodes."""
    heads = state.select("node", "part")
    between = (links.join(heads.toDF("a", "x"), "a").join(heads.toDF("b", "y"), "b")
               .select(F.col("x").alias("a"), F.col("y").alias("b")))
    moved = components(between).select(F.col("node").alias("part"), F.col("label").alias("to"))
    tasks = tasks_for(state, state.count(), _TASK_NODES)
    return written(state.join(moved, "part", "left").select("node", "label", F.coalesce("to", "part").alias("part"))
                   .coalesce(tasks), "parts")


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted distinct arrays."""
    both = np.sort(np.concatenate([a, b]), kind="stable")
    return int((both[1:] == both[:-1]).sum())


def sets_of(docs: DataFrame, wanted: DataFrame, params: NearParams) -> DataFrame:
    """(node, set) of the wanted rows (node, __at, __fp): a second pass over the keyed documents."""
    words = filter_words(wanted, key_hashes(F.col("__at"), F.col("__fp")), params.max_blocks)
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = shingler(params.words)
        for batch in batches:
            hashes = batch.column(3).flatten().to_numpy().reshape(-1, 2)
            chosen = batch.filter(pa.array(probe(shared.value, hashes[:, 0], hashes[:, 1])))
            found = [shingles(t).tobytes() for t in texts_of(chosen, "text")]
            yield pa.RecordBatch.from_arrays([chosen.column(0), chosen.column(1), pa.array(found, pa.binary())],
                                             names=["__at", "__fp", "set"])

    passed = docs.select("__at", "__fp", "text", key_hashes(F.col("__at"), F.col("__fp")).alias("h")).mapInArrow(
        run, "__at bigint, __fp bigint, set binary")
    return passed.join(wanted, ["__at", "__fp"]).select("node", "set")


def component_table(docs: DataFrame, params: NearParams) -> tuple[DataFrame, DataFrame, DataFrame]:
    """For keyed documents: the sketch rows, the nodes (one per distinct set), and (node, label, component) of linked nodes.

    ``label`` (the group's smallest node) tells groups apart; ``component`` is only the smallest id, which groups can share.
    """
    bounded_batches(docs.sparkSession)
    parts = partitions_for(docs.sparkSession, input_bytes(docs, "text"))
    drawn = written(sketches(docs, params.words), "sketches")
    # numbered once and written, so a node keeps its number
    nodes = written(
        drawn.where("n > 0").groupBy("sig").agg(
            F.min(F.struct("__at", "__fp")).alias("key"), F.first("n").alias("n"), F.first("regs").alias("regs"))
        .select("sig", F.monotonically_increasing_id().alias("node"), "n", "regs", "key.__at", "key.__fp"), "nodes")
    bands = band_rows(nodes)
    shared = bands.groupBy("band").agg(F.count("*").alias("cnt")).where("cnt > 1")
    members = bands.join(shared, "band").join(nodes.select("node", "n", "regs"), "node")
    candidates = candidate_forest(in_blocks(members, "band", "cnt", params.block), params.percent / 100, parts)
    clusters = components(candidates)
    sizes = clusters.groupBy("label").agg(F.count("*").alias("cnt"))
    wanted = written(clusters.join(nodes.drop("sig", "regs"), "node").join(sizes, "label")
                     .select("node", "label", "cnt", "n", "__at", "__fp"), "clusters")

    def with_sets(rows: DataFrame) -> DataFrame:
        return rows.select("node", "label", "n").join(sets_of(docs, rows.select("node", "__at", "__fp"), params), "node")
    small, large = wanted.where(F.col("cnt") <= params.block), wanted.where(F.col("cnt") > params.block)
    links = confirmed_forest(with_sets(small).select(F.col("label").alias("grp"), "node", "n", "set", F.col("node").alias("part"),
                                                     F.lit(True).alias("low")), params.percent, parts)
    if large.limit(1).count():
        links = links.unionByName(large_cluster_links(written(with_sets(large), "large-clusters"), params, parts))
    labels = components(links)
    lowest = labels.join(wanted.select("node", "__at"), "node").groupBy("label").agg(F.min("__at").alias("component"))
    return drawn, nodes, labels.join(lowest, "label").select("node", "label", "component")


def assigned(docs: DataFrame, params: NearParams) -> DataFrame:
    """__at, __fp, n, label (of the row's group; NULL without words), component per row of keyed documents."""
    drawn, nodes, linked = component_table(docs, params)
    found = nodes.select("sig", "node", F.col("__at").alias("first")).join(linked, "node", "left").select(
        "sig", F.coalesce("label", "node").alias("label"), F.coalesce("component", "first").alias("component"))
    return drawn.select("__at", "__fp", "sig", "n").join(found, "sig", "left").select(
        "__at", "__fp", "n", "label", F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("__at")).alias("component"))


def near_duplicates(docs: DataFrame, params: NearParams = NearParams()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept (the document is its component's smallest) per row of ``docs``."""
    rows = assigned(keyed(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))), params)

    def known(name: str):
        return F.when(F.col(name) != _LAST, F.col(name))
    return rows.select(known("__at").alias("doc_id"), F.col("n").alias("n_shingles"),
                       known("component").alias("component_id"), (F.col("__at") == F.col("component")).alias("kept"))


def keep_one_of_each(docs: DataFrame, params: NearParams = NearParams()) -> DataFrame:
    """``docs`` with one document of each group of near-duplicates: the smallest id.

    All columns stay. Rows without words stay. Of rows that repeat the kept id within its
    group, the one with the smallest text hash stays, and one of its exact repeats.
    """
    filled = keyed(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    chosen = assigned(filled, params).where(F.col("__at") == F.col("component"))
    empty = chosen.where("n = 0").select("__at", "__fp").distinct()
    full = chosen.where("n > 0").groupBy("label").agg(F.min(F.struct("__at", "__fp")).alias("k")).select("k.*")
    keep = full.withColumn("__once", F.lit(True)).unionByName(empty.withColumn("__once", F.lit(False)))
    source = packed(docs, "doc_id", "text").select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LAST)).alias("__at"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("__fp"), "__all")
    kept = source.join(keep, ["__at", "__fp"])
    repeats = filled.groupBy("__at", "__fp").agg(F.count("*").alias("c")).where("c > 1").limit(1).count()
    if repeats:         # rows that repeat id and text: one of each stays
        kept = kept.where("__once").dropDuplicates(["__at", "__fp"]).unionByName(kept.where(~F.col("__once")))
    return kept.select("__all.*")
