"""Near-duplicate vectors by cosine, with a robust-pruned flat graph built on overlapping shards.

1. Equal vectors collapse to one numbered node by a digest, with partial aggregation.
2. Centres are fitted on a bounded sample (``sample`` rows); every node goes to its nearest
   centre's shard. There near copies collapse further to classes: a graph is built and a
   node that finds an inserted one close by is not inserted but joins it. A class is kept
   only where all members lie within half the link angle of its mean direction, so that all
   its pairs are links and need no comparison.
3. Class centres go to the shards of their ``replicas`` nearest centres. In every shard a graph is
   built (greedy search, robust pruning); the adjacency lists of a class from its shards are united.
4. Each class is a query in its nearest shard, on the united lists: a greedy search from the
   medoids and from itself, then every class in range is expanded until none is left. The
   range of a query covers the radii of both classes.
5. Hits are verified in double precision. Two classes are linked as a whole (angle plus both
   radii within the link angle), not at all, or, in between, by comparing their members.
   Only counts and one link per pair of classes are written, never pairs of members.
6. Recall is audited: ``audit`` nodes are compared with all others exactly. Below ``min_recall``
   the search is repeated with twice the beam and one more replica, at most twice.

Shards above ``shard_rows`` x 4 rows are dealt in blocks, each with a graph of its own; a query
then visits every block of its shard, so no task holds more than a block. A group of copies or
near copies of any size shrinks to about one class per block before queries are made.

Nulls, edges: NULL vectors, zero vectors and those with a NULL or non-finite component have no
links and are components of their own. Vectors of different lengths are never linked. A NULL
``vec_id`` sorts last; rows that repeat an id or a whole row are separate members. An empty
table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm import flat_graph
from larder.llm.common import bounded_batches, keyed_tables, written
from larder.llm.components import components
from larder.llm.flat_graph import GraphParams

_LAST = (1 << 63) - 1
_CELLS = 1 << 20            # centre numbers of one vector length
_SLACK = 1e-9


@dataclass(frozen=True)
class EmbeddingParams:
    """``cosine``: least cosine of a link; ``shard_rows``: wanted nodes per centre (a block holds four times that)."""
    cosine: float = 0.95
    replicas: int = 3
    shard_rows: int = 1500
    max_shards: int = 2048
    sample: int = 16_384
    starts: int = 8
    audit: int = 200
    min_recall: float = 0.9
    member_block: int = 2000
    graph: GraphParams = GraphParams()

    @property
    def angle(self) -> float:
        return math.acos(self.cosine)


def matrix(column: pa.ChunkedArray | pa.Array, kind=np.float64) -> np.ndarray:
    """Binary vectors of one length as a matrix."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), np.float64).reshape(len(values), -1).astype(kind)


# --- nodes

def unit_rows(vectors: DataFrame) -> DataFrame:
    """__at (the id, NULL last), digest (of the components; NULL where nothing can be linked), dim, vec (unit vector)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            flat = lists.flatten().cast(pa.float64())           # NULL lists have no components here
            x = flat.fill_null(np.nan).to_numpy(zero_copy_only=False) + 0.0      # -0.0 becomes 0.0
            sizes = np.fromiter((0 if n is None else n for n in lists.value_lengths().to_pylist()), np.int64, len(lists))
            ends = np.cumsum(sizes)
            digests: list[bytes | None] = [None] * len(sizes)
            units: list[bytes | None] = [None] * len(sizes)
            for dim in np.unique(sizes[sizes > 0]).tolist():
                rows = np.flatnonzero(sizes == dim)
                part = x[(ends[rows] - dim)[:, None] + np.arange(dim)]
                largest = np.abs(part).max(axis=1)
                good = np.isfinite(part).all(axis=1) & (largest > 0)
                rows, part = rows[good], part[good]
                scaled = part / largest[good, None]             # no square overflows or vanishes
                scaled /= np.linalg.norm(scaled, axis=1, keepdims=True)
                for i, a, b in zip(rows.tolist(), part, scaled, strict=True):
                    digests[i] = hashlib.blake2b(a.tobytes(), digest_size=16).digest()
                    units[i] = b.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(digests, pa.binary()), pa.array(sizes.astype(np.int32)), pa.array(units, pa.binary())],
                names=["__at", "digest", "dim", "vec"])

    return vectors.select(F.coalesce(F.col("vec_id").cast("bigint"), F.lit(_LAST)).alias("__at"), "embedding").mapInArrow(
        run, "__at bigint, digest binary, dim int, vec binary")


def node_table(rows: DataFrame) -> DataFrame:
    """One numbered node per distinct vector: digest, node, dim, vec, cnt (rows), low (smallest id)."""
    return written(rows.where("digest IS NOT NULL").groupBy("digest").agg(
        F.first("dim").alias("dim"), F.first("vec").alias("vec"), F.count("*").alias("cnt"), F.min("__at").alias("low"))
        .withColumn("node", F.monotonically_increasing_id()), "vectors")


# --- shards

def fit_centres(nodes: DataFrame, params: EmbeddingParams) -> dict[int, np.ndarray]:
    """Per vector length the unit centres, fitted by a few rounds of k-means on at most ``sample`` nodes."""
    counts = nodes.groupBy("dim").count().orderBy(F.desc("count")).limit(64).collect()     # other lengths get one shard each
    total = sum(r["count"] for r in counts)
    if not total:
        return {}
    share = max(1, -(-total // params.sample))
    rows = (nodes.where(F.pmod(F.xxhash64("digest"), F.lit(share)) == 0).select("dim", "vec")
            .limit(2 * params.sample).collect())
    out = {}
    for r in counts:
        k = min(params.max_shards, -(-r["count"] // params.shard_rows))
        found = [bytes(x["vec"]) for x in rows if x["dim"] == r["dim"]]
        if k > 1 and len(found) >= 2 * k:
            x = np.frombuffer(b"".join(sorted(found)), np.float64).reshape(len(found), -1)
            rng = np.random.default_rng(len(found))
            centres = x[rng.choice(len(x), k, replace=False)]
            for _ in range(6):
                home = (x @ centres.T).argmax(axis=1)
                sums = np.zeros_like(centres)
                np.add.at(sums, home, x)
                norms = np.linalg.norm(sums, axis=1, keepdims=True)
                centres = np.where(norms > 0, sums / np.maximum(norms, 1e-300), centres)
            out[r["dim"]] = centres
    return out


def to_shards(rows: DataFrame, centres: dict[int, np.ndarray], replicas: int, vec: str, *carried: str) -> DataFrame:
    """shard, nth (0: the nearest centre's) and the carried columns, for the ``replicas`` nearest centres of each row."""
    shared = rows.sparkSession.sparkContext.broadcast(centres)         # at most max_shards vectors of a length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_pylist()
            dims = np.fromiter((len(v) // 8 for v in values), np.int64, len(values))
            shard, line, nth = [], [], []
            for dim in np.unique(dims).tolist():
                here = np.flatnonzero(dims == dim)
                found = shared.value.get(dim)
                n = 1 if found is None else min(replicas, len(found))
                if found is None:
                    nearest = np.zeros((len(here), 1), np.int64)
                else:
                    x = np.frombuffer(b"".join(values[i] for i in here.tolist()), np.float64).reshape(len(here), -1)
                    nearest = np.argsort(-(x @ found.T), axis=1, kind="stable")[:, :n]
                shard.append((dim * _CELLS + nearest).reshape(-1))
                line.append(np.repeat(here, n))
                nth.append(np.tile(np.arange(n), len(here)))
            if shard:
                line_ = np.concatenate(line)
                rest = pa.Table.from_batches([batch]).take(pa.array(line_)).drop_columns(["__key"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(shard)), pa.array(np.concatenate(nth).astype(np.int32)),
                     *[c.combine_chunks() if c.num_chunks != 1 else c.chunk(0) for c in rest.columns]],
                    names=["shard", "nth", *rest.column_names])

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in carried)
    return rows.select(F.col(vec).alias("__key"), *carried).mapInArrow(run, f"shard bigint, nth int, {kinds}")


def in_blocks(rows: DataFrame, key: str, params: EmbeddingParams) -> DataFrame:
    """Adds ``blocks`` (how many the row's shard has) and ``blk`` (the row's own)."""
    sizes = rows.groupBy("shard").count()
    blocks = F.ceil(F.col("count") / F.lit(4 * params.shard_rows)).cast("bigint")
    return rows.join(sizes.select("shard", blocks.alias("blocks")), "shard").withColumn(
        "blk", F.pmod(F.xxhash64(key), F.col("blocks")))


def _dealt(rows: DataFrame, *order: str) -> DataFrame:
    """Rows by (shard, blk), one group after the other in a task."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "shard", "blk").sortWithinPartitions("shard", "blk", *order)


# --- classes

def classes(x: np.ndarray, params: EmbeddingParams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner row, centre of the owner's class, its radius in radians) of each row of a block."""
    limit = params.angle / 2 - 1e-6
    owner, centres, radius = np.arange(len(x)), x.copy(), np.zeros(len(x))
    left = np.arange(len(x))
    # first around means, with room for members that lie opposite each other; then what is left, closer
    for near in (math.cos(min(1.4 * limit, params.angle)), math.cos(limit)):
        if len(left) < 2:
            break
        _, found = flat_graph.build(x[left].astype(np.float32), params.graph, near)
        group = left[found]
        alone = []
        order = np.argsort(group, kind="stable")
        cuts = np.flatnonzero(np.diff(group[order])) + 1
        for part in np.split(left[order], cuts):
            if len(part) < 2:
                alone.append(part)
                continue
            mean = x[part].sum(axis=0)
            mean /= max(np.linalg.norm(mean), 1e-300)
            far = np.arccos(np.clip(x[part] @ mean, -1, 1))
            kept = part[far <= limit]
            if len(kept) > 1:
                owner[kept], centres[kept[0]], radius[kept[0]] = kept[0], mean, far[far <= limit].max() + _SLACK
                alone.append(part[far > limit])
            else:
                alone.append(part)
        left = np.sort(np.concatenate(alone))
    return owner, centres[owner], radius[owner]


def class_members(nodes: DataFrame, centres: dict[int, np.ndarray], params: EmbeddingParams) -> DataFrame:
    """node, cls, vec, cnt, low per node; on the row of a class's first node also centre, radius, size (nodes), total (rows), lowest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in keyed_tables(batches, 2):
            x = matrix(rows.column("vec"))
            node, cnt, low = (rows.column(c).to_numpy() for c in ("node", "cnt", "low"))
            owner, centre, radius = classes(x, params)
            first = owner == np.arange(len(owner))
            size, total = np.bincount(owner, minlength=len(owner)), np.zeros(len(owner), np.int64)
            lowest = np.full(len(owner), _LAST)
            np.add.at(total, owner, cnt)
            np.minimum.at(lowest, owner, low)
            for lo in range(0, len(owner), 4096):
                s = slice(lo, lo + 4096)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node[s]), pa.array(node[owner[s]]), rows.column("vec").slice(lo, 4096).combine_chunks(),
                     pa.array(cnt[s]), pa.array(low[s]),
                     pa.array([c.tobytes() if f else None for c, f in zip(centre[s], first[s], strict=True)], pa.binary()),
                     pa.array(radius[s]), pa.array(size[s]), pa.array(total[s]), pa.array(lowest[s])],
                    names=["node", "cls", "vec", "cnt", "low", "centre", "radius", "size", "total", "lowest"])

    homes = to_shards(nodes, centres, 1, "vec", "node", "vec", "cnt", "low")
    return written(_dealt(in_blocks(homes, "node", params).select("shard", "blk", "node", "vec", "cnt", "low"), "node").mapInArrow(
        run, "node bigint, cls bigint, vec binary, cnt bigint, low bigint, centre binary, radius double, size bigint, "
             "total bigint, lowest bigint"), "classes")


# --- graph

def adjacency(placed: DataFrame, params: EmbeddingParams) -> DataFrame:
    """cls, next: the united adjacency list of each class from the graphs of its shards."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in keyed_tables(batches, 2):
            ids = rows.column("cls").to_numpy()
            edges, _ = flat_graph.build(matrix(rows.column("centre"), np.float32), params.graph)
            used = (edges >= 0).sum(axis=1)
            flat = ids[edges[edges >= 0]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(used)).astype(np.int32)), pa.array(flat))],
                names=["cls", "next"])

    made = _dealt(placed.select("shard", "blk", "cls", "centre"), "cls").mapInArrow(run, "cls bigint, next array<bigint>")
    return made.groupBy("cls").agg(F.array_distinct(F.flatten(F.collect_list("next"))).alias("next"))


def _search_group(rows: pa.Table, params: EmbeddingParams) -> pa.RecordBatch:
    """Links between classes that the queries of one block find: a, b, whole (all members are linked)."""
    member = np.array(rows.column("member").to_pylist(), bool)
    query = np.array(rows.column("query").to_pylist(), bool)
    ids, radius = rows.column("cls").to_numpy(), rows.column("radius").to_numpy()
    x = matrix(rows.column("centre"))
    place = np.flatnonzero(member)                          # rows of the graph; ids ascend within members
    lists = rows.column("next").to_pylist()
    names = ids[place]
    order = np.argsort(names)
    edges = np.full((len(place), max((len(lists[i] or ()) for i in place.tolist()), default=0) or 1), -1, np.int64)
    for k, i in enumerate(place.tolist()):
        wanted = np.array(lists[i] or [], np.int64)
        at = order[np.minimum(np.searchsorted(names[order], wanted), len(order) - 1)]
        known = at[names[at] == wanted]                     # the others lie in other shards
        edges[k, :len(known)] = known
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if len(place):
        small = x[place].astype(np.float32)
        starts = flat_graph.medoids(small, params.starts)
        widest = radius[place].max()
        own = np.full(len(ids), -1, np.int64)
        own[place] = np.arange(len(place))
        asked = np.flatnonzero(query)
        for lo in range(0, len(asked), 256):
            q = asked[lo:lo + 256]
            reach = np.cos(np.minimum(np.pi, params.angle + radius[q] + widest)) - 1e-5
            _, _, (a, b, _) = flat_graph.search(small, edges, starts, x[q].astype(np.float32), params.graph, own[q],
                                                reach.astype(np.float32))
            i, j = q[a], place[b]
            i, j = i[ids[i] != ids[j]], j[ids[i] != ids[j]]
            cosine = np.einsum("ij,ij->i", x[i], x[j])
            both = radius[i] + radius[j]
            angle = np.arccos(np.clip(cosine, -1, 1))
            whole = np.where(both > 0, angle + both <= params.angle - _SLACK, cosine >= params.cosine)
            some = whole | ((both > 0) & (angle - both <= params.angle + _SLACK))
            out.append((ids[i][some], ids[j][some], whole[some]))
    a, b, whole = (np.concatenate(v) for v in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 2 + (np.zeros(0, bool),)
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(whole)], names=["a", "b", "whole"])


def class_links(heads: DataFrame, centres: dict[int, np.ndarray], params: EmbeddingParams) -> DataFrame:
    """a < b, whole: pairs of classes that are linked as a whole, or whose members must be compared."""
    placed = written(in_blocks(to_shards(heads, centres, params.replicas, "centre", "cls", "centre", "radius"), "cls", params), "shards")
    lists = written(adjacency(placed, params), "adjacency")
    full = placed.join(lists, "cls", "left")
    here = full.select("shard", "blk", "cls", "centre", "radius", "next", F.lit(True).alias("member"), (F.col("nth") == 0).alias("query"))
    visits = (placed.where("nth = 0 AND blocks > 1").withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
              .where("other != blk")
              .select("shard", F.col("other").alias("blk"), "cls", "centre", "radius", F.lit(None).cast("array<bigint>").alias("next"),
                      F.lit(False).alias("member"), F.lit(True).alias("query")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in keyed_tables(batches, 2):
            yield _search_group(rows, params)

    found = _dealt(here.unionByName(visits), "cls").mapInArrow(run, "a bigint, b bigint, whole boolean")
    return written(found.groupBy("a", "b").agg(F.max("whole").alias("whole")), "class-links")


def member_links(pairs: DataFrame, members: DataFrame, params: EmbeddingParams) -> DataFrame:
    """a, b, node, n: for pairs of classes, the links of each member to the other class's members (rows), by comparing blocks of them."""
    sizes = members.where("centre IS NOT NULL").select("cls", F.ceil(F.col("size") / params.member_block).cast("bigint").alias("blocks"))
    sized = (pairs.join(sizes.select(F.col("cls").alias("a"), F.col("blocks").alias("blocks_a")), "a")
             .join(sizes.select(F.col("cls").alias("b"), F.col("blocks").alias("blocks_b")), "b"))
    sides = []
    for side, other in (("a", "b"), ("b", "a")):
        rows = sized.join(members.select(F.col("cls").alias(side), "node", "vec", "cnt"), side)
        own = F.pmod(F.xxhash64("node"), F.col(f"blocks_{side}"))
        rows = rows.withColumn("mine", own).withColumn("theirs", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(f"blocks_{other}") - 1)))
        cell = F.col("mine") * F.lit(1 << 31) + F.col("theirs") if side == "a" else F.col("theirs") * F.lit(1 << 31) + F.col("mine")
        sides.append(rows.select("a", "b", cell.alias("cell"), F.lit(side == "a").alias("left"), "node", "vec", "cnt"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in keyed_tables(batches, 3):
            left = np.array(rows.column("left").to_pylist(), bool)
            x, node, cnt = matrix(rows.column("vec")), rows.column("node").to_numpy(), rows.column("cnt").to_numpy()
            linked = x[left] @ x[~left].T >= params.cosine
            n = np.append(linked @ cnt[~left], linked.T @ cnt[left])
            node = np.append(node[left], node[~left])[n > 0]
            a, b = rows.column("a")[0].as_py(), rows.column("b")[0].as_py()
            yield pa.RecordBatch.from_arrays([pa.array([a] * len(node), pa.int64()), pa.array([b] * len(node), pa.int64()),
                                              pa.array(node), pa.array(n[n > 0])], names=["a", "b", "node", "n"])

    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (sides[0].unionByName(sides[1]).repartition(parts, "a", "b", "cell").sortWithinPartitions("a", "b", "cell")
            .mapInArrow(run, "a bigint, b bigint, node bigint, n bigint"))


def node_links(nodes: DataFrame, params: EmbeddingParams) -> DataFrame:
    """node, n_links (other rows linked), component (smallest id reachable) per node."""
    centres = fit_centres(nodes, params)
    members = class_members(nodes, centres, params)
    heads = members.where("centre IS NOT NULL").select("cls", "centre", "radius", "total", "lowest")
    links = class_links(heads, centres, params)
    fine = written(member_links(links.where("NOT whole").select("a", "b"), members, params), "member-links")
    whole = links.where("whole").select("a", "b")
    both = whole.union(whole.select("b", "a"))
    counted = both.join(heads.select(F.col("cls").alias("b"), "total"), "b").groupBy("a").agg(F.sum("total").alias("whole_n"))
    extra = fine.groupBy("node").agg(F.sum("n").alias("fine_n"))
    groups = components(whole.union(fine.select("a", "b").distinct()))
    lowest = (groups.join(heads.select(F.col("cls").alias("node"), "lowest"), "node").groupBy("label")
              .agg(F.min("lowest").alias("component")))
    of_class = (heads.select("cls", F.col("total"), "lowest").join(counted.withColumnRenamed("a", "cls"), "cls", "left")
                .join(groups.join(lowest, "label").select(F.col("node").alias("cls"), "component"), "cls", "left")
                .select("cls", (F.col("total") - 1 + F.coalesce("whole_n", F.lit(0))).alias("class_n"),
                        F.coalesce("component", "lowest").alias("component")))
    return written(members.select("node", "cls").join(of_class, "cls").join(extra, "node", "left").select(
        "node", (F.col("class_n") + F.coalesce("fine_n", F.lit(0))).alias("n_links"), "component"), "node-links")


# --- recall

def audited_recall(nodes: DataFrame, found: DataFrame, params: EmbeddingParams) -> tuple[int, int]:
    """(links found, links there are) of about ``audit`` nodes that are compared with all nodes exactly."""
    spark = nodes.sparkSession
    n = nodes.count()
    asked = (nodes.where(F.pmod(F.xxhash64(F.lit(7), "digest"), F.lit(max(1, n // max(1, params.audit)))) == 0)
             .limit(4 * params.audit).select("node", "vec").collect())
    if not asked:
        return 0, 0
    by_dim: dict[int, list] = {}
    for r in asked:
        by_dim.setdefault(len(r["vec"]) // 8, []).append(r)
    queries = spark.sparkContext.broadcast({
        d: (np.array([r["node"] for r in v]), np.frombuffer(b"".join(bytes(r["vec"]) for r in v), np.float64).reshape(len(v), d))
        for d, v in by_dim.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, values = batch.column(2).to_numpy(), batch.column(0).to_pylist()
            for d, (ids, q) in queries.value.items():
                here = np.flatnonzero(dims == d)
                if len(here):
                    x = np.frombuffer(b"".join(values[i] for i in here.tolist()), np.float64).reshape(len(here), d)
                    n_links = (q @ x.T >= params.cosine) @ batch.column(1).to_numpy()[here]
                    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n_links.astype(np.int64))], names=["node", "n"])

    there = nodes.select("vec", "cnt", "dim").mapInArrow(run, "node bigint, n bigint").groupBy("node").agg(
        (F.sum("n") - 1).alias("there"))                        # without the vector itself
    r = there.join(found, "node").agg(F.sum(F.least("n_links", "there")).alias("found"), F.sum("there").alias("there")).first()
    return int(r["found"] or 0), int(r["there"] or 0)


def linked_vectors(vectors: DataFrame, params: EmbeddingParams = EmbeddingParams()) -> DataFrame:
    """vec_id, n_links, component_id, kept (the vector is its component's smallest) per row of ``vectors``."""
    bounded_batches(vectors.sparkSession)
    rows = written(unit_rows(vectors), "unit-vectors")
    nodes = node_table(rows)
    for _ in range(3):
        found = node_links(nodes, params)
        right, there = audited_recall(nodes, found, params)
        if right >= params.min_recall * there:
            break
        params = replace(params, replicas=params.replicas + 1, graph=replace(params.graph, width=2 * params.graph.width))
    known = nodes.select("digest", "node").join(found, "node").drop("node")
    out = rows.select("__at", "digest").join(known, "digest", "left").select(
        "__at", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("component", "__at").alias("component"))

    def id_of(name: str):
        return F.when(F.col(name) != _LAST, F.col(name))
    return out.select(id_of("__at").alias("vec_id"), "n_links", id_of("component").alias("component_id"),
                      (F.col("__at") == F.col("component")).alias("kept"))
