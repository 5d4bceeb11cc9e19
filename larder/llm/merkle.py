"""Merkle manifest of a table of documents, stored in van Emde Boas order.

Every document is a leaf: the SHA-256 of its fields. The leaves of a source, in order of
``doc_id``, form a tree in which every ``ARITY`` consecutive nodes of a level have one
parent (the last run of a level may be shorter, even one node); the roots of the sources,
in order of the source, form one more tree of the same shape.

1. Leaves are hashed JVM-side, sorted by range and numbered: partition counts give every
   partition its first number, so no task sees more than its range.
2. A tree is cut into aligned blocks of ``ARITY ** height`` leaves. One task builds a block
   at a time: its nodes lie in one array in van Emde Boas order (the upper half of the
   levels, then each subtree below it, each laid out the same way), and ``addresses``
   computes where a node lies. The roots of the blocks are the leaves of the next tier,
   until a tree has one block. A source with a third of all rows is many blocks.
3. Proofs come top-down: a block's own siblings, read by the same addresses, followed by
   the path of its root. Only one path per block travels between tiers.

``build_manifest`` writes the blocks; ``proofs`` reads them. What the driver receives is
one count per partition and the root.

Nulls, edges: a NULL field is hashed as ``-``, an empty one as ``0:``. NULL ``doc_id`` sorts
last in its source and counts as not tampered; a NULL source sorts first. Equal ids are
ordered by their leaf, exact repeats are leaves of their own. A source with one document has
that leaf as its root. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from larder.llm.common import bounded_batches, keyed_tables, written

ARITY = 3
_DIGEST = 32
_ROW_BITS = 33          # bits below the partition number in monotonically_increasing_id


@dataclass(frozen=True)
class MerkleParams:
    """``height``: levels above the leaves in one block (3 ** 7 = 2187 leaves, 105 KB of digests)."""
    height: int = 7


# --- van Emde Boas order

def tree_size(levels: int) -> int:
    """Nodes of a complete tree with this many levels."""
    return (ARITY ** levels - 1) // (ARITY - 1)


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Place of the nodes ``index`` of a level (0: the root) in a complete tree of ``levels`` levels.

    The tree is split at half its height: the upper subtree comes first, then the lower
    ones from left to right, each in the same order.
    """
    index = np.asarray(index, np.int64)
    at = np.zeros_like(index)
    while levels > 1:
        upper = levels // 2
        if depth < upper:
            levels = upper
            continue
        depth -= upper
        below = levels - upper
        subtree, index = np.divmod(index, ARITY ** depth)
        at += tree_size(upper) + subtree * tree_size(below)
        levels = below
    return at


@lru_cache(maxsize=64)
def addresses(height: int) -> list[np.ndarray]:
    """For a block of this height the places of all nodes of each depth, 0 (root) to ``height`` (leaves)."""
    return [address(height + 1, d, np.arange(ARITY ** d)) for d in range(height + 1)]


def block_height(n_leaves: int, limit: int) -> int:
    """Height of the blocks of a tree with so many leaves: ``limit``, or less for a tree of one block."""
    height = 0
    while height < limit and ARITY ** height < n_leaves:
        height += 1
    return height


def build_block(leaves: list[bytes], height: int) -> bytes:
    """The nodes of a block in van Emde Boas order; places without a node hold zeros."""
    places = addresses(height)
    out = np.zeros((tree_size(height + 1), _DIGEST), np.uint8)
    level = leaves
    for depth in range(height, -1, -1):
        out[places[depth][:len(level)]] = np.frombuffer(b"".join(level), np.uint8).reshape(-1, _DIGEST)
        if depth:
            level = [hashlib.sha256(b"".join(level[i:i + ARITY]).hex().encode()).digest()
                     for i in range(0, len(level), ARITY)]
    return out.tobytes()


def sibling_paths(nodes: bytes, height: int, n_leaves: int) -> list[bytes]:
    """Per leaf the path in its block: for each level the node's place in its run, the number of siblings, the siblings."""
    places = addresses(height)
    counts = [n_leaves]
    for _ in range(height):
        counts.append(-(-counts[-1] // ARITY))

    @lru_cache(maxsize=None)
    def from_level(up: int, index: int) -> bytes:
        """The path of node ``index`` of the level ``up`` levels above the leaves."""
        if up == height:
            return b""
        first = index - index % ARITY
        run = range(first, min(first + ARITY, counts[up]))
        where = places[height - up]
        own = b"".join(nodes[at:at + _DIGEST] for at in (int(where[i]) * _DIGEST for i in run if i != index))
        return bytes([index - first, len(run) - 1]) + own + from_level(up + 1, index // ARITY)

    return [from_level(0, i) for i in range(n_leaves)]


def steps(path: bytes) -> Iterator[tuple[int, list[str]]]:
    """(place in the run, hex siblings) of each level of a path."""
    at = 0
    while at < len(path):
        place, n = path[at], path[at + 1]
        yield place, [path[i:i + _DIGEST].hex() for i in range(at + 2, at + 2 + n * _DIGEST, _DIGEST)]
        at += 2 + n * _DIGEST


def fold(leaf: str, path: bytes) -> str:
    """The digest that a leaf and its siblings lead to."""
    for place, siblings in steps(path):
        leaf = hashlib.sha256("".join([*siblings[:place], leaf, *siblings[place:]]).encode()).hexdigest()
    return leaf


# --- leaves

def _field(column: Column) -> Column:
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(text: Column) -> Column:
    """Binary digest of a document's fields, with ``text`` in place of its text."""
    fields = [_field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")]
    return F.unhex(F.sha2(F.concat(*fields, _field(text)), 256))


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """Rows with ``pos``, their number in the given order, and ``part``, the range they were sorted in."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    made = written(ordered.withColumn("mid", F.monotonically_increasing_id()), "merkle-sorted")
    made = made.withColumn("part", F.shiftright("mid", _ROW_BITS))
    counts = made.groupBy("part").count().orderBy("part").collect()        # one row per partition
    first, starts = 0, []
    for r in counts:
        starts.append((r["part"], first - (r["part"] << _ROW_BITS)))
        first += r["count"]
    shifts = spark.createDataFrame(starts, "part bigint, shift bigint")
    return made.join(F.broadcast(shifts), "part").withColumn("pos", F.col("mid") + F.col("shift")).drop("mid", "shift")


def leaves_of(docs: DataFrame, tampered: Column) -> DataFrame:
    """tree (number of the source's first leaf), rank, n (leaves of the tree), doc_id, digest, changed per document."""
    cut = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    hashed = written(docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("key"), "doc_id",
        leaf_digest(F.col("text")).alias("digest"),
        F.when(F.coalesce(tampered, F.lit(False)), leaf_digest(cut)).alias("changed"),
        F.coalesce(F.col("doc_id").isNull(), F.lit(False)).alias("no_id")), "merkle-leaves")
    placed = numbered(hashed, "key", "no_id", "doc_id", "digest")
    ranges = written(placed.groupBy("part", "key").agg(F.min("pos").alias("first"), F.count("*").alias("c")), "merkle-ranges")
    trees = ranges.groupBy("key").agg(F.min("first").alias("tree"), F.sum("c").alias("n"))
    # joined by range and key: one key may hold a third of the rows, a range of it can't
    return placed.join(ranges.join(trees, "key").select("part", "key", "tree", "n"), ["part", "key"]).select(
        "tree", (F.col("pos") - F.col("tree")).alias("rank"), "n", "doc_id", "digest", "changed")


# --- blocks

def blocks_of(leaves: DataFrame, params: MerkleParams, *carried: str) -> DataFrame:
    """tree, block, n (leaves of the tree), filled (leaves of the block), nodes, and the carried columns as arrays."""
    width, limit = ARITY ** params.height, params.height
    parts = int(leaves.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = StructType.fromDDL("tree bigint, block bigint, n bigint, filled int, nodes binary")
    for c in carried:
        schema = schema.add(StructField(c, ArrayType(leaves.schema[c].dataType)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in keyed_tables(batches, 2):
            n, size = rows.column("n")[0].as_py(), rows.num_rows
            arrays = [rows.column(c).combine_chunks() for c in carried]
            if size != min(width, n - rows.column("block")[0].as_py() * width):
                raise RuntimeError("leaves of a block are missing")
            yield pa.RecordBatch.from_arrays(
                [pa.array([rows.column("tree")[0].as_py()], pa.int64()), pa.array([rows.column("block")[0].as_py()], pa.int64()),
                 pa.array([n], pa.int64()), pa.array([size], pa.int32()),
                 pa.array([build_block(rows.column("digest").to_pylist(), block_height(n, limit))], pa.binary()),
                 *[pa.ListArray.from_arrays(pa.array([0, size], pa.int32()), a) for a in arrays]],
                names=["tree", "block", "n", "filled", "nodes", *carried])

    dealt = leaves.select("tree", F.expr(f"rank div {width}").alias("block"), "rank", "n", "digest", *carried)
    return dealt.repartition(parts, "tree", "block").sortWithinPartitions("tree", "block", "rank").mapInArrow(run, schema)


def tiers_of(leaves: DataFrame, params: MerkleParams, *carried: str) -> tuple[list[DataFrame], DataFrame]:
    """The written blocks of all trees, tier by tier upwards, and the roots (tree, digest)."""
    width = ARITY ** params.height
    tiers: list[DataFrame] = []
    roots = None
    while True:
        blocks = written(blocks_of(leaves, params, *(carried if not tiers else ())), "merkle-blocks")
        tiers.append(blocks)
        tops = blocks.select("tree", F.col("block").alias("rank"), F.ceil(F.col("n") / width).cast("bigint").alias("n"),
                             F.substring("nodes", 1, _DIGEST).alias("digest"), F.lit(1).alias("one"))   # the root lies first
        done = tops.where("n = 1").select("tree", "digest")
        roots = done if roots is None else roots.unionByName(done)
        leaves = tops.where("n > 1").drop("one")
        if not leaves.limit(1).count():
            return tiers, roots


@dataclass(frozen=True)
class Manifest:
    """The written blocks of the source trees and of the tree over their roots (lowest tier first), and the root."""
    sources: list[DataFrame]
    top: list[DataFrame]
    places: DataFrame                   # tree, rank (in the tree of roots), digest (subroot)
    root: str | None
    params: MerkleParams


def build_manifest(docs: DataFrame, tampered: Column | None = None, params: MerkleParams = MerkleParams()) -> Manifest:
    """Blocks of the table's trees; ``tampered`` marks rows whose text is also hashed without its line feeds."""
    bounded_batches(docs.sparkSession)
    sources, roots = tiers_of(leaves_of(docs, F.lit(False) if tampered is None else tampered), params, "doc_id", "changed")
    ordered = numbered(roots, "tree").select("tree", F.col("pos").alias("rank"), "digest")
    places = written(ordered, "merkle-subroots")
    n = places.count()
    top, last = tiers_of(places.select(F.lit(0).cast("bigint").alias("tree"), "rank", F.lit(n).cast("bigint").alias("n"), "digest"), params)
    found = last.first()
    return Manifest(sources, top, places, bytes(found["digest"]).hex() if found else None, params)


# --- proofs

def _leaf_paths(blocks: DataFrame, above: DataFrame, params: MerkleParams) -> DataFrame:
    """tree, block, path, subroot per leaf of the blocks (``block``: the leaf's number, which is a block one tier down)."""
    width, limit = ARITY ** params.height, params.height

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                own = sibling_paths(r["nodes"], block_height(r["n"], limit), r["filled"])
                first = r["block"] * width
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["tree"]] * len(own), pa.int64()), pa.array(range(first, first + len(own)), pa.int64()),
                     pa.array([p + r["path"] for p in own], pa.binary()), pa.array([r["subroot"]] * len(own), pa.binary())],
                    names=["tree", "block", "path", "subroot"])

    return blocks.select("tree", "block", "n", "filled", "nodes").join(above, ["tree", "block"]).mapInArrow(
        run, "tree bigint, block bigint, path binary, subroot binary")


def _down(tiers: list[DataFrame], above: DataFrame, params: MerkleParams) -> DataFrame:
    """tree, block, path, subroot of the blocks of the lowest tier; ``above`` (tree, path, subroot) leads from a tree's root on."""
    paths = None
    for tier in reversed(tiers):
        ends = tier.where(F.col("n") <= ARITY ** params.height).select("tree", "block").join(above, "tree")
        here = ends if paths is None else ends.unionByName(paths)
        if tier is tiers[0]:
            return here
        paths = written(_leaf_paths(tier, here, params), "merkle-paths")
    raise ValueError("no tiers")


def proofs(manifest: Manifest) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, path per document.

    ``proof_sha256`` is the digest of all siblings on the way to the root, ``folded_root`` what
    the tampered (else original) leaf and the original siblings lead to, ``path`` the siblings.
    """
    params = manifest.params
    spark = manifest.places.sparkSession
    limit, root = params.height, manifest.root
    start = spark.createDataFrame([(0, b"", b"")], "tree bigint, path binary, subroot binary")
    top = _leaf_paths(manifest.top[0], _down(manifest.top, start, params), params)
    above = written(top.select(F.col("block").alias("rank"), "path").join(manifest.places, "rank")
                    .select("tree", "path", F.col("digest").alias("subroot")), "merkle-above")
    lowest = _down(manifest.sources, above, params)
    kind = manifest.sources[0].schema["doc_id"].dataType.elementType
    schema = StructType([StructField("doc_id", kind)])
    for name in ("leaf", "subroot", "root", "proof_sha256", "folded_root"):
        schema = schema.add(name, "string")
    schema = schema.add("verified", "boolean").add("path", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            for i, r in enumerate(batch.select([c for c in batch.schema.names if c != "doc_id"]).to_pylist()):
                height, upper = block_height(r["n"], limit), r["path"]
                rest = "".join(s for _, part in steps(upper) for s in part)
                leaf_places = addresses(height)[height]
                top_hex = r["nodes"][:_DIGEST].hex()
                agreed = fold(top_hex, upper)
                out: list[list] = [[], [], [], [], []]
                for j, own in enumerate(sibling_paths(r["nodes"], height, r["filled"])):
                    at = int(leaf_places[j]) * _DIGEST
                    leaf = r["nodes"][at:at + _DIGEST].hex()
                    proof = "".join(s for _, part in steps(own) for s in part) + rest
                    changed = r["changed"][j]
                    folded = fold(changed.hex() if changed is not None else leaf, own)
                    folded = agreed if folded == top_hex else fold(folded, upper)
                    for values, v in zip(out, (leaf, hashlib.sha256(proof.encode()).hexdigest(), folded, folded == root,
                                               own + upper), strict=True):
                        values.append(v)
                n = len(out[0])
                lo, hi = ids.offsets[i].as_py(), ids.offsets[i + 1].as_py()
                yield pa.RecordBatch.from_arrays(
                    [ids.values.slice(lo, hi - lo), pa.array(out[0], pa.string()), pa.array([r["subroot"].hex()] * n, pa.string()),
                     pa.array([root] * n, pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string()),
                     pa.array(out[3], pa.bool_()), pa.array(out[4], pa.binary())], names=[f.name for f in schema.fields])

    blocks = manifest.sources[0].select("tree", "block", "n", "filled", "nodes", "doc_id", "changed")
    return (blocks.join(lowest, ["tree", "block"])
            .select("n", "filled", "nodes", "path", "subroot", "doc_id", "changed").mapInArrow(run, schema))


def verified_manifest(docs: DataFrame, tampered: Column, params: MerkleParams = MerkleParams()) -> DataFrame:
    """The proofs of all documents, without their paths."""
    return proofs(build_manifest(docs, tampered, params)).drop("path")
