"""The Merkle manifest against a plain-Python version, addresses against a laid-out tree."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from larder.llm import merkle
from larder.llm.common import id_remainder
from tests.llm import edge


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def brute(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) for rows (doc_id, source, lang, n_chars, text)."""
    def leaf(r, text):
        return sha(*map(field, (*r[:4], text)))

    trees = {}
    for r in rows:
        odd = r[0] is None or zlib.crc32(str(r[0]).encode()) % 2
        text = r[4] if odd or r[4] is None else r[4].replace("\n", "")
        trees.setdefault(r[1], []).append((edge.order_of(r[0]), leaf(r, r[4]), r[0], leaf(r, text)))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([sha(*out[-1][i:i + 3]) for i in range(0, len(out[-1]), 3)])
        return out

    def siblings(tree, at):
        for level in tree[:-1]:
            lo = at - at % 3
            run = level[lo:lo + 3]
            yield run[:at - lo], run[at - lo + 1:]
            at //= 3

    built = {s: levels([x[1] for x in sorted(trees[s])]) for s in order}
    top = levels([built[s][-1][0] for s in order])
    out = []
    for n, s in enumerate(order):
        for at, (_, own, doc_id, changed) in enumerate(sorted(trees[s])):
            way = [*siblings(built[s], at), *siblings(top, n)]
            folded = changed
            for left, right in way:
                folded = sha(*left, folded, *right)
            out.append((doc_id, own, built[s][-1][0], top[-1][0], sha(*(h for a, b in way for h in a + b)), folded,
                        folded == top[-1][0]))
    return out


def found(docs, params=merkle.MerkleParams()):
    rows = merkle.verified_manifest(docs, id_remainder(F.col("doc_id"), 2) == 0, params).collect()
    return sorted((tuple(r) for r in rows), key=str)


@pytest.mark.parametrize("levels", range(1, 9))
def test_addresses_lay_out_each_subtree_together(levels):
    places = merkle.addresses(levels - 1)
    assert sorted(a for level in places for a in level.tolist()) == list(range(merkle.tree_size(levels)))

    def layout(levels, depth, index):
        if levels == 1:
            return [(depth, index)]
        upper = levels // 2
        out = layout(upper, depth, index)
        for i in range(3 ** upper):
            out += layout(levels - upper, depth + upper, index * 3 ** upper + i)
        return out

    assert [int(places[d][i]) for d, i in layout(levels, 0, 0)] == list(range(merkle.tree_size(levels)))


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 26, 27])
def test_block_and_paths(n):
    leaves = [hashlib.sha256(bytes([i])).digest() for i in range(n)]
    height = merkle.block_height(n, 7)
    nodes = merkle.build_block(leaves, height)
    level = [x.hex() for x in leaves]
    while len(level) > 1:
        level = [sha(*level[i:i + 3]) for i in range(0, len(level), 3)]
    assert nodes[:32].hex() == level[0]
    assert [merkle.fold(x.hex(), p) for x, p in zip(leaves, merkle.sibling_paths(nodes, height, n), strict=True)] == level * n
    assert merkle.fold("00" * 32, merkle.sibling_paths(nodes, height, n)[-1]) != level[0]


@pytest.mark.parametrize("height", [1, 2, 7])
def test_edges_with_blocks_of_every_size(spark, height):
    docs = edge.documents(spark)
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()]
    got = found(docs, merkle.MerkleParams(height))
    assert got == sorted(brute(rows), key=str)
    assert {r[6] for r in got} == {True, False}


def test_many_tiers_and_a_hot_source(spark):
    rows = [(i * 7 % 1009, f"t {i}\n" * (i % 3), None if i % 3 == 0 else f"s{i % 11}é") for i in range(700)]
    docs = edge.documents(spark, rows)
    want = brute([(i, s, "en" if s else None, len(t), t) for i, t, s in rows])
    assert found(docs, merkle.MerkleParams(2)) == sorted(want, key=str)
    assert found(docs.repartition(13), merkle.MerkleParams(1)) == sorted(want, key=str)
    sources = [(i, "x", f"s{i}") for i in range(100)]
    want = brute([(i, s, "en", 1, t) for i, t, s in sources])
    assert found(edge.documents(spark, sources), merkle.MerkleParams(2)) == sorted(want, key=str)


def test_paths_prove_single_documents(spark):
    manifest = merkle.build_manifest(edge.documents(spark), params=merkle.MerkleParams(2))
    rows = merkle.proofs(manifest).collect()
    assert all(r["verified"] and merkle.fold(r["leaf"], r["path"]) == manifest.root for r in rows)
    assert all(merkle.fold(sha("other"), r["path"]) != manifest.root for r in rows)


def test_empty_and_single(spark):
    assert found(edge.documents(spark, [])) == []
    assert found(edge.documents(spark, [(4, "a\nb", "s")])) == brute([(4, "s", "en", 3, "a\nb")])
