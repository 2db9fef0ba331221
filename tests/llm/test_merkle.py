"""Merkle manifest: layout, brute force, edge cases."""

import zlib
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadence.llm import merkle
from cadence.llm.queries import QUERIES
from tests.llm.fixtures import SF, SCHEMA, corpus


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    parts = ["-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}"
             for c in merkle.COLUMNS]
    return h(*parts)


def levels(nodes):
    out = [nodes]
    while len(nodes) > 1:
        nodes = [h(*nodes[i:i + 2]) for i in range(0, len(nodes), 2)]
        out.append(nodes)
    return out


def siblings(tree, i):
    out = []
    for nodes in tree[:-1]:
        out.append((i & 1, nodes[i ^ 1] if i ^ 1 < len(nodes) else None))
        i >>= 1
    return out


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    trees = {g: levels([leaf(r) for r in groups[g]]) for g in order}
    forest = levels([trees[g][-1][0] for g in order])
    root, out = forest[-1][0], []
    for n, g in enumerate(order):
        for i, r in enumerate(groups[g]):
            path = siblings(trees[g], i) + siblings(forest, n)
            claim = dict(r)
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            if hit and r["n_chars"] is not None:
                claim["n_chars"] += 1
            now = leaf(claim)
            for odd, s in path:
                now = h(now) if s is None else h(s, now) if odd else h(now, s)
            out.append((r["doc_id"], leaf(r), trees[g][-1][0], root,
                        h(*[s for _, s in path if s]), now, now == root))
    return sorted(out, key=str)


def run(df, block_levels=merkle.BLOCK_LEVELS):
    found = merkle.manifest(df, merkle.tampered(df), block_levels=block_levels)
    return sorted((tuple(r) for r in found.collect()), key=str)


@pytest.mark.parametrize("n", range(1, 9))
def test_addresses_are_a_layout(n):
    """Every node has a place of its own, and aligned subtrees at half height
    lie together."""
    places = [merkle.address(d, np.arange(1 << d), n) for d in range(n)]
    assert sorted(np.concatenate(places)) == list(range((1 << n) - 1))
    assert places[0][0] == 0
    upper, lower = n // 2, n - n // 2
    if n > 1:
        for subtree in range(1 << upper):
            inside = np.concatenate([p[subtree << k:(subtree + 1) << k]
                                     for k, p in enumerate(places[upper:])])
            start = (1 << upper) - 1 + subtree * ((1 << lower) - 1)
            assert sorted(inside) == list(range(start, start + (1 << lower) - 1))


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8])
def test_blocks_hold_the_tree(n):
    digests = [sha256(bytes([i])).digest() for i in range(n)]
    height = (n - 1).bit_length()
    nodes = merkle.build_block(digests, height)
    tree = levels([d.hex() for d in digests])
    assert nodes[:32].hex() == tree[-1][0]
    for i, path in enumerate(merkle.block_paths(nodes, n, height, np.arange(n))):
        found = [(path[k] == 1, path[k + 1:k + 33].hex() if path[k] else None)
                 for k in range(0, len(path), 33)]
        assert [s for _, s in found] == [s for _, s in siblings(tree, i)]
        assert merkle.fold(digests[i], path)[0] == tree[-1][0]


def test_query(spark):
    rows = [r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = sorted((tuple(r) for r in QUERIES["op11_merkle_manifest"](spark, SF).collect()),
                   key=str)
    assert found == brute(rows)


@pytest.mark.parametrize("block_levels", [1, 2])
def test_layers_of_blocks(spark, block_levels):
    df = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60")
    assert run(df, block_levels) == brute([r.asDict() for r in df.collect()])


def test_edges(spark):
    """NULLs in any column, repeated rows, equal keys, a lone row in a group,
    long texts, columns named as the operator's own."""
    rows = []
    for i, text in enumerate(corpus(n=10)):
        lang = [None, "en", "fr", "zz", "é"][i % 5]
        rows.append((i, text, lang, None if i % 4 == 0 else "s", None if i % 3 == 0 else i,
                     "x", "y", "z"))
    rows += [rows[3], rows[3], (3, "other", rows[3][2], "s", 7, "x", "y", "z"),
             (None, "no key", "en", "s", 1, "x", "y", "z"), (99, "alone", "solo", "s", 2, "a", "b", "c")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("tree", F.lit(1)).withColumn(
        "digest", F.lit("d")).withColumn("grp", F.lit("g"))
    assert run(df) == brute([r.asDict() for r in df.collect()])
    assert run(df, 1) == run(df)


def test_one_row_and_none(spark):
    one = spark.createDataFrame([(5, "t", None, None, 1, "", "", "")], SCHEMA)
    (row,) = run(one)
    assert row[1] == row[2] == row[3] and row[4] == sha256(b"").hexdigest()
    assert run(spark.createDataFrame([], SCHEMA)) == []
