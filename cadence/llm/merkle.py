"""Merkle manifest of a dataset in van Emde Boas layout.

Every row is a leaf; the leaves of a group (``lang``), ascending by key, form
a binary hash tree, and the groups' roots form another above them.  A lone
node at the end of a level becomes the hash of itself.

A tree is kept as aligned subtrees of ``2**BLOCK_LEVELS`` leaves.  A subtree
is one row of a stored table: its digests in one binary value, laid out
recursively.  A tree of ``n`` levels is split at half height; its top half
comes first, then each bottom subtree, all laid out the same way, so a path
touches few places at any granularity.  ``address`` is the arithmetic of that
order; construction and sibling retrieval both use it.  Block roots are the
leaves of the next layer, until a group has one block.

Rows are numbered in their group by a prefix scan, so a group that holds a
third of all rows is spread over its blocks, and a task holds one block of
digests and one of leaves, never a text.
"""

from __future__ import annotations

import binascii
from collections.abc import Sequence
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import col, materialise, ship
from cadence.operators.prefix import row_numbers

BLOCK_LEVELS = 12       # 4096 leaves a block
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

_BLOCKS = "tree long, block long, n long, top boolean, nodes binary"


# ------------------------------------------------------------------ the layout
def address(depth: int, index: np.ndarray, levels: int) -> np.ndarray:
    """Places of the nodes ``index`` of the level ``depth`` (the root's is 0)
    in a complete tree of ``levels`` levels."""
    index = np.asarray(index, dtype=np.int64)
    place = np.zeros_like(index)
    while levels > 1:
        upper = levels // 2
        lower = levels - upper
        if depth < upper:
            levels = upper
            continue
        depth -= upper
        place += (1 << upper) - 1 + (index >> depth) * ((1 << lower) - 1)
        index = index & ((1 << depth) - 1)
        levels = lower
    return place


def _height(n: int, top: bool, block_levels: int) -> int:
    """Levels above the leaves: a block below others always has all of them."""
    return (n - 1).bit_length() if top else block_levels


def build_block(leaves: Sequence[bytes], height: int) -> bytes:
    """The digests of one subtree, in the layout; places of absent nodes are
    zero."""
    nodes = np.zeros(((2 << height) - 1, 32), dtype=np.uint8)
    level = list(leaves)
    for depth in range(height, -1, -1):
        nodes[address(depth, np.arange(len(level)), height + 1)] = np.frombuffer(
            b"".join(level), dtype=np.uint8).reshape(-1, 32)
        hexed = [x.hex().encode() for x in level]
        level = [sha256(b"".join(hexed[i:i + 2])).digest() for i in range(0, len(hexed), 2)]
    return nodes.tobytes()


def block_paths(nodes: bytes, n: int, height: int, index: np.ndarray) -> list[bytes]:
    """For every leaf ``index`` the siblings up to the block's root: a record
    of 33 bytes a level, 0 (no sibling), 1 (it is left) or 2 (right) and its
    digest."""
    stored = np.frombuffer(nodes, dtype=np.uint8).reshape(-1, 32)
    out = np.zeros((len(index), height, 33), dtype=np.uint8)
    present, at = n, np.asarray(index, dtype=np.int64)
    for k in range(height):
        sibling = at ^ 1
        there = sibling < present
        places = address(height - k, np.where(there, sibling, at), height + 1)
        out[:, k, 0] = np.where(there, np.where(at & 1, 1, 2), 0)
        out[:, k, 1:] = np.where(there[:, None], stored[places], 0)
        at, present = at >> 1, (present + 1) >> 1
    return [row.tobytes() for row in out]


def fold(leaf: bytes, path: bytes) -> tuple[str, str]:
    """Root of a leaf's digest along a path, and the hash of the path's
    siblings."""
    now, siblings = leaf.hex().encode(), []
    for i in range(0, len(path), 33):
        side = path[i]
        if not side:
            now = sha256(now).hexdigest().encode()
            continue
        other = binascii.hexlify(path[i + 1:i + 33])
        siblings.append(other)
        now = sha256(other + now if side == 1 else now + other).hexdigest().encode()
    return now.decode(), sha256(b"".join(siblings)).hexdigest()


# ---------------------------------------------------------------- construction
@dataclass(frozen=True)
class Trees:
    """``layers[0]`` holds the blocks over the leaves, the next the blocks over
    their roots; ``roots`` is ``tree, root``."""
    layers: tuple[DataFrame, ...]
    roots: DataFrame
    block_levels: int


def _block_of(levels: int) -> Column:
    return F.shiftright(F.col("idx"), levels)


def build(leaves: DataFrame, block_levels: int = BLOCK_LEVELS) -> Trees:
    """Trees over rows ``tree, idx, total, digest``: the leaf's tree, its
    number from 0, the tree's leaves and the digest (32 bytes)."""
    ship(__name__)

    def blocks(group: pa.Table) -> pa.Table:
        group = group.sort_by("idx")
        top = group["total"][0].as_py() <= 1 << block_levels
        height = _height(len(group), top, block_levels)
        nodes = build_block(group["digest"].to_pylist(), height)
        return pa.table({"tree": [group["tree"][0].as_py()], "block": [group["block"][0].as_py()],
                         "n": [len(group)], "top": [top], "nodes": [nodes]})

    layers, roots = [], None
    while True:
        layer = materialise(leaves.withColumn("block", _block_of(block_levels))
                            .select("tree", "block", "idx", "total", "digest")
                            .groupBy("tree", "block").applyInArrow(blocks, _BLOCKS))
        layers.append(layer)
        ends = layer.select("tree", "block", "top", F.substring("nodes", 1, 32).alias("digest"))
        done = ends.where("top").select("tree", F.col("digest").alias("root"))
        roots = done if roots is None else roots.unionByName(done)
        rest = ends.where("not top")
        if rest.isEmpty():
            return Trees(tuple(layers), materialise(roots), block_levels)
        totals = rest.groupBy("tree").agg(F.count("*").alias("total"))
        leaves = rest.join(totals, "tree").select(
            "tree", F.col("block").alias("idx"), "total", "digest")


# ------------------------------------------------------------------- retrieval
def _with_paths(rows: DataFrame, layer: DataFrame, upper: DataFrame, block_levels: int
                ) -> DataFrame:
    """Paths ``tree, idx, path`` of rows ``tree, idx`` of a layer: inside their
    block, then the block's own path ``tree, idx, path`` in ``upper``."""
    ship(__name__)
    above = upper.select("tree", F.col("idx").alias("block"), F.col("path").alias("above"))
    blocks = layer.join(above, ["tree", "block"], "left")

    def paths(group: pa.Table, block: pa.Table) -> pa.Table:
        idx = group["idx"].to_numpy()
        b = block.to_pylist()[0]
        inside = block_paths(b["nodes"], b["n"], _height(b["n"], b["top"], block_levels),
                             idx & ((1 << block_levels) - 1))
        above = b["above"] or b""
        return pa.table({"tree": group["tree"], "idx": group["idx"],
                         "path": pa.array([p + above for p in inside], pa.binary())})

    return (rows.withColumn("block", _block_of(block_levels)).groupBy("tree", "block")
            .cogroup(blocks.groupBy("tree", "block"))
            .applyInArrow(paths, "tree long, idx long, path binary"))


def top_paths(trees: Trees, above: DataFrame | None = None) -> DataFrame:
    """``tree, idx, path`` of the blocks over the leaves, from the blocks' roots
    to the trees' roots, and on by ``above`` (``tree, path``)."""
    spark = trees.roots.sparkSession
    found = spark.createDataFrame([], "tree long, idx long, path binary")
    for n in range(len(trees.layers) - 1, -1, -1):
        layer = trees.layers[n]
        roots = layer.where("top").select("tree", F.col("block").alias("idx"))
        # a tree's last block is its own top
        own = (roots.join(above, "tree", "left") if above is not None
               else roots.withColumn("path", F.lit(None).cast("binary")))
        inner = layer.where("not top").select("tree", F.col("block").alias("idx"))
        if n + 1 < len(trees.layers):
            inner = _with_paths(inner, trees.layers[n + 1], found, trees.block_levels)
            own = own.unionByName(inner)
        found = materialise(own.select("tree", "idx", "path"))
    return found


def prove(leaves: DataFrame, trees: Trees, upper: DataFrame) -> DataFrame:
    """``key, leaf, subroot, proof_sha256, folded_root`` of rows ``tree, idx,
    key, digest, claimed``: ``claimed`` folded along the stored siblings."""
    ship(__name__)
    block_levels = trees.block_levels
    blocks = trees.layers[0].join(upper.select("tree", F.col("idx").alias("block"),
                                               F.col("path").alias("above")), ["tree", "block"])
    blocks = blocks.join(trees.roots.select("tree", F.col("root").alias("subroot")), "tree")

    def proofs(group: pa.Table, block: pa.Table) -> pa.Table:
        b = block.to_pylist()[0]
        inside = block_paths(b["nodes"], b["n"], _height(b["n"], b["top"], block_levels),
                             group["idx"].to_numpy() & ((1 << block_levels) - 1))
        above = b["above"] or b""
        folded = [fold(c, p + above) for c, p in zip(group["claimed"].to_pylist(), inside)]
        digests = group["digest"].to_pylist()
        return pa.table({"key": group["key"], "leaf": [d.hex() for d in digests],
                         "subroot": [b["subroot"].hex()] * len(digests),
                         "proof_sha256": [p for _, p in folded],
                         "folded_root": [r for r, _ in folded]})

    kind = leaves.schema["key"].dataType.simpleString()
    return (leaves.withColumn("block", _block_of(block_levels)).groupBy("tree", "block")
            .cogroup(blocks.groupBy("tree", "block"))
            .applyInArrow(proofs, f"key {kind}, leaf string, subroot string, "
                                  "proof_sha256 string, folded_root string"))


# -------------------------------------------------------------------- manifest
def _part(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(docs: DataFrame, columns: Sequence[str], **changed: Column) -> Column:
    """Digest of a row: byte count, ``:`` and value of every column, ``-`` for
    NULL, concatenated."""
    parts = [_part(changed.get(c, col(c))) for c in columns]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def manifest(docs: DataFrame, claimed: Column | None = None, key: str = "doc_id",
             group: str = "lang", columns: Sequence[str] = COLUMNS,
             block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """One row per row of ``docs``: ``key, leaf, subroot, root, proof_sha256,
    folded_root, verified``.  ``claimed`` is the digest (32 bytes) a holder of
    the row presents, the row's own by default; ``folded_root`` follows from it
    and the stored siblings.

    Other columns than ``columns`` are not committed to.  Rows of a group are
    ordered by key (NULL first), equal keys by digest; equal rows are leaves
    of their own, interchangeable.  A NULL group comes first, the others by
    UTF-8 bytes.  A group of one row has its leaf as root.  An empty table
    gives an empty result."""
    digest = leaf_digest(docs, columns)
    rows = materialise(docs.select(
        col(key).alias("key"), col(group).cast("string").alias("grp"), digest.alias("digest"),
        (digest if claimed is None else claimed).alias("claimed"),
        F.monotonically_increasing_id().alias("rid")))
    groups = rows.groupBy("grp").agg(F.count("*").alias("total"))
    groups = groups.withColumn("known", F.col("grp").isNotNull())
    # trees are numbered in the order of their groups
    trees = materialise(row_numbers(groups, ["known", "grp"], name="tree").drop("known"))
    numbered = row_numbers(rows, ["key", "digest", "rid"], by=["grp"], name="row")
    leaves = materialise(numbered.alias("l").join(
        trees.alias("t"), F.col("l.grp").eqNullSafe(F.col("t.grp"))).select(
        "tree", (F.col("row") - 1).alias("idx"), "total", "key", "digest", "claimed"))
    below = build(leaves.select("tree", "idx", "total", "digest"), block_levels)
    forest_leaves = below.roots.select(
        F.lit(0).cast("long").alias("tree"), (F.col("tree") - 1).alias("idx"),
        F.lit(trees.count()).cast("long").alias("total"), F.col("root").alias("digest"))
    forest = build(forest_leaves, block_levels)
    subroot_paths = materialise(_with_paths(
        forest_leaves.select("tree", "idx"), forest.layers[0], top_paths(forest), block_levels)
        .select((F.col("idx") + 1).alias("tree"), "path"))
    found = prove(leaves.select("tree", "idx", "key", "digest", "claimed"), below,
                  top_paths(below, subroot_paths))
    top = forest.roots.first()      # one digest
    root = F.lit(bytes(top["root"]).hex() if top else None)
    return found.select(
        F.col("key").alias(key), "leaf", "subroot", root.alias("root"), "proof_sha256",
        "folded_root", (F.col("folded_root") == root).alias("verified"))


def tampered(docs: DataFrame, key: str = "doc_id", number: str = "n_chars", divisor: int = 7,
             columns: Sequence[str] = COLUMNS) -> Column:
    """The digest of a row whose ``number`` is one larger, for rows whose
    key's CRC-32 (decimal text) ``divisor`` divides; else its own.  A NULL
    number stays NULL, a NULL key is left alone."""
    hit = F.crc32(col(key).cast("string").cast("binary")) % divisor == 0
    more = (col(number).cast("decimal(20,0)") + 1).cast("string")
    return F.when(hit, leaf_digest(docs, columns, **{number: more})).otherwise(
        leaf_digest(docs, columns))
