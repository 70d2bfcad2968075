"""Merkle manifest of a table: one tree per group of rows, one over the groups' roots.

Leaves are hashed in the JVM and ranked within their tree: dealt by ranges of (tree, key, leaf),
numbered in their task, and shifted by the counts of the ranges before. A tree is cut into aligned
subtrees of ``2 ** HEIGHT`` leaves. Each is one row of a written table whose ``nodes`` hold its
digests in van Emde Boas order: the upper half of the levels first, then each subtree below it, all
split in the same way down to single nodes. ``address`` computes a node's place in that order, for
construction and for siblings alike. The roots of the subtrees are the leaves of the next tier, until
every tree is one subtree; the trees' roots, in the order of their names, make one more tree.

Proofs go the other way: a subtree is joined with the path of its own root and hands each leaf its
siblings, so a task never holds more than one subtree of a tree, however large the tree.

Defined cases: a null field is hashed as ``-``; rows without a group make a tree of their own, which
comes first; within a tree null keys come first, and rows that share a key are ordered by leaf. Equal
rows are equal leaves and keep their number. A lone leaf is its own root. An empty table gives no
rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirstone.session import fresh_dir
from weirstone.sources.tables import staged

HEIGHT = 8  # levels below the root of a subtree: 256 leaves

# A path is a run of steps from a node to the root: a byte for the sibling's side, then its digest.
NONE, RIGHT, LEFT = 0, 1, 2
STEP = 33


def address(depth: int, index: np.ndarray, levels: int) -> np.ndarray:
    """Places of the nodes ``index`` at ``depth`` in a complete tree of ``levels`` levels."""
    index = np.asarray(index, np.int64)
    place = np.zeros(len(index), np.int64)
    while levels > 1:
        top = levels // 2
        if depth < top:
            levels = top
            continue
        below = depth - top
        place += (1 << top) - 1 + (index >> below) * ((1 << (levels - top)) - 1)
        index = index & ((1 << below) - 1)
        depth, levels = below, levels - top
    return place


@lru_cache(maxsize=64)
def _addresses(height: int) -> list[np.ndarray]:
    return [address(d, np.arange(1 << d), height + 1) for d in range(height + 1)]


def height_of(n: int, limit: int = HEIGHT) -> int:
    """Levels below the root of the subtrees of a tier with ``n`` leaves: ``limit`` if there are several."""
    return limit if n > 1 << limit else max(n - 1, 0).bit_length()


def parent(*children: bytes) -> bytes:
    return sha256("".join(c.hex() for c in children).encode()).digest()


def built(leaves: bytes, height: int) -> bytes:
    """Digests of a subtree in van Emde Boas order; places without a node are zero."""
    nodes = np.zeros(((2 << height) - 1, 32), np.uint8)
    row = [leaves[i : i + 32] for i in range(0, len(leaves), 32)]
    for depth in range(height, -1, -1):
        nodes[_addresses(height)[depth][: len(row)]] = np.frombuffer(b"".join(row), np.uint8).reshape(-1, 32)
        row = [parent(*row[i : i + 2]) for i in range(0, len(row), 2)]
    return nodes.tobytes()


def paths(nodes: bytes, n: int, height: int) -> np.ndarray:
    """Steps of each of the ``n`` leaves up to the subtree's root, as an array of n x height x 33 bytes."""
    table = np.frombuffer(nodes, np.uint8).reshape(-1, 32)
    steps = np.zeros((n, height, STEP), np.uint8)
    index, count = np.arange(n), n
    for level, depth in enumerate(range(height, 0, -1)):
        beside = index ^ 1
        there = beside < count
        steps[there, level, 1:] = table[_addresses(height)[depth][beside[there]]]
        steps[there, level, 0] = np.where(index[there] & 1, LEFT, RIGHT)
        index, count = index >> 1, (count + 1) >> 1
    return steps


def fold(digest: bytes, path: bytes) -> bytes:
    """The root that a leaf's digest and its path lead to."""
    for at in range(0, len(path), STEP):
        side, sibling = path[at], path[at + 1 : at + STEP]
        digest = parent(digest, sibling) if side == RIGHT else parent(sibling, digest) if side == LEFT else parent(digest)
    return digest


def proof_digest(path: bytes) -> str:
    """Digest of the siblings on a path, in order."""
    return sha256("".join(path[i + 1 : i + STEP].hex() for i in range(0, len(path), STEP) if path[i] != NONE).encode()).hexdigest()


def leaf_digest(*fields: Column) -> Column:
    """Digest of a row: each field as ``-`` if null, else its UTF-8 byte count, ``:`` and its text."""
    parts = []
    for field in fields:
        text = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def ranked(leaves: DataFrame) -> DataFrame:
    """(tree, key, leaf, ...) with ``rank`` in the tree and its number of leaves ``n``.

    Ranges are cut between equal rows as well, by their place in the input.
    """
    spark = leaves.sparkSession
    order = ["tree", "key", "leaf", "__tie"]
    dealt = leaves.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order).drop("__tie")
    schema = T.StructType([*dealt.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("place", T.LongType())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, current, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            trees = batch.column("tree").to_numpy(zero_copy_only=False)
            new = np.ones(len(trees), bool)
            new[1:] = trees[1:] != trees[:-1]
            starts = np.flatnonzero(new)
            if not len(starts):
                continue
            place = np.arange(len(trees)) - np.repeat(starts, np.diff(np.append(starts, len(trees))))
            if trees[0] == current:
                place[: starts[1] if len(starts) > 1 else None] += seen
            current, seen = trees[-1], int(place[-1]) + 1
            numbers = [pa.array(np.full(len(trees), part, np.int32)), pa.array(place.astype(np.int64))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *numbers], names=schema.names)

    rows = staged(dealt.mapInArrow(number, schema), fresh_dir(spark, "merkle-ranked"))
    counts = rows.groupBy("tree", "part").agg(F.count("*").alias("c"))  # a row per range, and per tree in it
    within = Window.partitionBy("tree")
    before = F.sum("c").over(within.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    shifts = counts.select("tree", "part", F.coalesce(before, F.lit(0)).alias("before"), F.sum("c").over(within).alias("n"))
    return rows.join(shifts, ["tree", "part"]).withColumn("rank", F.col("before") + F.col("place")).drop("part", "place", "before")


def tier(leaves: DataFrame, height: int, *carried: str) -> DataFrame:
    """One row per subtree: (tree, block, n, height, leaves, nodes, root, and the columns carried by its leaves)."""
    block = F.shiftright("rank", height)
    members = F.array_sort(F.collect_list(F.struct("rank", "leaf", *carried)))
    rows = leaves.groupBy("tree", "n", block.alias("block")).agg(members.alias("m"))

    @F.arrow_udf("binary")
    def nodes(digests: pa.Array, n: pa.Array) -> pa.Array:
        made = (built(b"".join(x), height_of(k, height)) for x, k in zip(digests.to_pylist(), n.to_pylist(), strict=True))
        return pa.array(list(made), pa.binary())

    kept = [F.col("m").getField(c).alias(f"{c}s") for c in ("leaf", *carried)]
    named = rows.select("tree", "block", "n", *kept).withColumn("nodes", nodes(F.col("leafs"), F.col("n")))
    # the root has place 0
    return named.withColumn("root", F.substring("nodes", 1, 32))


def forest(spark: SparkSession, leaves: DataFrame, *carried: str, height: int = HEIGHT) -> list[DataFrame]:
    """The written tiers of all trees, from the leaves up to one subtree per tree."""
    tiers = [staged(tier(leaves, height, *carried), fresh_dir(spark, "merkle-tier"))]
    most = tiers[0].agg(F.max("n")).first()[0] or 0
    while most > 1 << height:
        below = tiers[-1]
        several = below.filter(F.col("n") > 1 << height)
        up = several.select("tree", F.col("block").alias("rank"), F.col("root").alias("leaf"), _blocks(F.col("n"), height).alias("n"))
        tiers.append(staged(tier(up, height), fresh_dir(spark, "merkle-tier")))
        most = -(-most >> height)
    return tiers


def _blocks(n: Column, height: int) -> Column:
    return F.shiftright(n + ((1 << height) - 1), height)


def roots(tiers: Sequence[DataFrame], height: int = HEIGHT) -> DataFrame:
    """(tree, root) of every tree: the tier in which it is one subtree has it."""
    tops = [t.filter(F.col("n") <= 1 << height).select("tree", "root") for t in tiers]
    out = tops[0]
    for top in tops[1:]:
        out = out.unionByName(top)
    return out


_HANDED = "array<binary>"


def _paths_in(height: int):
    """Column function: nodes, number of leaves, leaves of the tier and the path of the root to each leaf's path."""

    @F.arrow_udf(_HANDED)
    def handed(nodes: pa.Array, leafs: pa.Array, n: pa.Array, above: pa.Array) -> pa.Array:
        out = []
        for table, digests, k, path in zip(nodes.to_pylist(), leafs.to_pylist(), n.to_pylist(), above.to_pylist(), strict=True):
            steps = paths(table, len(digests), height_of(k, height))
            out.append([s.tobytes() + path for s in steps])
        return pa.array(out, pa.list_(pa.binary()))

    return handed


def _with_paths(tiers: Sequence[DataFrame], tops: DataFrame, height: int) -> DataFrame:
    """The lowest tier with the ``path`` of every subtree's root and what ``tops`` say of its tree."""
    said = [c for c in tops.columns if c not in ("tree", "path")]
    above = None
    for k in range(len(tiers) - 1, -1, -1):
        here = tiers[k]
        single = here.filter(F.col("n") <= 1 << height).join(tops, "tree")
        if above is not None:
            single = single.unionByName(here.filter(F.col("n") > 1 << height).join(above, ["tree", "block"]))
        if k:
            each = single.withColumn("__p", _paths_in(height)("nodes", "leafs", "n", "path"))
            above = each.select("tree", "block", *said, F.posexplode("__p").alias("at", "path")).select(
                "tree", (F.shiftleft("block", height) + F.col("at")).alias("block"), "path", *said
            )
    return single


def manifest(spark: SparkSession, leaves: DataFrame, *carried: str, height: int = HEIGHT) -> tuple[list[DataFrame], list[DataFrame]]:
    """The written tiers of the trees of (tree, key, leaf, carried columns) and those of the tree over their roots.

    ``tree`` is a string that sorts as the trees are to be ordered, and not null.
    """
    below = forest(spark, ranked(leaves), *carried, "key", height=height)
    tops = staged(roots(below, height), fresh_dir(spark, "merkle-roots"))
    over = tops.select(F.lit("").alias("tree"), F.col("tree").alias("key"), F.col("root").alias("leaf"))
    return below, forest(spark, ranked(over), "key", height=height)


def proofs(below: Sequence[DataFrame], over: Sequence[DataFrame], height: int = HEIGHT) -> DataFrame:
    """The lowest tier with the ``path`` of each subtree's root to the root of all, ``subroot`` and ``root``."""
    top = roots(over, height).select("tree", F.col("root").alias("__all")).withColumn("path", F.unhex(F.lit("")))
    each = _with_paths(over, top, height).withColumn("__p", _paths_in(height)("nodes", "leafs", "n", "path"))
    zipped = F.explode(F.arrays_zip("keys", "leafs", "__p"))
    trees = each.select("__all", zipped.alias("z")).select(
        F.col("z.keys").alias("tree"), F.col("z.__p").alias("path"), F.col("z.leafs").alias("subroot"), F.col("__all").alias("top")
    )
    return _with_paths(below, trees, height)


_CHECKED = "array<struct<proof_sha256:string,folded:string>>"


def verified(subtrees: DataFrame, claimed: str, height: int = HEIGHT) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified) of every leaf.

    ``claimed`` names the carried digests that are checked; a null one stands for the leaf itself.
    """

    @F.arrow_udf(_CHECKED)
    def checked(nodes: pa.Array, leafs: pa.Array, claims: pa.Array, n: pa.Array, above: pa.Array) -> pa.Array:
        out = []
        columns = (nodes.to_pylist(), leafs.to_pylist(), claims.to_pylist(), n.to_pylist(), above.to_pylist())
        for table, digests, claim, k, path in zip(*columns, strict=True):
            reached: dict[bytes, str] = {}  # what a subtree's root leads to
            found = []
            for digest, other, steps in zip(digests, claim, paths(table, len(digests), height_of(k, height)), strict=True):
                own = steps.tobytes()
                at = fold(other or digest, own)
                if at not in reached:
                    reached[at] = fold(at, path).hex()
                found.append({"proof_sha256": proof_digest(own + path), "folded": reached[at]})
            out.append(found)
        return pa.array(out, pa.list_(pa.struct([("proof_sha256", pa.string()), ("folded", pa.string())])))

    rows = subtrees.withColumn("__c", checked("nodes", "leafs", f"{claimed}s", "n", "path"))
    flat = rows.select("subroot", "top", F.explode(F.arrays_zip("keys", "leafs", "__c")).alias("z"))
    text = lambda digest: F.lower(F.hex(digest))
    return flat.select(
        F.col("z.keys").alias("key"),
        text(F.col("z.leafs")).alias("leaf"),
        text(F.col("subroot")).alias("subroot"),
        text(F.col("top")).alias("root"),
        F.col("z.__c.proof_sha256").alias("proof_sha256"),
        F.col("z.__c.folded").alias("folded_root"),
        (F.col("z.__c.folded") == text(F.col("top"))).alias("verified"),
    )


def document_leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """(tree, key, leaf, claim) of documents; where ``tampered`` holds, ``claim`` has one more in n_chars."""

    def digest(n_chars: Column) -> Column:
        return leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text"))

    tree = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit(""))
    claim = F.when(tampered, digest(F.col("n_chars") + 1))
    return docs.select(tree.alias("tree"), F.col("doc_id").alias("key"), digest(F.col("n_chars")).alias("leaf"), claim.alias("claim"))


def document_manifest(docs: DataFrame, tampered: Column, height: int = HEIGHT) -> DataFrame:
    """Every document's leaf, roots and proof, and whether what ``tampered`` left of it still leads to the root."""
    spark = docs.sparkSession
    leaves = staged(document_leaves(docs, tampered), fresh_dir(spark, "merkle-leaves"))
    below, over = manifest(spark, leaves, "claim", height=height)
    return verified(proofs(below, over, height), "claim", height).withColumnRenamed("key", "doc_id")
