"""Near-duplicate vectors: learned binary codes, multi-index Hamming tables, rerank by cosine.

Iterative quantisation learns a rotation of the principal components that makes signs balanced and
close to the vectors; it is fitted on a bounded sample, and every vector gets its code. Several
rotations from different starts give several codes. A code is cut into blocks of 16 bits; each
block is a table. A vector is looked up in every table under its own block and all blocks one bit
away, so codes within ``2 * blocks - 1`` bits always meet, and most pairs at the threshold do so
several times. Pairs that meet with codes within ``RADIUS`` bits are compared by cosine in double
precision on the original vectors.

Equal vectors are one class from the start, however many there are, so copies add no pairs.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components link with
nothing; so do vectors of a length that no other has. Repeated rows are copies of each other. A null
id counts as a vector but never names a component with other ids in it. An empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirstone.llm.graph import components
from weirstone.session import fresh_dir

SAMPLE = 8000
ROTATIONS = 2
BLOCK = 16
RADIUS = 16


def learn(vectors: np.ndarray, rotations: int = ROTATIONS, rounds: int = 30, seed: int = 11) -> list[tuple[np.ndarray, np.ndarray]]:
    """Projections and thresholds of each code, from a sample of unit vectors (one per row)."""
    centre = vectors - vectors.mean(axis=0)
    _, _, axes = np.linalg.svd(centre, full_matrices=False)
    low = centre @ axes.T[:, :64]
    random = np.random.default_rng(seed)
    made = []
    for _ in range(rotations):
        turn, _ = np.linalg.qr(random.normal(size=(low.shape[1], low.shape[1])))
        for _ in range(rounds):
            signs = np.where(low @ turn >= 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(low.T @ signs)
            turn = left @ right
        projection = axes.T[:, :64] @ turn
        made.append((projection, np.median(vectors @ projection, axis=0)))
    return made


def coder(codes: list[tuple[np.ndarray, np.ndarray]]) -> Callable[[Column], Column]:
    """Column function: unit vector to one 64-bit code per rotation."""

    @F.arrow_udf("array<long>")
    def encode(column: pa.Array) -> pa.Array:
        flat = column.flatten().to_numpy(zero_copy_only=False)
        matrix = flat.reshape(len(column), -1)
        found = []
        for projection, middle in codes:
            bits = np.zeros((len(column), 64), np.uint8)
            bits[:, : projection.shape[1]] = matrix @ projection >= middle
            found.append(np.packbits(bits, axis=1).view(">u8").ravel().astype(np.uint64).view(np.int64))
        return pa.ListArray.from_arrays(pa.array(np.arange(len(column) + 1, dtype=np.int32) * len(codes)), pa.array(np.stack(found, axis=1).ravel()))

    return encode


def near_pairs(units: DataFrame, threshold: float = 0.95, sample: int = SAMPLE, rotations: int = ROTATIONS) -> DataFrame:
    """Pairs ``a < b`` of ``cid`` with cosine at least ``threshold``; ``units`` has cid and unit ``v``,
    all of one length."""
    spark = units.sparkSession
    rows = units.orderBy(F.xxhash64("cid"), "cid").limit(sample).select("v").toArrow()["v"].combine_chunks()
    if len(rows) < 2:
        return units.limit(0).select(F.col("cid").alias("a"), F.col("cid").alias("b"))
    fitted = learn(rows.flatten().to_numpy().reshape(len(rows), -1), rotations)
    path = fresh_dir(spark, "codes")
    units.select("cid", coder(fitted)("v").alias("codes")).write.parquet(path)
    coded = spark.read.parquet(path).select("cid", F.posexplode("codes").alias("turn", "code"))
    blocks = 64 // BLOCK
    block = F.explode(F.array(*(F.struct(F.lit(b).alias("block"), F.shiftrightunsigned("code", b * BLOCK).bitwiseAND(F.lit((1 << BLOCK) - 1)).alias("bits")) for b in range(blocks))))
    tabled = coded.select("cid", "code", "turn", block.alias("t")).select("cid", "code", (F.col("turn") * blocks + F.col("t.block")).alias("table"), F.col("t.bits").alias("bits"))
    flipped = F.explode(F.array("bits", *(F.col("bits").bitwiseXOR(F.lit(1 << i)) for i in range(BLOCK))))
    probes = tabled.select(F.col("cid").alias("b"), F.col("code").alias("code_b"), "table", flipped.alias("bits"))
    index = tabled.select(F.col("cid").alias("a"), F.col("code").alias("code_a"), "table", "bits")
    meet = index.join(probes, (index.table == probes.table) & (index.bits == probes.bits) & (F.col("a") < F.col("b")) & (F.bit_count(F.col("code_a").bitwiseXOR(F.col("code_b"))) <= RADIUS))
    pairs = meet.select("a", "b").distinct()
    left = units.select(F.col("cid").alias("a"), F.col("v").alias("va"))
    right = units.select(F.col("cid").alias("b"), F.col("v").alias("vb"))
    dot = F.aggregate(F.zip_with("va", "vb", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return pairs.join(left, "a").join(right, "b").where(dot >= threshold).select("a", "b")


def near_duplicates(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = 0.95, sample: int = SAMPLE) -> DataFrame:
    """One row per vector: key, n_links, component_id, kept."""
    spark = rows.sparkSession
    given = rows.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("raw"))
    bad = F.exists("raw", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    top = F.array_max(F.transform("raw", lambda x: F.abs(x)))
    usable = given.where(F.col("raw").isNotNull() & (F.size("raw") > 0) & ~F.coalesce(bad, F.lit(True))).where(top > 0)
    # -0.0 and 0.0 are the same component
    usable = usable.withColumn("raw", F.transform("raw", lambda x: x + F.lit(0.0)))
    classes_path = fresh_dir(spark, "vector-classes")
    scaled = F.transform("raw", lambda x: x / F.array_max(F.transform("raw", lambda y: F.abs(y))))
    norm = F.sqrt(F.aggregate("s", F.lit(0.0), lambda t, x: t + x * x))
    classes = usable.groupBy("raw").agg(F.min("id").alias("least"), F.count("*").alias("copies")).withColumn("s", scaled)
    classes.select(F.monotonically_increasing_id().alias("cid"), "raw", "least", "copies", F.transform("s", lambda x: x / norm).alias("v")).write.parquet(classes_path)
    classes = spark.read.parquet(classes_path)
    lengths = [r[0] for r in classes.groupBy(F.size("v")).count().where("count > 1").collect()]  # one number per length
    pairs = classes.limit(0).select(F.col("cid").alias("a"), F.col("cid").alias("b"))
    for length in lengths:
        pairs = pairs.unionAll(near_pairs(classes.where(F.size("v") == length).select("cid", "v"), threshold, sample))
    pairs_path = fresh_dir(spark, "vector-pairs")
    pairs.write.parquet(pairs_path)
    pairs = spark.read.parquet(pairs_path)
    sizes = classes.select("cid", "copies")
    ends = pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = ends.join(sizes, ends.b == sizes.cid).groupBy("a").agg(F.sum("copies").alias("linked"))
    roots = components(pairs)
    known = classes.join(others, classes.cid == others.a, "left").join(roots, classes.cid == roots.node, "left")
    known = known.select("raw", "least", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), F.coalesce("root", "cid").alias("root"))
    named = known.groupBy("root").agg(F.min("least").alias("component_id"))
    found = known.join(named, "root").select("raw", "n_links", "component_id")
    linked = usable.join(found, "raw").select("id", "n_links", "component_id")
    alone = given.where(F.col("raw").isNull() | (F.size("raw") == 0) | F.coalesce(bad, F.lit(True)) | F.coalesce(top == 0, F.lit(True)))
    result = linked.unionAll(alone.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")))
    return result.select(F.col("id").alias(key), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"))
