"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirstone.session import fresh_dir


def _written(df: DataFrame, label: str) -> DataFrame:
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def star_forest(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node that is no root.

    ``edges`` has two columns of type long and is a written table, or one as cheap to read again.
    Alternating stars: each round links the larger neighbours of a node, then the smaller ones, to
    the smallest node around, until every node hangs on its root. A round is one written table, so
    the plan stays short and a lost executor costs one round; it has no more rows than the one
    before. A node with very many edges is split by the skew join. Whether every node has one other
    above it, which has none above itself, is asked after each round, so none is run to see that
    nothing changes.
    """
    a, b = edges.columns
    stars = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    while True:
        above = stars.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("m"))
        large = stars.join(above, "v", "left").select("u", F.coalesce("m", "v").alias("v"))
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        stars = _written(small.distinct(), "stars")
        ends = stars.select(F.col("u").alias("node"), "v").unionAll(stars.select("v", F.lit(None).cast("long")))
        state = ends.groupBy("node").agg(F.min("v").alias("low"), F.max("v").alias("high"), F.max(F.col("v").isNull()).alias("carries"))
        if state.where("low <> high or (low is not null and carries)").isEmpty():
            return stars.select(F.col("u").alias("node"), F.col("v").alias("root"))


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node of an edge.

    ``edges`` has two columns of type long. Edges of a node with itself keep the node in the result.
    """
    a, b = edges.columns
    pairs = _written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    roots = star_forest(pairs)
    tops = roots.select(F.col("root").alias("node"), "root")
    alone = pairs.where("u = v").select(F.col("u").alias("node"), F.col("u").alias("root"))
    # a node that hangs on a root appears once there; roots and nodes by themselves name themselves
    return roots.unionAll(tops).unionAll(alone).groupBy("node").agg(F.min("root").alias("root"))
