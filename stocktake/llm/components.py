"""Connected components of a distributed edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktake.session import shared_folder


def _saved(df: DataFrame) -> tuple[DataFrame, tuple]:
    """The table cut from its lineage in the shared folder, and a digest of its rows."""
    df = df.checkpoint()
    digest = df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.min("v"), F.max("u")).first()
    return df, tuple(digest)


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (two columns of longs, or of another type with an order); the root is the least node reachable.

    Each round links the larger neighbours of a node to its least one, then the
    smaller ones, until nothing changes; every link is kept, no group is
    gathered. Rounds are cut with reliable checkpoints. Edges with a null end or
    from a node to itself are ignored; without edges there are no rows.
    """
    shared_folder(edges.sparkSession)
    a, b = (F.col(f"`{c}`") for c in edges.columns[:2])
    table, seen = _saved(edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    while seen[0]:
        both = table.unionByName(table.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("v"))
        lower = large.join(least.withColumnRenamed("v", "m"), "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        table, now = _saved(lower.unionByName(least).distinct())
        if now == seen:
            break
        seen = now
    roots = table.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return table.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
