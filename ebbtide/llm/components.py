"""Connected components of a graph in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(edges: DataFrame, root: str) -> DataFrame:
    """``node, component`` for each node of ``edges`` (``a``, ``b``, of one integer type): the least node it reaches.

    Alternating large and small stars: each node hangs its larger, then its
    smaller neighbours on the least one it knows, until nothing changes. The
    edges of each round are a table under ``root``.
    """
    spark = edges.sparkSession
    stars = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    stars.write.parquet(f"{root}/0")
    stars, before, step = spark.read.parquet(f"{root}/0"), None, 0
    while True:
        # Large star: neighbours above a node move to the least of its neighbours and itself.
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: neighbours below a node, and the node, move to the least of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        step += 1
        small.write.parquet(f"{root}/{step}")
        stars = spark.read.parquet(f"{root}/{step}")
        now = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
