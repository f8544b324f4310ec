"""Connected components by alternating large and small stars."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", checkpoint_dir: str | None = None) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of an edge.

    Each round sends every node's larger neighbours to the smallest node next
    to it, then the same for smaller neighbours; the number of rounds grows
    with the logarithm of the longest path.  A node's neighbours are never
    gathered: minima are partial aggregates, and the joins split hot nodes.
    Lineage is cut with a written table in ``checkpoint_dir``, or checkpoint().
    """
    spark = edges.sparkSession
    e = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u IS NOT NULL AND v IS NOT NULL")
    nodes = e.select(F.col("u").alias("node")).union(e.select("v")).distinct()
    e = e.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    def keep(df: DataFrame) -> DataFrame:
        if checkpoint_dir is None:
            return df.checkpoint()
        path, schema = f"{checkpoint_dir}/components-{uuid.uuid4().hex}", df.schema
        df.write.parquet(path)
        return spark.read.schema(schema).parquet(path)

    def measure(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    e = keep(e)
    nodes, last = keep(nodes), None
    while (now := measure(e)) != last:
        last = now
        # Large star: a node's larger neighbours join its smallest neighbour (or itself).
        both = e.union(e.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # Small star: a node and its smaller neighbours join the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(least.select("u", F.col("m").alias("v"))).distinct()
        e = keep(small)
    roots = e.groupBy("u").agg(F.min("v").alias("v"))
    return nodes.join(roots, nodes.node == roots.u, "left").select("node", F.coalesce("v", "node").alias("component"))
