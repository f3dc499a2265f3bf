"""Connected components of an edge table, by alternating stars.

Large star: each node hands its larger neighbours to its least neighbour.
Small star: each node hands its smaller neighbours, and itself, to the least.
Both are joins and partial aggregations on the edge table; it ends when every
component is a star around its least node, after about log(n) rounds. Edges
are written to the shared folder each round, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from neoflow.session import scratch_path


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a").agg(F.min("b").alias("m"))


def _large(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = _least(both).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(edges: DataFrame) -> DataFrame:
    least = _least(edges)
    inner = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return inner.union(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` of any type that can be ordered, any direction -> (node, component: least node reachable)
    for every node with an edge. Nulls and loops are dropped, repeats don't matter."""
    spark = edges.sparkSession

    def written(df: DataFrame) -> tuple[DataFrame, tuple]:
        path = scratch_path(spark, "components")
        df.filter("a <> b").distinct().write.parquet(path)
        back = spark.read.parquet(path)
        return back, tuple(back.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now, seen = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    while True:
        now, after = written(_small(_large(now)))
        if after == seen:
            break
        seen = after
    return (now.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .union(now.select(F.col("b"), F.col("b")).distinct()))
