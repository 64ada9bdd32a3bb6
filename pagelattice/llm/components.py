"""Connected components of a large edge list by alternating large-star and small-star steps.

The method (Kiveris et al., "Connected Components in MapReduce and Beyond", 2014) keeps the number
of edges from growing and needs about log(n) rounds; each round is two groupings and two joins, whose
hot nodes Spark's adaptive skew join splits. Nothing is gathered on the driver but two figures a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, settle


def _figures(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def components(spark: SparkSession, edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges(a, b)`` of bigint nodes to ``(node, root)``: root is the least node of the component.

    Every node that has an edge to another node is returned once, roots included. Null ends and loops
    are ignored; repeated and mirrored edges are allowed; no edges give no rows.
    """
    edges = edges.where("a is not null and b is not null and a <> b")
    edges = materialize(spark, edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _figures(edges)
    for _ in range(max_rounds):
        if not before[0]:
            break
        edges = materialize(spark, _small_star(_large_star(edges)), "edges")
        after = _figures(edges)
        if after == before:
            break
        before = after
        settle(spark)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots.select("node", F.col("node").alias("root")))
