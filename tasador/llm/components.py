"""Connected components of a graph given by its edges, as repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasador.llm.scratch import stored


#: Edges of one file and task of a step, on average, where there are fewer than shuffle partitions would hold.
EDGES_A_TASK = 250_000


def stars(edges: DataFrame, tasks: int) -> bool:
    """Whether each u has one edge and no v is a u: with u > v, each component is then a star around its smallest vertex."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("v", F.lit(0), F.lit(1)))
    ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).coalesce(tasks)
    return ends.where(F.col("up") + F.col("down") > 1).where("up > 0").agg(F.count("*")).first()[0] == 0


def components(edges: DataFrame) -> DataFrame:
    """Smallest reachable vertex of each vertex that has an edge: (node, component).

    ``edges`` has long columns u and v in any direction, with repeats and loops allowed. Each round ties
    every vertex and its larger neighbours to the smallest vertex around it, then every vertex and its smaller neighbours, until the
    edges are stars around the smallest vertices. Minima combine before the shuffle, so a vertex with very many edges
    is no hot key of the aggregation, and joins on it are split by the adaptive plan. Rounds grow with the logarithm of the path length.
    Few edges are dealt over few tasks, whatever the number of shuffle partitions.
    """
    # ordered pairs u > v
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    edges = stored(edges, "edges")
    tasks = max(edges.sparkSession.sparkContext.defaultParallelism, edges.count() // EDGES_A_TASK + 1)
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")).coalesce(tasks)
        large = both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = stored(large.coalesce(tasks), "large")
        lowest = large.groupBy("u").agg(F.min("v").alias("m")).coalesce(tasks)
        small = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(lowest.select("u", F.col("m").alias("v")))
        edges = stored(small.distinct().coalesce(tasks), "small")
        if stars(edges, tasks):
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select(F.col("v"), F.col("v")).distinct())
