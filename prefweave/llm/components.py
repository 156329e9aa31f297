"""Connected components of an edge table by large-star / small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from prefweave.llm.tables import stored


def _min_neighbour(sides: DataFrame) -> DataFrame:
    return sides.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))
    sides = edges.select(F.explode(both).alias("e")).select("e.u", "e.v")
    return (sides.join(_min_neighbour(sides), "u").where("v > u and v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    sides = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = _min_neighbour(sides)
    linked = sides.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Whether each node is the greater end of one edge alone, or only the lesser
    end of any number; ``edges`` are distinct with ``u`` greater."""
    up = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"))
    ends = up.unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up")))
    seen = ends.groupBy("node").agg(F.sum("up").alias("up"), F.count("*").alias("n"))
    return seen.where("up > 0 and n > 1").isEmpty()


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every node with an edge; ``root`` is the least node of
    its component, which is a node of its own component. Every round is written
    to the shared folder, so the plan stays short and a lost executor costs one
    round at most; hot nodes meet only in counts with map-side combine and in
    joins that Spark can split. Rounds end when every component is a star."""
    now = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a) != F.col(b))
                 .distinct(), "edges")
    while not _is_forest_of_stars(now):
        now = stored(_small_star(stored(_large_star(now), "large-stars")), "edges")
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
