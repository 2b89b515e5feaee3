"""Connected components of a table of links, by rounds of joins on Spark.

Each round lets every node hand its smallest neighbour to its larger ones
(large star) and then to its smaller ones (small star), until every component
is one star. No group of neighbours is ever collected: minima are aggregated
with map-side combine and joined back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from millrace.llm.frames import written

# Links in one file of the table that a round leaves behind.
LINKS_PER_FILE = 200_000


def components(links: DataFrame, left: str = "a", right: str = "b", rounds: int = 60) -> DataFrame:
    """(node, component) of every node that has a link; ``component`` is its smallest reachable node.

    Links are undirected; self links, repeated links and links with a null end
    count for nothing. An empty table gives an empty result.
    """
    ends = links.select(F.least(left, right).alias("a"), F.greatest(left, right).alias("b"))
    ends = ends.filter(F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col("a") < F.col("b"))).distinct()
    edges, seen = _kept(ends, None)
    for _ in range(rounds):
        edges, state = _kept(_small_star(_large_star(edges)), seen["n"])
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).union(roots)


def _kept(edges: DataFrame, before: int | None) -> tuple[DataFrame, dict]:
    """The links written, and their number and two sums of hashes, which tell whether they are still the same."""
    seen = Observation()
    watched = edges.observe(
        seen,
        F.count("*").alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("x"),
        F.sum(F.hash("b", "a").cast("long")).alias("y"),
    )
    # Stars have no more links than the round before, so as many files will do.
    if before is not None:
        watched = watched.coalesce(before // LINKS_PER_FILE + 1)
    return written(watched, "stars"), seen.get


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # Written, so that the join has a shuffle on either side and Spark can split a node with very many links.
    least = written(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), "least")
    out = both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b")
    return out.filter("a < b")


def _small_star(edges: DataFrame) -> DataFrame:
    # Here every link points from the larger node b to the smaller node a.
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    joined = edges.join(least, "b")
    moved = joined.filter("a > m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    kept = least.select(F.col("m").alias("a"), "b")
    return moved.union(kept).filter("a < b").distinct()
