"""Connected components of links, by joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.scratch import released, written


def components(links: DataFrame, most_rounds: int = 100) -> DataFrame:
    """``node, component`` for every end of ``links`` (``a, b``); component is its least node.

    Large-star and small-star steps in turn: each hangs neighbours on the least of
    them, so a chain halves and a star is done at once. The least neighbour comes from
    an aggregation and returns by a join, so no neighbourhood is ever gathered. Each
    round is written to the shared folder, which cuts the lineage.
    """
    edges = written(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(least, "a")
        small = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            hung.select("a", F.col("m").alias("b"))
        )
        after = written(small.filter("a <> b").distinct(), "links")
        released(edges)
        # Done when every node hangs on a root: one that hangs on nothing.
        roots = after.select(F.col("b").alias("a")).distinct().join(after, "a", "left_semi")
        once = after.groupBy("a").count().filter("count > 1")
        if roots.isEmpty() and once.isEmpty():
            edges = after
            break
        edges = after
    else:
        raise RuntimeError(f"links are not joined up after {most_rounds} rounds")
    tops = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(tops)
