"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import forget, stored


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b), root being the smallest
    node that it is connected with.

    Alternating star contractions: each round sends every node's larger
    neighbours to its smallest one, then its smaller ones, until nothing
    changes; about log(n) rounds. All groups are map-side minimums and joins,
    so a node with very many neighbours is never gathered in one task. Self
    loops, repeated edges and null ends add nothing; no edges, no rows."""
    current = stored(
        edges.where("a IS NOT NULL AND b IS NOT NULL AND a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "components-0",
    )
    step = 0
    while True:
        step += 1
        # large star: every neighbour above u goes to the smallest of u and its neighbours
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # written first: the join then shuffles both sides, and Spark splits a node with very many neighbours
        low_ends = stored(low, "components-low")
        large = both.join(low_ends, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: u and its neighbours below u go to the smallest of those
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        below = large.join(low, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = stored(
            below.unionByName(low.select("a", F.col("m").alias("b"))).where("a != b").distinct(), f"components-{step}"
        )
        same = after.count() == current.count() and after.exceptAll(current).isEmpty()
        forget(low_ends, current)
        current = after
        if same:
            break
    # the last round's edges stay: what is returned reads them
    roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
