"""Connected components of an edge table by alternating large-star and
small-star rounds; nothing but a convergence checksum reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import materialise


def edge_state(e: DataFrame) -> tuple[int, int | None]:
    """Number and checksum of an edge table, whatever their order; no sum that could overflow."""
    return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """``edges`` (u, v) of any comparable type -> (node, root) for every node
    of an edge, root being the smallest node reachable.

    Each round replaces the edges by stars around local minima: a grouped
    minimum with map-side combine and a join back by node (an inner
    sort-merge join, which AQE splits when a hub is hot). Rounds end when the
    edge set stops changing; if it has not after ``max_rounds``, that is an
    error. Self loops and repeated edges are dropped; no
    edges give an empty result."""
    e = materialise(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = None
    for _ in range(max_rounds):
        found = edge_state(e)
        if not found[0] or found == state:
            break
        state = found
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low2, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low2.select("u", F.col("m").alias("v"))))
        e = materialise(small.distinct(), "edges")
    else:
        raise RuntimeError(f"components have not settled after {max_rounds} rounds")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
