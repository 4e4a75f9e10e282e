"""Connected components of a graph given as a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import written


def _state(edges: DataFrame) -> tuple:
    # a wrapping sum of hashes would overflow under ANSI, so half the bits are summed
    row = edges.agg(F.count(F.lit(1)), F.sum(F.shiftright(F.xxhash64("a", "b"), 32))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(a, b) for every node a of ``links`` (a, b) but the smallest of its component, b: that smallest node.

    Each round points the larger neighbours of a node, then the smaller ones, at its smallest neighbour.
    Minima are combined map-side and written, so that Spark can split the join at a hub.
    """
    edges = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .where("a <> b").distinct(), "components")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = written(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low")), "components-low")
        large = written(both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
                        .where("a <> b").distinct(), "components-large")
        low = written(large.groupBy("a").agg(F.min("b").alias("low")), "components-low")
        small = large.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        edges = written(small.unionByName(low.select("a", F.col("low").alias("b"))).distinct(), "components")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges
