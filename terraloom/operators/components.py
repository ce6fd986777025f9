"""Connected components by alternating large-star and small-star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import materialise


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row["n"], row["x"]


def connected_components(edges: DataFrame) -> DataFrame:
    """edges(a, b), both long and not null -> (node, root): every node that has an edge to another
    node, with the smallest node it reaches. Loops and repeated edges are allowed; no edges give an
    empty table. Each round is written to the shared folder; no round gathers a node's neighbours in
    one row. Least neighbours are written before they are joined, as adaptive execution splits a hub's rows
    only if the other side isn't aggregated on the same key in the same stage.
    """
    cur = materialise(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _state(cur)
    while state[0]:
        both = cur.unionAll(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = materialise(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        large = materialise(both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        low = materialise(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(low)
        cur = materialise(small.where("a != b").distinct())
        before, state = state, _state(cur)
        if state == before:
            break
    nodes = cur.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionAll(cur.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
