"""Connected components of an edge list, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thalweg.staging import stage


def components(edges: DataFrame) -> DataFrame:
    """Label the nodes of `edges` (long a, b) with their component's smallest node.

    Returns node, label. Smallest nodes themselves, and nodes without an edge to
    another one, don't appear. Loops, repeated edges and edges with a NULL end are allowed and ignored.

    Each round points larger neighbours at the smallest one, then the node itself
    and its smaller neighbours. Both steps are a minimum per node (partial sums on
    the map side) joined back, so a hub is never gathered in one row. Every round
    is a written table, which keeps the lineage short.
    """
    e = stage(_oriented(edges.select("a", "b")), "edges")
    before = _state(e)
    while True:
        e = stage(_small_star(_large_star(e)), "edges")
        after = _state(e)
        if after == before:
            return e.select(F.col("hi").alias("node"), F.col("lo").alias("label"))
        before = after


def _oriented(edges: DataFrame) -> DataFrame:
    a, b = edges.columns
    return (
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
        .distinct()
    )


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
        e.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select("v", "m")


def _small_star(pairs: DataFrame) -> DataFrame:
    e = _oriented(pairs)
    least = e.groupBy("hi").agg(F.min("lo").alias("m"))
    return _oriented(e.join(least, "hi").select("lo", "m").union(least.select("hi", "m")))


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first())
