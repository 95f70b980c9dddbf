"""Connected components of a written edge list by alternating large and small stars.

Each step sends every edge to the smallest neighbour of an end; the number of steps grows with the
logarithm of the longest chain. Every step is written, so a lost executor costs one step at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.spread import join_groups
from tidemark.sources.scratch import materialize


def _stars(edges: DataFrame) -> DataFrame:
    """Beside each edge (u, v) the smallest of u and all its v."""
    least = materialize(
        edges.groupBy("u").agg(F.min("v").alias("low"), F.count("*").alias("n")), "least"
    )
    joined = join_groups(edges, least, "u", "n")
    return joined.select("u", "v", F.least("u", "low").alias("low"))


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    found = _stars(materialize(both, "both")).filter("v > u")
    return found.select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    found = _stars(edges)
    hung = found.select(F.col("v").alias("u"), F.col("low").alias("v")).filter("u <> v")
    own = found.select("u", F.col("low").alias("v")).filter("u <> v")
    return hung.unionByName(own).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(u, v) edges to (node, root): every node of an edge, with the smallest node it reaches."""
    ends = (F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = materialize(edges.filter("u <> v").select(*ends).distinct(), "edges")
    state = _state(now)
    while state[0]:
        now = materialize(_small(materialize(_large(now), "large")), "small")
        before, state = state, _state(now)
        if state == before:
            break
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return nodes.unionByName(roots)
