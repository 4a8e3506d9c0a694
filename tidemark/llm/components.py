"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize


def _to_least(edges: DataFrame) -> DataFrame:
    """(v, u, m) with m the least of v and its neighbours; aggregate and join, so a hub can be split."""
    least = edges.groupBy("v").agg(F.min("u").alias("m"))
    return edges.join(least, "v").withColumn("m", F.least("v", "m"))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_003),
                           F.bit_xor(F.xxhash64("a", "b"))).first())


def star_round(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over ``edges(a, b)``; the components stay the same."""
    # large star: every greater neighbour goes to the least one
    both = edges.select(F.col("a").alias("v"), F.col("b").alias("u")).unionByName(
        edges.select(F.col("b").alias("v"), F.col("a").alias("u")))
    large = _to_least(both).where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u"))
    # small star: every lesser neighbour, and the vertex itself, goes to the least one
    least = _to_least(large)
    return (least.select(F.col("u").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select(F.col("v").alias("a"), F.col("m").alias("b"))).where("a <> b").distinct())


def downward(edges: DataFrame) -> DataFrame:
    """The edges without loops, from the greater to the lesser vertex."""
    return (edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(v, component): the least vertex of each vertex's component, for every vertex in ``edges(a, b)``.

    Each round is written to the shared checkpoint folder, so a lost executor costs one round."""
    now = materialize(downward(edges), name)
    before = _state(now)
    while before[0]:
        now = materialize(star_round(now), name)
        after = _state(now)
        if after == before:
            break
        before = after
    return (now.select(F.col("a").alias("v"), F.col("b").alias("component"))
            .unionByName(now.select(F.col("b").alias("v"), F.col("b").alias("component"))).distinct())
