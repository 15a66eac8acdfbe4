"""Connected components of a graph that no single task could hold.

Alternates two rounds, each a grouped minimum and a join: every node hands its larger neighbours to
the least node it knows, then every node hands its smaller ones. The edges end as stars around the
least node of each component, after a number of rounds that grows with the logarithm of the size.
Minima are combined before the shuffle and the joins may be split, so a hub of any degree is spread.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plumbline.llm.common import written


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
    )


def _large(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (
        both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    )


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def roots(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the edges ``u, v``: root is the least node it reaches.

    An edge from a node to itself counts as none; repeated edges count once.
    """
    now = written(edges.where("u <> v").distinct(), "edges")
    before = _state(now)
    while before[0]:
        now = written(_small(_large(now).distinct()).where("u <> v").distinct(), "edges")
        after = _state(now)
        if after == before:
            break
        before = after
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.union(stars.select(F.col("root").alias("node"), "root").distinct())
