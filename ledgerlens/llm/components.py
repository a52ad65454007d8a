"""Connected components of a distributed edge table.

Alternating large-star and small-star steps: each is a grouped minimum and one
join, so no node's neighbours ever meet in one row, a hub is pre-aggregated on
the map side, and its join partition can be split at run time.  Every round is
written to the shared scratch folder; the driver compares two numbers, and where
they are equal a join makes sure that no edge has changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import drop_scratch, scratch


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (
        both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    ).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` have ``u > v``; each u and its neighbours get the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    rest = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.union(least.select("u", F.col("m").alias("v"))).distinct()


def _print_of(edges: DataFrame) -> tuple:
    """Rows, and a sum of their hashes."""
    return tuple(edges.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for each node of ``edges`` (columns u, v); the root is the least node.

    Loops and repeated edges are allowed; no edges give no rows.
    """
    current = scratch(
        edges.where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "edges",
    )
    before = _print_of(current)
    while before[0]:
        following = scratch(_small_star(_large_star(current)), "edges")
        after = _print_of(following)
        # equal counts and hashes say that a comparison is worth it
        done = after == before and following.join(current, ["u", "v"], "left_anti").isEmpty()
        drop_scratch(current)
        current, before = following, after
        if done:
            break
    roots = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(
        roots.select(F.col("root").alias("node"), "root").distinct()
    )
