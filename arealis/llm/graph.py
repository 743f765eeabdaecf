"""Connected components of an edge table, by stars (no collection, no hot group in one task)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealis.llm.common import land, release


def _smallest(edges: DataFrame, largest_only: bool) -> DataFrame:
    """Each (u, v) with ``m``, the smallest of u and its neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return edges.join(least, "u").where("v > u" if largest_only else "true")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every end of an edge (a, b): the smallest id it is linked with.

    Alternates large-star and small-star until nothing changes; each round is written out, so a
    lost executor costs one round at most.
    """
    now = land(
        edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "links",
    )
    before, state = None, _state(now)
    while state != before:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _smallest(both, True).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        small = _smallest(large, False)
        small = small.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            small.select("u", F.col("m").alias("v"))
        )
        last, now = now, land(small.distinct(), "links")
        release(last)
        before, state = state, _state(now)
    ends = now.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return ends.unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def linked(found: DataFrame, edges: DataFrame) -> DataFrame:
    """The components ``found`` of earlier edges after further ones (a, b): (id, component).

    Only the components are linked anew, not their members, so there are few edges and rounds.
    """
    ends = [found.select(F.col("id").alias(end), F.col("component").alias(f"_{end}")) for end in "ab"]
    named = edges.join(ends[0], "a", "left").join(ends[1], "b", "left")
    new = components(named.select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b")))
    moved = new.select(F.col("id").alias("component"), F.col("component").alias("to"))
    known = found.join(moved, "component", "left").select("id", F.coalesce("to", "component").alias("component"))
    return known.unionByName(new.join(found.select("id"), "id", "left_anti"))
