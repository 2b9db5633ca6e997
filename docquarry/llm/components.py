"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import discard, join_counted, kept


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """large: a node's larger neighbours go to its least neighbour (or itself). Small: it and its smaller ones do."""
    if large:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")).select("a", F.least("a", "m").alias("m"), "n")
    met = join_counted(both, least, ["a"])  # the centre of a large star is a hot key
    if large:
        return met.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
    return met.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """Per node of an edge between different nodes: node, component (its least node).

    Each round halves paths; its edges are written to the shared folder, and those of the round before removed. The
    counts and sums that are compared come from the table alone, so a round repeated after a failure changes nothing.
    """
    now = kept(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct(), "edges")
    state = lambda e: e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.coalesce(F.max(F.col("b") >= F.col("a")), F.lit(False))).first()
    before = state(now)
    if before[0]:
        for _ in range(most_rounds):
            large = kept(_star(now, True), "large")
            then = kept(_star(large, False), "stars")
            discard(now, large)
            now, after = then, state(then)
            if after == before and not after[2]:
                break
            before = after
        else:
            raise RuntimeError("components did not settle")
    out = now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
    out.kept_at = now.kept_at
    return out
