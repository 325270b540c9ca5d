"""Connected components of a graph held as a DataFrame of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import Scratch


def components(edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """`node`, `label`: the smallest node reachable, for every node but those labels.

    `edges` has long columns `a` and `b`. Each round hangs the larger neighbours
    of every node on its smallest neighbour (large star), then its smaller ones
    (small star), until only stars around the smallest nodes are left. Rounds
    grow with the logarithm of the longest path; each is written to the shared
    folder, so that a lost executor costs one round. Neighbourhoods are never
    gathered: minima are aggregates and go back to the edges by a join. The result
    is the last round's table, which `scratch` deletes in the end.
    """
    high, low = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    held = Scratch(edges.sparkSession)
    now = held.staged(edges.where("a <> b").select(high, low).distinct(), "components")
    mark = _mark(now)
    while mark[0]:
        before, written = mark, Scratch(edges.sparkSession)
        now = written.staged(_hung(now), "components")
        held.__exit__()
        held, mark = written, _mark(now)
        if mark == before:
            break
    if scratch:
        scratch.paths += held.paths
    return now.select(F.col("u").alias("node"), F.col("v").alias("label"))


def _hung(edges: DataFrame) -> DataFrame:
    """One large star and one small star round over (u, v), u the larger node."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    nearest = both.groupBy("u").agg(F.min("v").alias("m"))
    large = (
        both.join(nearest, "u")
        .where(F.col("v") > F.col("u"))
        .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
    )
    nearest = large.groupBy("u").agg(F.min("v").alias("m"))
    smaller = large.join(nearest, "u").where("v <> m")
    return (
        smaller.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .union(nearest.select("u", F.col("m").alias("v")))
        .distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    """Tells whether a round changed any edge."""
    hashed = F.xxhash64("u", "v")
    return tuple(
        edges.agg(
            F.count(F.lit(1)),
            F.sum(hashed.bitwiseAND(F.lit((1 << 31) - 1))),
            F.sum(F.shiftrightunsigned(hashed, 33)),
        ).first()
    )
