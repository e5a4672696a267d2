"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from feedloom.llm.common import saved, spread_join


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = saved(both.groupBy("a").agg(F.min("b").alias("least"), F.count("*").alias("n")), "stars-least")
    return (
        spread_join(both, least, ["a"]).where("b > a")
        .select(F.col("b").alias("a"), F.least("a", "least").alias("b")).distinct()
    )


def _small(edges: DataFrame) -> DataFrame:
    edges = saved(edges, "stars-large")
    least = saved(edges.groupBy("a").agg(F.min("b").alias("least"), F.count("*").alias("n")), "stars-least")
    moved = spread_join(edges, least, ["a"]).where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(least.select("a", F.col("least").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).head()
    return tuple(row)


def stars(edges: DataFrame) -> DataFrame:
    """(a, b): each node of ``edges`` (a, b: long) with the least node of its component, itself left out.

    A round is written to the shared folder; the number of rounds grows with the
    logarithm of the longest chain. Links are summed up to a row a node in each task first, and the links of
    a node with very many stay where they are.
    """
    edges = saved(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    state = _state(edges)
    while state[0]:
        edges = saved(_small(_large(edges)), "stars")
        now = _state(edges)
        if now == state:
            break
        state = now
    return edges
