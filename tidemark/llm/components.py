"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import staged, workspace


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """One contraction of (u, v): every node hands its neighbours (the larger ones, or the
    smaller ones and itself) to the smallest node it knows."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if not larger:
        both = both.filter(F.col("v") < F.col("u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(
        "u", F.least("u", "m").alias("m"))
    joined = both.join(least, "u")
    if larger:
        out = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"),
                                                            F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return out.filter(F.col("u") != F.col("v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each linked node reaches, from links
    (a, b).  Large-star and small-star steps alternate until every node points at its
    component's smallest; each step is written out, and only its size and checksum reach
    the driver."""
    with workspace(links.sparkSession, "star") as stage:
        edges = stage(links.filter(F.col("a") != F.col("b")).select(
            F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")

        def state(df: DataFrame) -> tuple:
            return tuple(df.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")),
                                                         F.lit(0))).first())

        before = state(edges)
        while before[0]:
            edges = stage(_star(_star(edges, True), False), "links")
            now = state(edges)
            if now == before:
                break
            before = now
        roots = edges.select(F.col("v").alias("u")).distinct()
        return staged(edges.select("u", "v").unionByName(roots.select("u", F.col("u").alias("v")))
                      .toDF("node", "component"), "components")
