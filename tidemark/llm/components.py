"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import written


def _marked(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """Distinct edges written, with their number and a sum that tells them from other edges."""
    mark = Observation()
    edges = edges.where("u != v").distinct()
    total = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    table = written(edges.observe(mark, F.count("*").alias("n"), total.alias("total")), "links")
    return table, (mark.get["n"], mark.get["total"])


def components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(node, component) of each node in ``links`` (a, b): the smallest node that links lead to.

    ``known`` may have components of other links, which count as well. In turns every
    node's larger neighbours, then its smaller ones, are linked to its smallest
    neighbour, until nothing changes; each turn is a join that Spark can split where a
    node has very many neighbours, and is written to the shared folder.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    if known is not None:
        edges = edges.unionByName(known.select(F.col("node").alias("u"), F.col("component").alias("v")))
    edges, before = _marked(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.where("u != v").distinct(), "links")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("x"), "u", "m")
        small = small.select(F.col("x").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        edges, after = _marked(small)
        if after == before:  # every node points at the least one
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
