"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from passagecraft.functions.sizing import match
from passagecraft.llm.tables import stage


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``root``, the smallest id of its component, for every id in ``links`` (columns ``a``, ``b``).

    Alternates two steps until nothing changes: each node hands its smallest neighbour to
    its larger neighbours, then to its smaller ones. The number of rounds grows with the
    logarithm of the longest path. Each round is a table in the shared folder. Links from
    a node to itself only name the node; links with a null end are left out. The links of
    a node that very many others link to are spread over several tasks.
    """
    links = links.filter("a is not null and b is not null")
    nodes = stage(links.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "nodes")
    edges = stage(links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        edges = match(both, least, ["u"], ["v"]).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        edges = stage(edges, "large-star")
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        near = match(edges, least, ["u"], ["v"]).filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(near.union(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        if (now := _state(edges)) == state:
            break
        state = now
    return nodes.join(edges.select(F.col("u").alias("id"), F.col("v").alias("root")), "id", "left").select(
        "id", F.coalesce("root", "id").alias("root"))


def _state(edges: DataFrame) -> tuple:
    """Number of edges and a sum of their hashes: equal for equal sets of edges."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
