"""Connected components of a table of links, by rounds of star contractions.

Each round lets every node point its neighbours to the least node it knows: first the larger
neighbours of each node, then its smaller ones. Both are a minimum per node (reduced in the map
tasks) and a join back, so a node with very many links is never gathered; the number of rounds
grows with the logarithm of the longest path. Only a count and a checksum come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.llm.workspace import Workspace


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _joined_min(work: Workspace, near: DataFrame, name: str, held: list[DataFrame]) -> DataFrame:
    """``u, v, m``: each link with the least of ``u`` and all its neighbours; ``held`` takes what this reads."""
    near = work.keep(near, f"{name}-links")
    least = work.keep(near.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), f"{name}-least")
    held += [near, least]
    return near.join(least, "u")


def components(work: Workspace, links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id, component`` of every node in a link: the least node that can be reached from it.

    Null ends and links of a node with itself are left out; direction and repetition do not matter.
    """
    u, v = F.greatest(a, b), F.least(a, b)
    edges = links.filter(F.col(a) != F.col(b)).select(u.alias("u"), v.alias("v")).distinct()
    edges = work.keep(edges, "edges")
    before = _mark(edges)
    while before[0]:
        held = [edges]
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _joined_min(work, both, "large", held).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u != v").distinct()
        small = _joined_min(work, large, "small", held).select("u", "v", "m")
        own = small.select("u", F.col("m").alias("v"))
        others = small.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = work.keep(own.unionByName(others).distinct(), "edges")
        after = _mark(new)
        for table in held:
            work.drop(table)
        edges = new
        if after == before:
            break
        before = after
    members = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    out = work.keep(members.unionByName(roots), "components")
    work.drop(edges)
    return out
