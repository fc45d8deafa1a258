"""Connected components of a distributed graph by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratework.llm.common import Scratch


def stars(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (u, v) that is not its component's root.

    The root is the smallest node. Every round points the larger neighbours of a node at
    its smallest neighbour, then the smaller ones, until nothing changes: logarithmically
    many rounds, each written out. No node's neighbours are gathered in one task; the
    smallest neighbour is an aggregate with map-side reduction.
    """
    links = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    links = scratch.stage(links, "links-0")
    seen, turn = None, 0
    while True:
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state[0] == 0 or tuple(state) == seen:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen, turn = tuple(state), turn + 1
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = scratch.stage(large, f"large-{turn}")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = scratch.stage(least.select("u", F.col("m").alias("v")).union(small).distinct(), f"links-{turn}")
        scratch.drop(f"large-{turn}")
        scratch.drop(f"links-{turn - 1}")
