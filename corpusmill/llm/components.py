"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.session import materialized


def components(links: DataFrame) -> DataFrame:
    """``node`` and the smallest node it can reach, ``component``, for every node of the links (a, b).

    Each step joins a node's neighbours to their least member, a minimum that is combined before the shuffle, so a
    node with very many links is one row per task; the rows of such a node are split by the skew join. Each round is
    written to the shared folder. Links to itself and repeated links do no harm; no links give an empty table.
    """
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v")
    edges = both.select(F.least("u", "v").alias("lo"), F.greatest("u", "v").alias("hi")).distinct()
    edges = materialized(edges, "edges")
    seen = _fingerprint(edges)
    while True:
        pairs = edges.select(F.inline(F.array(F.struct(F.col("lo").alias("u"), F.col("hi").alias("v")),
                                              F.struct(F.col("hi").alias("u"), F.col("lo").alias("v")))))
        least = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Large star: larger neighbours move to the least node around; small star: so do the smaller ones and the node.
        large = pairs.where("v > u").join(least, "u").select(F.col("m").alias("lo"), F.col("v").alias("hi"))
        large = large.where("lo < hi").distinct()
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        moved = large.join(low, "hi").select(F.inline(F.array(F.struct(F.col("m").alias("lo"), F.col("lo").alias("hi")),
                                                              F.struct(F.col("m").alias("lo"), F.col("hi").alias("hi")))))
        edges = materialized(moved.where("lo < hi").distinct(), "edges")
        now = _fingerprint(edges)
        if now == seen:
            break
        seen = now
    # All edges now lead from a component's least node to each other member.
    heads = edges.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(heads)


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first()
    )
