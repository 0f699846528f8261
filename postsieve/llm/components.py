"""Connected components by alternating stars over written edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsieve.llm.base import staged


def _signature(edges: DataFrame) -> tuple:
    got = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return got[0], got[1]


def components(edges: DataFrame) -> DataFrame:
    """Node and root of every node with an edge; the root is the smallest node.

    ``edges`` has u and v.  In each round every node hands the smallest node it
    knows to its larger neighbours, then to all smaller ones; a component's
    depth at least halves every two rounds.  Only minima are gathered per node,
    never its neighbours; each round is written, so no lineage grows.
    """
    now = staged(
        edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "edges",
    )
    seen = _signature(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        now = staged(
            small.unionByName(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct(), "edges"
        )
        after = _signature(now)
        if after == seen:
            break
        seen = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
