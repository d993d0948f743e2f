"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import discard, saved


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u long, v long); root is the component's smallest node.

    Alternates the large-star and small-star steps until the edges stay as they
    are: every edge then points at its component's smallest node.  A step is a
    grouped minimum (partial aggregation) and a join on the node, so no node's
    neighbours ever meet in one task; AQE splits a hub's part of the join.  Each
    round is a table in the shared folder, the one before is deleted, and only
    a count and a checksum reach the driver.  NULL ends and loops are ignored;
    an empty edge table gives an empty result.
    """
    e = edges.where("u is not null and v is not null and u <> v")
    e = saved(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = None
    while True:
        now = e.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if now[0] == 0 or now == state:
            break
        state = now
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        nxt = small.where("u <> v").union(low.select("u", F.col("m").alias("v"))).distinct()
        nxt = saved(nxt, "edges")
        discard(e)
        e = nxt
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
