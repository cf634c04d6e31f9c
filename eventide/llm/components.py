"""Connected components of an edge table by alternating large and small stars.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014): every
round links each node's larger (then smaller) neighbours to the smallest node
seen; the edges converge to one star per component.  All rounds are joins and
map-side-combined minima; nothing is gathered on the driver but one checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import keep, release, rekeyed


def _checksum(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)`` for every node of ``edges``; component = its smallest node.

    Self-loops and repeated edges are ignored, edges with a null end are
    dropped, an empty table gives an empty result.
    """
    e = edges.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v"))
    e = keep(e.where("u is not null and v is not null and u <> v").distinct(), "cc")
    state = _checksum(e)
    while state[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(
            rekeyed("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.join(low, both.u == low.k).where("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = keep(large, "cc")
        low = large.groupBy("u").agg(F.min("v").alias("m")).select(rekeyed("u").alias("k"), "m")
        near = large.join(low, large.u == low.k)
        nxt = near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            near.select("u", F.col("m").alias("v"))).distinct()
        nxt = keep(nxt, "cc")
        release(e, large)
        e, last = nxt, state
        state = _checksum(e)
        if state == last:
            break
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(e.select("v", "v").distinct().toDF("node", "component"))
