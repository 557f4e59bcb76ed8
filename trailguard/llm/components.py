"""Connected components of an edge list by alternating large and small stars, on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailguard.llm.common import materialize


def _fingerprint(edges: DataFrame):
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v: bigint) -> (u, v): every node of an edge with the smallest node it reaches.

    Large star: each node's larger neighbours are linked to its smallest neighbour; small star:
    its smaller neighbours and itself are.  Minima are pre-aggregated and joined back, so a node
    with very many neighbours is split by the join, never gathered.  Each round is written to
    the shared folder.  Ends when the edges form stars.
    """
    e = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = materialize(e, "edges")
    seen = _fingerprint(e)
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        linked = large.join(low, "u")
        small = (linked.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(linked.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        e = materialize(small, "edges")
        now = _fingerprint(e)
        if now == seen:
            return e
        seen = now
