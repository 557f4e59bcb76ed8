"""Multi-day look-back windows as one plan.

A row dated ``day`` belongs to the windows of the anchors ``day .. day+days-1`` (window
``anchor-days < date <= anchor``) or ``day+1 .. day+days-1`` when the anchor day itself is
excluded.  Rows are exploded to those anchors (fan-out at most ``days``) and semi-joined to
the anchor set, so every anchor is computed in the same job -- no loop over collected dates.
Aggregate to one row per (key, day) *before* exploding so the fan-out applies to aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailguard.functions.columns import WINDOW_DAYS
from trailguard.operators.numbering import partitions_for


def anchor_dates(df: DataFrame, date_col: str = "run_date") -> DataFrame:
    """Distinct days present in ``df`` (D5), as column ``anchor``."""
    return df.select(F.col(date_col).alias("anchor")).distinct()


#: A block of anchors is so many windows long: rows go to one block, or to two near its end.
BLOCK_WINDOWS = 4


def block_of(date, days: int = WINDOW_DAYS) -> F.Column:
    """The block of an anchor day."""
    return F.floor(F.unix_date(date) / F.lit(BLOCK_WINDOWS * days)).cast("int")


def deal(df: DataFrame, partitions: int | None, *keys) -> DataFrame:
    """``df`` dealt by ``keys`` over ``partitions`` (the session's number if None)."""
    return df.repartition(partitions, *keys) if partitions else df.repartition(*keys)


def to_blocks(df: DataFrame, date_col: str = "run_date", days: int = WINDOW_DAYS) -> DataFrame:
    """Add column ``_block``: one row per block of anchors whose windows can contain ``date_col``.  Dealt by
    (key, ``_block``), all rows of a window lie in one partition before they are spread over
    their anchors, a hot key lies in as many as there are blocks, and only 1/BLOCK_WINDOWS rows go twice."""
    d = F.col(date_col)
    return df.withColumn("_block", F.explode(F.sequence(block_of(d, days), block_of(F.date_add(d, days - 1), days))))


def to_anchors(df: DataFrame, anchors: DataFrame | None, date_col: str = "run_date",
               days: int = WINDOW_DAYS, include_anchor: bool = True) -> DataFrame:
    """Add column ``anchor``: one row per anchor whose window contains ``date_col``."""
    first = 0 if include_anchor else 1
    if days - 1 < first:
        raise ValueError("window too short")
    d = F.col(date_col)
    out = df.withColumn("anchor", F.explode(F.sequence(F.date_add(d, first),
                                                       F.date_add(d, days - 1))))
    if anchors is None:
        anchors = anchor_dates(df, date_col)
    # days are a few ten thousand at most, whatever the number of rows; a planner that takes their
    # estimated size from the rows would shuffle all exploded rows by day
    return out.join(F.broadcast(anchors.select("anchor").distinct()), "anchor", "left_semi")


def block_pairs(edges: DataFrame, anchors: DataFrame | None = None, days: int = WINDOW_DAYS,
                include_anchor: bool = True, partitions: int | None = None) -> DataFrame:
    """(src, dst, anchor, _block) -> n, the parallel-edge count inside the window of each anchor.  Edges are shuffled
    once; the result lies by (src, ``_block``), the anchor's block."""
    anchors = anchors if anchors is not None else anchor_dates(edges)
    n = partitions or partitions_for(edges.sparkSession, edges.count() * days)
    dealt = deal(to_blocks(edges.select("src", "dst", "run_date"), "run_date", days), n, "src", "_block")
    per_day = dealt.groupBy("src", "_block", "run_date", "dst").agg(F.count(F.lit(1)).alias("n"))
    w = to_anchors(per_day, anchors, "run_date", days, include_anchor).where(block_of("anchor", days) == F.col("_block"))
    return w.groupBy("src", "_block", "anchor", "dst").agg(F.sum("n").cast("bigint").alias("n"))
