"""Row numbering without funnelling rows through one task.

``row_number() OVER (ORDER BY ...)`` with no PARTITION BY puts every row in one task, and
``PARTITION BY day`` puts a hot day in one task.  Both are replaced by two distributed passes:

1. range-partition on (by..., order...) and sort inside each partition; tag every row with its
   partition id and a position that grows by one per row inside the partition; write that to
   the shared folder so the sampled range boundaries and the positions are fixed (stored as
   columns) for the second pass;
2. count rows per (partition, by...) -- at most ``partitions + groups`` rows -- turn the counts
   into per-group offsets with a window over that small table, and add offset + local index.

A hot group simply spans several range partitions.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailguard.session import materialize, stash


#: Rows that one task sorts or aggregates in memory.
TASK_ROWS = 500_000


def partitions_for(spark: SparkSession, rows: int) -> int | None:
    """How many partitions keep ``rows`` at ``TASK_ROWS`` each; None where the session's own number does."""
    n = math.ceil(rows / TASK_ROWS)
    return n if n > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def ranged_rows(df: DataFrame, order: Sequence, by: Sequence[str] = (), partitions: int | None = None) -> DataFrame:
    """The first pass: range partitions of (by..., order...), sorted, with ``_nr_part`` and ``_nr_pos``.  To be
    written before it is used: another run may draw other boundaries."""
    keys = [*by, *order]
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    return (ranged.sortWithinPartitions(*keys)
            .withColumn("_nr_part", F.spark_partition_id())
            .withColumn("_nr_pos", F.monotonically_increasing_id()))


def range_offsets(ranged: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per range partition and group of written :func:`ranged_rows`: rows before it, and its first position."""
    counts = ranged.groupBy("_nr_part", *by).agg(
        F.count(F.lit(1)).alias("_nr_cnt"), F.min("_nr_pos").alias("_nr_first"))
    w = Window.partitionBy(*by).orderBy("_nr_part") if by else Window.orderBy("_nr_part")
    return counts.withColumn(
        "_nr_off", F.sum("_nr_cnt").over(w.rowsBetween(Window.unboundedPreceding, -1))
    ).select("_nr_part", *by, F.coalesce(F.col("_nr_off"), F.lit(0)).alias("_nr_off"),
             "_nr_first")


def numbered(ranged: DataFrame, offsets: DataFrame, by: Sequence[str] = (), name: str = "txn_id") -> DataFrame:
    """The second pass: the row number from the stored position."""
    if not by:
        # at most one row per range partition: a proven bound, safe to broadcast
        offsets = F.broadcast(offsets)
    out = ranged.join(offsets, ["_nr_part", *by])
    return (out.withColumn(name, (F.col("_nr_off") + F.col("_nr_pos") - F.col("_nr_first") + 1)
                           .cast("bigint"))
            .drop("_nr_part", "_nr_pos", "_nr_off", "_nr_first"))


def number_rows(df: DataFrame, order: Sequence[str], by: Sequence[str] = (),
                name: str = "txn_id", partitions: int | None = None) -> DataFrame:
    """1-based dense row numbers over ``order`` within ``by`` groups.  ``order`` must be a
    total order (append tiebreak columns), otherwise numbers of tied rows are arbitrary."""
    # fix boundaries and positions once: later passes read the stored (_nr_part, _nr_pos)
    ranged = materialize(ranged_rows(df, order, by, partitions), "numbering")
    return numbered(ranged, range_offsets(ranged, by), by, name)


def prefix_sums(df: DataFrame, values: dict, by: Sequence[str], order: Sequence[str],
                partitions: int | None = None, cache: list | None = None) -> DataFrame:
    """Running sums of ``values`` (name -> column) over ``order`` within ``by`` groups, rows
    included, without putting a group in one task: the same two passes as :func:`number_rows`
    (range partitions bound every local window; per-(partition, group) totals become offsets).
    """
    by, order = list(by), list(order)
    keys = by + order
    for c in by:                # a null is no group
        df = df.where(F.col(c).isNotNull())
    src = df.withColumns({f"_ps_{k}": v for k, v in values.items()})
    ranged = src.repartitionByRange(partitions, *keys) if partitions else src.repartitionByRange(*keys)
    ranged = stash(ranged.withColumn("_ps_part", F.spark_partition_id()), "prefix", cache)
    local = Window.partitionBy("_ps_part", *by).orderBy(*order) \
                  .rowsBetween(Window.unboundedPreceding, 0)
    loc = ranged.withColumns({f"_ps_loc_{k}": F.sum(f"_ps_{k}").over(local) for k in values})
    tot = ranged.groupBy("_ps_part", *by).agg(*[F.sum(f"_ps_{k}").alias(f"_ps_tot_{k}") for k in values])
    w = Window.partitionBy(*by).orderBy("_ps_part")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select("_ps_part", *by, F.lag("_ps_part").over(w).alias("_ps_prev"),
                     *[F.sum(f"_ps_tot_{k}").over(before).alias(f"_ps_off_{k}") for k in values])
    # only a range partition's first group can go on from an earlier one: at most one row each, safe to broadcast
    off = off.where(F.col("_ps_prev").isNotNull()).drop("_ps_prev")
    out = loc.join(F.broadcast(off), ["_ps_part", *by], "left")
    out = out.withColumns({f"_ps_off_{k}": F.coalesce(F.col(f"_ps_off_{k}"), F.lit(0)) for k in values})

    def addend(name):
        # one digit narrower than DECIMAL(38, s): the sum of two then keeps its scale
        t = out.schema[name].dataType
        wide = isinstance(t, T.DecimalType) and t.precision == 38
        return F.col(name).cast(T.DecimalType(37, t.scale)) if wide else F.col(name)

    out = out.withColumns({k: addend(f"_ps_loc_{k}") + addend(f"_ps_off_{k}") for k in values})
    return out.drop("_ps_part", *[f"_ps_{k}" for k in values], *[f"_ps_loc_{k}" for k in values],
                    *[f"_ps_off_{k}" for k in values])
