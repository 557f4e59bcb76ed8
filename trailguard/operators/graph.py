"""The bank / account / transaction graph as plain tables.

banks(id) accounts(id) has(bank_id, account_id) txn_edges(src, dst, txn_id, ts, ..., run_date)

Upserts are expressed as keyed reductions (``max_by`` over a write sequence) and partition
overwrites, so replays and retries are idempotent and no graph server is involved.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailguard.functions.columns import date_text
from trailguard.operators.numbering import partitions_for
from trailguard.operators.windows import block_pairs, deal
from trailguard.session import materialize

EDGE_KEY = ["src", "dst", "run_date", "txn_id"]
EDGE_PROPS = ["ts", "amount_received", "receiving_currency", "amount_paid", "payment_currency",
              "payment_format"]


def graph_tables(ledger: DataFrame) -> dict[str, DataFrame]:
    """Node, membership and edge tables of a (qualified-key) ledger."""
    banks = (ledger.select(F.col("from_bank").alias("id"))
             .unionByName(ledger.select(F.col("to_bank").alias("id"))).distinct())
    accounts = (ledger.select(F.col("from_acc").alias("id"))
                .unionByName(ledger.select(F.col("to_acc").alias("id"))).distinct())
    has = (ledger.select(F.col("from_bank").alias("bank_id"), F.col("from_acc").alias("account_id"))
           .unionByName(ledger.select(F.col("to_bank").alias("bank_id"),
                                      F.col("to_acc").alias("account_id")))
           .distinct())
    edges = ledger.select(F.col("from_acc").alias("src"), F.col("to_acc").alias("dst"),
                          "txn_id", *EDGE_PROPS, "run_date")
    return {"banks": banks, "accounts": accounts, "has": has, "edges": edges}


def latest_edges(edges: DataFrame, key: Sequence[str] = EDGE_KEY, order: str = "batch_id") -> DataFrame:
    """One row per key, the properties of the write with the highest ``order`` (last SET
    wins).  A hash aggregate with map-side combine -- no sort of all rows, no window."""
    key = list(key)
    rest = [c for c in edges.columns if c not in key]
    agg = edges.groupBy(*key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_v"))
    return agg.select(*key, *[F.col(f"_v.{c}").alias(c) for c in rest])


def upsert_edges(batch: DataFrame, batch_id: int, root: str) -> None:
    """A17 sink for ``foreachBatch``: the micro-batch goes to its own ``batch_id`` partition,
    overwritten as a whole, so a retried batch replaces itself instead of appending twice."""
    (batch.withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").parquet(root))


def read_latest_edges(spark: SparkSession, root: str, key: Sequence[str] = EDGE_KEY) -> DataFrame:
    return latest_edges(spark.read.parquet(root), key, "batch_id")


def replace_day(edges: DataFrame, new: DataFrame, run_date: str) -> DataFrame:
    """A18, functional form: drop the day, then add its new rows."""
    d = F.to_date(F.lit(run_date))
    return edges.where(F.col("run_date") != d).unionByName(new.where(F.col("run_date") == d))


def delete_by_prefix(edges: DataFrame, prefix: str, col: str = "run_date") -> DataFrame:
    """Drop edges whose date text starts with ``prefix``."""
    return edges.where(~date_text(col).startswith(prefix))


def combine_edges(batch: DataFrame, stream: DataFrame, key: Sequence[str] = EDGE_KEY) -> DataFrame:
    """Batch-graph and stream-graph edges as one edge set; an edge in both counts once."""
    key = list(key)
    b = batch.select(*key, F.lit(True).alias("in_batch"), F.lit(False).alias("in_stream"))
    s = stream.select(*key, F.lit(False).alias("in_batch"), F.lit(True).alias("in_stream"))
    return b.unionByName(s).groupBy(*key).agg(F.max("in_batch").alias("in_batch"),
                                              F.max("in_stream").alias("in_stream"))


def edge_view(has: DataFrame, edges: DataFrame, from_date: str, to_date: str,
              limit: int | None = None) -> DataFrame:
    """Bank-HAS-Account-TRANSACTION-Account-HAS-Bank rows with the date in range."""
    e = edges.where((F.col("run_date") >= F.to_date(F.lit(from_date)))
                    & (F.col("run_date") <= F.to_date(F.lit(to_date))))
    h1 = has.select(F.col("bank_id").alias("from_bank_id"), F.col("account_id").alias("src"))
    h2 = has.select(F.col("bank_id").alias("to_bank_id"), F.col("account_id").alias("dst"))
    out = e.join(h1, "src").join(h2, "dst").select(
        "from_bank_id", "src", "txn_id", "run_date", "amount_paid", "payment_format", "dst",
        "to_bank_id")
    if limit is not None:
        out = out.orderBy("run_date", "txn_id", "src", "dst").limit(limit)
    return out


def expand_paths(edges: DataFrame, seeds: DataFrame, min_len: int = 2, max_len: int = 3,
                 days: int = 5) -> DataFrame:
    """The neighbourhood of each seed (account_id, anchor_date): the distinct (src, dst) on
    trails of min_len..max_len edges (edges distinct, all in the seed's window
    (anchor-days, anchor]) that start at the seed.

    Paths themselves are never built: each hop keeps the distinct accounts it reaches, so a hub
    costs its edges once per seed, not once per path.  Only a first hop needs a look ahead: it is
    on a trail of two when its end has an edge other than the one just used.

    The windows' pairs are written once and dealt by (account, day); only reached accounts (seed, anchor, x) are dealt
    to them.  Those are distinct, so what they add needs no distinct of the wider result, the seeds' own
    pairs apart.
    """
    if not (1 <= min_len <= 2 <= max_len):
        raise ValueError("min_len is 1 or 2, max_len 2 or more")
    anchors = seeds.select(F.col("anchor_date").alias("anchor")).distinct()
    n = partitions_for(edges.sparkSession, edges.count() * days)
    pairs = materialize(block_pairs(edges, anchors, days, True, n).select(F.col("src").alias("x"), "anchor", "dst", "n"), "pairs")
    place = ["x", "anchor"]
    pairs = deal(pairs, n, *place)
    s = deal(seeds.select(F.col("account_id").alias("x"), F.col("anchor_date").alias("anchor")), n, *place).distinct()
    first = s.join(pairs, place).select(F.col("x").alias("seed"), "anchor", F.col("dst").alias("x"), F.col("n").alias("n1"))
    ends = deal(first, n, *place)
    # a seed's own loop can be walked twice only if there are two
    free = (F.col("seed") != F.col("x")) | (F.col("n1") >= 2)
    if min_len == 2:
        out_n = pairs.groupBy(*place).agg(F.sum("n").alias("out_n"))
        goes_on = F.col("out_n") > F.when(F.col("seed") == F.col("x"), 1).otherwise(0)
        kept = ends.join(out_n, place).where(goes_on)
    else:
        kept = first
    front = ends.select("seed", *place, free.alias("free"))
    reached = front
    for _ in range(3, max_len + 1):
        step = front.join(pairs, place).where(F.col("free") | (F.col("dst") != F.col("x")))
        front = deal(step.select("seed", "anchor", F.col("dst").alias("x")), n, *place).distinct().withColumn("free", F.lit(True))
        reached = reached.unionByName(front)
    reached = materialize(deal(reached, n, *place).groupBy("seed", *place).agg(F.max("free").alias("free")), "reached")
    found = deal(reached, n, *place).join(pairs, place).where(F.col("free") | (F.col("dst") != F.col("x"))) \
        .select("seed", "anchor", F.col("x").alias("src"), "dst", (F.col("seed") == F.col("x")).alias("own"))
    own = kept.select("seed", "anchor", F.col("seed").alias("src"), F.col("x").alias("dst")) \
        .unionByName(found.where("own").drop("own")).distinct()
    return own.unionByName(found.where("not own").drop("own")).select(
        F.col("seed").alias("account_id"), F.col("anchor").alias("anchor_date"), "src", "dst")
