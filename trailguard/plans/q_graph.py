"""Graph-table queries: node/edge tables, upserts, reload, delete, edge view, paths, snapshot."""

from __future__ import annotations

from pyspark.sql import functions as F

from trailguard.operators import features, graph
from trailguard.plans import oracle_sql as O
from trailguard.plans.catalog import (ANCHOR_DAY, DELETE_PREFIX, SNAPSHOT_DAY, STREAM_FROM,
                                      STREAM_TO, register)
from trailguard.session import scratch_path
from trailguard.sources.files import write_partitioned
from trailguard.sources.ledger import memo_path, prepared_ledger


def _tables(spark, sf_dir):
    return graph.graph_tables(prepared_ledger(spark, sf_dir))


EDGE_SQL_COLS = ("src, dst, txn_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, amount_received, "
                 "receiving_currency, amount_paid, payment_currency, payment_format, "
                 "strftime(run_date, '%Y-%m-%d') AS run_date")
GEDGES = """gedges AS (
  SELECT from_acc AS src, to_acc AS dst, txn_id, ts, amount_received, receiving_currency,
         amount_paid, payment_currency, payment_format, run_date FROM ledger)"""


@register("graph_banks", O.with_ledger(
    "SELECT from_bank AS id FROM ledger UNION SELECT to_bank FROM ledger"))
def graph_banks(spark, sf_dir):
    return _tables(spark, sf_dir)["banks"]


@register("graph_accounts", O.with_ledger(
    "SELECT from_acc AS id FROM ledger UNION SELECT to_acc FROM ledger"))
def graph_accounts(spark, sf_dir):
    return _tables(spark, sf_dir)["accounts"]


@register("graph_has", O.with_ledger(
    "SELECT from_bank AS bank_id, from_acc AS account_id FROM ledger "
    "UNION SELECT to_bank, to_acc FROM ledger"))
def graph_has(spark, sf_dir):
    return _tables(spark, sf_dir)["has"]


@register("graph_edges", O.with_ledger(f"SELECT {EDGE_SQL_COLS} FROM gedges", GEDGES))
def graph_edges(spark, sf_dir):
    return graph.latest_edges(_tables(spark, sf_dir)["edges"].withColumn("batch_id", F.lit(0))) \
                .drop("batch_id")


@register("edge_upsert_latest", O.with_ledger(f"""
SELECT {EDGE_SQL_COLS},
       CASE WHEN run_date BETWEEN DATE '{STREAM_FROM}' AND DATE '{STREAM_TO}' THEN 1 ELSE 0 END
         AS batch_id
FROM gedges""", GEDGES))
def edge_upsert_latest(spark, sf_dir):
    """Micro-batch 0 delivers every edge, micro-batch 1 re-delivers the stream slice and
    is then retried; the store keeps one row per key, from the latest batch."""
    edges = _tables(spark, sf_dir)["edges"]
    root = scratch_path(spark, "edge-store")
    graph.upsert_edges(edges, 0, root)
    redelivery = edges.where(F.col("run_date").between(F.to_date(F.lit(STREAM_FROM)),
                                                       F.to_date(F.lit(STREAM_TO))))
    graph.upsert_edges(redelivery, 1, root)
    graph.upsert_edges(redelivery, 1, root)          # retried batch: replaces itself
    return graph.read_latest_edges(spark, root)


@register("graph_reload_day", O.with_ledger(f"""
SELECT src, dst, txn_id, strftime(run_date, '%Y-%m-%d') AS run_date, amount_paid,
       CASE WHEN run_date = DATE '{ANCHOR_DAY}' THEN 'reload' ELSE 'initial' END AS load
FROM gedges""", GEDGES))
def graph_reload_day(spark, sf_dir):
    """The batch edge store is partitioned by run_date (written once per session);
    reloading a day overwrites exactly that partition (dynamic partition overwrite) and leaves
    every other day untouched.  Reloading twice gives the same store."""
    edges = _tables(spark, sf_dir)["edges"].select("src", "dst", "txn_id", "run_date", "amount_paid")

    def build(path):
        write_partitioned(edges.withColumn("load", F.lit("initial")), path, ["run_date"],
                          ["src", "txn_id"])
    root = memo_path(spark, sf_dir, "edge-store", build)
    day = edges.where(F.col("run_date") == F.to_date(F.lit(ANCHOR_DAY))).withColumn("load", F.lit("reload"))
    write_partitioned(day, root, ["run_date"], ["src", "txn_id"])
    return spark.read.parquet(root).withColumn("run_date", F.col("run_date").cast("date"))


@register("graph_delete_prefix", O.with_ledger(f"""
SELECT {EDGE_SQL_COLS} FROM gedges
WHERE NOT starts_with(strftime(run_date, '%Y-%m-%d'), '{DELETE_PREFIX}')""", GEDGES))
def graph_delete_prefix(spark, sf_dir):
    return graph.delete_by_prefix(_tables(spark, sf_dir)["edges"], DELETE_PREFIX)


@register("edge_view", O.with_ledger(f"""
SELECT l.from_bank AS from_bank_id, l.from_acc AS src, l.txn_id,
       strftime(l.run_date, '%Y-%m-%d') AS run_date, l.amount_paid, l.payment_format,
       l.to_acc AS dst, l.to_bank AS to_bank_id
FROM ledger l
WHERE l.run_date BETWEEN DATE '{STREAM_FROM}' AND DATE '{ANCHOR_DAY}'
ORDER BY l.run_date, l.txn_id, l.from_acc, l.to_acc LIMIT 200"""))
def edge_view(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return graph.edge_view(t["has"], t["edges"], STREAM_FROM, ANCHOR_DAY, limit=200)


@register("combined_edges", O.with_ledger(f"""
SELECT src, dst, strftime(run_date, '%Y-%m-%d') AS run_date, txn_id, true AS in_batch,
       run_date BETWEEN DATE '{STREAM_FROM}' AND DATE '{STREAM_TO}' AS in_stream
FROM gedges""", GEDGES))
def combined_edges(spark, sf_dir):
    """Batch graph (every day) united with the stream graph (the stream slice)."""
    e = _tables(spark, sf_dir)["edges"]
    s = e.where(F.col("run_date").between(F.to_date(F.lit(STREAM_FROM)), F.to_date(F.lit(STREAM_TO))))
    return graph.combine_edges(e, s)


def event_seeds(ledger):
    """Every sender with the days of its events."""
    return ledger.select(F.col("from_acc").alias("account_id"), F.col("run_date").alias("anchor_date")).distinct()


PATHS = """seeds AS (SELECT DISTINCT from_acc AS account_id, run_date AS anchor FROM ledger),
pw AS (
  SELECT s.account_id AS seed, s.anchor, e.* FROM seeds s JOIN edges e
    ON e.run_date > s.anchor - 5 AND e.run_date <= s.anchor),
trails2 AS (
  SELECT e1.seed, e1.anchor, e1.src AS a, e1.dst AS b, e2.dst AS c, e1.txn_id AS t1, e2.txn_id AS t2
  FROM pw e1 JOIN pw e2 ON e2.seed = e1.seed AND e2.anchor = e1.anchor AND e2.src = e1.dst
  WHERE e1.src = e1.seed AND e1.txn_id <> e2.txn_id),
trails3 AS (
  SELECT t.seed, t.anchor, t.c AS a, e3.dst AS b FROM trails2 t JOIN pw e3
    ON e3.seed = t.seed AND e3.anchor = t.anchor AND e3.src = t.c
  WHERE e3.txn_id <> t.t1 AND e3.txn_id <> t.t2),
near AS (
  SELECT seed, anchor, a, b FROM trails2 UNION SELECT seed, anchor, b, c FROM trails2
  UNION SELECT seed, anchor, a, b FROM trails3)"""


@register("path_expand", O.with_ledger(
    "SELECT seed AS account_id, strftime(anchor, '%Y-%m-%d') AS anchor_date, a AS src, b AS dst FROM near",
    PATHS))
def path_expand(spark, sf_dir):
    """Edges on 2..3-hop trails from every sender, window of its event day."""
    led = prepared_ledger(spark, sf_dir)
    return graph.expand_paths(features.edges_of(led), event_seeds(led), 2, 3)


@register("feature_snapshot_upsert", O.with_ledger(
    """SELECT coalesce(n.account_id, o.account_id) AS account_id,
       coalesce(n.feature_day_tx_count, o.feature_day_tx_count) AS feature_day_tx_count,
       coalesce(n.feature_day_avg_amount, o.feature_day_avg_amount) AS feature_day_avg_amount,
       coalesce(n.feature_day_unique_targets, o.feature_day_unique_targets) AS feature_day_unique_targets,
       coalesce(n.feature_round_trip_count, o.feature_round_trip_count) AS feature_round_trip_count,
       coalesce(n.feature_round_trip_avg_len, o.feature_round_trip_avg_len) AS feature_round_trip_avg_len,
       coalesce(n.feature_small_tx_count, o.feature_small_tx_count) AS feature_small_tx_count
FROM snap_new n FULL OUTER JOIN snap_old o ON n.account_id = o.account_id""",
    O.snapshot_sql("snap_old", SNAPSHOT_DAY), O.snapshot_sql("snap_new", ANCHOR_DAY)))
def feature_snapshot_upsert(spark, sf_dir):
    """Snapshot of SNAPSHOT_DAY, then the enrichers of ANCHOR_DAY upserted into it."""
    e = features.edges_of(prepared_ledger(spark, sf_dir))
    old = features.account_snapshot(e, SNAPSHOT_DAY)
    new = features.account_snapshot(e, ANCHOR_DAY)
    return features.merge_snapshot(old, new)
