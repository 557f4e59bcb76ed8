"""Source and sink queries: raw CSV, partitioned Parquet, staged day, daily CSV export."""

from __future__ import annotations

from pyspark.sql import functions as F

from trailguard.operators import ledger as L
from trailguard.plans import oracle_sql as O
from trailguard.plans.catalog import ANCHOR_DAY, register
from trailguard.session import scratch_path
from trailguard.sources import files
from trailguard.sources.ledger import partitioned_ledger_root, prepared_ledger

RAW_SQL = """SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, from_bank, from_account, to_bank,
       to_account, amount_received, receiving_currency, amount_paid, payment_currency,
       payment_format, is_laundering FROM ledger"""


@register("scan_csv_ledger", O.with_ledger(RAW_SQL))
def scan_csv_ledger(spark, sf_dir):
    """A1 A2 B1: ledger written in the raw file format (duplicate 'Account' headers repaired
    by the positional schema), read back and parsed."""
    path = scratch_path(spark, "raw-csv")
    files.raw_ledger_rows(prepared_ledger(spark, sf_dir)).write.option("header", True).csv(path)
    good, _ = files.read_ledger_csv(spark, path)
    return good.select(
        "ts", F.col("From Bank").alias("from_bank"), F.col("From Account").alias("from_account"),
        F.col("To Bank").alias("to_bank"), F.col("To Account").alias("to_account"),
        F.col("Amount Received").alias("amount_received"),
        F.col("Receiving Currency").alias("receiving_currency"),
        F.col("Amount Paid").alias("amount_paid"),
        F.col("Payment Currency").alias("payment_currency"),
        F.col("Payment Format").alias("payment_format"),
        F.col("Is Laundering").alias("is_laundering"))


PART_COLS = ["txn_id", "from_acc", "to_acc", "amount_paid", "ts", "run_date"]
PART_SQL = f"""SELECT {O.cols(PART_COLS)}, year(ts) AS year, month(ts) AS month, day(ts) AS day
FROM ledger"""


@register("scan_partitioned", O.with_ledger(PART_SQL))
def scan_partitioned(spark, sf_dir):
    """A3: the year/month/day layout read from its root with partition discovery."""
    df = files.read_partitioned(spark, partitioned_ledger_root(spark, sf_dir))
    return df.select(*PART_COLS, "year", "month", "day")


@register("scan_day_partition", O.with_ledger(PART_SQL + f" WHERE run_date = DATE '{ANCHOR_DAY}'"))
def scan_day_partition(spark, sf_dir):
    """One day by partition filter (pruned), partition columns kept."""
    df = files.read_partitioned(spark, partitioned_ledger_root(spark, sf_dir), ANCHOR_DAY)
    return df.select(*PART_COLS, "year", "month", "day")


@register("sink_partitioned_roundtrip", O.with_ledger(
    "SELECT year(ts) AS year, month(ts) AS month, day(ts) AS day, count(*) AS n, "
    "sum(txn_id) AS txn_id_sum FROM related GROUP BY 1, 2, 3", O.SUSPECTS, O.RELATED))
def sink_partitioned_roundtrip(spark, sf_dir):
    """A10: related transactions written by day with dynamic overwrite, then written again
    (a rerun) and read back: every day holds its rows exactly once."""
    led = prepared_ledger(spark, sf_dir)
    rel = L.with_date_parts(L.related_transactions(led, L.suspect_parties(led)))
    root = scratch_path(spark, "related-by-day")
    files.write_partitioned(rel, root, ["year", "month", "day"], ["ts", "txn_id"])
    files.write_partitioned(rel.where(F.col("run_date") == F.to_date(F.lit(ANCHOR_DAY))), root,
                            ["year", "month", "day"], ["ts", "txn_id"])
    back = spark.read.parquet(root)
    return back.groupBy("year", "month", "day").agg(
        F.count(F.lit(1)).alias("n"), F.sum("txn_id").cast("decimal(38,0)").cast("double").alias("txn_id_sum"))


@register("sink_staged_day", O.with_ledger(f"""
SELECT txn_id, from_bank, concat_ws('_', from_bank, from_account) AS from_account,
       to_bank, concat_ws('_', to_bank, to_account) AS to_account, amount_paid,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts
FROM ledger WHERE run_date = DATE '{ANCHOR_DAY}'"""))
def sink_staged_day(spark, sf_dir):
    """Key-transformed day staged under <root>/<run_date>, overwritten by a rerun."""
    day = files.read_partitioned(spark, partitioned_ledger_root(spark, sf_dir), ANCHOR_DAY)
    t = L.qualify_accounts(day).select("txn_id", "from_bank", "from_account", "to_bank",
                                       "to_account", "amount_paid", "ts")
    root = scratch_path(spark, "staged")
    files.write_staged_day(t, root, ANCHOR_DAY)
    path = files.write_staged_day(t, root, ANCHOR_DAY)
    return spark.read.parquet(path)


EXPORT_SCHEMA = ("txn_id BIGINT, from_acc STRING, to_acc STRING, amount_paid DOUBLE, "
                 "payment_format STRING, is_laundering INT, ts STRING")


@register("export_daily_csv", O.with_ledger("""
SELECT txn_id, from_acc, to_acc, amount_paid, payment_format, is_laundering,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.000Z') AS ts, strftime(ts, '%Y-%m-%d') AS date_str
FROM ledger"""))
def export_daily_csv(spark, sf_dir):
    """One CSV folder per day (ISO 'Z' timestamps as in the sample file), one job."""
    led = prepared_ledger(spark, sf_dir)
    out = led.select("txn_id", "from_acc", "to_acc", "amount_paid", "payment_format",
                     "is_laundering",
                     F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("ts"),
                     F.date_format("ts", "yyyy-MM-dd").alias("date_str"))
    root = scratch_path(spark, "daily-csv")
    files.export_daily_csv(out, root)
    return (spark.read.schema(EXPORT_SCHEMA + ", date_str STRING").option("header", True)
            .option("basePath", root).csv(root))
