"""Ledger preparation queries: numbering, suspects, related transactions, projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from trailguard.functions.columns import date_text, ts_text
from trailguard.operators import ledger as L
from trailguard.plans import oracle_sql as O
from trailguard.plans.catalog import register
from trailguard.sources.ledger import ledger_source, number_ledger, prepared_ledger

ALL = O.LEDGER_COLS


@register("global_txn_id", O.with_ledger(f"SELECT {O.cols()} FROM ledger"))
def global_txn_id(spark, sf_dir):
    """E1, computed afresh (not read from the prepared table)."""
    return number_ledger(ledger_source(spark, sf_dir))


@register("suspect_parties", O.with_ledger("SELECT * FROM sus", O.SUSPECTS))
def suspect_parties(spark, sf_dir):
    return L.suspect_parties(prepared_ledger(spark, sf_dir))


@register("suspect_from_match", O.with_ledger(f"""
SELECT {O.cols(alias='l')}, s.bank, s.account FROM ledger l
JOIN sus s ON l.from_bank = s.bank AND l.from_account = s.account""", O.SUSPECTS))
def suspect_from_match(spark, sf_dir):
    led = prepared_ledger(spark, sf_dir)
    return L.match_side(led, L.suspect_parties(led), "from")


@register("suspect_to_match", O.with_ledger(f"""
SELECT {O.cols(alias='l')}, s.bank, s.account FROM ledger l
JOIN sus s ON l.to_bank = s.bank AND l.to_account = s.account""", O.SUSPECTS))
def suspect_to_match(spark, sf_dir):
    led = prepared_ledger(spark, sf_dir)
    return L.match_side(led, L.suspect_parties(led), "to")


def _related(spark, sf_dir):
    led = prepared_ledger(spark, sf_dir)
    return L.related_transactions(led, L.suspect_parties(led))


@register("related_transactions", O.with_ledger(
    f"SELECT {O.cols()}, bank, account FROM related", O.SUSPECTS, O.RELATED))
def related_transactions(spark, sf_dir):
    return _related(spark, sf_dir)


@register("related_count", O.with_ledger(
    "SELECT count(*) AS n FROM related", O.SUSPECTS, O.RELATED))
def related_count(spark, sf_dir):
    return _related(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"))


@register("label_counts", O.with_ledger(
    "SELECT is_laundering, count(*) AS n FROM ledger GROUP BY 1"))
def label_counts(spark, sf_dir):
    return L.label_counts(prepared_ledger(spark, sf_dir))


@register("related_label_counts", O.with_ledger(
    "SELECT is_laundering, count(*) AS n FROM related GROUP BY 1", O.SUSPECTS, O.RELATED))
def related_label_counts(spark, sf_dir):
    return L.label_counts(_related(spark, sf_dir))


@register("daily_txn_id", O.with_ledger("""
SELECT txn_id AS global_txn_id,
       row_number() OVER (PARTITION BY year(ts), month(ts), day(ts) ORDER BY ts, txn_id) AS txn_id,
       year(ts) AS year, month(ts) AS month, day(ts) AS day, from_acc, to_acc,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, bank, account
FROM related""", O.SUSPECTS, O.RELATED))
def daily_txn_id(spark, sf_dir):
    d = L.number_within_day(_related(spark, sf_dir))
    return d.select("global_txn_id", "txn_id", "year", "month", "day", "from_acc", "to_acc",
                    "ts", "bank", "account")


@register("label_split", O.with_ledger("""
SELECT CASE WHEN is_laundering = 1 THEN 'positive' ELSE 'negative' END AS split,
       txn_id, is_laundering FROM ledger WHERE is_laundering IN (0, 1)"""))
def label_split(spark, sf_dir):
    pos, neg = L.split_by_label(prepared_ledger(spark, sf_dir))
    cols = ["txn_id", "is_laundering"]
    return pos.select(F.lit("positive").alias("split"), *cols).unionByName(
        neg.select(F.lit("negative").alias("split"), *cols))


@register("key_transform", O.with_ledger("""
SELECT txn_id, from_bank, concat_ws('_', from_bank, from_account) AS from_account,
       to_bank, concat_ws('_', to_bank, to_account) AS to_account,
       concat(from_bank, '_', from_account) AS account_id
FROM ledger"""))
def key_transform(spark, sf_dir):
    led = prepared_ledger(spark, sf_dir)
    q = L.qualify_accounts(led.withColumn("account_id", F.col("from_acc")))
    return q.select("txn_id", "from_bank", "from_account", "to_bank", "to_account", "account_id")


@register("date_parts", O.with_ledger("""
SELECT txn_id, year(ts) AS year, month(ts) AS month, dayofmonth(ts) AS day,
       strftime(CAST(ts AS DATE), '%Y-%m-%d') AS date,
       strftime(ts, '%Y-%m-%d') AS date_str,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text,
       strftime(run_date - 5, '%Y-%m-%d') AS from_date,
       year(run_date) AS run_year, month(run_date) AS run_month, day(run_date) AS run_day
FROM ledger"""))
def date_parts(spark, sf_dir):
    """H2-H7: year/month/day, to_date, date_format, date minus 5 days, ISO date parts."""
    led = prepared_ledger(spark, sf_dir)
    iso = F.to_date(date_text("run_date"))
    return led.select(
        "txn_id", F.year("ts").alias("year"), F.month("ts").alias("month"),
        F.dayofmonth("ts").alias("day"), F.to_date("ts").alias("date"),
        F.date_format("ts", "yyyy-MM-dd").alias("date_str"), ts_text("ts").alias("ts_text"),
        F.date_sub("run_date", 5).alias("from_date"),
        F.year(iso).alias("run_year"), F.month(iso).alias("run_month"),
        F.dayofmonth(iso).alias("run_day"))


WIRE_SQL = """SELECT from_bank, from_account AS from_acc, to_bank, to_account AS to_acc, txn_id,
       amount_received, receiving_currency, amount_paid, payment_currency, payment_format,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, strftime(run_date, '%Y-%m-%d') AS run_date
FROM ledger"""


@register("wire_projection", O.with_ledger(WIRE_SQL))
def wire_projection(spark, sf_dir):
    return L.wire_records(prepared_ledger(spark, sf_dir))


@register("preview_topn", O.with_ledger(
    f"SELECT {O.cols()} FROM ledger ORDER BY ts, txn_id LIMIT 20"))
def preview_topn(spark, sf_dir):
    return L.preview(prepared_ledger(spark, sf_dir), ["ts", "txn_id"], 20)


@register("ordered_day", O.with_ledger(f"""
SELECT txn_id, concat_ws('_', from_bank, from_account) AS from_account,
       concat_ws('_', to_bank, to_account) AS to_account, amount_paid,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, strftime(run_date, '%Y-%m-%d') AS run_date
FROM ledger"""))
def ordered_day(spark, sf_dir):
    """staged days in (run_date, ts, txn_id) order; range-partitioned, so a hot day
    spans several tasks."""
    q = L.qualify_accounts(prepared_ledger(spark, sf_dir))
    return q.orderBy("run_date", "ts", "txn_id").select(
        "txn_id", "from_account", "to_account", "amount_paid", "ts", "run_date")


@register("partition_profile")
def partition_profile(spark, sf_dir):
    """D13 (rows-only: counts depend on the physical layout)."""
    return L.partition_profile(prepared_ledger(spark, sf_dir))
