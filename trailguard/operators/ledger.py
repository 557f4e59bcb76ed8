"""Ledger-level operators: suspects, related transactions, labels, keys, previews.

B2-B4, B10-B12, C1, C2, D1-D4, D13, E2, F1, F4, G1, G2, H2-H8.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailguard.functions.columns import qualify_keep_nulls, ts_text, date_text
from trailguard.operators.numbering import number_rows


def suspect_parties(ledger: DataFrame, label_col: str = "is_laundering") -> DataFrame:
    """Distinct (bank, account) on either side of a labelled transaction."""
    s = ledger.where(F.col(label_col) == 1)
    return (s.select(F.col("from_bank").alias("bank"), F.col("from_account").alias("account"))
            .unionByName(s.select(F.col("to_bank").alias("bank"), F.col("to_account").alias("account")))
            .distinct())


def match_side(ledger: DataFrame, suspects: DataFrame, side: str) -> DataFrame:
    """Transactions whose ``side`` ('from' or 'to') party is a suspect, inner join."""
    s = suspects.select(F.col("bank").alias("_sb"), F.col("account").alias("_sa"))
    j = ledger.join(s, (F.col(f"{side}_bank") == F.col("_sb")) & (F.col(f"{side}_account") == F.col("_sa")))
    return j.withColumnsRenamed({"_sb": "bank", "_sa": "account"})


def related_transactions(ledger: DataFrame, suspects: DataFrame) -> DataFrame:
    """Transactions touching a suspect, one row each; the sender match wins (Q1).

    Instead of union + dropDuplicates(txn_id) (a shuffle of every match on txn_id), both
    sides are probed with a left join on the distinct suspect keys, which keeps the ledger's
    partitioning and needs no dedupe: the suspects table is unique per (bank, account).
    """
    sf = suspects.select(F.col("bank").alias("_fb"), F.col("account").alias("_fa"),
                         F.lit(True).alias("_fm"))
    st = suspects.select(F.col("bank").alias("_tb"), F.col("account").alias("_ta"),
                         F.lit(True).alias("_tm"))
    j = (ledger
         .join(sf, (F.col("from_bank") == F.col("_fb")) & (F.col("from_account") == F.col("_fa")), "left")
         .join(st, (F.col("to_bank") == F.col("_tb")) & (F.col("to_account") == F.col("_ta")), "left")
         .where(F.col("_fm").isNotNull() | F.col("_tm").isNotNull()))
    sender = F.col("_fm").isNotNull()
    return j.withColumns({
        "bank": F.when(sender, F.col("from_bank")).otherwise(F.col("to_bank")),
        "account": F.when(sender, F.col("from_account")).otherwise(F.col("to_account")),
    }).drop("_fb", "_fa", "_fm", "_tb", "_ta", "_tm")


def label_counts(df: DataFrame, label_col: str = "is_laundering") -> DataFrame:
    """Rows per label."""
    return df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))


def split_by_label(df: DataFrame, label_col: str = "is_laundering") -> tuple[DataFrame, DataFrame]:
    """(label = 1, label = 0)."""
    return df.where(F.col(label_col) == 1), df.where(F.col(label_col) == 0)


def with_date_parts(df: DataFrame, ts_col: str = "ts") -> DataFrame:
    """H2: year / month / day columns used as the Hive partition layout."""
    ts = F.col(ts_col)
    return df.withColumns({"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts)})


def number_within_day(df: DataFrame, name: str = "txn_id") -> DataFrame:
    """Per-day numbering by (ts, txn_id); the global id is kept as ``global_txn_id``."""
    d = with_date_parts(df).withColumnRenamed("txn_id", "global_txn_id")
    return number_rows(d, ["ts", "global_txn_id"], by=["year", "month", "day"], name=name)


def qualify_accounts(df: DataFrame) -> DataFrame:
    """Overwrite both account columns with ``<bank>_<account>`` (concat_ws semantics)."""
    return df.withColumns({
        "from_account": qualify_keep_nulls("from_bank", "from_account"),
        "to_account": qualify_keep_nulls("to_bank", "to_account"),
    })


WIRE_COLUMNS = ["from_bank", "from_acc", "to_bank", "to_acc", "txn_id", "amount_received",
                "receiving_currency", "amount_paid", "payment_currency", "payment_format", "ts",
                "run_date"]


def wire_records(ledger: DataFrame) -> DataFrame:
    """The stream message -- bare accounts, ts and run_date as text."""
    return ledger.select(
        F.col("from_bank").cast("bigint").alias("from_bank"),
        F.col("from_account").alias("from_acc"),
        F.col("to_bank").cast("bigint").alias("to_bank"),
        F.col("to_account").alias("to_acc"),
        F.col("txn_id").cast("bigint").alias("txn_id"),
        F.col("amount_received").cast("double").alias("amount_received"),
        "receiving_currency",
        F.col("amount_paid").cast("double").alias("amount_paid"),
        "payment_currency", "payment_format",
        ts_text("ts").alias("ts"),
        date_text("run_date").alias("run_date"))


def preview(df: DataFrame, order: Sequence[str], n: int = 20) -> DataFrame:
    """deterministic first-n (distributed top-k, no global sort of all rows)."""
    return df.orderBy(*order).limit(n)


def partition_profile(df: DataFrame) -> DataFrame:
    """Rows per physical partition."""
    return df.groupBy(F.spark_partition_id().alias("partition_id")).agg(
        F.count(F.lit(1)).alias("rows"))
