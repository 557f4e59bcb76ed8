"""The transaction ledger built from the driver tables (FIXTURES F7) and its prepared form.

``ledger_source`` is the un-numbered view; ``prepared_ledger`` numbers it globally (E1) and
stores it once per session as a Parquet table in the shared folder, sorted by time so that
date filters skip row groups.  Every query reads that table (the reference's prepared ledger M2).

Shuffled and stored are only the columns that the others are computed from (``ledger_parts``); texts such as the
account keys, and the row number from its range's offset, are computed by whoever reads them.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailguard.functions.columns import account_key
from trailguard.operators.numbering import number_rows, numbered, partitions_for, range_offsets, ranged_rows
from trailguard.session import scratch_path, scratch_scope, shuffles_released

# Fixed values of the ledger view (FIXTURES F7): currency by line number modulo 4,
# payment format by quantity modulo 3, laundering label by order key modulo 5000.
CURRENCIES = ["Euro", "US Dollar", "Yen", "Yuan"]          # index = l_linenumber % 4
FORMATS = ["ACH", "Wire", "Cheque"]                         # index = l_quantity % 3
LABEL_MODULUS, LABEL_REMAINDER = 5000, 7
MINUTES_PER_DAY = 1440

ORDER = ["ts", "from_bank", "from_account", "to_bank", "to_account",
         "l_orderkey", "l_linenumber", "l_partkey"]

LEDGER_COLUMNS = ["txn_id", "from_acc", "to_acc", "l_orderkey", "l_linenumber", "l_partkey",
                  "from_bank", "from_account", "to_bank", "to_account", "amount_paid",
                  "amount_received", "payment_currency", "receiving_currency", "payment_format",
                  "is_laundering", "ts", "run_date"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(expr, values) -> F.Column:
    out = None
    for i, v in enumerate(values):
        out = F.when(expr == i, F.lit(v)) if out is None else out.when(expr == i, F.lit(v))
    return out


#: Up to so many suppliers (two numbers each) are sent to every executor; more are joined by shuffles.
BROADCAST_SUPPLIERS = 4_000_000


def ledger_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem x supplier (sender) x supplier (receiver): what a ledger row is computed from."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice", "l_discount", "l_shipdate")
    sup = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n_sup = sup.select(F.count(F.lit(1))).scalar()
    f = sup.select(F.col("s_suppkey").alias("f_key"), F.col("s_nationkey").alias("f_nation"))
    t = sup.select(F.col("s_suppkey").alias("t_key"), F.col("s_nationkey").alias("t_nation"))
    if sup.count() <= BROADCAST_SUPPLIERS:
        f, t = F.broadcast(f), F.broadcast(t)
    src = (li.join(f, li.l_suppkey == f.f_key)
             .join(t, (li.l_partkey % n_sup) == t.t_key))
    minutes = ((F.col("l_orderkey") * 7 + F.col("l_linenumber") * 13) % MINUTES_PER_DAY).cast("int")
    return src.select(
        "l_orderkey", "l_linenumber", "l_partkey", "f_nation", "f_key", "t_nation", "t_key", "l_quantity",
        "l_extendedprice", "l_discount", F.timestamp_add("MINUTE", minutes, F.col("l_shipdate")).alias("ts"),
        F.col("l_shipdate").cast("date").alias("run_date"))


def _ledger_rows(parts: DataFrame, *more: str) -> DataFrame:
    """The ledger's columns, without txn_id, from :func:`ledger_parts`; ``more`` columns are kept."""
    cur = _pick(F.col("l_linenumber") % 4, CURRENCIES)
    return parts.select(
        *more, "l_orderkey", "l_linenumber", "l_partkey",
        F.col("f_nation").cast("bigint").alias("from_bank"),
        F.col("f_key").cast("string").alias("from_account"),
        F.col("t_nation").cast("bigint").alias("to_bank"),
        F.col("t_key").cast("string").alias("to_account"),
        F.col("l_extendedprice").alias("amount_paid"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("amount_received"),
        cur.alias("payment_currency"),
        cur.alias("receiving_currency"),
        _pick(F.col("l_quantity") % 3, FORMATS).alias("payment_format"),
        F.when(F.col("l_orderkey") % LABEL_MODULUS == LABEL_REMAINDER, 1).otherwise(0)
         .alias("is_laundering"),
        "ts", "run_date")


def ledger_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger without txn_id."""
    return _ledger_rows(ledger_parts(spark, sf_dir))


def order_of_parts() -> list:
    """``ORDER`` in terms of :func:`ledger_parts`."""
    return [F.col("ts"), F.col("f_nation").cast("bigint"), F.col("f_key").cast("string"), F.col("t_nation").cast("bigint"),
            F.col("t_key").cast("string"), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")]


def _with_keys(numbered_rows: DataFrame) -> DataFrame:
    return numbered_rows.select(
        "txn_id",
        account_key("from_bank", "from_account").alias("from_acc"),
        account_key("to_bank", "to_account").alias("to_acc"),
        *[c for c in LEDGER_COLUMNS if c not in ("txn_id", "from_acc", "to_acc")])


def number_ledger(src: DataFrame) -> DataFrame:
    """:func:`ledger_source` with its numbers and keys."""
    return _with_keys(number_rows(src, ORDER, name="txn_id"))


_MEMO: dict[tuple[str, str, str], str] = {}
_LOCK = threading.RLock()


def memo_path(spark: SparkSession, sf_dir: str, name: str, build) -> str:
    """Path of a derived table written once per session: ``build(path)`` writes it; its scratch tables go when it is there."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    with _LOCK:
        path = _MEMO.get(key)
        if path is None:
            path = scratch_path(spark, name)
            with scratch_scope(spark), shuffles_released(spark):
                build(path)
            _MEMO[key] = path
    return path


def prepared_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbered ledger, materialised once per session and then read as Parquet."""
    def build(path):
        n = partitions_for(spark, read_table(spark, sf_dir, "lineitem").count())
        ranged_rows(ledger_parts(spark, sf_dir), order_of_parts(), partitions=n).write.mode("overwrite").parquet(f"{path}/rows")
        range_offsets(spark.read.parquet(f"{path}/rows")).coalesce(1).write.mode("overwrite").parquet(f"{path}/offsets")
    root = memo_path(spark, sf_dir, "ledger", build)
    rows = numbered(spark.read.parquet(f"{root}/rows"), spark.read.parquet(f"{root}/offsets"))
    return _with_keys(_ledger_rows(rows, "txn_id"))


def partitioned_ledger_root(spark: SparkSession, sf_dir: str) -> str:
    """The prepared ledger in the reference's year=/month=/day= layout (M2), written once."""
    from trailguard.operators.ledger import with_date_parts
    from trailguard.sources.files import write_partitioned

    def build(path):
        write_partitioned(with_date_parts(prepared_ledger(spark, sf_dir)), path,
                          ["year", "month", "day"], ["ts", "txn_id"])
    return memo_path(spark, sf_dir, "ledger-by-day", build)
