"""File sources and sinks: raw CSV ledger, Hive-partitioned Parquet, staged days, daily CSV.

A1 A2 A3 A4 A5 A6 A10 A11 A12 A13 B1 B5 F2 F3 H1.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Positional schema of the raw ledger file.  The file has two columns both headed "Account";
# a declared schema applied by position (header skipped) names them apart, replacing the
# withColumnRenamed("Account2", ...) repair of inferred names.
RAW_LEDGER_SCHEMA = T.StructType([
    T.StructField("Timestamp", T.StringType()),
    T.StructField("From Bank", T.LongType()),
    T.StructField("From Account", T.StringType()),
    T.StructField("To Bank", T.LongType()),
    T.StructField("To Account", T.StringType()),
    T.StructField("Amount Received", T.DoubleType()),
    T.StructField("Receiving Currency", T.StringType()),
    T.StructField("Amount Paid", T.DoubleType()),
    T.StructField("Payment Currency", T.StringType()),
    T.StructField("Payment Format", T.StringType()),
    T.StructField("Is Laundering", T.IntegerType()),
])
RAW_TS_FORMAT = "yyyy/MM/dd HH:mm"
CORRUPT = "_corrupt_record"


def read_ledger_csv(spark: SparkSession, path: str,
                    schema: T.StructType = RAW_LEDGER_SCHEMA) -> tuple[DataFrame, DataFrame]:
    """A1 A2 B1: (good, bad).  Good rows get ``ts`` parsed with ``try_to_timestamp``; rows that
    do not parse, miss a key field or have an unparsable timestamp go to ``bad`` with a reason and
    the whole line (rendered anew from its fields where the line itself parsed)."""
    full = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    raw = (spark.read.schema(full).option("header", True).option("enforceSchema", True)
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(path))
    ts = F.try_to_timestamp(F.col("Timestamp"), F.lit(RAW_TS_FORMAT))
    df = raw.withColumn("ts", ts)
    keys_missing = (F.col("From Bank").isNull() | F.col("From Account").isNull()
                    | F.col("To Bank").isNull() | F.col("To Account").isNull())
    reason = (F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed row"))
              .when(F.col("ts").isNull(), F.lit("bad timestamp"))
              .when(keys_missing, F.lit("missing party")))
    df = df.withColumn("_reason", reason)
    good = df.where(F.col("_reason").isNull()).drop(CORRUPT, "_reason")
    bad = df.where(F.col("_reason").isNotNull()).select(
        F.col("_reason").alias("error"),
        F.coalesce(F.col(CORRUPT), F.to_csv(F.struct(*[f.name for f in schema.fields])))
        .alias("original"))
    return good, bad


def raw_ledger_rows(ledger: DataFrame) -> DataFrame:
    """The prepared ledger rendered back into the raw file's columns and formats."""
    return ledger.select(
        F.date_format("ts", RAW_TS_FORMAT).alias("Timestamp"),
        F.col("from_bank").alias("From Bank"), F.col("from_account").alias("From Account"),
        F.col("to_bank").alias("To Bank"), F.col("to_account").alias("To Account"),
        F.col("amount_received").alias("Amount Received"),
        F.col("receiving_currency").alias("Receiving Currency"),
        F.col("amount_paid").alias("Amount Paid"),
        F.col("payment_currency").alias("Payment Currency"),
        F.col("payment_format").alias("Payment Format"),
        F.col("is_laundering").alias("Is Laundering"))


def write_partitioned(df: DataFrame, root: str, by: Sequence[str], order: Sequence[str] = (),
                      mode: str = "overwrite", dynamic: bool = True, fmt: str = "parquet",
                      options: dict | None = None) -> None:
    """Hive-partitioned write.

    Rows are range-partitioned on (by..., order...) first: each output partition is written by
    a few tasks (few files), and a hot day is split across several tasks instead of one.
    ``dynamic`` overwrite replaces only the partitions present in ``df`` (idempotent reruns).
    """
    keys = list(by) + list(order)
    w = df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode(mode)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.partitionBy(*by).format(fmt).save(root)


def read_partitioned(spark: SparkSession, root: str, run_date: str | None = None,
                     by: Sequence[str] = ("year", "month", "day")) -> DataFrame:
    """Read the root with partition discovery; a run_date becomes a partition filter
    (pruned at planning time) instead of a leaf path, so the partition columns are kept."""
    df = spark.read.parquet(root)
    if run_date is not None:
        y, m, d = (int(x) for x in run_date.split("-"))
        df = df.where((F.col(by[0]) == y) & (F.col(by[1]) == m) & (F.col(by[2]) == d))
    return df


def export_daily_csv(df: DataFrame, root: str, date_col: str = "date_str",
                     order: Sequence[str] = ("ts", "txn_id")) -> None:
    """One CSV folder per day, in one job (no driver loop over dates).  Every file has a header and
    is sorted by ``order``; a hot day is cut by it into several files, each a task of its own."""
    write_partitioned(df, root, [date_col], order, fmt="csv", options={"header": True})


def write_staged_day(df: DataFrame, root: str, run_date: str) -> str:
    """The transformed day under ``root/<run_date>``, overwritten on rerun."""
    path = f"{root.rstrip('/')}/{run_date}"
    df.write.mode("overwrite").parquet(path)
    return path
