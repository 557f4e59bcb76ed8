"""Bucketed tables: the rolling features written once and read by the model and rule jobs.

A write makes a folder of its own under ``root`` and is published by one appended line in
``root/versions``, so an overwrite that dies is never read and running readers keep theirs.  Rows of one
key lie in one file, sorted: aggregates and joins on the key read the files without a shuffle.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

VERSIONS = "version bigint, path string, buckets int, keys array<string>, order array<string>, columns string"
#: Published versions that stay on disk: the current one and the one that readers may still hold.
KEPT = 2


def _published(spark: SparkSession, root: str) -> list:
    """Published versions, newest first: one short row per overwrite."""
    return (spark.read.schema(VERSIONS).json(f"{root}/versions").where(F.col("version").isNotNull())
            .orderBy(F.desc("version")).collect())


def _name(path: str) -> str:
    return "trailguard_" + hashlib.md5(path.encode()).hexdigest()


def _declare(spark: SparkSession, v) -> str:
    """The catalog's entry for a version's files; they stay when it is dropped."""
    name = _name(v.path)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                            for f in StructType.fromDDL(v.columns).fields)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({', '.join(v['keys'])}) "
                  f"SORTED BY ({', '.join(v.order)}) INTO {v.buckets} BUCKETS LOCATION '{v.path}'")
    return name


def write_bucketed(df: DataFrame, root: str, keys: Sequence[str], order: Sequence[str] = (),
                   buckets: int | None = None, finish: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Overwrite the table at ``root`` with ``df`` in ``buckets`` files (the shuffle's partitions unless
    given) by ``keys``, sorted by ``order`` within each.  Nulls are a key of their own.  ``finish`` adds columns
    that are computed row by row, after the shuffle."""
    spark = df.sparkSession
    root, order = root.rstrip("/"), list(order) or list(keys)
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = f"{root}/v-{uuid.uuid4().hex[:12]}"
    # the same hash as the buckets', so each task writes one file
    df = df.repartition(buckets, *keys)
    df = finish(df) if finish else df
    (df.write.bucketBy(buckets, *keys).sortBy(*order)
     .option("path", path).format("parquet").saveAsTable(_name(path)))
    columns = ", ".join(f"`{n}` {t}" for n, t in df.dtypes)
    spark.createDataFrame([(time.time_ns(), path, buckets, list(keys), order, columns)], VERSIONS) \
        .coalesce(1).write.mode("append").json(f"{root}/versions")
    for old in _published(spark, root)[KEPT:]:
        spark.sql(f"DROP TABLE IF EXISTS {_name(old.path)}")
        where = spark._jvm.org.apache.hadoop.fs.Path(old.path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def read_bucketed(spark: SparkSession, root: str) -> DataFrame:
    """The last published version, with its buckets known to the planner in any session."""
    versions = _published(spark, root.rstrip("/"))
    if not versions:
        raise FileNotFoundError(f"no table has been published under {root}")
    return spark.table(_declare(spark, versions[0]))
