"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per SURVEY §2 key.

Every query starts from the prepared ledger of the driver tables (FIXTURES F7) and runs over
all of it; literal arguments (anchor days, stream slice) are those listed in FIXTURES F7.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailguard.plans import oracle_sql as O
from trailguard.session import ship_package

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def temporal_as_text(df: DataFrame) -> DataFrame:
    """Render DATE as ``yyyy-MM-dd`` and timestamps as ``yyyy-MM-dd HH:mm:ss`` text, the way the
    reference carries dates between stages; results then compare as plain strings."""
    out = []
    for f in df.schema.fields:
        t = f.dataType.typeName()
        if t == "date":
            out.append(F.date_format(F.col(f.name), "yyyy-MM-dd").alias(f.name))
        elif t in ("timestamp", "timestamp_ntz"):
            out.append(F.date_format(F.col(f.name), "yyyy-MM-dd HH:mm:ss").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return temporal_as_text(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return fn
    return deco


# Literal arguments (FIXTURES F7).
ANCHOR_DAY = "1999-03-10"
SNAPSHOT_DAY = "1999-02-28"
STREAM_FROM, STREAM_TO = "1999-03-01", "1999-03-31"
REDELIVER_UNTIL = "1995-06-30"          # days the topic delivers twice
DELETE_PREFIX = "1999-03"


def _import_all() -> None:
    # modules register their queries on import
    from trailguard.plans import q_features, q_ledger, q_graph, q_model, q_io, q_stream  # noqa: F401


def all_queries() -> dict[str, QueryFn]:
    _import_all()
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    _import_all()
    return dict(ORACLES)


__all__ = ["register", "QUERIES", "ORACLES", "all_queries", "all_oracles", "O", "F"]
