"""trailguard: transaction-graph risk analytics as Spark DataFrame / Structured Streaming jobs.

Sub-packages
------------
sources    ledger view, CSV / Parquet / JSON-wire readers and the matching writers
functions  column expressions (keys, dates, ratios, rules, safe casts)
operators  DataFrame -> DataFrame building blocks (numbering, suspects, graph tables,
           rolling features, round trips, cycles, scaler, isolation forest)
plans      the registered query catalogue used by ``__spark_entry__`` and ``bench.py``
streaming  decode, dedupe, keyed state, stream-static joins and the scoring pipeline
"""

from trailguard.session import build_session, scratch_path, scratch_scope, shared_dir

__all__ = ["build_session", "shared_dir", "scratch_path", "scratch_scope"]
