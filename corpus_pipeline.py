"""Corpus pipeline: documents to packed sequences in five stages.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns the rows
that go on, with the columns of ``documents`` (the last returns packed pieces).  ``run`` writes
each stage's result to the shared folder and reads it again for the next, so a lost executor
never repeats earlier stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailguard.llm import queries as Q
from trailguard.llm.common import materialize
from trailguard.session import scratch_scope

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go."""
    from trailguard.llm.quality import filter_quality
    return filter_quality(docs.select(COLUMNS))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row stays: that with the smallest doc_id (null last), of
    several the one whose columns have the smallest hash.  A doc_id listed with different texts
    can so stay in several groups."""
    from trailguard.llm.simhash import near_duplicates
    # a row's number is stored with the row, so it names the same row in both reads
    docs = materialize(docs.select(COLUMNS).withColumns({
        "_row": F.monotonically_increasing_id(), "_hash": F.xxhash64("text", "lang", "source", "n_chars")}), "rows")
    found = near_duplicates(docs, shingle=3, keep=("_hash", "_row"))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_hash", "_row")
    first = found.groupBy("root").agg(F.min(place).alias("first")).select("first._row")
    return docs.join(first, "_row", "left_semi").select(COLUMNS)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of repeated 200-byte strings are removed; documents left without text go.  n_chars is
    counted anew."""
    from trailguard.llm.suffix_dedup import dedup_suffixes
    kept = dedup_suffixes(docs.select(COLUMNS), length=200, keep=("lang", "source"))
    return (kept.where("n_removed = 0 or trim(kept_text) <> ''")
            .select("doc_id", F.col("kept_text").alias("text"), "lang", "source",
                    F.length("kept_text").cast("bigint").alias("n_chars")))


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the mix takes, as often as it takes their words: a document taken for a share of
    a pass goes in once if that share is at least half a pass."""
    from trailguard.llm.mixing import mix_sources
    mixed = mix_sources(docs.select(COLUMNS), keep=("text", "lang", "source", "n_chars"))
    times = F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    return mixed.withColumn("_n", F.explode(F.array_repeat(F.lit(1), times))).select(COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1,024 ids, placed in sequences."""
    from trailguard.llm.packing import pack_documents
    return pack_documents(docs, Q.vocabulary("byte_bpe_50k.json"), capacity=1024, end_id=2)


STAGES = [("quality_rules", quality_rules), ("simhash_near_dedup", simhash_near_dedup),
          ("suffix_array_dedup", suffix_array_dedup), ("mix_to_targets", mix_to_targets),
          ("best_fit_packing", best_fit_packing)]

#: Fingerprints, byte strings and tokens have no form in SQL; tests hold the stages against plain
#: Python versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        with scratch_scope(spark):       # a stage's own tables go when its result is written
            docs = materialize(stage(spark, docs, sf_dir), name, keep=True)
    return docs
