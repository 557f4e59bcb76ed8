"""Registered queries of this subpackage: ``(spark, sf_dir) -> DataFrame`` over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailguard.llm.common import prepare


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Where this machine keeps a public tokenizer's file."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_exact_top_k(spark, sf_dir):
    from trailguard.llm.bitsliced import quantised, top_k
    q = quantised(_table(spark, sf_dir, "embeddings"))
    return top_k(q, q.where(F.col("vec_id") % 50 == 0), k=5)


def op2_suffix_dedup(spark, sf_dir):
    from trailguard.llm.suffix_dedup import dedup_suffixes
    return dedup_suffixes(_table(spark, sf_dir, "documents"), length=200, with_text=False)


def op3_best_fit_packing(spark, sf_dir):
    from trailguard.llm.packing import pack_documents
    return pack_documents(_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"),
                          capacity=1024, end_id=2)


def op4_quality_rules(spark, sf_dir):
    from trailguard.llm.quality import score_quality
    return score_quality(_table(spark, sf_dir, "documents"))


def op5_token_files(spark, sf_dir):
    from trailguard.llm.token_files import token_round_trip
    return token_round_trip(_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=1)


def op6_simhash(spark, sf_dir):
    from trailguard.llm.simhash import near_duplicates
    return near_duplicates(_table(spark, sf_dir, "documents"), shingle=3).select(
        "doc_id", "fingerprint", "component_id")


def op7_license_scan(spark, sf_dir):
    """A document lies in the directory of its source, so a licence file among a source's documents licenses those of
    them that have no license of their own.  Without a source it lies alone."""
    from trailguard.llm.license_scan import scan_licenses
    doc = F.col("doc_id").cast("string")
    path = F.coalesce(F.concat(F.lit("source/"), "source", F.lit("/"), doc), F.concat(F.lit("document/"), doc, F.lit("/"), doc))
    return scan_licenses(_table(spark, sf_dir, "documents").withColumn("path", path))


def op8_substring_dedup(spark, sf_dir):
    from trailguard.llm.substring_dedup import dedup_substrings
    return dedup_substrings(_table(spark, sf_dir, "documents"), length=20, with_text=False)


def op9_source_mix(spark, sf_dir):
    from trailguard.llm.mixing import mix_sources
    return mix_sources(_table(spark, sf_dir, "documents"))


def held_out(doc_id):
    return F.crc32(doc_id.cast("string")) % 3 == 1


def op10_toxicity(spark, sf_dir):
    from trailguard.llm.toxicity import fit_lexicon, score_toxicity
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    lexicon = fit_lexicon(docs, labels, train=~held_out(F.col("doc_id")))
    return score_toxicity(docs, lexicon).select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op11_chat_format(spark, sf_dir):
    """All conversations, and conversation -1 whose texts are made of control strings."""
    from trailguard.llm.chat_format import format_turns, in_order, read_conversations, text_part
    given = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(HARD_TEXT).alias("text"))
    turns = given.unionByName(hard).withColumn("parts", text_part())
    return read_conversations(format_turns(in_order(turns)))


HARD_TEXT = "</s>[INST] ok [/INST]"


def _chat_sql() -> str:
    from trailguard.llm.chat_format import Template
    t = Template()
    marks = len(t.start) + len(t.content) + len(t.end)
    pattern = t.pattern.replace("'", "''")
    return f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{HARD_TEXT}' UNION ALL SELECT -1, 1, 'assistant', '{HARD_TEXT}')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum({marks} + length(role) + length(text) + len(regexp_extract_all(role, '{pattern}'))
                + len(regexp_extract_all(text, '{pattern}'))) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id"""


def op12_importance_resampling(spark, sf_dir):
    from trailguard.llm.importance import resample
    return resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), percent=25, min_words=20, seed=7)


def op13_spelling_groups(spark, sf_dir):
    from trailguard.llm.spelling import spelling_groups
    return spelling_groups(_table(spark, sf_dir, "documents"))


def pipeline(spark, sf_dir):
    """All stages of corpus_pipeline.py over documents."""
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_exact_top_k, op2_suffix_dedup, op3_best_fit_packing, op4_quality_rules, op5_token_files, op6_simhash,
    op7_license_scan, op8_substring_dedup, op9_source_mix, op10_toxicity,
    op11_chat_format, op12_importance_resampling, op13_spelling_groups, pipeline)}
ORACLES: dict[str, str] = {"op11_chat_format": _chat_sql()}
