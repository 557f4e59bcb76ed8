"""Importance resampling towards a target distribution.

Documents and target texts are hashed to counts of word runs in a fixed number of buckets.  Each
bucket has a gain, the scaled logarithm of its share in the target over its share in the
documents; the array of gains (one long a bucket, a fixed bound) scores every document, seeded
Gumbel noise is added, and the highest scores are drawn.

Ranks come from a distributed LSD radix sort.  Every pass is a stable counting sort by one digit
of the composite key (score, then document id): digits are counted per block of positions, running
sums over blocks and lower digits give each (block, digit) its first destination, and a row's
destination is that plus its rank among the block's rows of its digit.  The last destinations are
the ranks.  Blocks hold a fixed number of positions, so no task's share depends on the keys.

Cases: a null text has no words, no features and weight 0.  A null doc_id draws its noise from an
empty id and comes last among ties.  Repeated rows are documents of their own; ties between rows of
equal doc_id are broken by where they are stored.  An empty table gives an empty result; an empty
target counts as no features.  Columns besides doc_id, text and ``keep`` are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trailguard.llm.common import chunks, merged, prepare
from trailguard.llm.crc import crc_spans, extend, runs, shift
from trailguard.session import materialize

BUCKETS = 10_000
DIGIT_BITS = 11
BLOCK = 1 << 17

_BYTES = np.arange(256)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
#: words: 0-9, a-z and everything beyond ASCII
_IN_WORD = (_BYTES >= 48) & (_BYTES <= 57) | (_BYTES >= 97) & (_BYTES <= 122) | (_BYTES >= 128)


def _features(data: np.ndarray, off: np.ndarray, buckets: int):
    """(bucket of each word, bucket of each word with the next, has a next in its text, first word of each text)."""
    data = _LOWER[data]
    starts, ends, first = runs(_IN_WORD[data], off)
    one = crc_spans(data, starts, ends)
    nxt = np.ones(len(one), bool)
    nxt[first[1:][first[1:] > first[:-1]] - 1] = False
    at = np.flatnonzero(nxt)
    two = np.zeros(len(one), np.int64)
    two[at] = (shift(extend(one[at], 32), (ends - starts)[at + 1]) ^ one[at + 1]) % buckets
    return (one % buckets).astype(np.int64), two, nxt, first


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket's features occur in all texts: at most ``buckets`` rows reach the driver."""
    schema = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for b in merged(batches):
            for _, data, off in chunks(b.column(0)):
                one, two, nxt, _ = _features(data, off, buckets)
                total += np.bincount(one, minlength=buckets) + np.bincount(two[nxt], minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held])], schema=schema)

    rows = (texts.select("text").where("text is not null").mapInArrow(count, "bucket int, n bigint")
            .groupBy("bucket").agg(F.sum("n").alias("n")).collect())
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r.bucket] = r.n
    return out


def bucket_gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    s_all, t_all, k = float(documents.sum()), float(target.sum()), float(len(documents))
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + k) / ((s + 1.0) * (t_all + k))))
                     for s, t in zip(documents.tolist(), target.tolist())], np.int64)


def _noise(key: str) -> int:
    h = int(hashlib.sha256(key.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gains: np.ndarray, seed: int = 7, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, ``keep``, n_words, n_features, weight and score of every row."""
    src = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), *keep,
                      F.coalesce("text", F.lit("")).alias("_text"))
    held = src.columns[:-1]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1])

    def score(batches):
        for b in batches:
            words, weight = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64)
            for lo, data, off in chunks(b.column(b.num_columns - 1)):
                one, two, nxt, first = _features(data, off, len(gains))
                worth = np.concatenate(([0], np.cumsum(gains[one] + np.where(nxt, gains[two], 0))))
                n = np.diff(first)
                words[lo: lo + len(n)] = n
                weight[lo: lo + len(n)] = (worth[first[1:]] - worth[first[:-1]]) // np.maximum(2 * n - 1, 1)
            ids = b.column(0).to_pylist()
            noise = np.array([_noise(f"{seed}:{'' if i is None else i}") for i in ids], np.int64)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(words), pa.array(np.maximum(2 * words - 1, 0)), pa.array(weight),
                 pa.array(weight + noise)], names=[*held, "n_words", "n_features", "weight", "score"])

    return src.mapInArrow(score, ddl + ", n_words bigint, n_features bigint, weight bigint, score bigint")


_SIGN = -(2 ** 63)


def _unsigned(value: int) -> int:
    return (value + 2 ** 63) % 2 ** 64


def radix_positions(rows: DataFrame, keys: list[str], name: str = "position", bits: int = DIGIT_BITS,
                    block: int = BLOCK) -> DataFrame:
    """``rows`` with their 0-based place in ascending order of the long columns ``keys`` (the first is the most
    significant, none may be null).  Only digits in which the keys differ get a pass."""
    held = rows.columns
    table = materialize(rows.withColumns({"_block": F.spark_partition_id().cast("bigint"),
                                          "_pos": F.monotonically_increasing_id()}), "radix")
    ends = table.agg(*[f(k).alias(f"{k}_{i}") for k in keys for i, f in enumerate((F.min, F.max))]).first()
    passes = 0
    for key in reversed(keys):
        lo, hi = ends[f"{key}_0"], ends[f"{key}_1"]
        differ = 0 if lo is None else _unsigned(lo) ^ _unsigned(hi)
        for down in range(0, differ.bit_length(), bits):
            # the sign bit is turned so that digits sort as unsigned numbers
            digit = F.shiftrightunsigned(F.col(key).bitwiseXOR(F.lit(_SIGN)), down) \
                .bitwiseAND(F.lit((1 << bits) - 1)).cast("int")
            table = materialize(_counting_pass(table.withColumn("_digit", digit), block), "radix")
            passes += 1
    if not passes:                       # all keys equal: places as stored
        table = materialize(_counting_pass(table.withColumn("_digit", F.lit(0)), block), "radix")
    return table.select(*held, F.col("_pos").alias(name))


def _counting_pass(table: DataFrame, block: int) -> DataFrame:
    count = table.groupBy("_block", "_digit").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    # at most one row a digit: the window over all of them and the broadcast are bounded by 2^bits
    lower = count.groupBy("_digit").agg(F.sum("_n").alias("_n")).select(
        "_digit", F.coalesce(F.sum("_n").over(before.orderBy("_digit")), F.lit(0)).alias("_lower"))
    first = count.join(F.broadcast(lower), "_digit").select(
        "_block", "_digit", (F.col("_lower") + F.coalesce(F.sum("_n").over(
            before.partitionBy("_digit").orderBy("_block")), F.lit(0))).alias("_first"))
    local = F.row_number().over(Window.partitionBy("_block", "_digit").orderBy("_pos")) - 1
    placed = table.withColumn("_local", local).join(first, ["_block", "_digit"]) \
        .withColumn("_pos", (F.col("_first") + F.col("_local")).cast("bigint"))
    return placed.withColumn("_block", F.expr(f"_pos div {int(block)}")) \
        .drop("_digit", "_first", "_local")


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20, seed: int = 7,
             buckets: int = BUCKETS, keep: tuple[str, ...] = (), block: int = BLOCK) -> DataFrame:
    """Every row's doc_id, ``keep``, n_features, weight, score and rank.  Of the N rows with at least ``min_words``
    words, the floor(percent * N / 100) highest scores are drawn, ties to the smaller doc_id, and
    ranked from 1; rows not drawn have a null rank."""
    prepare(docs.sparkSession)
    gains = bucket_gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    rows = materialize(scored(docs, gains, seed, keep).withColumn("_row", F.monotonically_increasing_id()), "scored")
    able = rows.where(F.col("n_words") >= min_words).select(
        "_row", (-F.col("score")).alias("_down"), F.coalesce("doc_id", F.lit(2 ** 63 - 1)).alias("_id"))
    place = radix_positions(able, ["_down", "_id"], "_place", block=block)
    drawn = able.count() * percent // 100
    ranks = place.where(F.col("_place") < drawn).select("_row", (F.col("_place") + 1).alias("rank"))
    return rows.join(ranks, "_row", "left").select("doc_id", *keep, "n_features", "weight", "score", "rank")


def draw(docs: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20, seed: int = 7) -> DataFrame:
    """The drawn documents with all their columns, as training input."""
    own = {"doc_id", "n_features", "weight", "score", "rank", "n_words", "_row", "_text"}
    keep = tuple(c for c in docs.columns if c.lower() not in own)
    return resample(docs, target, percent, min_words, seed, keep=keep).where("rank is not null")
