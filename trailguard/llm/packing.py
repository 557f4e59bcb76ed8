"""Best-fit packing by sums of squares.

Documents become token ids; longer ones are cut into full sequences (the remainder comes first).
Each piece is placed where the sum of squares of the numbers of open sequences per remaining gap
becomes smallest, which keeps every gap about equally rare, so that later pieces find a
fitting one.  Pieces are dealt to groups of bounded size by a hash, each group is packed on its
own, longest pieces first; sequences that stay open are packed once more as whole items across
the groups, until one group holds them all or a round saves less than one in a thousand.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailguard.llm.common import as_batch, materialize, merged, prepare
from trailguard.llm.tokenizing import encoded, encoder

GROUP_ITEMS = 20_000
#: Repacking ends with a round that closes less than this share of the open sequences.
WORTHWHILE = 0.001


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each item.  ``open_[g]`` counts open bins with gap g; an item of length s
    changes the sum by 1 - 2 open_[g] for leaving gap g and 1 + 2 open_[g - s] for entering
    g - s (full bins don't count).  A new bin is opened only where no open one fits: with the longest
    items first, opening earlier than that cost up to 3 % more bins.  Ties go to the tightest
    gap."""
    n = len(lengths)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    open_ = np.zeros(capacity + 1, np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    made = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        s = int(lengths[i])
        gaps = np.flatnonzero(open_[s:capacity]) + s if s < capacity else ()
        best = capacity
        if len(gaps):
            left = gaps - s
            change = 1 - 2 * open_[gaps] + np.where(left > 0, 1 + 2 * open_[left], 0)
            best = int(gaps[change.argmin()])
        if best == capacity:
            b, made = made, made + 1
        else:
            b = stacks[best].pop()
            open_[best] -= 1
        bins[i], offsets[i] = b, capacity - best
        if best > s:
            stacks[best - s].append(b)
            open_[best - s] += 1
    return bins, offsets


PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                    ("length", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary())])


def _pieces(path: str, end_id: int, capacity: int, with_ids: bool, special_as_text: bool):
    def run(batches):
        enc = encoder(path, special_as_text)
        end = np.array([end_id], "<u4").tobytes()
        for b in merged(batches):
            docs = b.column("doc_id")
            for lo, ids, off in encoded(enc, b.column("text")):
                raw, out = ids.tobytes(), []
                for i, (a, z) in enumerate(zip(off[:-1].tolist(), off[1:].tolist())):
                    doc = raw[4 * a: 4 * z] + end
                    n, doc_id = z - a + 1, docs[lo + i].as_py()
                    first = (n - 1) % capacity + 1
                    at = 0
                    for piece, stop in enumerate(range(first, n + 1, capacity)):
                        part = doc[4 * at: 4 * stop]
                        out.append((doc_id, piece, at, stop - at, zlib.crc32(part),
                                    part if with_ids else None))
                        at = stop
                yield as_batch(PIECES, *zip(*out))
    return run


def _pack_group(capacity: int):
    def run(key, table):
        t = table.combine_chunks()
        # an order of its own makes the result independent of how rows arrived
        t = t.sort_by([("_len", "descending"), ("_row", "ascending")])
        lengths = t.column("_len").to_numpy().astype(np.int64)
        bins, offsets = sum_of_squares(lengths, capacity)
        g = key[0].as_py()
        t = t.append_column("_bin", pa.array(bins + (g << 32), pa.int64()))
        t = t.append_column("_at", pa.array(offsets, pa.int64()))
        used = np.bincount(bins, weights=lengths).astype(np.int64) if len(bins) else bins
        return t.append_column("_used", pa.array(used[bins], pa.int64()))
    return run


def _schema(df: DataFrame, more: str) -> str:
    return ", ".join(f"`{n}` {t}" for n, t in df.dtypes) + ", " + more


def _grouped(items: DataFrame, capacity: int, groups: int) -> DataFrame:
    """``items`` (_row unique, _len) with bin, place in it and what the bin holds."""
    dealt = items.withColumn("_g", F.pmod(F.xxhash64("_row", F.lit(groups)), F.lit(groups)).cast("bigint"))
    return dealt.groupBy("_g").applyInArrow(
        _pack_group(capacity), _schema(dealt, "_bin bigint, _at bigint, _used bigint")).drop("_g")


def _groups(n: int) -> int:
    return max(1, -(-n // GROUP_ITEMS))


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2,
                   with_ids: bool = False, special_as_text: bool = False) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` ids.

    Returns per piece: doc_id, piece, start (its document's ids before it), length, ids_crc32
    (of the little-endian 32-bit ids), sequence_id, offset, and ids when ``with_ids``.  Pieces of
    one sequence lie end to end from offset 0.  Null text counts as empty (one piece: the end
    id); repeated rows are packed one by one; a special token's string in a text is that token, as the
    library has it, or with ``special_as_text`` ordinary text; null doc_ids are kept; other columns are ignored;
    an empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))
    pieces = materialize(base.mapInArrow(
        _pieces(tokenizer_path, end_id, capacity, with_ids, special_as_text),
        "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary")
        .withColumn("_row", F.monotonically_increasing_id()), "pieces")
    full = pieces.where(F.col("length") == capacity)
    # the stored row number is a piece's name for dealing, so copies of one document spread over all groups
    rest = pieces.where(F.col("length") < capacity)
    slim = rest.select("doc_id", "piece", "start", "length", "ids_crc32", "ids",
                       "_row", F.col("length").alias("_len"))
    first = materialize(_grouped(slim, capacity, _groups(rest.count())), "packed")
    # open sequences of all groups are packed again, as whole items
    moved = (first.where(F.col("_used") < capacity).groupBy(F.col("_bin").alias("_row"))
             .agg(F.max("_used").alias("_len")))
    moved = materialize(moved.withColumns({"_from": F.col("_row"), "_shift": F.lit(0).cast("bigint")}), "open")
    n = moved.count()
    while n > 1:
        groups = _groups(n)
        step = _grouped(moved.groupBy("_row").agg(F.max("_len").alias("_len")), capacity, groups)
        step = materialize(step, "repacked")
        was, n = n, step.select("_bin").distinct().count()
        moved = materialize(
            moved.drop("_len").join(step.select("_row", "_bin", "_at", F.col("_used").alias("_len")), "_row")
            .select(F.col("_bin").alias("_row"), "_len", "_from",
                    (F.col("_shift") + F.col("_at")).alias("_shift")), "open")
        if groups == 1 or was - n < WORTHWHILE * was:
            break
    part = (first.join(moved.select(F.col("_from").alias("_bin"), F.col("_row").alias("_to"), "_shift"),
                       "_bin", "left")
            .select("doc_id", "piece", "start", "length", "ids_crc32", "ids",
                    # three families of numbers: untouched bins, repacked bins, full pieces
                    F.coalesce(F.col("_to") * 3 + 1, F.col("_bin") * 3).alias("sequence_id"),
                    (F.col("_at") + F.coalesce(F.col("_shift"), F.lit(0))).alias("offset")))
    alone = full.select("doc_id", "piece", "start", "length", "ids_crc32", "ids",
                        (F.monotonically_increasing_id() * 3 + 2).alias("sequence_id"),
                        F.lit(0).cast("bigint").alias("offset"))
    out = part.unionByName(alone)
    return out if with_ids else out.drop("ids")
