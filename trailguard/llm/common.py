"""Shared helpers: document keys, chunked access to Arrow text, rolling hashes, packed blobs.

Operators that compare every text with every other one move *packed blobs* instead of one row
per position: a map task sorts its hashes, cuts them into hash-range buckets and sends one
compressed blob per (Arrow batch, bucket).  A bucket holds a bounded share of the hash space;
hashes that repeat inside a batch are sent once, so a hot passage never piles up in one bucket.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailguard.operators.numbering import number_rows
from trailguard.session import materialize, scratch_path, ship_package

U64 = np.uint64
CHUNK_BYTES = 1 << 19
GROUP_BYTES = 8 << 20
BATCH_ROWS = 1000

WORD = "[^\\x20\\x09-\\x0D]+"


def prepare(spark: SparkSession) -> None:
    """Ship the package, and keep Arrow batches of whole texts small: Spark's default of 10,000 rows
    can be hundreds of megabytes in the JVM and the worker alike."""
    ship_package(spark)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)


def keyed_documents(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, text, _k`` and the columns in ``keep``: null texts become empty, ``_k`` is a long that sorts like
    ``doc_id`` (nulls first).  Normally ``_k`` is ``doc_id`` itself; where a doc_id is null or
    repeated, ``_k`` is the dense rank of the distinct (doc_id, text hash): rows that repeat a
    doc_id *and* its text are one document listed twice, other texts are documents of their own.
    """
    prepare(docs.sparkSession)
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"), *keep)
    twice = (base.select("doc_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
             .where((F.col("n") > 1) | F.col("doc_id").isNull()).limit(1).count())
    if not twice:
        return base.withColumn("_k", F.col("doc_id"))
    keyed = base.withColumn("_h", F.xxhash64("text")) \
                .withColumn("_i", F.coalesce(F.col("doc_id"), F.lit(-(2 ** 63)).cast("bigint"))) \
                .withColumn("_z", F.col("doc_id").isNotNull())
    rank = number_rows(keyed.select("_z", "_i", "_h").distinct(), ["_z", "_i", "_h"], name="_k")
    return keyed.join(rank, ["_z", "_i", "_h"]).select("doc_id", "text", *keep, "_k")


def bucket_count(df: DataFrame) -> int:
    """Hash buckets for an exchange: two per partition of ``df``, so buckets grow in number, not in
    size, with the input.  Ask for the table as read: behind a join the partitions are the shuffle's."""
    return max(4, 2 * df.rdd.getNumPartitions())


def text_buffer(col) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of an Arrow string column without nulls, without copying."""
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    bufs = col.buffers()
    off = np.frombuffer(bufs[1], np.int64 if wide else np.int32)[col.offset: col.offset + len(col) + 1]
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data, off.astype(np.int64)


def chunks(col, limit: int = CHUNK_BYTES):
    """Cut a text column into runs of whole rows of about ``limit`` bytes (a longer text is a
    run of its own): yields (first row, bytes, offsets of the run's rows)."""
    if len(col) == 0:
        return
    data, off = text_buffer(col)
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = int(np.searchsorted(off, off[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, data[off[lo]: off[hi]], off[lo: hi + 1] - off[lo]
        lo = hi


def merged(batches, limit: int = GROUP_BYTES):
    """Arrow batches joined to about ``limit`` bytes: how much text one packed blob covers."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.nbytes
        if size >= limit:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if size and any(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


class Rolling:
    """Hashes of arbitrary spans of a sequence from one prefix sum: sum(v[i] * B^i) mod 2^64
    over the span, shifted to start at power 0."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.table = rng.integers(1, 2 ** 63, 256, dtype=np.uint64) * U64(2) + U64(1)
        base = int(rng.integers(2 ** 40, 2 ** 62)) * 8 + 5
        self.base, self.back = base % 2 ** 64, pow(base, -1, 2 ** 64)
        self.pow = self.inv = np.zeros(0, np.uint64)

    def powers(self, n: int):
        if len(self.pow) < n:
            m = max(n, CHUNK_BYTES + 1)
            for name, b in (("pow", self.base), ("inv", self.back)):
                p = np.full(m, b, np.uint64)
                p[0] = 1
                setattr(self, name, np.cumprod(p, dtype=np.uint64))
        return self.pow[:n], self.inv[:n]

    def prefix(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.powers(len(values))[0], out=out[1:])
        return out

    def span(self, prefix: np.ndarray, start, end) -> np.ndarray:
        """Mixed hashes of [start, end) for arrays of starts and ends."""
        return mix((prefix[end] - prefix[start]) * self.powers(len(prefix))[1][start])


def words_of(data: np.ndarray, off: np.ndarray):
    """Words of a run of texts: (starts, ends, index of each row's first word, length rows + 1).
    Words are maximal runs without 0x20 and 0x09-0x0D and never cross rows."""
    n = len(data)
    solid = (data != 32) & ((data < 9) | (data > 13))
    first = np.zeros(n + 1, bool)
    first[off] = True
    before = np.empty(n, bool)
    after = np.empty(n, bool)
    if n:
        before[0] = False
        before[1:] = solid[:-1]
        after[-1] = False
        after[:-1] = solid[1:]
    starts = np.flatnonzero(solid & (~before | first[:-1]))
    ends = np.flatnonzero(solid & (~after | first[1:])) + 1
    return starts, ends, np.searchsorted(starts, off, "left")


def pack(*arrays: np.ndarray) -> bytes:
    """Compress integer arrays, each as byte planes, into one blob."""
    parts = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        parts.append(struct.pack("<BI", a.itemsize, len(a)))
        parts.append(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    out, at = [], 0
    while at < len(raw):
        size, n = struct.unpack_from("<BI", raw, at)
        planes = np.frombuffer(raw, np.uint8, size * n, at + 5).reshape(size, n)
        out.append(np.ascontiguousarray(planes.T).view(f"<u{size}").reshape(n))
        at += 5 + size * n
    return out


def small(a: np.ndarray) -> np.ndarray:
    """The narrowest unsigned type that holds ``a``."""
    top = int(a.max()) if len(a) else 0
    return a.astype(np.uint8 if top < 256 else np.uint16 if top < 65536 else
                    np.uint32 if top < 2 ** 32 else np.uint64)


def deltas(a: np.ndarray) -> np.ndarray:
    return np.diff(a, prepend=a.dtype.type(0)) if len(a) else a


def ranges(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each 64-bit hash: equal slices of the hash range, so sorted hashes give
    contiguous buckets."""
    return ((hashes >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)


def slices(sorted_keys: np.ndarray):
    """(key, lo, hi) of each run of a sorted array."""
    if len(sorted_keys):
        cut = np.flatnonzero(np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1])))
        for lo, hi in zip(cut, np.append(cut[1:], len(sorted_keys))):
            yield int(sorted_keys[lo]), int(lo), int(hi)


def run_ids(*keys: np.ndarray) -> np.ndarray:
    """Index of the run of equal key tuples that each row of sorted arrays belongs to."""
    n = len(keys[0])
    new = np.zeros(n, bool)
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.cumsum(new)


def as_batch(schema: pa.Schema, *cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, schema.types)], schema=schema)


def as_table(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows)) if rows else [[] for _ in schema.names]
    return pa.Table.from_arrays([pa.array(list(c), t) for c, t in zip(cols, schema.types)], schema=schema)


SHARDS = pa.schema([("shard", pa.int64()), ("blob", pa.binary())])


def to_shards(buckets: int, keys: np.ndarray, *arrays: np.ndarray) -> pa.Table:
    """What a bucket found, as one blob per shard of documents: rows grow with buckets and shards,
    not with the buckets each document is spread over."""
    shard = ranges(mix(keys.view(np.uint64)), buckets)
    order = np.lexsort((keys, shard))
    shard, keys, arrays = shard[order], keys[order], [a[order] for a in arrays]
    rows = []
    for s, lo, hi in slices(shard):
        docs, idx = np.unique(keys[lo:hi], return_inverse=True)
        rows.append((s, pack(deltas(docs), small(idx), *[small(a[lo:hi]) for a in arrays])))
    return as_table(SHARDS, rows)


def packed_keys(packed: np.ndarray) -> np.ndarray:
    return np.cumsum(packed.view(np.int64))


_PER_DOC = pa.schema([("_k", pa.int64()), ("blob", pa.binary())])


def _by_document(key, table):
    """One blob per document of a shard."""
    parts = []
    for b in table.column("blob"):
        x = unpack(b.as_py())
        parts.append((packed_keys(x[0])[x[1]], *x[2:]))
    keys, *arrays = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(keys, kind="stable")
    keys, arrays = keys[order], [a[order] for a in arrays]
    return as_table(_PER_DOC, [(k, pack(*[small(a[lo:hi]) for a in arrays])) for k, lo, hi in slices(keys)])


def with_found(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The columns of ``docs`` and ``blob``: what an exchange found (shard, blob) for each document; its size
    is bounded by the document's own length."""
    each = found.groupBy("shard").applyInArrow(_by_document, "_k bigint, blob binary")
    return docs.join(each, "_k", "left").select(*docs.columns, "blob")
