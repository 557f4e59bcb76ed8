"""Token ids in files of bit-plane shuffled blocks.

Documents are range-partitioned and sorted by doc_id, encoded, and cut into chunks of whole
documents.  A chunk's ids are split into blocks of a fixed number of ids; each block is
transposed into bit or byte planes (plane j holds bit or byte j of every id) and each plane is
compressed with zstandard on its own: high planes are nearly constant and shrink to a few bytes.

The files are a Parquet table (``data/``) with one row per chunk: part, chunk, counts, the
documents' ids and lengths, the planes end to end and the plane sizes; and the chunk index
(``index/``): for each chunk the number of ids before it, its ids, documents and bytes.
Chunks decode independently, in any order.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trailguard.llm.common import as_batch, merged, prepare, scratch_path
from trailguard.llm.tokenizing import encoded, encoder

BLOCK_IDS = 16_384
CHUNK_IDS = 1 << 18


def shuffle_planes(ids: np.ndarray, planes: str = "byte", block: int = BLOCK_IDS,
                   level: int = 3) -> tuple[bytes, list[int]]:
    """(compressed planes end to end, size of each) of unsigned 32-bit ids."""
    z = zstandard.ZstdCompressor(level=level)
    out = []
    for lo in range(0, len(ids), block):
        x = np.ascontiguousarray(ids[lo: lo + block], "<u4").view(np.uint8).reshape(-1, 4)
        if planes == "bit":
            bits = np.unpackbits(x, axis=1, bitorder="little").T
            rows = np.packbits(bits, axis=1, bitorder="little")
        else:
            rows = x.T
        out += [z.compress(np.ascontiguousarray(r).tobytes()) for r in rows]
    return b"".join(out), [len(x) for x in out]


def unshuffle_planes(payload: bytes, sizes, n: int, planes: str = "byte",
                     block: int = BLOCK_IDS) -> np.ndarray:
    z = zstandard.ZstdDecompressor()
    per = 32 if planes == "bit" else 4
    at, j, out = 0, 0, []
    for lo in range(0, n, block):
        m = min(block, n - lo)
        rows = []
        for s in sizes[j: j + per]:
            rows.append(np.frombuffer(z.decompress(payload[at: at + s]), np.uint8))
            at += s
        j += per
        if planes == "bit":
            bits = np.unpackbits(np.stack(rows), axis=1, bitorder="little")[:, :m]
            x = np.packbits(bits.T, axis=1, bitorder="little")
        else:
            x = np.stack(rows).T
        out.append(np.ascontiguousarray(x).view("<u4").reshape(m))
    return np.concatenate(out) if out else np.zeros(0, "<u4")


CHUNKS = pa.schema([("part", pa.int32()), ("chunk", pa.int32()), ("n_ids", pa.int64()),
                    ("n_docs", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                    ("lengths", pa.list_(pa.int64())), ("planes", pa.list_(pa.int32())),
                    ("payload", pa.binary())])


def _write(path: str, end_id: int, planes: str, special_as_text: bool):
    def run(batches):
        enc = encoder(path, special_as_text)
        part, chunk = TaskContext.get().partitionId(), 0
        docs, lens, held, n = [], [], [], 0

        def flush():
            payload, sizes = shuffle_planes(np.concatenate(held), planes)
            return as_batch(CHUNKS, [part], [chunk], [n], [len(docs)], [docs], [lens], [sizes], [payload])

        for b in merged(batches):
            ids_of = b.column("doc_id").to_pylist()
            for lo, ids, off in encoded(enc, b.column("text")):
                m = len(off) - 1
                ended = np.insert(ids, off[1:], end_id)          # the end id closes every text
                off = off + np.arange(m + 1)
                cut = 0
                while cut < m:
                    stop = int(np.searchsorted(off, off[cut] + CHUNK_IDS - n, "left"))
                    stop = min(max(stop, cut + 1), m)
                    held.append(ended[off[cut]: off[stop]])
                    docs += ids_of[lo + cut: lo + stop]
                    lens += np.diff(off[cut: stop + 1]).tolist()
                    n += int(off[stop] - off[cut])
                    cut = stop
                    if n >= CHUNK_IDS:
                        yield flush()
                        chunk += 1
                        docs, lens, held, n = [], [], [], 0
        if docs:
            yield flush()
    return run


def write_tokens(docs: DataFrame, tokenizer_path: str, path: str, end_id: int = 1,
                 planes: str = "byte", special_as_text: bool = False) -> None:
    """Write the ids of all documents in ascending doc_id order (nulls first; equal doc_ids by
    text hash) under ``path``.  Null text counts as empty; every text ends with ``end_id``.  A special
    token's string in a text is that token, as the library has it, or with ``special_as_text``
    ordinary text."""
    spark = docs.sparkSession
    prepare(spark)
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))
    # as many ranges as input partitions: a range is about the size of an input split
    ranges = max(base.rdd.getNumPartitions(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = base.repartitionByRange(ranges, "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    (ordered.mapInArrow(_write(tokenizer_path, end_id, planes, special_as_text),
                        "part int, chunk int, n_ids bigint, n_docs bigint, doc_ids array<bigint>, "
                        "lengths array<bigint>, planes array<int>, payload binary")
     .write.option("compression", "uncompressed").parquet(path + "/data"))
    chunks = spark.read.parquet(path + "/data").select(
        "part", "chunk", "n_ids", "n_docs", F.octet_length("payload").alias("n_bytes"))
    parts = chunks.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    # one row per part: the number of parts bounds this window and the broadcast
    before = parts.select("part", F.coalesce(F.sum("ids").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = F.coalesce(F.sum("n_ids").over(
        Window.partitionBy("part").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    (chunks.withColumn("inside", inside).join(F.broadcast(before), "part")
     .select("part", "chunk", (F.col("before") + F.col("inside")).alias("first_id"), "n_ids", "n_docs",
             "n_bytes").write.parquet(path + "/index"))


DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                  ("ids_crc32", pa.int64()), ("ids", pa.binary())])


def _read(planes: str, with_ids: bool):
    def run(batches):
        for b in batches:
            for r in range(b.num_rows):
                row = {n: b.column(n)[r].as_py() for n in b.schema.names}
                ids = unshuffle_planes(row["payload"], row["planes"], row["n_ids"], planes)
                raw = ids.astype("<u4").tobytes()
                end = np.cumsum(row["lengths"], dtype=np.int64)
                start = end - np.array(row["lengths"], np.int64)
                parts = [raw[4 * a: 4 * z] for a, z in zip(start.tolist(), end.tolist())]
                yield as_batch(DOCS, row["doc_ids"], start + row["first_id"], end - start,
                               [zlib.crc32(p) for p in parts], parts if with_ids else [None] * len(parts))
    return run


def read_tokens(spark: SparkSession, path: str, planes: str = "byte", with_ids: bool = False) -> DataFrame:
    """Read the files back: per document doc_id, start (ids of all documents before it), n_tokens
    (with the end id), ids_crc32, and ids (little-endian 32-bit) when ``with_ids``."""
    data = spark.read.parquet(path + "/data")
    index = spark.read.parquet(path + "/index").select("part", "chunk", "first_id")
    out = data.select("part", "chunk", "n_ids", "doc_ids", "lengths", "planes", "payload") \
        .join(index, ["part", "chunk"]).drop("part", "chunk") \
        .mapInArrow(_read(planes, with_ids),
                    "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, ids binary")
    return out if with_ids else out.drop("ids")


def token_round_trip(docs: DataFrame, tokenizer_path: str, end_id: int = 1, planes: str = "byte",
                     path: str | None = None, special_as_text: bool = False) -> DataFrame:
    """Write all documents to files (a fresh folder in the shared one unless ``path`` is given) and
    read them back.  An empty table gives empty files and an empty result; other columns are
    ignored; repeated rows are written one by one."""
    path = path or scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, tokenizer_path, path, end_id, planes, special_as_text)
    return read_tokens(docs.sparkSession, path, planes)
