"""Exact top-k inner products on a bit-sliced index.

Vectors are quantised to integers.  The index keeps blocks of rows; in a block every component
is stored as bit slices: slice i of component j is a bitmap of the rows whose value, shifted to be
non-negative, has bit i.  A query adds the slices with bitmap arithmetic (full adders over whole
bitmaps, carries one weight up) into the slices of all scores of the block at once.  The top rows
are then read from the most significant slice downward: rows with the bit set move ahead while
they number at most k, otherwise only they stay in question; rows still undecided after the
last slice tie exactly, and go to the smaller id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trailguard.llm.common import as_batch, materialize, prepare

BLOCK_ROWS = 32_768
QUERY_ROWS = 64


def slices_of(values: np.ndarray) -> tuple[int, np.ndarray]:
    """(lowest value, bitmaps as 64-bit words, one per bit) of one component of a block."""
    low = int(values.min())
    u = (values - low).astype(np.uint64)
    bits = int(u.max()).bit_length()
    pad = -len(u) % 64
    u = np.append(u, np.zeros(pad, np.uint64))
    out = [np.packbits(((u >> np.uint64(i)) & np.uint64(1)).astype(np.uint8), bitorder="little").view(np.uint64)
           for i in range(bits)]
    return low, np.array(out, np.uint64).reshape(bits, len(u) // 64)


def add_slices(weighted: dict[int, list[np.ndarray]], words: int) -> list[np.ndarray]:
    """Sum of bitmaps with weights 2^w, as one bitmap per bit of the sum.  Three bitmaps of a
    weight become one of it and a carry, for whole stacks of bitmaps at a time."""
    out, w = [], 0
    stacks = {k: np.stack(v) for k, v in weighted.items() if v}
    while stacks:
        s = stacks.pop(w, None)
        carries = []
        if s is None:
            out.append(np.zeros(words, np.uint64))
        else:
            while len(s) >= 3:
                m = len(s) // 3
                a, b, c = s[:m], s[m:2 * m], s[2 * m:3 * m]
                x = a ^ b
                carries.append((a & b) | (x & c))
                s = np.concatenate((x ^ c, s[3 * m:]))
            if len(s) == 2:
                carries.append((s[0] & s[1])[None])
                s = (s[0] ^ s[1])[None]
            out.append(s[0])
        if carries:
            up = stacks.get(w + 1)
            stacks[w + 1] = np.concatenate(([up] if up is not None else []) + carries)
        w += 1
    return out


def top_rows(score: list[np.ndarray], allowed: np.ndarray, k: int) -> np.ndarray:
    """Row numbers of the k largest scores among the ``allowed`` rows; of rows that tie at the
    boundary the first ones (rows lie in id order)."""
    sure, open_ = np.zeros_like(allowed), allowed
    for s in reversed(score):
        x = sure | (open_ & s)
        n = int(np.bitwise_count(x).sum())
        if n > k:
            open_ = open_ & s
        else:
            sure = x
            open_ = open_ & ~s
            if n == k:
                open_ = np.zeros_like(open_)
                break
    rows = np.flatnonzero(np.unpackbits(sure.view(np.uint8), bitorder="little"))
    rest = np.flatnonzero(np.unpackbits(open_.view(np.uint8), bitorder="little"))[: k - len(rows)]
    return np.concatenate((rows, rest))


INDEX = pa.schema([("block", pa.int64()), ("dims", pa.int32()), ("ids", pa.binary()), ("low", pa.binary()),
                   ("n_slices", pa.binary()), ("bitmaps", pa.binary())])


def _index_block(key, table):
    block, dims = key[0].as_py(), key[1].as_py()
    t = table.sort_by("vec_id")
    q = np.array(t.column("q").to_pylist(), np.int64).reshape(t.num_rows, dims)
    parts = [slices_of(q[:, j]) for j in range(dims)]
    return pa.Table.from_arrays([
        pa.array([block], pa.int64()), pa.array([dims], pa.int32()),
        pa.array([t.column("vec_id").to_numpy().astype(np.int64).tobytes()], pa.binary()),
        pa.array([np.array([x[0] for x in parts], np.int64).tobytes()], pa.binary()),
        pa.array([np.array([len(x[1]) for x in parts], np.uint8).tobytes()], pa.binary()),
        pa.array([b"".join(x[1].tobytes() for x in parts)], pa.binary())], schema=INDEX)


def build_index(vectors: DataFrame) -> DataFrame:
    """Bit-sliced blocks of ``vectors`` (vec_id, q: array<bigint>), one row per block; vectors of
    different lengths go to different blocks.  Every row is indexed."""
    n = max(1, -(-vectors.count() // BLOCK_ROWS))
    dealt = vectors.withColumns({"block": F.pmod(F.xxhash64("vec_id", "q"), F.lit(n)), "dims": F.size("q")})
    return dealt.groupBy("block", "dims").applyInArrow(
        _index_block, "block bigint, dims int, ids binary, low binary, n_slices binary, bitmaps binary")


HITS = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _search(k: int):
    def run(batches):
        for b in batches:
            for r in range(b.num_rows):
                row = {n: b.column(n)[r].as_py() for n in b.schema.names}
                dims = row["dims"]
                ids, low = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["low"], np.int64)
                count = np.frombuffer(row["n_slices"], np.uint8).astype(int)
                words = -(-len(ids) // 64)
                maps = np.frombuffer(row["bitmaps"], np.uint64).reshape(-1, words)
                first = np.concatenate(([0], np.cumsum(count)))
                every = np.packbits(np.arange(words * 64) < len(ids), bitorder="little").view(np.uint64)
                out = []
                for query_id, q in zip(row["query_ids"], row["queries"]):
                    # a negative factor takes the complement of the slices: -q u = |q| ~u + const
                    weighted: dict[int, list[np.ndarray]] = {}
                    const = 0
                    for j in range(dims):
                        f, bits = int(q[j]), int(count[j])
                        const += f * int(low[j])
                        if f < 0:
                            const += f * ((1 << bits) - 1)
                        for shift in range(abs(f).bit_length()):
                            if abs(f) >> shift & 1:
                                for i in range(bits):
                                    s = maps[first[j] + i]
                                    weighted.setdefault(shift + i, []).append(~s if f < 0 else s)
                    score = add_slices(weighted, words)
                    own = np.flatnonzero(ids == query_id)
                    allowed = every.copy()
                    np.bitwise_and.at(allowed, own // 64, ~(np.uint64(1) << (own % 64).astype(np.uint64)))
                    for i in top_rows(score, allowed, k):
                        got = sum(1 << w for w, s in enumerate(score) if int(s[i // 64]) >> int(i % 64) & 1)
                        out.append((query_id, int(ids[i]), got + const))
                if out:
                    yield as_batch(HITS, *zip(*out))
    return run


def quantised(vectors: DataFrame, scale: float = 256.0, column: str = "embedding") -> DataFrame:
    """vec_id, q: components as floor(scale * x), x as double.  Vectors that are null, empty, or
    hold null or non-finite components take no part, nor do rows without vec_id.  A finite component
    whose quantised value is beyond 64 bits fails the job."""
    def whole(v):
        x = v * F.lit(scale)
        return F.when(F.abs(x) < 2.0 ** 63, F.floor(x)).otherwise(
            F.raise_error(F.lit("a quantised component is beyond 64 bits")).cast("bigint"))

    d = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"),
                       F.col(column).cast("array<double>").alias("x"))
    fine = F.col("vec_id").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0) & F.forall(
        "x", lambda v: F.coalesce(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    return d.where(fine).select("vec_id", F.transform("x", whole).alias("q"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k highest integer inner products of each query
    with every vector but those of its own id (all, if fewer); ties go to the smaller vec_id.

    ``vectors`` and ``queries`` are (vec_id, q) as from :func:`quantised`.  Vectors of another
    length than the query's are no candidates.  Repeated rows are candidates of their own, a
    repeated query is asked once per distinct row.  Empty inputs give an empty result.  A score
    beyond 64 bits fails the job.
    """
    prepare(vectors.sparkSession)
    index = materialize(build_index(vectors), "bit-slices")
    n = max(1, -(-queries.count() // QUERY_ROWS))
    groups = (queries.distinct().withColumn("dims", F.size("q"))
              .groupBy("dims", F.pmod(F.xxhash64("vec_id", "q"), F.lit(n)).alias("group"))
              .agg(F.collect_list(F.struct("vec_id", "q")).alias("_all"))
              .select("dims", "group", F.col("_all.vec_id").alias("query_ids"), F.col("_all.q").alias("queries")))
    blocks = index.select("block", "dims")
    # every group of queries visits every block of its length: the stated search of a query set
    # against all rows, in blocks
    visits = groups.join(blocks, "dims").repartition("block", "group")
    hits = visits.join(index, ["block", "dims"]).select(
        "dims", "ids", "low", "n_slices", "bitmaps", "query_ids", "queries") \
        .mapInArrow(_search(k), "query_id bigint, vec_id bigint, score bigint")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
