"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Fingerprints within 3 bits meet half-way: every fingerprint emits all variants within half the
radius (one flipped bit, or none), and equal variants collide.  That alone bridges 2 bits; for
the third the 64 bits are taken as 4 groups of 16, and variants collide on the 48 bits outside
one group.  Inside a collision, variants whose group bits are equal or differ in one place are
linked: then at most 2 + 1 bits differ.  Any pair with a bit of its difference alone in some
group is found so; a pair whose 3 bits all lie in one group agrees on the 48 bits, where all
3-bit flips of the group are looked up.  Each fingerprint emits 4 x 49 variants instead of the
2,081 of full radius-2 balls.

Equal fingerprints are one node.  Within a collision links form chains between neighbours, not
all pairs; links are verified and joined into components by distributed stars.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailguard.llm.common import (U64, as_batch, as_table, bucket_count, materialize, merged, mix, pack, prepare, ranges,
                                   slices, unpack)
from trailguard.llm.components import components

RADIUS = 3
GROUPS = 4
GROUP_BITS = 64 // GROUPS
NO_FLIP = 64
SEED = 42
_BITS = np.array([1 << i for i in range(64)], np.uint64)
_TRIPLES = np.array([sum(1 << i for i in c) for c in combinations(range(GROUP_BITS), 3)], np.uint64)
FLUSH = 200_000
FINGERPRINTS_AT_ONCE = 8000


def _bits_over_half(hashes: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Fingerprint of each stretch of hashes (stretches are not empty)."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    count = np.add.reduceat(bits, start, axis=0, dtype=np.int32)
    size = np.diff(np.append(start, len(hashes)))
    on = 2 * count > size[:, None]
    return np.packbits(on, axis=1, bitorder="little").view("<u8").reshape(-1)


def fingerprints(texts: pa.Array, shingle: int) -> np.ndarray:
    """64-bit SimHash of each text's word shingles."""
    out = np.zeros(len(texts), np.uint64)
    digest = xxhash.xxh64_intdigest
    held, rows, starts, n = [], [], [], 0

    def flush():
        if held:
            out[rows] = _bits_over_half(np.concatenate(held), np.array(starts))

    for i, text in enumerate(texts):
        words = text.as_buffer().to_pybytes().lower().split() if text.is_valid else []
        if not words:
            continue
        joined = b" ".join(words)
        end = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        start = np.concatenate(([0], end[:-1] + 1))
        k = min(shingle, len(words))
        h = [digest(joined[a:z], SEED) for a, z in zip(start[: len(words) - k + 1].tolist(), end[k - 1:].tolist())]
        rows.append(i)
        starts.append(n)
        held.append(np.array(h, np.uint64))
        n += len(h)
        if n >= FLUSH:
            flush()
            held, rows, starts, n = [], [], [], 0
    flush()
    return out


def _fingerprint(shingle: int, keep: list[str]):
    def run(batches):
        for b in batches:
            fp = fingerprints(b.column("text"), shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(c) for c in keep] + [pa.array(fp)], names=[*keep, "fp"])
    return run


BLOBS = pa.schema([("bucket", pa.int32()), ("blob", pa.binary())])
EDGES = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _rotated(x: np.ndarray, group: int) -> np.ndarray:
    """``x`` with the bits of ``group`` lowest."""
    r = U64(group * GROUP_BITS)
    return (x >> r) | (x << (U64(64) - r)) if group else x


def _unrotated(x: np.ndarray, group: int) -> np.ndarray:
    r = U64(group * GROUP_BITS)
    return (x << r) | (x >> (U64(64) - r)) if group else x


def _variants(buckets: int):
    def run(batches):
        for b in merged(batches, 8 * FINGERPRINTS_AT_ONCE):
            fp = b.column("fp").to_numpy().view(np.uint64)
            for lo in range(0, len(fp), FINGERPRINTS_AT_ONCE):
                some, out = fp[lo: lo + FINGERPRINTS_AT_ONCE], []
                for g in range(GROUPS):
                    y = _rotated(some, g)
                    flips = np.concatenate((_BITS[GROUP_BITS:], [U64(0)]))
                    z = (y[:, None] ^ flips[None, :]).ravel()
                    flip = np.tile(np.append(np.arange(GROUP_BITS, 64), NO_FLIP).astype(np.uint8), len(y))
                    where = ranges(mix(z >> U64(GROUP_BITS)), buckets)
                    order = np.argsort(where, kind="stable")
                    z, flip, where = z[order], flip[order], where[order]
                    out += [(g * buckets + k, pack(z[s:e], flip[s:e])) for k, s, e in slices(where)]
                yield as_batch(BLOBS, *zip(*out))
    return run


def collisions(z: np.ndarray, flip: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between (rotated) fingerprints from the variants of one group's bucket."""
    y = z ^ np.where(flip == NO_FLIP, U64(0), _BITS[np.minimum(flip, 63)])
    order = np.lexsort((y, z))
    z, y, flip = z[order], y[order], flip[order]
    key = z >> U64(GROUP_BITS)
    # only keys with two different fingerprints matter
    run = np.cumsum(np.concatenate(([False], key[1:] != key[:-1]))) if len(z) else np.zeros(0, np.int64)
    if not len(z):
        return z, z
    lead = np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1])))
    several = np.logical_or.reduceat(y != y[lead][run], lead)[run]
    z, y, flip, key = z[several], y[several], flip[several], key[several]
    if not len(z):
        return z, z
    a, b = [], []
    same = z[1:] == z[:-1]                       # equal variants: neighbours differ in 2 bits at most
    a.append(y[:-1][same])
    b.append(y[1:][same])
    uniq, at = np.unique(z, return_index=True)

    def look(values, fps, other):
        i = np.minimum(np.searchsorted(uniq if other is None else other[0], values), (len(uniq) if other is None else len(other[0])) - 1)
        base, who = (uniq, y[at]) if other is None else other
        hit = base[i] == values
        a.append(fps[hit])
        b.append(who[i[hit]])

    for bit in _BITS[:GROUP_BITS]:               # one bit of the group apart
        look(uniq ^ bit, y[at], None)
    own = flip == NO_FLIP                        # the fingerprints themselves: 3 bits of the group apart
    oz = z[own]
    if len(oz):
        k = oz >> U64(GROUP_BITS)
        n = np.unique(k, return_inverse=True, return_counts=True)
        oz = oz[n[2][n[1]] > 1]
        if len(oz):
            for t in _TRIPLES:
                look(oz ^ t, oz, (oz, oz))
    a, b = np.concatenate(a), np.concatenate(b)
    near = np.bitwise_count(a ^ b) <= RADIUS
    a, b = np.minimum(a, b)[near], np.maximum(a, b)[near]
    differ = a != b
    pairs = np.unique(np.column_stack((a[differ], b[differ])), axis=0)
    return pairs[:, 0], pairs[:, 1]


def _links(buckets: int):
    def run(key, table):
        g = key[0].as_py() // buckets
        z, flip = (np.concatenate(x) for x in zip(*(unpack(b.as_py()) for b in table.column("blob"))))
        a, b = collisions(z.astype(np.uint64), flip)
        a, b = _unrotated(a, g), _unrotated(b, g)
        return as_table(EDGES, list(zip(a.view(np.int64).tolist(), b.view(np.int64).tolist())))
    return run


def near_duplicates(docs: DataFrame, shingle: int = 3, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, fp (signed 64-bit fingerprint), fingerprint (16 hex digits), component_id, root (the
    smallest fp that links reach: a name of the component that is never null) and the columns in
    ``keep``.

    Texts are lower-cased (A-Z), cut into words and ``shingle``-word shingles; a text with fewer
    words is one shingle; without words (null, empty) the fingerprint is zero and links like any
    other.  Fingerprints within 3 bits are linked; component_id is the smallest doc_id that links
    reach, the own included (null only where all of them are null).  Repeated rows return one row
    each; other columns are ignored; an empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"), *keep)
    n = bucket_count(base)
    carried = "".join(f"`{c}` {base.schema[c].dataType.simpleString()}, " for c in keep)
    fps = materialize(base.mapInArrow(_fingerprint(shingle, ["doc_id", *keep]), f"doc_id bigint, {carried}fp bigint"),
                      "fingerprints")
    nodes = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    edges = (nodes.select("fp").mapInArrow(_variants(n), "bucket int, blob binary")
             .groupBy("bucket").applyInArrow(_links(n), "u bigint, v bigint"))
    stars = components(edges).select(F.col("u").alias("fp"), F.col("v").alias("root"))
    rooted = nodes.join(stars, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    ids = rooted.select("fp", "root").join(least, "root").select("fp", "root", "component_id")
    return fps.join(ids, "fp").select(
        "doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "root", *keep)
