"""Substring dedup on words: difference-cover anchors.

Positions are taken modulo 13; the cover {0, 1, 3, 9} is a perfect difference set, so for any two
positions i, j some shift below 13 moves both onto cover positions.  Two equal windows of
``length`` words therefore share an equal sub-window of ``length - 12`` words that starts on a
cover position in both, at the same distance from the window's start.

1. Hash the sub-windows at cover positions only (4 of 13) and find the hashes that occur twice
   (packed exchange by hash range; a hash repeated within a batch is known to repeat and sent
   once, so hot passages don't pile up).
2. Extend: each window of ``length`` words that contains a repeated anchor is a candidate and is
   hashed whole (96 bits); of equal windows all but the earliest (doc_id, start) are removed.
3. Cover the words of removed windows and return what is left.

Documents travel once: both joins on the document key reuse one exchange.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from trailguard.llm.common import (
    U64, Rolling, as_batch, bucket_count, chunks, deltas, keyed_documents, merged, pack, packed_keys,
    ranges, run_ids, slices, small, to_shards, unpack, with_found, words_of)

PERIOD = 13
COVER = (0, 1, 3, 9)          # every residue modulo 13 is a difference of two of these
BYTES, WORDS, TAIL = Rolling(11), Rolling(12), Rolling(13)

BLOBS = pa.schema([("bucket", pa.int32()), ("blob", pa.binary())])


def _word_values(data, starts, ends):
    return BYTES.span(BYTES.prefix(BYTES.table[data]), starts, ends)


def _positions(first, length):
    """Word indexes at which a window of ``length`` words fits inside its row, and the rows."""
    n = np.maximum(np.diff(first) - length + 1, 0)
    rows = np.repeat(np.arange(len(n)), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return first[:-1][rows] + at, rows, at


def _anchors(buckets: int, length: int):
    """Map side of step 1."""
    core = length - PERIOD + 1
    on_cover = np.zeros(PERIOD, bool)
    on_cover[list(COVER)] = True

    def run(batches):
        for b in merged(batches):
            keys = b.column("_k").to_numpy()
            parts = []
            for lo, data, off in chunks(b.column("text")):
                starts, ends, first = words_of(data, off)
                p, rows, at = _positions(first, core)
                take = on_cover[at % PERIOD]
                p, rows, at = p[take], rows[take], at[take]
                c = WORDS.prefix(_word_values(data, starts, ends))
                # 48 bits name an anchor: a chance collision only adds a candidate
                parts.append((WORDS.span(c, p, p + core) >> U64(16) << U64(16), rows + lo, at))
            if not parts:
                continue
            name, row, at = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(name, kind="stable")
            name, row, at = name[order], row[order], at[order]
            first = np.concatenate(([True], name[1:] != name[:-1])) if len(name) else np.zeros(0, bool)
            last = np.append(first[1:], True) if len(name) else first
            lone = first & last
            witness = first & ~last
            out = []
            if (~lone).any():           # repeated inside this batch: needs no exchange
                r, a = row[~lone], at[~lone]
                o = np.lexsort((a, r))
                salt = int(keys[r[0]]) % buckets
                rows_, idx = np.unique(r[o], return_inverse=True)
                out.append((buckets + salt, pack(deltas(keys[rows_]), small(idx), small(a[o]))))
            sent = lone | witness
            name, row, at, witness = name[sent], row[sent], at[sent], witness[sent]
            for bucket, s, e in slices(ranges(name, buckets)):
                rows_, idx = np.unique(row[s:e], return_inverse=True)
                out.append((bucket, pack(deltas(keys[rows_]), small(idx), small(at[s:e]),
                                         deltas(name[s:e] >> U64(16)), witness[s:e].astype(np.uint8))))
            if out:
                yield as_batch(BLOBS, *zip(*out))
    return run


def _repeated(buckets: int):
    """Reduce side of step 1: positions of anchors that occur twice or more, by document."""
    def run(key, table):
        bucket = key[0].as_py()
        k, at, name, witness = [], [], [], []
        for blob in table.column("blob"):
            x = unpack(blob.as_py())
            k.append(packed_keys(x[0])[x[1]])
            at.append(x[2].astype(np.int64))
            if bucket < buckets:
                name.append(np.cumsum(x[3].astype(np.uint64)))
                witness.append(x[4])
        k, at = np.concatenate(k), np.concatenate(at)
        if bucket < buckets:
            name, witness = np.concatenate(name), np.concatenate(witness).astype(bool)
            order = np.argsort(name, kind="stable")
            run = run_ids(name[order])
            twice = np.bincount(run) > 1
            known = np.bincount(run, weights=witness[order]) > 0
            hit = np.zeros(len(name), bool)
            hit[order] = (twice | known)[run]
            hit &= ~witness            # a witness's own positions are already known
            k, at = k[hit], at[hit]
        return to_shards(buckets, k, at)
    return run


def _windows(buckets: int, length: int):
    """Map side of step 2: whole-window hashes of candidates."""
    def run(batches):
        for b in merged(batches):
            keys, found = b.column("_k").to_numpy(), b.column("blob")
            parts = []
            for lo, data, off in chunks(b.column("text")):
                starts, ends, first = words_of(data, off)
                mark = np.zeros(len(starts) + 1, np.int32)
                for i in range(len(off) - 1):
                    blob = found[lo + i].as_py()
                    if blob:
                        mark[first[i] + unpack(blob)[0].astype(np.int64) + 1] = 1
                if not mark.any():
                    continue
                c = np.cumsum(mark)
                p, rows, at = _positions(first, length)
                take = c[p + PERIOD] > c[p]
                p, rows, at = p[take], rows[take], at[take]
                v = _word_values(data, starts, ends)
                hi = WORDS.span(WORDS.prefix(v), p, p + length)
                tail = TAIL.span(TAIL.prefix(v), p, p + length) >> U64(32)
                parts.append((hi, tail.astype(np.uint32), rows + lo, at))
            if not parts:
                continue
            hi, tail, row, at = (np.concatenate(x) for x in zip(*parts))
            order = np.lexsort((at, keys[row], tail, hi))
            hi, tail, row, at = hi[order], tail[order], row[order], at[order]
            run = run_ids(hi, tail)
            lead = np.concatenate(([True], run[1:] != run[:-1])) if len(run) else np.zeros(0, bool)
            # a repeated row of one document is the same place, not an earlier one
            k = keys[row]
            first_of = np.flatnonzero(lead)[run] if len(run) else run
            later = (k != k[first_of]) | (at != at[first_of])
            out = []
            if later.any():
                r, a = row[later], at[later]
                o = np.lexsort((a, r))
                rows_, idx = np.unique(r[o], return_inverse=True)
                out.append((buckets + int(keys[r[0]]) % buckets,
                            pack(deltas(keys[rows_]), small(idx), small(a[o]))))
            hi, tail, row, at = hi[lead], tail[lead], row[lead], at[lead]
            for bucket, s, e in slices(ranges(hi, buckets)):
                rows_, idx = np.unique(row[s:e], return_inverse=True)
                out.append((bucket, pack(deltas(keys[rows_]), small(idx), small(at[s:e]),
                                         deltas(hi[s:e]), tail[s:e])))
            if out:
                yield as_batch(BLOBS, *zip(*out))
    return run


def _later(buckets: int):
    """Reduce side of step 2: starts of windows with an earlier equal one."""
    def run(key, table):
        bucket = key[0].as_py()
        k, at, hi, tail = [], [], [], []
        for blob in table.column("blob"):
            x = unpack(blob.as_py())
            k.append(packed_keys(x[0])[x[1]])
            at.append(x[2].astype(np.int64))
            if bucket < buckets:
                hi.append(np.cumsum(x[3].astype(np.uint64)))
                tail.append(x[4])
        k, at = np.concatenate(k), np.concatenate(at)
        if bucket < buckets:
            hi, tail = np.concatenate(hi), np.concatenate(tail)
            order = np.lexsort((at, k, tail, hi))
            k, at, hi, tail = k[order], at[order], hi[order], tail[order]
            run = run_ids(hi, tail)
            first_of = np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1])))[run]
            later = (k != k[first_of]) | (at != at[first_of])
            k, at = k[later], at[later]
        return to_shards(buckets, k, at)
    return run


KEPT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                  ("kept_text", pa.string()), ("kept_sha256", pa.string())])


def _finish(length: int, with_text: bool):
    def run(batches):
        for b in batches:
            out = []
            for doc_id, text, blob in zip(*(b.column(c) for c in ("doc_id", "text", "blob"))):
                words = text.as_buffer().to_pybytes().split() if text.is_valid else []
                removed = 0
                kept = words
                blob = blob.as_py()
                if blob:
                    cover = np.zeros(len(words) + 1, np.int32)
                    at = np.unique(unpack(blob)[0].astype(np.int64))
                    np.add.at(cover, at, 1)
                    np.add.at(cover, at + length, -1)
                    keep = np.cumsum(cover[:-1]) == 0
                    removed = len(words) - int(keep.sum())
                    kept = list(compress(words, keep))
                joined = b" ".join(kept)
                out.append((doc_id.as_py(), len(words), removed, joined.decode() if with_text else None,
                            hashlib.sha256(joined).hexdigest()))
            yield as_batch(KEPT, *zip(*out)) if out else as_batch(KEPT, [], [], [], [], [])
    return run


def dedup_substrings(docs: DataFrame, length: int = 20, with_text: bool = True) -> DataFrame:
    """Remove every word covered by a ``length``-word window whose words also start earlier
    (smaller doc_id, or earlier in the same document); windows are judged on the input.

    Returns doc_id, n_words, n_removed, kept_text (kept words joined by one space), kept_sha256.
    Null text counts as no words; texts shorter than a window lose nothing; repeated rows of one
    document are one document and each returns its row (null or repeated doc_ids:
    :func:`trailguard.llm.common.keyed_documents`); other columns are ignored; an empty table
    gives an empty result.  ``length`` must be at least 14 words.
    """
    if length < PERIOD + 1:
        raise ValueError(f"length must be at least {PERIOD + 1} words")
    n = bucket_count(docs)
    docs = keyed_documents(docs)
    blobs = "bucket int, blob binary"
    found = "shard bigint, blob binary"
    anchors = (docs.select("_k", "text").mapInArrow(_anchors(n, length), blobs)
               .groupBy("bucket").applyInArrow(_repeated(n), found))
    later = (with_found(docs, anchors).mapInArrow(_windows(n, length), blobs)
             .groupBy("bucket").applyInArrow(_later(n), found))
    out = with_found(docs, later).mapInArrow(
        _finish(length, with_text),
        "doc_id bigint, n_words bigint, n_removed bigint, kept_text string, kept_sha256 string")
    return out if with_text else out.drop("kept_text")
