"""Exact substring dedup on bytes by external induced sorting of suffixes.

Sorting every suffix of a corpus would move many times the corpus.  Induced sorting orders a
content-defined sample of suffixes first and induces the rest from them, one preceding character
at a time; here that runs over shards of the sample, with Spark's disk-backed shuffle as the
external queue that brings the tuples of one shard together.

1. *Sample.*  A window is ``length`` bytes.  Each window samples the position of its smallest
   k-byte hash (k = length / 2, leftmost on ties), so equal windows sample the same place inside
   them.  Neighbouring windows mostly share their sample, which leaves one tuple per about
   length / 4 bytes: (name = hash of the k bytes, hash of the whole context its windows span).
2. *Naming and recursion.*  Tuples meet by name in hash-range shards.  A unique name ends the
   recursion: no suffix induced from it shares ``length`` bytes with another.  Tuples with equal
   context are repeats as a whole.  Only names with several different contexts go on, one
   representative of each context.
3. *Induction.*  Their tuples carry (name, text right of the sample, the preceding bytes).  In
   each shard the sample suffixes are sorted with their common-prefix lengths; then each step
   prepends one byte to all suffixes: a stable pass by (name, byte) over the previous order
   gives the next order, and its common-prefix values are one plus the minimum over the range
   between both suffixes.  A window whose suffix shares ``length`` bytes with a neighbour in
   that order repeats.

A name with very many different contexts (a hot passage's edge) doesn't go to one shard: its
windows are hashed whole (96 bits) and spread by that hash, which is exact in the same way.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from trailguard.llm.common import (
    SHARDS, U64, Rolling, as_batch, as_table, bucket_count, chunks, deltas, keyed_documents, merged, mix, pack,
    packed_keys,
    ranges, run_ids, slices, small, to_shards, unpack, with_found)
from trailguard.llm.substring_dedup import BLOBS

BYTES, TAIL = Rolling(21), Rolling(22)
FULL, PART, KNOWN, HOT = 0, 1, 2, 3     # what a sampled place is: see _named
#: Different contexts of one name in a batch, or in a shard, beyond which its windows are spread
#: by their own hash.
HOT_CONTEXTS = (64, 4096)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by doubling."""
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    rest = width - have
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def _sampled(data, off, length):
    """Sampled places of a run of texts: (row, start of the first window relative to the row,
    number of windows, sample - start, name, context hash)."""
    k = length // 2
    w = length - k + 1
    size = np.diff(off)
    if not (size >= length).any():
        return None
    c = BYTES.prefix(BYTES.table[data])
    i = np.arange(len(data) - k + 1)
    h = BYTES.span(c, i, i + k)
    packed = (h & U64(0xFFFFFFFF00000000)) | i.astype(np.uint64)
    sample = (_sliding_min(packed, w) & U64(0xFFFFFFFF)).astype(np.int64)
    n = np.maximum(size - length + 1, 0)
    rows = np.repeat(np.arange(len(n)), n)
    p = off[:-1][rows] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    a = sample[p]
    new = np.ones(len(p), bool)
    new[1:] = (a[1:] != a[:-1]) | (rows[1:] != rows[:-1])
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(p)))
    start, a, rows = p[at], a[at], rows[at]
    lead = a - start
    from_, to = start, start + count - 1 + length
    ctx = BYTES.span(c, from_, to) + (lead.astype(np.uint64) << U64(32) | count.astype(np.uint64)) * U64(0x9E3779B97F4A7C15)
    # sampled hashes are all small; mixed again they spread over the whole hash range
    return rows, start - off[:-1][rows], count, lead, mix(h[a]), ctx


def _entries(keys, row, *arrays):
    rows_, idx = np.unique(row, return_inverse=True)
    return pack(deltas(keys[rows_]), small(idx), *arrays)


def _samples(buckets: int, length: int, hot_in_batch: int):
    """Map side of step 2."""
    def run(batches):
        for b in merged(batches):
            keys = b.column("_k").to_numpy()
            parts = []
            for lo, data, off in chunks(b.column("text")):
                got = _sampled(data, off, length)
                if got is not None:
                    parts.append((got[0] + lo, *got[1:]))
            if not parts:
                continue
            row, start, count, lead, name, ctx = (np.concatenate(x) for x in zip(*parts))
            # a row listed twice is one document: the same place must not count twice
            order = np.lexsort((start, keys[row], ctx, name))
            row, start, count, lead, name, ctx = (x[order] for x in (row, start, count, lead, name, ctx))
            same = np.zeros(len(row), bool)
            k = keys[row]
            same[1:] = (k[1:] == k[:-1]) & (start[1:] == start[:-1]) & (name[1:] == name[:-1])
            row, start, count, lead, name, ctx = (x[~same] for x in (row, start, count, lead, name, ctx))
            run_c, run_n = run_ids(name, ctx), run_ids(name)
            head = np.zeros(len(row), bool)
            head[np.unique(run_c, return_index=True)[1]] = True
            full = (np.bincount(run_c) > 1)[run_c]
            hot = (np.bincount(run_n, weights=head) >= hot_in_batch)[run_n]
            out = []
            direct = full | (hot & head)
            if direct.any():
                r, kind = row[direct], np.where(full[direct], FULL, HOT)
                extra = np.flatnonzero(hot & head & full)      # hot repeats also speak for their context
                r = np.concatenate((r, row[extra]))
                kind = np.concatenate((kind, np.full(len(extra), HOT)))
                sel = np.concatenate((np.flatnonzero(direct), extra))
                out.append((buckets + int(keys[r[0]]) % buckets,
                            _entries(keys, r, small(start[sel]), small(count[sel]), small(lead[sel]),
                                     name[sel], kind.astype(np.uint8))))
            # sent: each context once; of a hot name only one entry that says so (flag 2)
            lead_of_name = np.zeros(len(row), bool)
            lead_of_name[np.unique(run_n, return_index=True)[1]] = True
            sent = (head & ~hot) | (lead_of_name & hot)
            flag = (full.astype(np.uint8) | (hot.astype(np.uint8) << 1))[sent]
            row, start, count, lead, name, ctx = (x[sent] for x in (row, start, count, lead, name, ctx))
            for bucket, s, e in slices(ranges(name, buckets)):
                out.append((bucket, _entries(keys, row[s:e], small(start[s:e]), small(count[s:e]),
                                             small(lead[s:e]), deltas(name[s:e]), ctx[s:e], flag[s:e])))
            if out:
                yield as_batch(BLOBS, *zip(*out))
    return run


def _named(buckets: int, hot_in_shard: int):
    """Reduce side of step 2.  Each place gets a kind: FULL, all its windows repeat; PART, they
    must be compared with other contexts of the name; KNOWN, a repeat that others are compared
    with; HOT, its windows are compared by their own hash."""
    def run(key, table):
        bucket = key[0].as_py()
        cols = []
        for blob in table.column("blob"):
            x = unpack(blob.as_py())
            k = packed_keys(x[0])[x[1]]
            if bucket >= buckets:
                cols.append((k, *(y.astype(np.int64) for y in x[2:5]), x[5], x[6].astype(np.int64)))
            else:
                cols.append((k, *(y.astype(np.int64) for y in x[2:5]), np.cumsum(x[5].astype(np.uint64)),
                             x[6], x[7]))
        cols = [np.concatenate(x) for x in zip(*cols)]
        if bucket >= buckets:
            k, start, count, lead, name, kind = cols
        else:
            # an exact tie order makes the choice of representatives repeatable
            order = np.lexsort((cols[1], cols[0], cols[5], cols[4]))
            k, start, count, lead, name, ctx, flag = (x[order] for x in cols)
            said = (flag & 2) > 0
            run_n = run_ids(name)
            hot = (np.bincount(run_n, weights=said) > 0)[run_n]
            keep = ~said
            k, start, count, lead, name, ctx, flag, hot = (
                x[keep] for x in (k, start, count, lead, name, ctx, flag, hot))
            if not len(k):
                return as_table(SHARDS, [])
            same = np.zeros(len(k), bool)
            same[1:] = (k[1:] == k[:-1]) & (start[1:] == start[:-1]) & (name[1:] == name[:-1])
            k, start, count, lead, name, ctx, flag, hot = (
                x[~same] for x in (k, start, count, lead, name, ctx, flag, hot))
            run_c, run_n = run_ids(name, ctx), run_ids(name)
            head = np.zeros(len(k), bool)
            head[np.unique(run_c, return_index=True)[1]] = True
            contexts = np.bincount(run_n, weights=head)[run_n]
            full = ((np.bincount(run_c) > 1) | (np.bincount(run_c, weights=flag & 1) > 0))[run_c]
            hot |= contexts > hot_in_shard
            told = full & ((flag & 1) == 0)
            rep = head & ((contexts > 1) | hot)
            kind = np.where(hot, HOT, np.where(full, KNOWN, PART))
            sel = np.concatenate((np.flatnonzero(told), np.flatnonzero(rep)))
            kind = np.concatenate((np.full(told.sum(), FULL), kind[rep]))
            k, start, count, lead, name = (x[sel] for x in (k, start, count, lead, name))
        return to_shards(buckets, k, start, count, lead, name, kind)
    return run


def _tuples(buckets: int, length: int):
    """Map side of step 3: what is settled passes by; tuples of the rest carry their text."""
    def run(batches):
        for b in merged(batches):
            keys, found = b.column("_k").to_numpy(), b.column("blob")
            settled, items, texts, whole = [], [], [], []
            done = set()
            for lo, data, off in chunks(b.column("text")):
                hot = []
                for i in range(len(off) - 1):
                    blob = found[lo + i].as_py()
                    if not blob or keys[lo + i] in done:
                        continue                # nothing found, or a row listed twice
                    done.add(keys[lo + i])
                    start, count, lead, name, kind = unpack(blob)
                    start, count, lead = (x.astype(np.int64) for x in (start, count, lead))
                    full = kind == FULL
                    if full.any():
                        settled.append((np.full(full.sum(), lo + i), start[full], count[full]))
                    for j in np.flatnonzero((kind == PART) | (kind == KNOWN)):
                        s = off[i] + start[j]
                        items.append((lo + i, start[j], count[j], lead[j], int(name[j]), kind[j] == KNOWN))
                        texts.append(data[s: s + count[j] - 1 + length].tobytes())
                    for j in np.flatnonzero(kind == HOT):
                        hot.append((i, start[j], count[j]))
                if hot:
                    i, s, n = (np.array(x, np.int64) for x in zip(*hot))
                    rows = np.repeat(i, n)
                    at = np.repeat(s, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    p = off[:-1][rows] + at
                    v = BYTES.table[data]
                    hi = BYTES.span(BYTES.prefix(v), p, p + length)
                    tail = TAIL.span(TAIL.prefix(v), p, p + length) >> U64(32)
                    whole.append((hi, tail.astype(np.uint32), rows + lo, at))
            out = []
            if settled:
                row, start, count = (np.concatenate(x) for x in zip(*settled))
                out.append((3 * buckets + int(keys[row[0]]) % buckets,
                            _entries(keys, row, small(start), small(count))))
            if items:
                row, start, count, lead = (np.array(x, np.int64) for x in list(zip(*items))[:4])
                name = np.array([x[4] for x in items], np.uint64)
                known = np.array([x[5] for x in items], np.uint8)
                order = np.argsort(name, kind="stable")
                row, start, count, lead, name, known = (x[order] for x in (row, start, count, lead, name, known))
                for bucket, s, e in slices(ranges(name, buckets)):
                    text = np.frombuffer(b"".join(texts[j] for j in order[s:e]), np.uint8)
                    out.append((bucket, _entries(keys, row[s:e], small(start[s:e]), small(count[s:e]),
                                                 small(lead[s:e]), name[s:e], known[s:e], text)))
            if whole:
                hi, tail, row, at = (np.concatenate(x) for x in zip(*whole))
                order = np.lexsort((at, keys[row], tail, hi))
                hi, tail, row, at = hi[order], tail[order], row[order], at[order]
                k, run = keys[row], run_ids(hi, tail)
                lead = np.concatenate(([True], run[1:] != run[:-1]))
                # repeated within the batch: settled here, one witness is sent
                first_of = np.flatnonzero(lead)[run]
                other = (k != k[first_of]) | (at != at[first_of])
                known = (np.bincount(run, weights=other) > 0)[run]
                if known.any():
                    out.append((3 * buckets + int(k[known][0]) % buckets,
                                _entries(keys, row[known], small(at[known]), np.ones(known.sum(), np.uint8))))
                hi, tail, row, at, known = (x[lead] for x in (hi, tail, row, at, known.astype(np.uint8)))
                for bucket, s, e in slices(ranges(hi, buckets)):
                    out.append((buckets + bucket, _entries(keys, row[s:e], small(at[s:e]), deltas(hi[s:e]),
                                                           tail[s:e], known[s:e])))
            if out:
                yield as_batch(BLOBS, *zip(*out))
    return run


def induced_repeats(name, count, lead, texts: list[bytes], length: int):
    """Step 3 for one shard: (item, window) pairs whose ``length`` bytes another item of the same
    name has at the same distance from the sample.

    Carries the order of the suffixes and the common prefix of neighbours (capped at ``length``)
    from step to step; ``lead`` bytes precede the sample of each item.
    """
    m = len(texts)
    k = length // 2
    right = np.array([len(t) for t in texts]) - lead
    # order of the sample suffixes: names agree on k bytes, the rest is compared in 8-byte words
    width = -(-max(1, int(right.max()) - k) // 8) * 8
    rest = np.zeros((m, width), np.uint8)
    before = np.zeros((m, max(1, int(lead.max()))), np.uint8)     # nearest preceding byte first
    for i, t in enumerate(texts):
        x = np.frombuffer(t, np.uint8)
        rest[i, : right[i] - k] = x[lead[i] + k:]
        before[i, : lead[i]] = x[: lead[i]][::-1]
    words = rest.view(">u8").astype(np.uint64)
    order = np.lexsort((right, *(words[:, j] for j in range(words.shape[1] - 1, -1, -1)), name))
    rest, right_o, name_o = rest[order], right[order], name[order]
    lcp = np.zeros(m, np.int64)           # of each suffix with the one before it
    if m > 1:
        differ = rest[1:] != rest[:-1]
        common = np.where(differ.any(axis=1), differ.argmax(axis=1), width) + k
        common = np.minimum(common, np.minimum(right_o[1:], right_o[:-1]))
        lcp[1:] = np.where(name_o[1:] == name_o[:-1], np.minimum(common, length), 0)
    hits = []
    step = 0
    while len(order):
        alike = lcp >= length
        alike[:-1] |= lcp[1:] >= length
        w = lead[order] - step                # the window that starts at this suffix
        ok = alike & (w < count[order])
        hits.append((order[ok], w[ok]))
        # suffixes with a byte left to prepend, by (name, byte), previous order inside
        alive = np.flatnonzero(lead[order] > step)
        if not len(alive):
            break
        byte = before[order[alive], step]
        group = run_ids(name[order[alive]])
        perm = alive[np.argsort(group * 256 + byte, kind="stable")]
        key = np.empty(len(lcp), np.int64)
        key[alive] = group * 256 + byte
        nxt = np.zeros(len(perm), np.int64)
        if len(perm) > 1:
            same = np.flatnonzero(key[perm[1:]] == key[perm[:-1]])
            lo, hi = perm[:-1][same] + 1, perm[1:][same] + 1
            if len(lo):
                padded = np.append(lcp, 0)
                spans = np.column_stack((lo, hi)).ravel()
                nxt[same + 1] = np.minimum(np.minimum.reduceat(padded, spans)[::2] + 1, length)
        order, lcp = order[perm], nxt
        # suffixes that share nothing with either neighbour can't come back: their order position
        # no longer matters for anyone else once both common prefixes are 0
        lonely = (lcp == 0) & (np.append(lcp[1:], 0) == 0)
        if lonely.any():
            order, lcp = order[~lonely], lcp[~lonely]
        step += 1
    return (np.concatenate(x) for x in zip(*hits)) if hits else (np.zeros(0, np.int64),) * 2


def _induce(buckets: int, length: int):
    """Reduce side of step 3: removed windows as (start, number of windows), by document."""
    def run(key, table):
        bucket = key[0].as_py()
        blobs = [unpack(x.as_py()) for x in table.column("blob")]
        k = [packed_keys(x[0])[x[1]] for x in blobs]
        if bucket >= 3 * buckets:
            start, count = (np.concatenate([x[i] for x in blobs]).astype(np.int64) for i in (2, 3))
            return to_shards(buckets, np.concatenate(k), start, count)
        if bucket >= buckets:
            at, tail, known = (np.concatenate([x[i] for x in blobs]).astype(np.int64) for i in (2, 4, 5))
            hi = np.concatenate([np.cumsum(x[3].astype(np.uint64)) for x in blobs])
            k = np.concatenate(k)
            order = np.lexsort((at, k, tail, hi))
            k, at, hi, tail, known = k[order], at[order], hi[order], tail[order], known[order]
            run = run_ids(hi, tail)
            first_of = np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1])))[run]
            other = (k != k[first_of]) | (at != at[first_of])
            hit = ((np.bincount(run, weights=other) > 0) | (np.bincount(run, weights=known) > 0))[run]
            k, at = k[hit], at[hit]
            return to_shards(buckets, k, at, np.ones(len(at), np.int64))
        k = np.concatenate(k)
        start, count, lead = (np.concatenate([x[i] for x in blobs]).astype(np.int64) for i in (2, 3, 4))
        name = np.concatenate([x[5] for x in blobs])
        known = np.concatenate([x[6] for x in blobs]).astype(bool)
        texts = []
        for x in blobs:
            raw, n = x[7].tobytes(), x[3].astype(np.int64) - 1 + length
            cut = np.concatenate(([0], np.cumsum(n)))
            texts += [raw[a:z] for a, z in zip(cut[:-1], cut[1:])]
        # a document listed twice may have sent the same place twice
        order = np.lexsort((start, k, name))
        new = np.ones(len(k), bool)
        o = order
        new[1:] = (k[o][1:] != k[o][:-1]) | (start[o][1:] != start[o][:-1]) | (name[o][1:] != name[o][:-1])
        o = o[new]
        k, start, count, lead, name, known = (x[o] for x in (k, start, count, lead, name, known))
        item, window = induced_repeats(name, count, lead, [texts[i] for i in o], length)
        real = ~known[item]
        item, window = item[real], window[real]
        return to_shards(buckets, k[item], start[item] + window, np.ones(len(item), np.int64))
    return run


KEPT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                  ("n_spans", pa.int64()), ("kept_text", pa.string()), ("kept_sha256", pa.string())])


def _finish(length: int, with_text: bool, keep: tuple[str, ...] = ()):
    def run(batches):
        for b in batches:
            out = []
            for doc_id, text, blob in zip(*(b.column(c) for c in ("doc_id", "text", "blob"))):
                raw = text.as_buffer().to_pybytes()
                removed = spans = 0
                kept = raw
                blob = blob.as_py()
                if blob:
                    start, count = (x.astype(np.int64) for x in unpack(blob))
                    cover = np.zeros(len(raw) + 1, np.int32)
                    np.add.at(cover, start, 1)
                    np.add.at(cover, start + count - 1 + length, -1)
                    gone = np.cumsum(cover[:-1]) > 0
                    removed = int(gone.sum())
                    spans = int((gone & ~np.concatenate(([False], gone[:-1]))).sum())
                    kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                out.append((doc_id.as_py(), len(raw), removed, spans,
                            kept.decode(errors="ignore") if with_text else None,
                            hashlib.sha256(kept).hexdigest()))
            done = as_batch(KEPT, *zip(*out)) if out else as_batch(KEPT, *[[]] * 6)
            yield pa.RecordBatch.from_arrays([*done.columns, *(b.column(c) for c in keep)],
                                             names=[*done.schema.names, *keep])
    return run


def dedup_suffixes(docs: DataFrame, length: int = 200, with_text: bool = True,
                   hot_contexts: tuple[int, int] = HOT_CONTEXTS, keep: tuple[str, ...] = ()) -> DataFrame:
    """Remove every byte (of the UTF-8 text) covered by a ``length``-byte string that also starts
    anywhere else, in any document or the same one; strings are judged on the input.

    Returns doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_text (remaining
    bytes as text; a character cut in two is left out), kept_sha256 (of the remaining bytes) and
    each row's own columns in ``keep``.
    Null text counts as empty; texts shorter than ``length`` lose nothing; repeated rows of one
    document are one document and each returns its row (null or repeated doc_ids:
    :func:`trailguard.llm.common.keyed_documents`); other columns are ignored; an empty table
    gives an empty result.  ``length`` must be at least 16 bytes.
    """
    if length < 16:
        raise ValueError("length must be at least 16 bytes")
    n = bucket_count(docs)
    docs = keyed_documents(docs, keep)
    blobs = "bucket int, blob binary"
    found = "shard bigint, blob binary"
    named = (docs.select("_k", "text").mapInArrow(_samples(n, length, hot_contexts[0]), blobs)
             .groupBy("bucket").applyInArrow(_named(n, hot_contexts[1]), found))
    repeats = (with_found(docs, named).mapInArrow(_tuples(n, length), blobs)
               .groupBy("bucket").applyInArrow(_induce(n, length), found))
    carried = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    out = with_found(docs, repeats).mapInArrow(
        _finish(length, with_text, keep),
        "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_text string, "
        "kept_sha256 string" + carried)
    return out if with_text else out.drop("kept_text")
