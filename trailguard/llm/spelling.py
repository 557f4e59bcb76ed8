"""Grouping spelling variants: words one inserted, deleted or replaced letter apart.

Words are runs of letters with A-Z lower-cased.  Each word is a point, its letter counts.  A replaced
letter moves one count up and one down (L1 distance two), an inserted one moves one up (distance
one), so near words are found by range searches in k-d trees, one tree per word length, for
the length pairs (L, L) and (L, L + 1).  A search goes down only into boxes it can still reach
with one step up and one down; the letter order of what it finds is then verified.  Words of equal
counts are never near and are not compared.

The planes of the upper trees are fitted on at most SAMPLE words (by hash; this decides only how
evenly work is dealt).  Every word is dealt to the leaf it lies in, and as a query to every leaf
its search reaches; a leaf with more than LEAF words or QUERIES queries is cut into blocks that
cover all pairs of both, so one task's share is bounded whatever the words are.  Each block has a
k-d tree of its own.  Pairs are reduced to one row per word and block before they leave it.

Cases: a null text has no words; a null doc_id counts as an empty id in the noise hash; repeated
rows count as often as they are listed; of equally frequent near words the smallest in code-point
order is the form; an empty table gives no words.  Columns besides doc_id and text are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailguard.llm.common import chunks, merged, prepare
from trailguard.llm.crc import crc_spans, runs, shift
from trailguard.session import materialize

SAMPLE = 200_000
LEAF = 4096
QUERIES = 65_536
LOCAL_LEAF = 8
SAMPLE_LENGTH = 64
COUNT_BYTES = 4 << 20
ROUTE_BYTES = 256 << 10
PAIRS = 200_000

_BYTES = np.arange(256)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
_ASCII_LETTER = (_BYTES >= 97) & (_BYTES <= 122)
LEAD = 0xC3                       # first byte of U+00C0 to U+00FF
LETTERS = 26 + 64


def _letters(data: np.ndarray) -> np.ndarray:
    lead = data == LEAD
    out = _ASCII_LETTER[data] | lead
    out[1:] |= lead[:-1]
    return out


def _words(data, starts, ends) -> pa.Array:
    """Spans as an Arrow string array."""
    size = ends - starts
    off = np.concatenate(([0], np.cumsum(size)))
    pick = np.repeat(starts - off[:-1], size) + np.arange(off[-1])
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(off.astype(np.int64)), pa.py_buffer(data[pick]))


def _count_chunk(ids: list, data: np.ndarray, off: np.ndarray, min_letters: int, noise: int | None):
    """(words, how often) of a run of whole texts, after the noise."""
    data = _LOWER[data]
    starts, ends, first = runs(_letters(data), off)
    points = np.concatenate(([0], np.cumsum(data & 0xC0 != 0x80)))
    length = points[ends] - points[starts]
    row = np.repeat(np.arange(len(off) - 1), np.diff(first))
    long = np.flatnonzero(length >= min_letters)
    starts, ends, length, row = starts[long], ends[long], length[long], row[long]
    odd, odd_words = np.zeros(len(starts), bool), []
    if noise and len(starts):
        key = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
        h = shift(key[row], ends - starts) ^ crc_spans(data, starts, ends)
        odd = h % np.uint32(noise) == 0
        for i in np.flatnonzero(odd):
            w = data[starts[i]: ends[i]].tobytes().decode()
            at = int(h[i]) % len(w)
            odd_words.append(w[:at] + w[at + 1:])
    words = _words(data, starts[~odd], ends[~odd])
    return pa.concat_arrays([words, pa.array(odd_words, pa.large_string())])


def word_counts(docs: DataFrame, min_letters: int = 6, min_count: int = 5, noise: int | None = 199) -> DataFrame:
    """word, n of every word with at least ``min_letters`` letters that occurs at least ``min_count`` times.  With
    ``noise`` an occurrence loses one letter where noise divides its hash of doc_id and word."""
    prepare(docs.sparkSession)
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def count(batches):
        for b in merged(batches, COUNT_BYTES):
            ids = b.column(0).to_pylist()
            for lo, data, off in chunks(b.column(1), COUNT_BYTES):
                words = _count_chunk(ids[lo: lo + len(off) - 1], data, off, min_letters, noise)
                got = pc.value_counts(words)
                yield pa.RecordBatch.from_arrays([got.field("values").cast(pa.string()),
                                                  got.field("counts").cast(pa.int64())], schema=schema)

    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("text is not null")
            .mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
            .where((F.col("n") >= min_count) & (F.char_length("word") >= min_letters)))


class Words:
    """Letter codes and letter counts of an Arrow array of words."""

    def __init__(self, col: pa.Array):
        col = col.cast(pa.large_binary())
        off = np.frombuffer(col.buffers()[1], np.int64)[col.offset: col.offset + len(col) + 1]
        data = np.frombuffer(col.buffers()[2] or b"", np.uint8)[off[0]: off[-1]] if len(col) else np.zeros(0, np.uint8)
        off = off - off[0] if len(col) else np.zeros(1, np.int64)
        lead = data == LEAD
        after = np.concatenate(([False], lead[:-1]))
        code = np.where(after, data.astype(np.int64) - 0x80 + 26, data.astype(np.int64) - 97)
        points = np.concatenate(([0], np.cumsum(~lead)))
        self.codes, self.off = code[~lead].astype(np.uint8), points[off]
        self.length = np.diff(self.off)

    def counts(self, which: np.ndarray) -> np.ndarray:
        n = self.length[which]
        row = np.repeat(np.arange(len(which)), n)
        at = np.repeat(self.off[which] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        flat = np.bincount(row * LETTERS + self.codes[at], minlength=len(which) * LETTERS)
        return flat.reshape(len(which), LETTERS).astype(np.int32)

    def letters(self, which: np.ndarray, length: int) -> np.ndarray:
        return self.codes[self.off[which][:, None] + np.arange(length)]


class KdTree:
    """Splits points on one letter's count at a time until a leaf holds at most ``size`` of them."""

    def __init__(self, points: np.ndarray, size: int):
        self.dim, self.cut, self.low, self.high, self.child, self.leaf = [], [], [], [], [], []
        self.members: list[np.ndarray] = []
        lo, hi = np.full(points.shape[1], -1), np.full(points.shape[1], np.iinfo(np.int32).max)
        self._grow(points, np.arange(len(points)), lo, hi, size)
        for name in ("dim", "cut", "low", "high", "child", "leaf"):
            setattr(self, name, np.array(getattr(self, name), np.int64))

    def _grow(self, points, which, lo, hi, size) -> int:
        node = len(self.dim)
        for held in (self.dim, self.cut, self.low, self.high, self.leaf):
            held.append(-1)
        self.child.append((-1, -1))
        split = self._split(points[which]) if len(which) > size else None
        if split is None:
            self.leaf[node] = len(self.members)
            self.members.append(which)
            return node
        d, cut = split
        self.dim[node], self.cut[node], self.low[node], self.high[node] = d, cut, lo[d], hi[d]
        below = points[which, d] <= cut
        left_hi, right_lo = hi.copy(), lo.copy()
        left_hi[d], right_lo[d] = cut, cut + 1
        left = self._grow(points, which[below], lo, left_hi, size)
        self.child[node] = (left, self._grow(points, which[~below], right_lo, hi, size))
        return node

    @staticmethod
    def _split(x):
        """The letter and count that part the points most evenly."""
        cut = np.median(x, axis=0).astype(np.int64)
        cut = np.where(cut >= x.max(axis=0), cut - 1, cut)
        part = (x <= cut).mean(axis=0)
        d = int(np.argmin(np.abs(part - .5)))
        return (d, int(cut[d])) if 0 < part[d] < 1 else None

    def search(self, points: np.ndarray, up: int, down: int):
        """(point, leaf) for every leaf whose box a point reaches with ``up`` steps up and ``down`` steps down."""
        q, node = np.arange(len(points)), np.zeros(len(points), np.int64)
        u, d = np.full(len(points), up), np.full(len(points), down)
        out = []
        while len(q):
            end = self.leaf[node] >= 0
            out.append((q[end], self.leaf[node[end]]))
            q, node, u, d = q[~end], node[~end], u[~end], d[~end]
            x = points[q, self.dim[node]]
            cut, low, high = self.cut[node], self.low[node], self.high[node]
            # steps already paid for this letter are given back before the narrower box is charged
            left = d + np.maximum(x - high, 0) - np.maximum(x - cut, 0)
            right = u + np.maximum(low - x, 0) - np.maximum(cut + 1 - x, 0)
            a, b = left >= 0, right >= 0
            child = self.child[node].reshape(-1, 2)
            q, node = np.concatenate((q[a], q[b])), np.concatenate((child[a, 0], child[b, 1]))
            u, d = np.concatenate((u[a], right[b])), np.concatenate((left[a], d[b]))
        return np.concatenate([x for x, _ in out] or [q]), np.concatenate([x for _, x in out] or [node])


class Forest:
    """One tree per word length; lengths that the sample lacks are a single leaf."""

    def __init__(self, sample: pa.Array, size: int):
        w = Words(sample)
        self.trees, self.first, n = {}, {}, 0
        for length in np.unique(w.length).tolist():
            self.trees[length] = t = KdTree(w.counts(np.flatnonzero(w.length == length)), size)
            self.first[length], n = n, n + len(t.members)
            t.members = []

    def leaves(self, length: int, points: np.ndarray, up: int, down: int):
        if length not in self.trees:
            return np.arange(len(points)), np.full(len(points), -length)
        q, leaf = self.trees[length].search(points, up, down)
        return q, leaf + self.first[length]

    def deal(self, words: pa.Array):
        """(word, leaf, is a query): each word in its own leaf, and as a query where its search reaches words of
        its own length or one letter more."""
        w = Words(words)
        out = []
        for length in np.unique(w.length).tolist():
            which = np.flatnonzero(w.length == length)
            points = w.counts(which)
            for target, up, down, query in ((length, 0, 0, False), (length, 1, 1, True), (length + 1, 1, 0, True)):
                q, leaf = self.leaves(target, points, up, down)
                out.append((which[q], leaf, np.full(len(q), query)))
        return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3


def _close(tree: KdTree, data: np.ndarray, query: np.ndarray, up: int, down: int):
    """(query, point) whose counts differ by exactly ``up`` up and ``down`` down."""
    q, leaf = tree.search(query, up, down)
    size = np.array([len(m) for m in tree.members])
    flat, at = np.concatenate(tree.members), np.cumsum(size) - size
    ends = np.cumsum(size[leaf])
    lo = 0
    while lo < len(q):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + PAIRS, "right")))
        n = size[leaf[lo:hi]]
        a = np.repeat(q[lo:hi], n)
        b = flat[np.repeat(at[leaf[lo:hi]] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        diff = data[b] - query[a]
        ok = (np.maximum(diff, 0).sum(axis=1) == up) & (np.maximum(-diff, 0).sum(axis=1) == down)
        yield a[ok], b[ok]
        lo = hi


def _classes(points: np.ndarray):
    """(distinct points, members of each in one array, offset of each, size of each)."""
    distinct, kind = np.unique(points, axis=0, return_inverse=True)
    kind = kind.reshape(-1)
    size = np.bincount(kind, minlength=len(distinct))
    return distinct, np.argsort(kind, kind="stable"), np.cumsum(size) - size, size


def _expand(a, b, ca, cb):
    """Word pairs of class pairs, in runs of about PAIRS."""
    (_, in_a, at_a, n_a), (_, in_b, at_b, n_b) = ca, cb
    n = n_a[a] * n_b[b]
    ends = np.cumsum(n)
    lo = 0
    while lo < len(a):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + PAIRS, "right")))
        m = n[lo:hi]
        k = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
        width = np.repeat(n_b[b[lo:hi]], m)
        yield (in_a[np.repeat(at_a[a[lo:hi]], m) + k // width], in_b[np.repeat(at_b[b[lo:hi]], m) + k % width])
        lo = hi


def near_in_block(words: pa.Array, is_query: np.ndarray):
    """(query, word) index pairs one letter apart; the words that are no queries all have one length."""
    w = Words(words)
    data = np.flatnonzero(~is_query)
    found = [(np.zeros(0, np.int64),) * 2]
    if len(data):
        length = int(w.length[data[0]])
        held = w.letters(data, length)
        counts = w.counts(data)
        for size, up, down in ((length, 1, 1), (length - 1, 1, 0)):
            query = np.flatnonzero(is_query & (w.length == size))
            if not len(query):
                continue
            asked, asked_counts = w.letters(query, size), w.counts(query)
            used = np.flatnonzero(counts.any(axis=0) | asked_counts.any(axis=0))
            cd, cq = _classes(counts[:, used]), _classes(asked_counts[:, used])
            tree = KdTree(cd[0], LOCAL_LEAF)
            for a, b in _close(tree, cd[0], cq[0], up, down):
                for i, j in _expand(a, b, cq, cd):
                    x, y = asked[i], held[j]
                    if size == length:
                        ok = (x != y).sum(axis=1) == 1
                    else:                   # equal up to a letter, and equal after it is left out
                        same = x == y[:, :-1]
                        head = np.where(same.all(axis=1), size, np.argmin(same, axis=1))
                        rest = x == y[:, 1:]
                        ok = (rest | (np.arange(size) < head[:, None])).all(axis=1)
                    found.append((query[i[ok]], data[j[ok]]))
    return tuple(np.concatenate(x) for x in zip(*found))


_PART = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("form_n", pa.int64()), ("form", pa.string())])


def _block(table: pa.Table) -> pa.Table:
    """Of each word of a block: how many near words it has there, and the most frequent of them."""
    words = table.column("word").combine_chunks()
    n = table.column("n").to_numpy()
    is_query = table.column("is_query").to_numpy(zero_copy_only=False).astype(bool)
    a, b = near_in_block(words, is_query)
    longer = pc.utf8_length(words).to_numpy(zero_copy_only=False)
    back = longer[b] > longer[a]             # pairs of a length pair are searched from the shorter word only
    a, b = np.concatenate((a, b[back])), np.concatenate((b, a[back]))
    if not len(a):
        return pa.Table.from_batches([], _PART)
    rank = np.empty(len(words), np.int64)
    rank[pc.array_sort_indices(words.cast(pa.large_binary())).to_numpy()] = np.arange(len(words))
    order = np.lexsort((rank[b], -n[b], a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1])))
    near = np.diff(np.append(first, len(a)))
    return pa.table([words.take(pa.array(a[first])).cast(pa.string()), pa.array(near), pa.array(n[b[first]]),
                     words.take(pa.array(b[first])).cast(pa.string())], schema=_PART)


def near_words(words: DataFrame, sample: int = SAMPLE, leaf: int = LEAF, queries: int = QUERIES) -> DataFrame:
    """word, n_near, form_n, form: of every word with near words their number, and the most frequent (ties:
    the smallest) with its count.  ``words`` has word and n, each word once."""
    total = words.count()
    share = min(1.0, sample / max(total, 1))
    fit = words.where((F.char_length("word") <= SAMPLE_LENGTH) & (
        F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < int(share * (1 << 30)))).select("word").toArrow()
    forest = Forest(fit.column("word").combine_chunks(), max(32, int(leaf * share)))

    def sizes(batches):
        held: dict = {}
        for b in merged(batches, ROUTE_BYTES):
            _, to, query = forest.deal(b.column(0))
            for is_query in (False, True):
                for k, c in zip(*np.unique(to[query == is_query], return_counts=True)):
                    held[int(k), is_query] = held.get((int(k), is_query), 0) + int(c)
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in held], pa.int64()), pa.array([q for _, q in held], pa.bool_()),
                                          pa.array(list(held.values()), pa.int64())], names=["leaf", "is_query", "n"])

    # only leaves over their size come to the driver: at most total / leaf of them
    big = words.select("word").mapInArrow(sizes, "leaf bigint, is_query boolean, n bigint") \
        .groupBy("leaf").agg(F.sum(F.when(F.col("is_query"), F.col("n")).otherwise(0)).alias("q"),
                             F.sum(F.when(~F.col("is_query"), F.col("n")).otherwise(0)).alias("d")) \
        .where((F.col("q") > queries) | (F.col("d") > leaf)).collect()
    cut = {r.leaf: (max(1, -(-r.d // leaf)), max(1, -(-r.q // queries))) for r in big}

    def deal(batches):
        for b in merged(batches, ROUTE_BYTES):
            which, to, query = forest.deal(b.column(0))
            seed = np.array([zlib.crc32(x.encode()) for x in b.column(0).to_pylist()], np.int64)
            block = np.zeros(len(which), np.int64)
            parts = []
            split = np.isin(to, list(cut)) if cut else np.zeros(len(to), bool)
            parts.append((which[~split], to[~split], query[~split], block[~split]))
            for k in np.unique(to[split]).tolist():
                rows, side = cut[k]
                for is_query in (False, True):
                    at = np.flatnonzero((to == k) & (query == is_query))
                    own = seed[which[at]] % (side if is_query else rows)
                    for other in range(rows if is_query else side):
                        cell = other * side + own if is_query else own * side + other
                        parts.append((which[at], to[at], query[at], cell))
            which, to, query, block = (np.concatenate(x) for x in zip(*parts))
            at = pa.array(which)
            yield pa.RecordBatch.from_arrays(
                [pa.array(to), pa.array(block), pa.array(query), b.column(0).take(at), b.column(1).take(at)],
                names=["leaf", "block", "is_query", "word", "n"])

    dealt = words.select("word", "n").mapInArrow(deal, "leaf bigint, block bigint, is_query boolean, word string, n bigint")
    parts = dealt.groupBy("leaf", "block").applyInArrow(_block, "word string, n_near bigint, form_n bigint, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("m"), F.col("form").alias("f")))
    return parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("_b")).select(
        "word", "n_near", (-F.col("_b.m")).alias("form_n"), F.col("_b.f").alias("form"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root of every word with a form: forms are followed to the last, twice as far each round.  Counts grow
    from form to form, so there are no rings."""
    held = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        then = held.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = materialize(held.join(then, "root", "left").select(
            "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "roots")
        held = moved.select("word", "root")
        if moved.where("_moved").isEmpty():
            return held


def spelling_groups(docs: DataFrame, min_letters: int = 6, min_count: int = 5, noise: int | None = 199,
                    factor: int = 5, sample: int = SAMPLE, leaf: int = LEAF, queries: int = QUERIES) -> DataFrame:
    """Every word with its count, near words, form (the most frequent near word, if at least ``factor`` times as
    frequent) and root: word, form, root, n, n_near, form_n."""
    words = materialize(word_counts(docs, min_letters, min_count, noise), "words")
    near = near_words(words, sample, leaf, queries)
    enough = F.col("form_n") >= factor * F.col("n")
    out = materialize(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(enough, F.col("form")).alias("form"), F.when(enough, F.col("form_n")).alias("form_n")), "forms")
    last = roots(out.where("form is not null"))
    return out.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
