"""Fast ids for whole texts from the ``tokenizers`` library.

Both public vocabularies cut a text into stretches before they merge, and no token spans a cut.
A cut always lies before a space that a visible character follows, between a letter and a
following mark, and around a line break between visible characters.  Texts are therefore taken
apart at spaces, the distinct parts of a slice into lines, letter stems and marks, all as Arrow and
numpy columns; only stems that the worker has not met lately go through the library.  Texts with
anything unusual (runs of white space, characters beyond U+024F at a cut, a special token's string
where it counts as one) are encoded whole.  The ids equal encoding whole texts.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ɏ"
#: A line of a part: letters, then ASCII marks other than the apostrophe.
_PLAIN = rf"^(?P<stem>[{_LETTERS}]+)(?P<mark>[!-&(-/:-@\[-`{{-~]*)$"
#: What may follow the space of a cut.
_SAFE = "^[!-~À-ɏ]"
CACHE_STEMS = 500_000
SLICE_BYTES = 8 << 20
_LOADED: dict = {}


def encoder(path: str, special_as_text: bool = False) -> "Encoder":
    """One encoder per worker process, vocabulary file and reading of special tokens."""
    key = path, special_as_text
    if key not in _LOADED:
        _LOADED[key] = Encoder(path, special_as_text)
    return _LOADED[key]


def _pick(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Positions of spans one after the other."""
    size = size.astype(np.int32)
    ends = np.cumsum(size, dtype=np.int32)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(start.astype(np.int32) - (ends - size), size) + np.arange(total, dtype=np.int32)


class _Table:
    """Ids of strings in one array.  A full table keeps the strings of the last two slices, or none
    where those alone would fill half of it."""

    def __init__(self, ids_of):
        self.ids_of, self.now = ids_of, 0
        self._reset({}, np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0, np.int64))

    def _reset(self, row, flat, size, last):
        self.row, self.flat, self.size, self.last = row, flat, size, last

    def rows(self, keys: list[str]) -> np.ndarray:
        """Row of each of the distinct ``keys``."""
        self.now += 1
        new = [k for k in keys if k not in self.row]
        if new and len(self.row) + len(new) > CACHE_STEMS:
            keep = np.flatnonzero(self.last >= self.now - 2)
            if 2 * len(keep) > CACHE_STEMS:
                keep = keep[:0]
            names = list(self.row)
            self._reset({names[i]: n for n, i in enumerate(keep.tolist())},
                        self.flat[_pick(self.start[keep], self.size[keep])], self.size[keep], self.last[keep])
            new = [k for k in keys if k not in self.row]
        if new:
            flat, size = self.ids_of(new)
            n = len(self.row)
            self.row.update(zip(new, range(n, n + len(new))))
            self._reset(self.row, np.concatenate((self.flat, flat)), np.concatenate((self.size, size)),
                        np.concatenate((self.last, np.zeros(len(new), np.int64))))
        got = np.fromiter(map(self.row.__getitem__, keys), np.int64, len(keys))
        self.last[got] = self.now
        return got

    @property
    def start(self) -> np.ndarray:
        return np.cumsum(self.size) - self.size


class Encoder:
    def __init__(self, path: str, special_as_text: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.lib = Tokenizer.from_file(path)
        self.lib.encode_special_tokens = special_as_text
        self.special = [] if special_as_text else \
            [t.content for t in self.lib.get_added_tokens_decoder().values()]
        self.folds = self._ids(["Aa", " Zz"])[0].tolist() == self._ids(["aa", " zz"])[0].tolist()
        self.line = self._ids(["a\nb"])[0][len(self._ids(["a"])[0]): -len(self._ids(["b"])[0])]
        # a separator that becomes one id of its own between stems
        self.sep = None
        a, b = self._ids([" a"])[0], self._ids([" b"])[0]
        for sep in ("\n", " \x01"):
            got = self._ids([" a" + sep + " b"])[0]
            mid = got[len(a): -len(b)]
            if len(mid) == 1 and got.tolist() == [*a, *mid, *b]:
                self.sep, self.sep_id = sep, int(mid[0])
                break
        self.after = _Table(lambda new: self._stems(" ", new))
        self.bare = _Table(lambda new: self._stems("", new))
        self.marks = _Table(self._ids)

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids end to end, their number per text)."""
        ids = [e.ids for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)] if texts else []
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter((i for x in ids for i in x), "<u4", int(size.sum())), size

    def _stems(self, lead: str, stems: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.sep is None:
            return self._ids([lead + s for s in stems])
        flats, sizes = [], []
        for lo in range(0, len(stems), 2000):
            some = stems[lo: lo + 2000]
            joined = self.sep.join(lead + s for s in some) if self.sep == "\n" else \
                lead + (self.sep + " ").join(some)
            ids = np.array(self.lib.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
            cut = np.flatnonzero(ids == self.sep_id)
            sizes.append(np.diff(np.concatenate(([-1], cut, [len(ids)]))) - 1)
            flats.append(np.delete(ids, cut))
        return np.concatenate(flats), np.concatenate(sizes)

    def _plain(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, their number per part, taken) of parts that stand after a space; parts with a line that
        is not letters and marks are not taken and have no ids."""
        lines = pc.split_pattern(parts, "\n")
        off = lines.offsets.to_numpy().astype(np.int64)
        off -= off[0]
        found = pc.extract_regex(lines.flatten(), _PLAIN)
        ok = np.logical_and.reduceat(found.is_valid().to_numpy(zero_copy_only=False), off[:-1])
        n_lines = np.diff(off)
        of_part = np.repeat(np.arange(len(parts)), n_lines)
        use = np.flatnonzero(ok[of_part])
        first = np.zeros(len(of_part), bool)
        first[off[:-1]] = True
        first = first[use]
        found = found.take(pa.array(use))
        stem = found.field("stem")
        if self.folds:
            stem = pc.ascii_lower(stem)

        start, size = np.zeros(len(use), np.int64), np.zeros(len(use), np.int64)
        flats, base = [self.line], len(self.line)
        for table, rows in ((self.after, np.flatnonzero(first)), (self.bare, np.flatnonzero(~first))):
            got = stem.take(pa.array(rows)).dictionary_encode()
            at = table.rows(got.dictionary.to_pylist())[got.indices.to_numpy()]
            start[rows], size[rows] = base + table.start[at], table.size[at]
            flats.append(table.flat)
            base += len(table.flat)
        got = found.field("mark").dictionary_encode()
        at = self.marks.rows(got.dictionary.to_pylist())[got.indices.to_numpy()]
        starts = np.stack((np.zeros(len(use), np.int64), start, base + self.marks.start[at]), 1).ravel()
        sizes = np.stack((np.where(first, 0, len(self.line)), size, self.marks.size[at]), 1)
        flats.append(self.marks.flat)
        ids = np.concatenate(flats)[_pick(starts, sizes.ravel())]
        n = np.bincount(of_part[use], weights=sizes.sum(1), minlength=len(parts)).astype(np.int64)
        return ids, n, ok

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, offset of each text), without special tokens added."""
        if not len(texts):
            return np.zeros(0, "<u4"), np.zeros(1, np.int64)
        texts = texts.cast(pa.large_string())
        split = pc.split_pattern(texts, " ")
        off = split.offsets.to_numpy().astype(np.int64)
        off -= off[0]
        words = split.flatten().dictionary_encode()
        which = words.indices.to_numpy().astype(np.int32)
        parts = words.dictionary
        heads = which[off[:-1]]                      # stand at a text's start, not after a space
        safe = pc.match_substring_regex(parts, _SAFE).to_numpy(zero_copy_only=False)
        bad = ~safe[which]
        bad[off[:-1]] = False
        in_whole = np.logical_or.reduceat(bad, off[:-1])
        for token in self.special:
            in_whole |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        whole = np.flatnonzero(in_whole)

        # one table of spans: parts, odd parts in their place, heads, whole texts
        flat, size, taken = self._plain(parts)
        at = np.cumsum(size) - size
        odd = np.flatnonzero(safe & ~taken)
        odd_ids, odd_n = self._ids([" " + p for p in parts.take(pa.array(odd)).to_pylist()])
        size[odd], at[odd] = odd_n, len(flat) + np.cumsum(odd_n) - odd_n
        rest_ids, rest_n = self._ids(parts.take(pa.array(heads)).to_pylist()
                                     + texts.take(pa.array(whole)).to_pylist())
        at = np.concatenate((at, len(flat) + len(odd_ids) + np.cumsum(rest_n) - rest_n)).astype(np.int32)
        size = np.concatenate((size, rest_n)).astype(np.int32)
        flat = np.concatenate((flat, odd_ids, rest_ids))
        src = which.copy()
        src[off[:-1]] = len(parts) + np.arange(len(heads))
        n = size[src]
        if len(whole):
            n[np.repeat(in_whole, np.diff(off))] = 0
            src[off[whole]] = len(parts) + len(heads) + np.arange(len(whole))
            n[off[whole]] = size[src[off[whole]]]
        ends = np.cumsum(n, dtype=np.int64)
        return flat[_pick(at[src], n)], np.concatenate(([0], ends[off[1:] - 1]))


def encoded(enc: Encoder, col: pa.Array):
    """Encode a column slice by slice: yields (first row, ids, offsets)."""
    col = col.cast(pa.large_string())
    size = pc.binary_length(col).to_numpy(zero_copy_only=False)
    part = np.cumsum(size) // SLICE_BYTES
    cut = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))) if len(size) else []
    for lo, hi in zip(cut, [*cut[1:], len(size)]):
        yield int(lo), *enc.encode(col.slice(int(lo), int(hi - lo)))
