"""CRC-32 of many short spans of a byte array at once, and the spans themselves.

CRC-32 is linear: the checksum of a concatenation is the first part's, moved on by the length of
the second, combined with the second part's own.  So checksums of word pairs, or of a prefix and
a word, come from those of the words without joining any bytes.
"""

from __future__ import annotations

import zlib

import numpy as np

U32 = np.uint32
ALL = U32(0xFFFFFFFF)
LONG = 64


def _byte_table() -> np.ndarray:
    t = np.arange(256, dtype=U32)
    for _ in range(8):
        t = np.where(t & U32(1), (t >> U32(1)) ^ U32(0xEDB88320), t >> U32(1))
    return t


TABLE = _byte_table()


def _shift_tables(bits: int = 40) -> list[np.ndarray]:
    """Entry b: four tables of 256 that together move a checksum on by 2^b zero bytes."""
    low = np.arange(256, dtype=U32)
    steps = [np.stack([(low << U32(8 * k) >> U32(8)) ^ TABLE[(low << U32(8 * k)) & U32(255)] for k in range(4)])]
    while len(steps) < bits:
        t = steps[-1]
        steps.append(np.stack([_apply(t, x) for x in t]))
    return steps


def _apply(t: np.ndarray, x: np.ndarray) -> np.ndarray:
    return t[0][x & U32(255)] ^ t[1][x >> U32(8) & U32(255)] ^ t[2][x >> U32(16) & U32(255)] ^ t[3][x >> U32(24)]


STEPS = _shift_tables()


def shift(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Checksums moved on by ``n`` bytes each: ``crc(a + b) = shift(crc(a), len(b)) ^ crc(b)``."""
    out = crc.astype(U32)
    for bit in range(int(n.max()).bit_length() if len(n) else 0):
        at = np.flatnonzero(n >> bit & 1)
        out[at] = _apply(STEPS[bit], out[at])
    return out


def extend(crc: np.ndarray, byte: int) -> np.ndarray:
    """Checksums after one more byte."""
    x = ~crc
    return ~(x >> U32(8) ^ TABLE[(x ^ U32(byte)) & U32(255)])


def crc_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of every span, one byte column after the other; spans over LONG bytes go to zlib."""
    size = ends - starts
    order = np.argsort(-np.minimum(size, LONG + 1), kind="stable")
    s, n = starts[order], size[order]
    first = int(np.searchsorted(-n, -LONG, "left"))          # spans before it are longer than LONG
    got = np.full(len(s), ALL, U32)
    for j in range(int(n[first]) if first < len(n) else 0):
        live = int(np.searchsorted(-n, -j, "left"))          # spans longer than j
        x = got[first:live]
        got[first:live] = x >> U32(8) ^ TABLE[(x ^ data[s[first:live] + j]) & U32(255)]
    got = ~got
    for i in range(first):
        got[i] = zlib.crc32(data[s[i]: s[i] + n[i]])
    out = np.empty(len(s), U32)
    out[order] = got
    return out


def runs(inside: np.ndarray, off: np.ndarray):
    """Maximal runs of ``inside`` that do not cross rows: (starts, ends, index of each row's first run)."""
    n = len(inside)
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    before = np.zeros(n, bool)
    after = np.zeros(n, bool)
    before[1:] = inside[:-1]
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, off, "left")
