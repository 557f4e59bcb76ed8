"""Quality rules as a short-circuit cascade.

Each rule is a vectorised test on a run of texts.  On a sample every rule is timed and its
rejections are counted; rules are then ordered by rejections per second, and each text is
tested only until the first rule rejects it.  The order changes the cost, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailguard.llm.common import (U64, Rolling, as_batch, chunks, mix, prepare, words_of)

BYTES, WORDS = Rolling(41), Rolling(42)
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True


class Run:
    """A run of texts with lazily computed measures; each is an array over the texts."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        self.data, self.off, self._kept = data, off, {}

    def of(self, name: str):
        if name not in self._kept:
            self._kept[name] = getattr(self, "_" + name)()
        return self._kept[name]

    def take(self, rows: np.ndarray) -> "Run":
        """The run of some of the texts."""
        size = np.diff(self.off)[rows]
        off = np.concatenate(([0], np.cumsum(size)))
        keep = np.zeros(len(self.data) + 1, np.int8)
        np.add.at(keep, self.off[:-1][rows], 1)
        np.add.at(keep, self.off[1:][rows], -1)
        return Run(self.data[np.cumsum(keep[:-1]) > 0], off)

    def _per_text(self, flags):
        c = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return c[self.off[1:]] - c[self.off[:-1]]

    def _words(self):
        return words_of(self.data, self.off)

    def _n_words(self):
        return np.diff(self.of("words")[2])

    def _n_chars(self):
        return self._per_text((self.data & 0xC0) != 0x80)

    def _word_chars(self):
        d = self.data
        return self._per_text(((d & 0xC0) != 0x80) & (d != 32) & ((d < 9) | (d > 13)))

    def _n_symbols(self):
        return self._per_text(SYMBOLS[self.data])

    def _lines(self):
        """(row, has a word, hash) of every \\n-split line."""
        nl = np.flatnonzero(self.data == 10)
        rows = np.concatenate((np.arange(len(self.off) - 1), np.searchsorted(self.off, nl, "right") - 1))
        start = np.concatenate((self.off[:-1], nl + 1))
        order = np.lexsort((start, rows))
        rows, start = rows[order], start[order]
        end = np.where(np.append(rows[1:] == rows[:-1], False), np.append(start[1:], 0) - 1, self.off[1:][rows])
        ws = self.of("words")[0]
        worded = np.searchsorted(ws, end, "left") > np.searchsorted(ws, start, "left")
        rows, start, end = rows[worded], start[worded], end[worded]
        return rows, BYTES.span(BYTES.prefix(BYTES.table[self.data]), start, end)

    def _n_lines(self):
        return np.bincount(self.of("lines")[0], minlength=len(self.off) - 1)

    def _n_dup_lines(self):
        rows, h = self.of("lines")
        order = np.lexsort((h, rows))
        again = np.zeros(len(rows), bool)
        again[1:] = (rows[order][1:] == rows[order][:-1]) & (h[order][1:] == h[order][:-1])
        return np.bincount(rows[order][again], minlength=len(self.off) - 1)

    def _word_hashes(self):
        s, e, _ = self.of("words")
        return BYTES.span(BYTES.prefix(BYTES.table[self.data]), s, e)

    def _row_of_word(self):
        return np.repeat(np.arange(len(self.off) - 1), self.of("n_words"))

    def _n_repeat_words(self, width: int = 5):
        v, rows = self.of("word_hashes"), self.of("row_of_word")
        m = len(v) - width + 1
        if m <= 0:
            return np.zeros(len(self.off) - 1, np.int64)
        i = np.flatnonzero(rows[:m] == rows[width - 1:])
        h = WORDS.span(WORDS.prefix(v), i, i + width)
        h = mix(h ^ (rows[i].astype(np.uint64) * U64(0x9E3779B97F4A7C15)))      # within the text only
        order = np.argsort(h, kind="stable")
        hs = h[order]
        equal = hs[1:] == hs[:-1]
        twice = np.zeros(len(h), bool)
        twice[1:] = equal
        twice[:-1] |= equal
        cover = np.zeros(len(v) + 1, np.int32)
        at = i[order[twice]]
        cover[at] += 1                      # window starts are distinct
        np.add.at(cover, at + width, -1)
        return np.bincount(rows[np.cumsum(cover[:-1]) > 0], minlength=len(self.off) - 1)

    def _n_stutter(self):
        v, rows = self.of("word_hashes"), self.of("row_of_word")
        same = (v[1:] == v[:-1]) & (rows[1:] == rows[:-1])
        return np.bincount(rows[1:][same], minlength=len(self.off) - 1)


@dataclass(frozen=True)
class Rule:
    """``rejects(run)`` gives a flag per text."""
    name: str
    rejects: Callable[[Run], np.ndarray]


def too_short(run: Run) -> np.ndarray:
    return run.of("n_words") < 10


def repetitive(run: Run) -> np.ndarray:
    return 100 * run.of("n_repeat_words") > 20 * run.of("n_words")


def symbols(run: Run) -> np.ndarray:
    return 10 * run.of("n_symbols") > run.of("n_words")


def word_length(run: Run) -> np.ndarray:
    """Mean word length outside 2 to 12 characters."""
    c, n = run.of("word_chars"), run.of("n_words")
    return (c < 2 * n) | (c > 12 * n)


def dup_lines(run: Run) -> np.ndarray:
    """More than 40 % of at least 5 lines repeat an earlier one."""
    n = run.of("n_lines")
    return (n >= 5) & (10 * run.of("n_dup_lines") > 4 * n)


def stutter(run: Run) -> np.ndarray:
    """A quarter of the words equal the word before."""
    return 4 * run.of("n_stutter") > run.of("n_words")


BASE = (Rule("too_short", too_short), Rule("repetitive", repetitive))
RULES = (Rule("symbols", symbols), Rule("word_length", word_length), Rule("dup_lines", dup_lines),
         Rule("stutter", stutter))


def order_rules(rules, texts: pa.Array) -> list[Rule]:
    """Rules by rejections per second on sampled texts; ties and rules without rejections keep
    their place, cheapest first."""
    cost, hits = dict.fromkeys((r.name for r in rules), 0.0), dict.fromkeys((r.name for r in rules), 0)
    for _, data, off in chunks(texts):
        for r in rules:
            run = Run(data, off)            # each rule pays for its own measures
            t = time.perf_counter()
            hits[r.name] += int(r.rejects(run).sum())
            cost[r.name] += time.perf_counter() - t
    return sorted(rules, key=lambda r: (-hits[r.name] / max(cost[r.name], 1e-9), cost[r.name]))


def cascade(run: Run, rules, alive: np.ndarray) -> np.ndarray:
    """Texts of ``alive`` that no rule rejects; each rule sees only what is left."""
    alive = alive.copy()
    for r in rules:
        rows = np.flatnonzero(alive)
        if not len(rows):
            break
        if len(rows) == len(alive):
            alive[rows[r.rejects(run)]] = False
        else:
            alive[rows[r.rejects(run.take(rows))]] = False
    return alive


SAMPLE_SPLITS = 32
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _sample(docs: DataFrame, rows: int) -> pa.Array:
    """Up to ``rows`` texts for costs and selectivities, without effect on verdicts: the first rows of at
    most ``SAMPLE_SPLITS`` input splits, spread evenly over the table.  Only these splits are
    read, however large the table."""
    texts = docs.select("text").rdd
    n = texts.getNumPartitions()
    picked = sorted({i * n // SAMPLE_SPLITS for i in range(SAMPLE_SPLITS)}) if n else []
    share = -(-rows // max(1, len(picked)))
    got = docs.sparkSession.sparkContext.runJob(texts, lambda split: [r[0] for r in islice(split, share)], picked)
    return pa.array(got[:rows], pa.large_string())


def _scored(rules):
    schema = pa.schema([("doc_id", pa.int64())] + [(m, pa.int64()) for m in MEASURES] +
                       [("base_failed", pa.bool_()), ("kept", pa.bool_())])

    def run(batches):
        for b in batches:
            ids = b.column("doc_id")
            for lo, data, off in chunks(b.column("text")):
                r = Run(data, off)
                base = too_short(r) | repetitive(r)
                yield as_batch(schema, ids.slice(lo, len(off) - 1), *(r.of(m) for m in MEASURES), base,
                               cascade(r, rules, ~base))
    return run


def score_quality(docs: DataFrame, rules=RULES, sample_rows: int = 2000) -> DataFrame:
    """Per document doc_id, the base measures, base_failed and kept (passed the base and every
    rule).  Null text has no words and fails the base; every row is judged on its own, so
    repeated rows agree; other columns are ignored; an empty table gives an empty result."""
    prepare(docs.sparkSession)
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))
    ordered = order_rules(rules, _sample(base, sample_rows))
    return base.mapInArrow(_scored(ordered), "doc_id bigint, " + ", ".join(f"{m} bigint" for m in MEASURES)
                           + ", base_failed boolean, kept boolean")


def _passing(rules, text_at: str):
    def run(batches):
        for b in batches:
            col = b.column(text_at)
            parts = [cascade(Run(d, o), rules, np.ones(len(o) - 1, bool)) for _, d, o in chunks(col.fill_null(""))]
            if parts:
                yield b.filter(pa.array(np.concatenate(parts)))
    return run


def filter_quality(docs: DataFrame, rules=BASE + RULES, sample_rows: int = 2000) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, whose text passes every rule."""
    prepare(docs.sparkSession)
    ordered = order_rules(rules, _sample(docs.select(F.coalesce("text", F.lit("")).alias("text")), sample_rows))
    return docs.mapInArrow(_passing(ordered, "text"), docs.schema)
