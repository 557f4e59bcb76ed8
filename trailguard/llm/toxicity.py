"""Toxicity: a weighted lexicon matched by Aho-Corasick.

Texts are folded first: case, accents, full-width forms, look-alike letters of other scripts and
digits or signs that stand for letters.  The lexicon holds word beginnings (stems catch invented
inflections) whose weights are log odds learned from labelled documents; exception phrases are
pairs of words in which a lexicon word is harmless.  A document's weights add up, are normalised
by its length, and become a score between 0 and 1.

The lexicon is fitted on at most ``max_labelled`` labelled rows (the smallest hashes of doc_id)
and has at most ``max_terms`` terms and ``max_exceptions`` phrases, so it can be sent to every
task.  Scoring reads whole texts of all documents.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailguard.llm.common import as_batch, prepare

#: Characters that look like or stand for a letter.
LOOKALIKE = {
    "а": "a", "в": "b", "с": "c", "е": "e", "н": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o",
    "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "ı": "i", "ł": "l", "ø": "o", "đ": "d", "ß": "s",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i",
}
_TABLE = str.maketrans(LOOKALIKE)
_NOT_LETTER = re.compile(r"[^a-z]+")
#: A stand-in counts only inside a word that has letters: "4$" or a closing "!" says nothing.
_STAND_IN = re.compile(r"(?<=[^\W\d_])[0134578@$!]+(?=[^\W\d_])|(?<![\w@$!])[0134578@$](?=[^\W\d_])")
STEM_LENGTHS = (4, 5, 6, 7, 8)


def fold(text: str) -> str:
    """Lower-case Latin words, each between single spaces (also at both ends)."""
    t = text.lower()
    if not t.isascii():
        t = unicodedata.normalize("NFKD", t)
        t = "".join(c for c in t if not unicodedata.combining(c))
        t = t.translate({k: v for k, v in _TABLE.items() if k > 127})
    if re.search(r"[0134578@$!]", t):
        t = _STAND_IN.sub(lambda m: m.group().translate(_TABLE), t)
    return " " + _NOT_LETTER.sub(" ", t).strip() + " "


def _terms(words: set[str]) -> set[str]:
    out = set()
    for w in words:
        if len(w) <= 20:
            out.add(w + " ")
        out.update(w[:n] for n in STEM_LENGTHS if len(w) >= n)
    return out


@dataclass(frozen=True)
class Lexicon:
    """Terms (a trailing space makes it a whole word) with weights, exception phrases, and the
    coefficients of the final logistic step."""
    terms: tuple[tuple[str, float], ...]
    exceptions: tuple[tuple[str, str], ...] = ()
    slope: float = 1.0
    bias: float = 0.0


class Matcher:
    def __init__(self, lexicon: Lexicon):
        self.lex = lexicon
        self.auto = ahocorasick.Automaton()
        for term, weight in lexicon.terms:
            self.auto.add_word(" " + term, (len(term) + 1, weight))
        if lexicon.terms:
            self.auto.make_automaton()
        self.except_ = set(lexicon.exceptions)

    def hits(self, folded: str):
        """(weight, word, word before, word after) of each matched word; the heaviest term counts."""
        found: dict[int, float] = {}
        if self.lex.terms:
            for end, (n, w) in self.auto.iter(folded):
                at = end - n + 2
                found[at] = max(w, found.get(at, 0.0))
        for at, w in found.items():
            stop = folded.index(" ", at)
            before = folded[folded.rindex(" ", 0, at - 1) + 1: at - 1] if at > 1 else ""
            nxt = folded.find(" ", stop + 1)
            yield w, folded[at:stop], before, folded[stop + 1: nxt] if nxt > 0 else ""

    def weight(self, folded: str) -> float:
        """Sum of weights of matches outside exception phrases, normalised by length."""
        total = sum(w for w, word, before, after in self.hits(folded)
                    if (before, word) not in self.except_ and (word, after) not in self.except_)
        n = folded.count(" ") - 1
        return float(np.log1p(100.0 * total / (n + 100.0)))


def _logistic(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and bias by Newton's method with a small ridge."""
    a, b = 1.0, -1.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        w = p * (1 - p)
        g = np.array([((p - y) * z).sum() + 0.01 * a, (p - y).sum() + 0.01 * b])
        h = np.array([[(w * z * z).sum() + 0.01, (w * z).sum()], [(w * z).sum(), w.sum() + 0.01]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-8:
            break
    return max(float(a), 1e-6), float(b)


def _count_terms(batches):
    schema = pa.schema([("term", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])
    for b in batches:
        count = {0: Counter(), 1: Counter()}
        for text, y in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist()):
            count[y].update(_terms(set(fold(text).split())))
        toxic, clean = count[1], count[0]
        terms = list(toxic.keys() | clean.keys())
        yield as_batch(schema, terms, [toxic[t] for t in terms], [clean[t] for t in terms])


def _measure(lexicon: Lexicon):
    """Per training text its normalised weight and the phrases around matches."""
    schema = pa.schema([("toxic", pa.int64()), ("z", pa.float64()), ("first", pa.string()), ("second", pa.string())])

    def run(batches):
        m = Matcher(lexicon)
        for b in batches:
            out = []
            for text, y in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist()):
                f = fold(text)
                out.append((y, m.weight(f), None, None))
                pairs = set()
                for _, word, before, after in m.hits(f):
                    pairs |= {(before, word), (word, after)}
                out += [(y, None, *p) for p in pairs if all(p)]
            if out:
                yield as_batch(schema, *zip(*out))
    return run


def fit_lexicon(docs: DataFrame, labels: DataFrame, train, max_labelled: int = 50_000, max_terms: int = 500,
                max_exceptions: int = 500, min_toxic: int = 3, min_weight: float = 2.0) -> Lexicon:
    """Learn terms, weights, exceptions and the final step from labelled documents for which the
    column condition ``train`` (on doc_id) holds.  Without toxic examples the lexicon is empty."""
    prepare(docs.sparkSession)
    rows = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("bigint").alias("toxic")) \
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).where(train) \
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id")).limit(max_labelled)
    sample = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where(F.col("text").isNotNull()) \
        .join(F.broadcast(rows), "doc_id").select("text", "toxic").persist()     # at most max_labelled small rows
    n = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    pos, neg = n.get(1, 0), n.get(0, 0)
    if not pos:
        return Lexicon(())
    odds = F.log((F.col("a") + 0.5) / F.lit(pos + 1.0)) - F.log((F.col("b") + 0.5) / F.lit(neg + 1.0))
    best = (sample.mapInArrow(_count_terms, "term string, toxic bigint, clean bigint")
            .groupBy("term").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b"))
            .where(F.col("a") >= min_toxic).withColumn("w", odds).where(F.col("w") >= min_weight)
            .orderBy(F.desc(F.col("a") * F.col("w")), F.length("term"), "term").limit(max_terms).collect())
    # a longer term that adds nothing to a kept beginning of it is left out
    kept: dict[str, float] = {}
    for r in sorted(best, key=lambda r: (len(r.term), r.term)):
        if not any(r.term.startswith(t) and w >= r.w - 0.7 for t, w in kept.items()):
            kept[r.term] = float(r.w)
    lexicon = Lexicon(tuple(sorted(kept.items())))
    seen = sample.mapInArrow(_measure(lexicon), "toxic bigint, z double, first string, second string").persist()
    pairs = (seen.where("first is not null").groupBy("first", "second")
             .agg(F.sum(1 - F.col("toxic")).alias("clean"), F.sum("toxic").alias("bad"))
             .where((F.col("clean") >= 3) & (F.col("clean") > 3 * F.col("bad")))
             .orderBy(F.desc("clean"), "first", "second").limit(max_exceptions).collect())
    seen.unpersist()
    lexicon = Lexicon(lexicon.terms, tuple((r["first"], r["second"]) for r in pairs))
    zy = sample.mapInArrow(_measure(lexicon), "toxic bigint, z double, first string, second string") \
        .where("z is not null").select("z", "toxic").toArrow()                    # two numbers a labelled row
    sample.unpersist()
    z, y = zy.column("z").to_numpy(), zy.column("toxic").to_numpy().astype(float)
    order = np.argsort(z, kind="stable")
    slope, bias = _logistic(z[order], y[order])
    return Lexicon(lexicon.terms, lexicon.exceptions, slope, bias)


def _score(lexicon: Lexicon):
    def run(batches):
        m = Matcher(lexicon)
        for b in batches:
            z = np.array([m.weight(fold(t)) for t in b.column("text").to_pylist()])
            p = 1 / (1 + np.exp(-np.clip(lexicon.slope * z + lexicon.bias, -30, 30)))
            rest = [b.column(c) for c in b.schema.names if c != "text"]
            names = [c for c in b.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(p, pa.float64())], names=[*names, "score"])
    return run


def score_toxicity(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id and score of every document.  Null and empty texts score like texts without a
    match; every row is scored on its own; other columns are ignored; an empty table gives an
    empty result."""
    prepare(docs.sparkSession)
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return base.mapInArrow(_score(lexicon), "doc_id bigint, score double")
