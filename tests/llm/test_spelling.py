"""Spelling variants against comparing every pair of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from trailguard.llm import spelling as S

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans({c: chr(c + 32) for c in range(65, 91)})


def near(x, y):
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) == 1
    if len(x) > len(y):
        x, y = y, x
    return len(y) - len(x) == 1 and any(y[:i] + y[i + 1:] == x for i in range(len(y)))


def brute(docs, noise=199):
    n = Counter()
    for d, t in docs:
        for w in RUN.findall(t or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % noise == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    words = {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}
    out = {}
    for w, k in words.items():
        close = sorted((-words[x], x) for x in words if abs(len(x) - len(w)) < 2 and near(w, x))
        form = close[0][1] if close and -close[0][0] >= 5 * k else None
        out[w] = (form, k, len(close), words[form] if form else None)
    res = {}
    for w, (form, k, c, fn) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        res[w] = (form, root, k, c, fn)
    return res


def corpus(seed):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("abeÉé") for _ in range(rnd.randint(5, 9))) for _ in range(60)] + ["×÷abcdefg", "ÿ" * 70]
    words = list(base)
    for w in base * 3:
        i = rnd.randrange(len(w))
        words += [w[:i] + w[i + 1:], w[:i] + rnd.choice("abeé") + w[i:], w[:i] + rnd.choice("abeé") + w[i + 1:], "".join(rnd.sample(w, len(w)))]
    docs = []
    for d in range(80):
        some = [rnd.choice(base if rnd.random() < .6 else words) for _ in range(rnd.randint(0, 400))]
        docs.append((d, rnd.choice([" ", "1", "_", "Ā"]).join(x.upper() if rnd.random() < .1 and x.isascii() else x for x in some)))
    return docs + [(80, None), (81, ""), (None, docs[3][1]), (3, docs[3][1]), (3, docs[4][1])]


@pytest.mark.parametrize("seed,limits", [(1, {}), (2, dict(leaf=9, queries=11)), (3, dict(sample=30, leaf=40, queries=25))])
def test_spelling_groups(spark, seed, limits):
    docs = corpus(seed)
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4).selectExpr(
        "*", "1 as n", "'x' as word", "2 as leaf", "'y' as form")
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in S.spelling_groups(df, **limits).collect()}
    want = brute(docs)
    assert got == want
    assert len(want) > 100 and sum(v[3] for v in want.values()) > 200 and any(v[0] for v in want.values())


def test_empty(spark, empty):
    assert S.spelling_groups(empty).count() == 0
    one = spark.createDataFrame([(1, "lonely " * 9)], "doc_id bigint, text string")
    assert [tuple(r)[1:3] for r in S.spelling_groups(one, noise=None).collect()] == [(None, "lonely")]


def test_roots_follow_chains(spark):
    df = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(21)] + [("x", "w3")], "word string, form string")
    assert {r.word: r.root for r in S.roots(df).collect()} == {f"w{i}": "w21" for i in range(21)} | {"x": "w21"}


def test_tree_search_reaches_every_box_within_one_edit():
    rng = np.random.default_rng(2)
    points = rng.integers(0, 4, (500, S.LETTERS)).astype(np.int32)
    tree = S.KdTree(points, 7)
    home = np.empty(500, np.int64)
    for i, m in enumerate(tree.members):
        home[m] = i
    q, leaf = tree.search(points, 0, 0)
    assert (home[q] == leaf).all() and len(q) == 500
    moved = points.copy()
    moved[np.arange(500), rng.integers(0, S.LETTERS, 500)] -= 1
    moved[np.arange(500), rng.integers(0, S.LETTERS, 500)] += 1
    q, leaf = tree.search(moved, 1, 1)
    assert set(zip(range(500), home.tolist())) <= set(zip(q.tolist(), leaf.tolist()))


def test_equal_counts_are_no_neighbours():
    words = pa.array(["abcdef", "bacdef", "abcdeg", "abcdefg"])
    a, b = S.near_in_block(words, np.array([False, False, True, True]))
    assert {(int(i), int(j)) for i, j in zip(a, b)} == {(2, 0)}
