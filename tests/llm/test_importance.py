"""Importance resampling and its radix sort against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from trailguard.llm import importance as I

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: chr(c + 32) for c in range(65, 91)})


def buckets(text):
    w = WORD.findall((text or "").translate(LOWER))
    return w, [zlib.crc32(x.encode()) % 10000 for x in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]


def brute(docs, target, percent=25, least=20):
    s, t = Counter(), Counter()
    for _, x in docs:
        s.update(buckets(x)[1])
    for x in target:
        t.update(buckets(x)[1])
    s_all, t_all = s.total(), t.total()
    rows, able = [], []
    for i, (d, x) in enumerate(docs):
        w, b = buckets(x)
        gain = [math.floor(1000 * math.log((t[k] + 1) * (s_all + 10000) / ((s[k] + 1) * (t_all + 10000)))) for k in b]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([d, len(b), weight, score, None])
        if len(w) >= least:
            able.append((-score, 2 ** 63 if d is None else d, i))
    for r, (_, _, i) in enumerate(sorted(able)[: percent * len(able) // 100], 1):
        rows[i][4] = r
    return rows


def test_resample(spark, docs):
    rows, df = docs
    long = "x" * 70 + " " + "Ab1 " * 3000
    pairs = [(r[0], r[1]) for r in rows] + [(1000, long), (1001, "A b\x00C d-e 9 é ÀÉ"), (1002, "one")]
    extra = spark.createDataFrame(pairs[-3:], "doc_id bigint, text string")
    df = df.select("doc_id", "text").unionByName(extra).selectExpr("*", "1 as rank", "'x' as weight", "2 as score", "3 as _block")
    target = [rows[3][1], rows[5][1], None, ""]
    got = I.resample(df, spark.createDataFrame([(x,) for x in target], "text string"), block=16).collect()
    key = lambda r: r[0]
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, brute(pairs, target)), key=key)
    assert sum(r["rank"] is not None for r in got) > 10


def test_repeated_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text), (1, text), (None, text), (None, text + " more"), (2, text), (3, None)] * 3
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = I.resample(df, df.limit(0), percent=100).collect()
    want = brute(rows, [], percent=100)
    assert Counter(tuple(r)[:4] for r in got) == Counter(tuple(r)[:4] for r in want)
    ranked = sorted((r["rank"], -r.score, r.doc_id) for r in got if r["rank"])
    assert [r[0] for r in ranked] == list(range(1, 16)) and [r[1] for r in ranked] == sorted(r[1] for r in ranked)


def test_empty(spark, empty):
    assert I.resample(empty, empty).count() == 0
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    assert [tuple(r)[-1] for r in I.resample(docs, empty).collect()] == [None]


def test_draw_keeps_the_documents(spark, docs):
    rows, df = docs
    got = I.draw(df, df.limit(5)).collect()
    text = {r[0]: r[1] for r in rows}
    assert got and all(r.text == text[r.doc_id] for r in got) and {"lang", "source"} <= set(got[0].asDict())


@pytest.mark.parametrize("bits,block", [(16, 50), (11, 1 << 17)])
def test_radix_positions(spark, bits, block):
    import random
    rnd = random.Random(bits)
    rows = [(i, rnd.choice([-5, 0, 3, 2 ** 40, -2 ** 63, 2 ** 63 - 1]) if i % 2 else 3, rnd.randint(-40, 40)) for i in range(400)]
    df = spark.createDataFrame(rows, "i bigint, a bigint, b bigint").repartition(5)
    got = I.radix_positions(df, ["a", "b"], bits=bits, block=block).orderBy("position").collect()
    assert [r.position for r in got] == list(range(400))
    assert [(r.a, r.b) for r in got] == sorted((a, b) for _, a, b in rows)
    assert sorted(r.i for r in got) == list(range(400))
    same = I.radix_positions(df.withColumn("a", F.lit(1).cast("bigint")).select("i", "a"), ["a"], block=block)
    assert sorted(r.position for r in same.collect()) == list(range(400))
