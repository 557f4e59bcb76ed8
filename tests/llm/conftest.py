import random
import sys
from pathlib import Path

import pytest

HERE = Path(__file__).resolve().parent
sys.path[:0] = [str(HERE), str(HERE.parents[1])]

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def corpus(seed: int, n: int = 90, vocabulary: int = 600) -> list[tuple]:
    """Documents with shared passages, copies, runs, empty, null and one long text."""
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 7))) for _ in range(vocabulary)]
    base = [[rnd.choice(words) for _ in range(rnd.randint(0, 120))] for _ in range(n)]
    out = []
    for i in range(n):
        w = list(base[i])
        for _ in range(rnd.randint(0, 2)):
            o = rnd.choice(base)
            a = rnd.randint(0, len(o))
            c = rnd.randint(0, len(w))
            w[c:c] = o[a: a + rnd.randint(1, 80)]
        if rnd.random() < .2:
            w = list(rnd.choice(base))
        if rnd.random() < .05:
            w = ["aa"] * rnd.randint(1, 300)
        out.append((i, rnd.choice([" ", "\n", "  "]).join(w)))
    out += [(n, None), (n + 1, ""), (n + 2, " \n "), (n + 3, " ".join(rnd.choice(words) for _ in range(9000)))]
    return [(d, t, "en", rnd.choice(["a", "a", "b", "c", None]), None) for d, t in out]


@pytest.fixture(scope="session", params=[1, 2])
def docs(spark, request):
    rows = corpus(request.param)
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(3 * request.param - 2)


@pytest.fixture(scope="session")
def odd(spark):
    """Null and repeated doc_ids, repeated rows, clashing extra columns."""
    t = " ".join(f"w{i}" for i in range(60))
    rows = [(1, t, 0, "x"), (1, t, 0, "x"), (1, t + " tail", 0, "x"), (None, t, 0, "x"), (None, None, 0, None),
            (2, "", 0, "y"), (3, "lone text", 0, "y")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, _k int, source string") \
        .selectExpr("*", "'e' as blob", "1 as bucket", "2 as size", "'z' as word")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
