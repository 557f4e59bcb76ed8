"""Each operator against a plain-Python version, and the odd cases of its docstring."""

import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_substring_dedup(docs):
    from trailguard.llm.substring_dedup import dedup_substrings
    rows, df = docs
    want = brute.substrings([(r[0], r[1] or "") for r in rows])
    got = by_id(dedup_substrings(df))
    assert {d: (r.n_words, r.n_removed, r.kept_sha256) for d, r in got.items()} == want
    assert sum(v[1] for v in want.values()) > 500


@pytest.mark.parametrize("length,hot", [(200, (64, 4096)), (40, (64, 4096)), (40, (3, 4))])
def test_suffix_dedup(docs, length, hot):
    from trailguard.llm.suffix_dedup import dedup_suffixes
    rows, df = docs
    want = brute.suffixes([(r[0], r[1]) for r in rows], length)
    got = by_id(dedup_suffixes(df, length, hot_contexts=hot))
    assert {d: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for d, r in got.items()} == want


def test_dedup_odd_rows(odd):
    from trailguard.llm.substring_dedup import dedup_substrings
    from trailguard.llm.suffix_dedup import dedup_suffixes
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_words, r.n_removed)
                 for r in dedup_substrings(odd).collect())
    # the null document comes first; the repeated row is one document listed twice
    assert got == [(-1, 0, 0), (-1, 60, 0), (1, 60, 60), (1, 60, 60), (1, 61, 60), (2, 0, 0), (3, 2, 0)]
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_bytes, r.n_removed)
                 for r in dedup_suffixes(odd).collect())
    assert [x[2] > 0 for x in got] == [False, True, True, True, True, False, False]


def test_quality(docs, odd):
    from trailguard.llm.quality import MEASURES, filter_quality, score_quality
    rows, df = docs
    got = by_id(score_quality(df))
    for r in rows:
        g = got[r[0]]
        assert (*(g[m] for m in MEASURES), g.base_failed) == brute.quality(r[1])
        assert not (g.kept and g.base_failed)
    kept = {r.doc_id for r in filter_quality(df).collect()}
    assert kept == {d for d, g in got.items() if g.kept}
    assert filter_quality(odd).columns == odd.columns
    assert score_quality(odd).count() == odd.count()


def test_simhash(docs, odd):
    from trailguard.llm.simhash import near_duplicates
    rows, df = docs
    want = brute.near_groups([(r[0], r[1]) for r in rows])
    assert {d: (r.fingerprint, r.component_id) for d, r in by_id(near_duplicates(df)).items()} == want
    assert near_duplicates(odd).count() == odd.count()


def test_ball_hashing_finds_every_near_pair():
    from trailguard.llm import simhash as S
    rng = np.random.default_rng(3)
    fp = rng.integers(0, 2 ** 63, 12, dtype=np.uint64)
    fp = np.unique(np.concatenate([fp] + [fp ^ sum(S._BITS[b] for b in rng.choice(
        rng.choice([16, 64]), rng.integers(1, 4), replace=False)) for _ in range(25)]))
    links = set()
    for g in range(S.GROUPS):
        y = S._rotated(fp, g)
        z = np.concatenate([y] + [y ^ S._BITS[b] for b in range(S.GROUP_BITS, 64)])
        flip = np.repeat(np.array([S.NO_FLIP, *range(S.GROUP_BITS, 64)], np.uint8), len(y))
        a, b = S.collisions(z, flip)
        links |= set(zip(S._unrotated(a, g).tolist(), S._unrotated(b, g).tolist()))
    assert all((a ^ b).bit_count() <= 3 for a, b in links)

    def groups(pairs):
        root = {int(f): int(f) for f in fp}
        find = lambda x: x if root[x] == x else find(root[x])
        for a, b in pairs:
            root[find(a)] = find(b)
        return {frozenset(x for x in root if find(x) == r) for r in {find(x) for x in root}}

    near = [(int(a), int(b)) for i, a in enumerate(fp) for b in fp[i + 1:] if int(a ^ b).bit_count() <= 3]
    assert groups(links) == groups(near)


def test_top_k(spark):
    from trailguard.llm.bitsliced import quantised, top_k
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(0, .2, 6)]) for i in range(150)] + \
           [(i, rows_) for i, rows_ in ((150, None), (151, [1.0, None] * 3), (152, [float("nan")] * 6),
                                        (153, [float("inf")] * 6), (154, []), (155, [0.0] * 6), (156, [0.0] * 6))]
    rows += [(7, rows[7][1]), (200, rows[9][1])]                 # a repeated row and a tie
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("score", F.lit(1))
    ints = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows if v and all(
        x is not None and np.isfinite(x) for x in v)]
    q = quantised(df)
    got = top_k(q, q.where("vec_id % 10 = 0")).collect()
    want = brute.top_k(ints, [x for x in ints if x[0] % 10 == 0])
    assert {k: [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == k]
            for k in want} == want
    assert top_k(q.limit(0), q.limit(0)).count() == 0
    with pytest.raises(Exception, match="beyond 64 bits"):
        quantised(spark.createDataFrame([(1, [1e300])], "vec_id bigint, embedding array<double>")).collect()


def vocab(name):
    return pytest.importorskip("public_tokenizers").path(name)


def whole_ids(path, rows, end):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(path)
    return {r[0]: np.array(lib.encode(r[1] or "", add_special_tokens=False).ids + [end], "<u4") for r in rows}


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_cached_encoder_equals_library(name):
    import random
    import pyarrow as pa
    from trailguard.llm.tokenizing import Encoder
    rnd = random.Random(4)
    texts = ["", " ", "  a", "a \n b", "it's ,x", "é́ x", "<|endoftext|> a", "İxİ, İ.", "a　b 　 c",
             "don't 'll can't.", "1,2 3.4. 5", "a   b    c", "x\nY.\nZ, w\n\nq", "a ab\x01c \x01 d", "tail "]
    texts += ["".join(rnd.choice("ab'sé .,\n\t 1²İ́ %") for _ in range(40)) for _ in range(600)]
    texts += ["a <|endoftext|> b", "<|startoftext|> x", "x<|endoftext|>", "Ab aB. AB, ÀB\nÀb. c"]
    from tokenizers import Tokenizer
    for as_text in (False, True):
        lib = Tokenizer.from_file(vocab(name))
        if as_text:
            lib.encode_special_tokens = True
        want = [lib.encode(t, add_special_tokens=False).ids for t in texts]
        enc = Encoder(vocab(name), as_text)
        for _ in range(2):                     # cold and from the cache
            ids, off = enc.encode(pa.array(texts))
            assert [ids[a:z].tolist() for a, z in zip(off[:-1], off[1:])] == want
        assert enc.encode(pa.array([], pa.string()))[1].tolist() == [0]


def test_encoder_forgets_stems(monkeypatch):
    import pyarrow as pa
    from trailguard.llm import tokenizing
    monkeypatch.setattr(tokenizing, "CACHE_STEMS", 12)
    enc = tokenizing.Encoder(vocab("byte_bpe_50k.json"))
    for lo in range(0, 60, 3):
        texts = [f"the {'abcdefghij'[i % 10] * (1 + i // 10)} the, {'xyz'[i % 3]}." for i in range(lo, lo + 3)]
        ids, off = enc.encode(pa.array(texts))
        got = [ids[a:z].tolist() for a, z in zip(off[:-1], off[1:])]
        assert got == [enc.lib.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(enc.after.row) <= 12


def test_packing(docs, odd):
    from trailguard.llm.packing import pack_documents
    rows, df = docs
    path = vocab("byte_bpe_50k.json")
    ids = whole_ids(path, rows, 2)
    got = pack_documents(df, path, capacity=256).toPandas()
    for r in got.itertuples():
        assert zlib.crc32(ids[r.doc_id][r.start: r.start + r.length].tobytes()) == r.ids_crc32
    assert got.groupby("doc_id").length.sum().to_dict() == {d: len(x) for d, x in ids.items()}
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert s.offset.tolist() == [0, *s.length.cumsum().tolist()[:-1]] and s.length.sum() <= 256
    assert got.sequence_id.nunique() <= 1.1 * np.ceil(got.length.sum() / 256) + 1
    assert pack_documents(odd, path).selectExpr("sum(length) > 0").first()[0]


def test_packing_repacks_open_sequences_across_groups(spark, docs, monkeypatch):
    from trailguard.llm import packing
    rows, df = docs
    monkeypatch.setattr(packing, "GROUP_ITEMS", 7)
    got = packing.pack_documents(df, vocab("byte_bpe_50k.json"), capacity=256).toPandas()
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert s.offset.tolist() == [0, *s.length.cumsum().tolist()[:-1]] and s.length.sum() <= 256
    assert got.sequence_id.nunique() <= 1.3 * np.ceil(got.length.sum() / 256) + 1


def test_packing_deals_copies_over_groups(spark, monkeypatch):
    """Sixty copies of one row are dealt to several groups, and each is packed once."""
    from trailguard.llm import packing
    monkeypatch.setattr(packing, "GROUP_ITEMS", 10)
    items = spark.range(60).selectExpr("id as _row", "7L as _len")
    dealt = packing._grouped(items, 64, packing._groups(60)).toPandas()
    assert len(dealt) == 60 and (dealt._bin // 2 ** 32).nunique() > 3
    df = spark.createDataFrame([(5, "one two three four five")] * 60, "doc_id bigint, text string")
    got = packing.pack_documents(df, vocab("byte_bpe_50k.json"), capacity=64).toPandas()
    assert len(got) == 60 and got.groupby("sequence_id").length.sum().max() <= 64
    # ten pieces of six ids fill a sequence: six are the least, and open ones move as wholes
    assert got.sequence_id.nunique() <= 7


def test_special_tokens(spark):
    from trailguard.llm.packing import pack_documents
    from tokenizers import Tokenizer
    df = spark.createDataFrame([(1, "a <|endoftext|> b"), (2, None), (2, "x"), (None, "x")], "doc_id bigint, text string")
    lib = Tokenizer.from_file(vocab("byte_bpe_50k.json"))
    lib.encode_special_tokens = True
    text = len(lib.encode("a <|endoftext|> b", add_special_tokens=False).ids) + 1
    n = {as_text: sorted(r.length for r in pack_documents(df, vocab("byte_bpe_50k.json"), special_as_text=as_text).collect())
         for as_text in (False, True)}
    assert n == {False: [1, 2, 2, 5], True: [1, 2, 2, text]}


def test_buckets_do_not_shrink_with_a_repeated_id(spark, monkeypatch):
    from trailguard.llm import suffix_dedup
    seen, count = [], suffix_dedup.bucket_count
    monkeypatch.setattr(suffix_dedup, "bucket_count", lambda d: seen.append(count(d)) or seen[-1])
    rows = [(i, f"text {i}") for i in range(64)]
    for more in ([], [(3, "again")]):
        df = spark.createDataFrame(rows + more, "doc_id bigint, text string").repartition(16)
        assert suffix_dedup.dedup_suffixes(df).count() == 64 + len(more)
    assert seen == [32, 32]


def test_quality_sample_spreads_over_splits(spark):
    from trailguard.llm.quality import _sample
    df = spark.range(0, 6400, 1, 64).selectExpr("cast(id as string) text")
    got = [int(x) for x in _sample(df, 320).to_pylist()]
    assert len(got) == 320 and len({x // 100 for x in got}) == 32 and max(got) > 6000
    assert len(_sample(df.limit(0), 10)) == 0


def test_token_files_with_null_and_repeated_ids(odd):
    from trailguard.llm.token_files import token_round_trip
    path = vocab("word_bpe_49k.json")
    got = sorted(token_round_trip(odd, path).collect(), key=lambda r: r.start)
    want = whole_ids(path, [(i, r.text) for i, r in enumerate(odd.collect())], 1)
    assert sorted(r.ids_crc32 for r in got) == sorted(zlib.crc32(x.tobytes()) for x in want.values())
    assert [r.doc_id for r in got] == [None, None, 1, 1, 1, 2, 3]
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got[:-1]]).tolist()


@pytest.mark.parametrize("planes", ["byte", "bit"])
def test_token_files(docs, planes):
    from trailguard.llm.token_files import token_round_trip
    rows, df = docs
    path = vocab("word_bpe_49k.json")
    ids, start = whole_ids(path, rows, 1), 0
    got = by_id(token_round_trip(df, path, planes=planes))
    for d in sorted(ids):
        r = got[d]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids[d]), zlib.crc32(ids[d].tobytes()))
        start += len(ids[d])


@pytest.mark.parametrize("planes", ["byte", "bit"])
def test_planes_round_trip(planes):
    from trailguard.llm.token_files import shuffle_planes, unshuffle_planes
    for n in (0, 1, 7, 16_384, 40_001):
        x = np.random.default_rng(n).integers(0, 2 ** 32, n, dtype=np.uint32)
        assert (unshuffle_planes(*shuffle_planes(x, planes), n, planes) == x).all()


def test_mix(docs, odd):
    from trailguard.llm.mixing import mix_sources
    rows, df = docs
    got = mix_sources(df).toPandas()
    again = mix_sources(df.repartition(5)).toPandas()
    key = ["doc_id", "size", "taken", "target"]
    assert got[key].sort_values("doc_id").values.tolist() == again[key].sort_values("doc_id").values.tolist()
    assert (got.taken <= 3 * got["size"]).all()
    assert dict(zip(got.doc_id, got["size"])) == {r[0]: len(brute.words(r[1])) for r in rows}
    got["source"] = got.doc_id.map({r[0]: r[3] or "~" for r in rows})
    s = got.groupby("source").agg(size=("size", "sum"), target=("target", "first"), taken=("taken", "sum"))
    weight, free, total = {"a": 5, "b": 2, "c": 1, "~": 5}, {"a", "b", "c", "~"}, s["size"].sum()
    want = {}
    while True:
        rest = total - sum(want.values())
        share = {k: rest * weight[k] / sum(weight[x] for x in free) for k in free}
        over = {k for k in free if share[k] > 3 * s["size"][k]}
        if not over:
            break
        want |= {k: 3.0 * s["size"][k] for k in over}
        free -= over
    want |= share
    assert {k: round(v, 6) for k, v in s.target.items()} == {k: round(v, 6) for k, v in want.items()}
    assert ((s.taken - s.target).abs() <= 48).all()
    assert mix_sources(odd).count() == odd.count()


def test_quotas_are_highest_averages():
    from trailguard.llm.mixing import quotas
    rng = np.random.default_rng(1)
    for _ in range(30):
        w, seats = rng.integers(1, 60, 6).astype(float), int(rng.integers(0, 40))
        caps = rng.integers(0, 15, 6)
        got = quotas(w, caps, seats)
        assert got.sum() == min(seats, caps.sum()) and (got <= caps).all()
        # no seat was given for a lower quotient than one that got none (ties either way)
        given, due = (w / (2 * got - 1))[got > 0], (w / (2 * got + 1))[got < caps]
        assert not len(given) or not len(due) or given.min() >= due.max() * (1 - 1e-9)


def test_toxicity(spark, odd):
    from trailguard.llm.toxicity import Lexicon, Matcher, fit_lexicon, fold, score_toxicity
    import random
    rnd = random.Random(2)
    clean = ["tree", "river", "stone", "cloud", "market", "letter", "garden", "can"]
    rows = []
    for i in range(400):
        w = [rnd.choice(clean) for _ in range(rnd.randint(5, 60))]
        toxic = i % 4 == 0
        if toxic:
            w[rnd.randrange(len(w))] = rnd.choice(["idiot", "1d10t", "іdіot", "IDIOTS", "mörøn", "trash"])
        elif i % 4 == 1:
            w += ["trash", "can"]
        rows.append((i, " ".join(w), int(toxic)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id bigint, toxic int")
    lex = fit_lexicon(docs, labels, train=F.col("doc_id") < 300)
    got = {r.doc_id: r.score for r in score_toxicity(docs, lex).collect()}
    held = [r for r in rows if r[0] >= 300]
    hit = [(got[r[0]] >= 0.5) == bool(r[2]) for r in held]
    assert np.mean(hit) > 0.9
    assert fold("Ìd１OT!! 5tup1d $") == " idiot stupid "
    m = Matcher(Lexicon((("trash ", 2.0),), (("trash", "can"),)))
    assert m.weight(fold("a trash can")) == 0 and m.weight(fold("trash talk")) > 0
    assert score_toxicity(odd, lex).count() == odd.count()
    none = fit_lexicon(docs, labels.where("toxic = 0"), train=F.lit(True))
    assert score_toxicity(docs, none).where("score between 0 and 1").count() == 400


def test_license_scan(spark):
    from trailguard.llm.license_scan import scan_licenses
    rows = [(1, "src/LICENSE", "Released under the MIT License."),
            (2, "src/deep/er/a.txt", "some words of a text without any notice"),
            (3, "src/deep/b.txt", "plain words first\nLicensed under the Apache License, Version 2.0.\n" + "more words " * 20),
            (4, "other/c.txt", "nothing here"), (5, None, None), (6, "src/d.txt", ""),
            (7, "other/d.txt", "the licence of a driver is something else entirely in this long line of words"),
            (3, "src/deep/b.txt", "plain words first\nLicensed under the Apache License, Version 2.0.\n" + "more words " * 20)]
    df = spark.createDataFrame(rows, "doc_id bigint, path string, text string") \
        .selectExpr("*", "1 as license", "2 as similarity", "3 as dir")
    got = sorted((r.doc_id, r.license or "", r.origin or "", r.licensed_by or "") for r in scan_licenses(df).collect())
    assert got == [(1, "MIT", "file", ""), (2, "MIT", "inherited", "src"), (3, "Apache-2.0", "header", ""),
                   (3, "Apache-2.0", "header", ""), (4, "", "", ""), (5, "", "", ""), (6, "MIT", "inherited", "src"),
                   (7, "", "", "")]
    bare = {r.doc_id: (r.path, r.license, r.origin) for r in scan_licenses(df, path=None).collect()}
    assert bare == {1: (None, "MIT", "header"), 2: (None, None, None), 3: (None, "Apache-2.0", "header"),
                    4: (None, None, None), 5: (None, None, None), 6: (None, None, None), 7: (None, None, None)}


def test_license_scan_runs_no_python(spark, monkeypatch):
    """The plans of every table that the scan writes, and of its result."""
    from trailguard.llm import license_scan
    plans, write = [], license_scan.materialize

    def seen(df, name):
        plans.append(df._jdf.queryExecution().toString())
        return write(df, name)
    monkeypatch.setattr(license_scan, "materialize", seen)
    df = spark.createDataFrame([(1, "a/LICENSE", "Released under the MIT License."), (2, "a/b/c", "words")],
                               "doc_id bigint, path string, text string")
    plans.append(license_scan.scan_licenses(df)._jdf.queryExecution().toString())
    assert len(plans) > 6 and not any(w in p for p in plans for w in ("Python", "Arrow", "Pandas"))


def test_license_scan_brute_force(spark):
    """Mixed, altered and cut notices and licence texts along paths, a directory with half of all rows."""
    import random
    from trailguard.llm import license_scan as L
    rnd = random.Random(4)
    texts, notices = L.licence_texts(), [t for many in L.TEMPLATES.values() for t in many]
    plain = "once there was a village with a mill and a river that ran past it licence copyright and rights".split()
    story = lambda n: " ".join(rnd.choice(plain) + rnd.choice(["", "", ".", "x", "\n"]) for _ in range(n))
    rows = []
    for i in range(160):
        notice = rnd.choice(notices).split()
        if rnd.random() < .5:
            notice[rnd.randrange(len(notice))] = rnd.choice(plain)
        whole = rnd.choice(sorted(t for t in texts.values() if len(t) < 3000))
        text = rnd.choice([story(30), " ".join(notice), story(12) + "\n" + " ".join(notice) + "\n" + story(9),
                           story(5) + " " + " ".join(notice) + " " + story(5), whole, whole[: rnd.randrange(len(whole))],
                           story(9) + "\n" + whole, whole + story(rnd.choice([20, 900])), "", None])
        path = rnd.choice(["", "hot/", "hot/", "a/", "a/b/", "a/b/c/", "d/e/", "/abs/x/"]) + \
            rnd.choice(["x.py", "x.py", "LICENSE", "licence.md", "copying", "licenses", "license_plate.txt"])
        rows.append((i // 2, None if rnd.random() < .05 else path, text))
    rows += [rows[0]] * 3 + [(None, "hot/y", "Released under the MIT License.")]
    df = spark.createDataFrame(rows, "doc_id bigint, path string, text string").repartition(5)
    got = [(r.doc_id, r.license, r.similarity, r.origin, r.licensed_by) for r in L.scan_licenses(df).collect()]
    want = brute.licenses(rows, L._all_templates(L.TEMPLATES, texts), L.KEYWORDS, L._NOTICE_WORD, L.RUN_WORDS)
    near = lambda rows: sorted(((d, n, o, b, round(s or 0, 4)) for d, n, s, o, b in rows), key=repr)
    assert near(got) == near(want)
    assert len({n for _, n, *_ in want}) > 8 and {o for *_, o, _ in want} >= {"file", "header", "inherited"}


def test_license_scan_takes_no_short_text_for_a_file(spark):
    got = _scan(spark, [(1, "s/en/1", "A tale of a mill.\nThis work is licensed under the GNU General Public License, version 3."),
                        (2, "s/en/2", "some words"), (3, "t/LICENSE", "This work is licensed under the GNU General Public License, "
                                                     "version 3."), (4, "t/x", "some words")])
    assert {d: (r.license, r.origin) for d, r in got.items()} == {
        1: ("GPL-3.0", "header"), 2: (None, None), 3: ("GPL-3.0", "file"), 4: ("GPL-3.0", "inherited")}


def test_components(spark):
    from trailguard.llm.components import components
    import random
    rnd = random.Random(9)
    edges = [(i, i + 1) for i in range(40)] + [(rnd.randrange(100, 160), rnd.randrange(100, 160)) for _ in range(40)]
    root = {x: x for e in edges for x in e}
    find = lambda x: x if root[x] == x else find(root[x])
    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {r.u: r.v for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {x: find(x) for x in root if find(x) != x}


def test_empty_tables(spark, empty):
    from trailguard.llm import bitsliced, license_scan, mixing, packing, quality, simhash
    from trailguard.llm import substring_dedup, suffix_dedup, token_files, toxicity
    path = vocab("byte_bpe_50k.json")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    lex = toxicity.fit_lexicon(empty, labels, train=F.lit(True))
    for df in (substring_dedup.dedup_substrings(empty), suffix_dedup.dedup_suffixes(empty),
               quality.score_quality(empty), simhash.near_duplicates(empty), packing.pack_documents(empty, path),
               token_files.token_round_trip(empty, path), mixing.mix_sources(empty),
               toxicity.score_toxicity(empty, lex),
               license_scan.scan_licenses(empty.withColumn("path", F.lit("a/b")))):
        assert df.count() == 0


def _scan(spark, rows):
    from trailguard.llm.license_scan import scan_licenses
    df = spark.createDataFrame(rows, "doc_id bigint, path string, text string")
    return {r.doc_id: r for r in scan_licenses(df).collect()}


def test_license_scan_recognises_whole_texts(spark):
    from trailguard.llm.license_scan import licence_texts
    texts = licence_texts()
    rows, want = [], {}
    for i, (name, t) in enumerate(sorted(texts.items())):
        flat = " ".join(t.split())
        wrapped = "\n".join(flat[k: k + 60] for k in range(0, len(flat), 60)) if i % 2 else \
            "Some Project\n\nCopyright (c) 2020 Some Holder. All rights reserved.\n\n" + t
        for k, form in enumerate((t, flat, wrapped)):
            d = 10 * i + k
            rows += [(d, f"p{d}/LICENSE", form), (1000 + d, f"p{d}/src/a.txt", "plain words of a story")]
            want[d] = name
    rows += [(5000 + i, f"q/{i}", "the words of a story and the rest of it, with no licence for the driver in it " * 20)
             for i in range(20)]
    code = " ".join(f"x{i} = y{i}" for i in range(400))
    rows.append((7000, "r/a.py", "\n".join("# " + x for x in texts["BSD-2-Clause"].split("\n")) + "\n" + code))
    got = _scan(spark, rows)
    assert {d: (got[d].license, got[d].origin) for d in want} == {d: (n, "file") for d, n in want.items()}
    assert {d: (got[1000 + d].license, got[1000 + d].origin) for d in want} == {d: (n, "inherited") for d, n in want.items()}
    assert all(got[5000 + i].license is None for i in range(20))
    assert (got[7000].license, got[7000].origin) == ("BSD-2-Clause", "header")


def test_license_scan_finds_notices_inside_longer_lines(spark):
    notices = {"Copyright 2020 Example Corp. All rights reserved.": "All rights reserved",
               "The text of this page is licensed under the MIT License.": "MIT",
               "SPDX-License-Identifier: MIT": "MIT", "SPDX-License-Identifier: Apache-2.0": "Apache-2.0",
               "You may copy this manual under the\nterms of the GNU General Public License,\nversion 2, or later": "GPL-2.0",
               "Copyright 2021 A. Writer. All rights reserved. Our photographs are released under the Creative Commons "
               "Attribution-ShareAlike 4.0 International License unless we say otherwise": "CC-BY-SA-4.0",
               "this story is released under the Sunshine License of our village": None}
    story = "once there was a village with a mill and a river that ran past the mill all year "
    rows = [(i, f"a{i}/x", story * 10 + "\n" + t + "\n" + story * 10) for i, t in enumerate(notices)]
    rows += [(100 + i, f"b{i}/x", story * 3 + f"word{i}") for i in range(200)]
    got = _scan(spark, rows)
    assert {t: (got[i].license, got[i].origin) for i, t in enumerate(notices)} == \
        {t: (n, "header" if n else None) for t, n in notices.items()}


def test_op7_inherits_within_a_source(spark, tmp_path):
    """A whole licence text licenses its source's other documents, and no document of another or no source."""
    from trailguard.llm.license_scan import licence_texts
    from trailguard.llm.queries import op7_license_scan
    rows = [(1, licence_texts()["MIT"], "s0"), (2, "some words", "s0"), (3, "some words", "s1"), (4, "some words", None),
            (5, None, "s0"), (6, "Released under the GNU General Public License, version 3.", "s0")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.license, r.origin, r.licensed_by) for r in op7_license_scan(spark, str(tmp_path)).collect()}
    assert got[1] == ("MIT", "file", None) and got[6][1] == "header"
    assert got[2] == got[5] == ("MIT", "inherited", "source/s0") and got[3] == got[4] == (None, None, None)
