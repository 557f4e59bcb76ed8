"""Plain-Python versions of the operators, for small inputs."""

import hashlib
import re
from collections import defaultdict

WS = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WS.findall(text or "")


def substrings(docs, length=20):
    """[(doc_id, text)] -> {doc_id: (n_words, n_removed, sha)}"""
    docs = sorted(docs)
    seen, gone = set(), defaultdict(set)
    for d, t in docs:
        w = words(t)
        for i in range(len(w) - length + 1):
            key = tuple(w[i:i + length])
            if key in seen:
                gone[d].update(range(i, i + length))
            seen.add(key)
    out = {}
    for d, t in docs:
        w = words(t)
        kept = " ".join(x for i, x in enumerate(w) if i not in gone[d])
        out[d] = (len(w), len(gone[d]), hashlib.sha256(kept.encode()).hexdigest())
    return out


def suffixes(docs, length=200):
    count = defaultdict(int)
    for _, t in docs:
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            count[b[i:i + length]] += 1
    out = {}
    for d, t in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if count[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def quality(text):
    from collections import Counter
    w = words(text)
    n = len(w)
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WS.search(line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(w[i:i + 5]) for i in range(n - 4))
    rep = set()
    for i in range(n - 4):
        if grams[tuple(w[i:i + 5])] > 1:
            rep.update(range(i, i + 5))
    return (n, sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(rep),
            n < 10 or 100 * len(rep) > 20 * n)


def simhash(text, shingle=3):
    import xxhash
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    k = min(shingle, len(w))
    hs = [xxhash.xxh64_intdigest(b" ".join(w[i:i + k]), 42) for i in range(len(w) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def near_groups(docs, radius=3, shingle=3):
    """[(doc_id, text)] -> {doc_id: (fingerprint, component)}"""
    import numpy as np
    ids = [d for d, _ in docs]
    fp = np.array([simhash(t, shingle) for _, t in docs], np.uint64)
    parent = list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(fp[i + 1:] ^ fp[i]) <= radius) + i + 1:
            parent[find(int(j))] = find(i)
    least = {}
    for i, d in enumerate(ids):
        r = find(i)
        least[r] = min(least.get(r, d), d)
    return {d: (f"{int(fp[i]):016x}", least[find(i)]) for i, d in enumerate(ids)}


def top_k(vectors, queries, k=5):
    """[(id, ints)] -> {query id: [(id, score)]}"""
    out = {}
    for q, a in queries:
        s = sorted(((-sum(x * y for x, y in zip(a, b)), v) for v, b in vectors if v != q and len(b) == len(a)))
        out[q] = [(v, -n) for n, v in s[:k]]
    return out


def _license_words(text):
    import regex
    return [w for w in (x.strip(".") for x in regex.split(r"[^\p{L}\p{N}.]+", text.lower())) if w]


def licenses(rows, templates, keywords, notice_word, run_words, threshold=0.7, file_share=0.5, reserved="All rights reserved"):
    """[(doc, path, text)], [(license, number, whole text?, words, telling words)] ->
    [(doc, license, similarity, origin, licensed_by)] by comparing every window and run with every template."""
    import math
    from collections import Counter
    texts = [(d, p or "", t or "") for d, p, t in rows]
    frequency = Counter(w for _, _, t in texts for w in set(_license_words(t)))
    idf = lambda w: math.log((1 + len(texts)) / (1 + frequency[w])) + 1

    def vector(ws):
        v = {w: (1 + math.log(n)) * idf(w) for w, n in Counter(ws).items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / norm for w, x in v.items()}
    known = [(name, whole, ws, must, vector(ws)) for name, _, whole, ws, must in templates]
    keyword = re.compile("|".join(keywords), re.I)
    own = []
    for _, path, text in texts:
        best, is_file = None, False
        ws = _license_words(text)
        units = [("whole", ws)] + [("line", _license_words(x)) for x in text.split("\n") if keyword.search(x)]
        at = [i for i, w in enumerate(ws) if re.search(notice_word, w)]
        for n in {len(t[2]) for t in known if not t[1]}:
            units += [("window", ws[i:i + n]) for i in range(len(ws) - n + 1) if any(i <= k < i + n for k in at)]
        for opening, n in {(tuple(t[2][:run_words]), len(t[2])) for t in known if t[1]}:
            units += [("run", ws[i:i + n]) for i in range(len(ws)) if tuple(ws[i:i + run_words]) == opening]
        for kind, unit in units if keyword.search(text) else ():
            if not unit:
                continue
            mine = vector(unit)
            found = None
            for name, whole, words, must, v in known:
                if kind != "whole" and (kind == "run") != whole or not must <= set(unit):
                    continue
                if kind == "window" and len(words) != len(unit):
                    continue
                cosine = round(sum(x * v.get(w, 0.0) for w, x in mine.items()), 6)
                if cosine >= threshold:
                    found = max(found or (False,), (whole, name != reserved, cosine, len(words), name))
            if found:
                best = max(best or (False,), found)
                is_file |= found[0] and (kind == "whole" or kind == "run" and len(unit) >= file_share * len(ws))
        named = re.search(r"^((un)?licen[cs]e|copying)([-_.].*)?$", path.rpartition("/")[2], re.I)
        own.append((best[4], best[2], bool(is_file or named)) if best else None)
    votes = defaultdict(list)
    for (_, path, _), o in zip(texts, own):
        if o and o[2]:
            votes[path.rpartition("/")[0]].append(o)
    given = {}
    for where, many in votes.items():
        given[where] = max((sum(m[0] == name for m in many), max(m[1] for m in many if m[0] == name), name)
                           for name in {m[0] for m in many})
    out = []
    for (d, path, _), o in zip(texts, own):
        where = path.rpartition("/")[0]
        while o is None and where not in given and where:
            where = where.rpartition("/")[0]
        if o:
            out.append((d, o[0], o[1], "file" if o[2] else "header", None))
        elif where in given:
            out.append((d, given[where][2], given[where][1], "inherited", where))
        else:
            out.append((d, None, None, None, None))
    return out
