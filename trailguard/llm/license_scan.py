"""License scan with DataFrame operations only.

*Cosine.*  Texts and templates are sparse TF-IDF vectors of their words: (1 + ln tf) times the
idf, with document frequencies counted over all texts for every word of a text that holds a
license keyword.  Templates are short notices and whole licence texts (``licenses/``).  Compared
are, of each text with a keyword: the text as a whole, its lines with a keyword, the windows of
a notice's length around license words (across line breaks), and the runs of a licence text's
length from where its opening words stand.  A notice that spells a license's name matches only
where the telling words of that name stand.

*A text's license* is that of the best match at or above ``threshold``: a licence text before a
notice, a license before "All rights reserved" (which stands beside most), then the cosine, the
longer template and the name.

*Licence files.*  A text that as a whole reaches ``threshold`` with a whole licence text is a licence
file, as is one where a run that matches a whole licence text holds at least ``file_share`` of its
words, and one with a license of its own whose path names a licence file (``FILE_NAME``).  A short
text with a notice is none.  A licence file licenses its directory (of several, the license most
files name, then the higher cosine, then the name).

*Inheritance.*  A text without a license of its own takes that of the nearest ancestor directory
that has one.  Paths are joined level by level: each distinct directory is expanded to its
ancestors, the licensed ones are joined and the deepest is kept, so the work grows with
directories, not with texts.  Directories that hold a thousandth of all texts or more are at most a
thousand; those are joined by broadcast, so a hot directory spans tasks (:func:`_join_by`).  Without
a path column nothing is inherited.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from importlib.resources import files

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trailguard.llm.common import materialize

#: Short notices by license name.
TEMPLATES = {
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "You may not use this file except in compliance with the License."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms "
                "of the GNU General Public License"],
    "BSD-3-Clause": ["Redistribution and use in source and binary forms, with or without modification, "
                     "are permitted provided that the following conditions are met"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons "
                  "Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons "
                     "Attribution-NonCommercial 4.0 International License."],
    "All rights reserved": ["All rights reserved.", "Copyright. All rights reserved."],
}
#: Names of the licenses as notices spell them.
NAMES = {
    "MIT": ["MIT License"], "ISC": ["ISC License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"],
    "GPL-2.0": ["GNU General Public License, version 2"], "GPL-3.0": ["GNU General Public License, version 3"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3"],
    "MPL-2.0": ["Mozilla Public License, version 2.0"],
    "BSD-2-Clause": ["BSD 2-Clause License"], "BSD-3-Clause": ["BSD 3-Clause License"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC0-1.0": ["CC0 1.0 Universal"],
}
FORMS = ("Licensed under the {}", "Released under the {}", "Under the terms of the {}")
for _license, _names in NAMES.items():
    TEMPLATES[_license] = list(dict.fromkeys(
        TEMPLATES.get(_license, []) + [f.format(n) for n in _names for f in FORMS] + [f"SPDX-License-Identifier: {_license}"]))
RESERVED = "All rights reserved"
#: Words of a name that don't tell licenses apart.
_PLAIN_WORDS = {"license", "version", "public", "international", "clause"}
#: Opening words of a licence text: where a run of it starts, and a notice of its own.
RUN_WORDS, OPENING_WORDS = 6, 10
#: What a window of a notice's length holds; every notice has such a word.
_NOTICE_WORD = "^(licen[sc]|copyright|reserved$|permission$|commons$|redistribut)"
KEYWORDS = ("licen[sc]", "copyright", "rights reserved", "permission is hereby", "creative commons",
            "public license", "redistribut")
#: Last path segment of a licence file.
FILE_NAME = "(?i)(^|/)((un)?licen[cs]e|copying)([-_.][^/]*)?$"
#: A key that holds one in this many rows is hot: there are at most so many of them.
HOT_SHARE = 1000
_SPLIT = "[^\\p{L}\\p{N}.]+"


def _words(text: str) -> list[str]:
    """The words of a template, as :func:`_tokens` finds them in a text."""
    return [w for w in (x.strip(".") for x in re.split(r"[^\w.]+", text.lower())) if w]


def _tokens(col):
    """Lower-case words of a text column: letters, digits and inner dots."""
    raw = F.split(F.lower(col), _SPLIT)
    return F.filter(F.transform(raw, lambda w: F.btrim(w, F.lit("."))), lambda w: w != "")


def licence_texts() -> dict[str, str]:
    """Whole licence texts by license.  No copy of CC BY 4.0 and CC BY-NC 4.0 was at hand: they are told by
    their notices alone, which their whole texts hold as well."""
    return {f.name.removesuffix(".txt"): f.read_text() for f in files(__package__).joinpath("licenses").iterdir()
             if f.name.endswith(".txt")}


def _telling(license: str, words: list[str]) -> set[str]:
    """Words that a match must hold: those that tell the license's name, if ``words`` spell it."""
    for name in NAMES.get(license, ()):
        if set(_words(name)) <= set(words):
            return set(_words(name)) - _PLAIN_WORDS
    return set(_words(license)) if words[:3] == ["spdx", "license", "identifier"] else set()


def _all_templates(templates: dict, texts: dict) -> list[tuple]:
    """(license, number, whether a whole text, words, telling words)."""
    out = [(name, _words(t), False, None) for name, many in templates.items() for t in many]
    for name, t in texts.items():
        words = _words(t)
        telling = {"CC-BY-SA-4.0": {"sharealike"}, "BSD-3-Clause": {"endorse"}}
        out.append((name, words, True, telling.get(name, set()) & set(words)))
        opening = words[:OPENING_WORDS]
        if name != "BSD-2-Clause" and any(re.match(_NOTICE_WORD, w) for w in opening):
            out.append((name, opening, False, set(opening[:RUN_WORDS])))
    return [(name, i, whole, words, _telling(name, words) if must is None else must)
            for i, (name, words, whole, must) in enumerate(out)]


def _positions(words, test):
    """Positions of an array column where ``test`` (of word and position) holds."""
    return F.filter(F.transform(words, lambda w, i: F.when(test(w, i), i)), lambda i: i.isNotNull())


def _units(cand: DataFrame, all_: list[tuple], weight: dict, threshold: float) -> DataFrame:
    """What is compared with templates: _row, kind, i, j (which together name it), ws (its words)."""
    name = lambda kind, i, j: (F.lit(kind).alias("kind"), i.cast("int").alias("i"), j.cast("int").alias("j"))
    none = F.lit(0)
    words = F.col("words")
    out = cand.select("_row", *name("whole", none, none), words.alias("ws"))
    lines = cand.select("_row", F.posexplode("lines").alias("line", "l"))
    out = out.unionByName(lines.select("_row", *name("line", F.col("line"), none), _tokens(F.col("l")).alias("ws")))
    for n in sorted({len(t[3]) for t in all_ if not t[2]}):
        # a cosine is at most the norm of the template's words that the window holds, so windows
        # below that are left out before anything is shuffled
        bound = F.lit(False)
        for license, i, whole, ws, _ in all_:
            if not whole and len(ws) == n:
                held = F.lit(0.0)
                for w in sorted(set(ws)):
                    held = held + F.when(F.array_contains("ws", w), weight[i, w] ** 2).otherwise(0.0)
                bound = bound | (held >= threshold ** 2 - 1e-6)
        starts = F.array_distinct(F.flatten(F.transform("at", lambda k: F.sequence(
            F.greatest(F.lit(0), k - n + 1), F.least(k, F.size(words) - n)))))
        windows = cand.where(F.size(words) >= n).select("_row", F.explode(F.transform(
            starts, lambda s: F.struct(s.alias("s"), F.slice(words, s + 1, n).alias("ws")))).alias("x"))
        out = out.unionByName(windows.select("_row", *name("window", F.lit(n), F.col("x.s")), F.col("x.ws").alias("ws"))
                              .where(bound))
    for opening in sorted({tuple(t[3][:RUN_WORDS]) for t in all_ if t[2]}):
        sizes = sorted({len(t[3]) for t in all_ if t[2] and tuple(t[3][:RUN_WORDS]) == opening})

        def opens(w, i):
            test = w == opening[0]
            for k, o in enumerate(opening[1:], 1):
                test = test & (F.get(words, i + k) == o)
            return test
        found = cand.where(F.array_contains(words, opening[0])) \
            .select("_row", "words", F.explode(_positions(words, opens)).alias("s")) \
            .select("_row", "words", "s", F.explode(F.array(*[F.lit(z) for z in sizes])).alias("z"))
        out = out.unionByName(found.select("_row", *name("run", F.col("z"), F.col("s")),
                                           F.slice(words, F.col("s") + 1, F.col("z")).alias("ws")))
    return out


def _join_by(left: DataFrame, right: DataFrame, key: str, how: str) -> DataFrame:
    """``left`` joined with ``right`` (one row a key).  Keys that hold a ``HOT_SHARE``-th of left's rows or more
    are at most ``HOT_SHARE``, so their rows of ``right`` are broadcast; only the others are shuffled by key."""
    counts = left.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    limit = left.count() / HOT_SHARE
    hot = materialize(counts.where(F.col("_n") >= limit).select(key).join(right, key, "left"), "hot-keys")
    rest = left.join(F.broadcast(hot.select(key)), key, "left_anti").join(right, key, how)
    there = hot if how == "left" else hot.join(right.select(key), key, "left_semi")
    return rest.unionByName(left.join(F.broadcast(there), key))


def scan_licenses(docs: DataFrame, path: str | None = "path", text: str = "text", key: str = "doc_id",
                  templates: dict = TEMPLATES, threshold: float = 0.7, file_share: float = 0.5,
                  texts: dict | None = None) -> DataFrame:
    """``key``, path, license, similarity, origin ('header', 'file', 'inherited' or null) and
    licensed_by (the directory a license is inherited from).

    ``texts`` are whole licence texts (:func:`licence_texts` if not given).  Null texts have no
    words; a null path is the root directory; a text with neither license has nulls.  With ``path=None``
    paths are null and nothing is inherited.  Every row is judged on its own, so repeated rows agree,
    except that each counts as a licence file.  Other columns are ignored; an empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    all_ = _all_templates(templates, licence_texts() if texts is None else texts)
    base = docs.select(F.col(key).alias("doc"), (F.coalesce(F.col(path).cast("string"), F.lit("")) if path else
                        F.lit(None).cast("string")).alias("path"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))

    # one pass for the texts that hold a keyword; a row's number is stored with it
    keyword = "(?i)" + "|".join(KEYWORDS)
    scanned = materialize(base.select(
        F.monotonically_increasing_id().alias("_row"), "doc", "path",
        F.when(F.col("text").rlike(keyword), F.col("text")).alias("text")), "scanned")
    cand = scanned.where("text is not null") \
        .select("_row", _tokens(F.col("text")).alias("words"),
                F.filter(F.split("text", "\n"), lambda l: l.rlike(keyword)).alias("lines"))
    cand = materialize(cand.withColumn("at", _positions(F.col("words"), lambda w, i: w.rlike(_NOTICE_WORD))), "candidates")

    # and one for the document frequencies of their words and the templates'
    total = scanned.count()
    vocabulary = sorted({w for t in all_ for w in t[3]})
    wanted = cand.select(F.explode("words").alias("w")) \
        .unionByName(spark.createDataFrame([(w,) for w in vocabulary], "w string")).distinct()
    found = base.select(F.explode(F.array_distinct(_tokens(F.col("text")))).alias("w")) \
        .groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    idfs = materialize(wanted.join(found, "w", "left").select(
        "w", (F.log(F.lit(1.0 + total) / (1 + F.coalesce("n", F.lit(0)))) + 1).alias("idf")), "idf")
    # the templates are bounded, so their words can go to the driver
    mine = spark.createDataFrame([(w,) for w in vocabulary], "w string")
    idf = {r.w: r.idf for r in idfs.join(F.broadcast(mine), "w", "left_semi").collect()}
    weight: dict = {}
    for _, i, _, words, _ in all_:
        raw = {w: (1 + math.log(c)) * idf[w] for w, c in Counter(words).items()}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        weight |= {(i, w): x / norm for w, x in raw.items()}
    # per word the templates that hold it
    by_word: dict = {}
    for name, i, whole, words, must in all_:
        for w in set(words):
            by_word.setdefault(w, []).append((name, i, whole, len(words), len(must), weight[i, w], int(w in must)))
    template = "license string, template int, long boolean, t_words int, n_must int"
    weights = F.broadcast(spark.createDataFrame(sorted(by_word.items()), "w string, ts array<struct<" + ", ".join(
        c.replace(" ", ": ") for c in (template + ", weight double, must int").split(", ")) + ">>"))

    # a text's words lie together from its row on: only the idf is fetched by word
    unit = ["_row", "kind", "i", "j"]
    terms = (_units(cand, all_, weight, threshold).repartition("_row").withColumn("n", F.size("ws"))
             .select(*unit, "n", F.explode("ws").alias("w")).groupBy(*unit, "w")
             .agg(F.count(F.lit(1)).alias("tf"), F.first("n").alias("n")))
    terms = terms.join(idfs, "w").select(*unit, "n", "w", ((F.log("tf") + 1) * F.col("idf")).alias("x")).repartition("_row")
    # beside its templates each word meets its own weight, under a null template: the squared norm
    alone = F.array(F.struct(*[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in template.split(", ")],
                             F.col("x").alias("weight"), F.lit(0).alias("must")))
    # lines are compared with notices, windows with notices of their length, runs with whole texts, a whole text with all
    fits = F.col("t.template").isNull() | (F.col("kind") == "whole") | (
        ((F.col("kind") == "run") == F.col("t.long")) & ((F.col("kind") != "window") | (F.col("t.t_words") == F.col("i"))))
    dot = (terms.join(weights, "w", "left").select(*unit, "n", "x", F.explode(
               F.when(F.col("ts").isNull(), alone).otherwise(F.concat("ts", alone))).alias("t")).where(fits)
           .select(*unit, "n", "x", "t.*").groupBy(*unit, *[c.split()[0] for c in template.split(", ")])
           .agg(F.sum(F.col("x") * F.col("weight")).alias("dot"), F.sum("must").alias("must"), F.first("n").alias("n")))
    dot = dot.groupBy(*unit).agg(
        F.sqrt(F.max(F.when(F.col("template").isNull(), F.col("dot")))).alias("norm"), F.first("n").alias("n"),
        F.collect_list(F.when(F.col("must") == F.col("n_must"), F.struct("long", "license", "t_words", "dot"))).alias("t"))
    matched = (dot.select("_row", "kind", "i", "j", "norm", "n", F.explode("t").alias("t")).select("*", "t.*")
               .withColumn("similarity", F.round(F.col("dot") / F.col("norm"), 6)).where(F.col("similarity") >= threshold))
    best = F.struct(F.col("long"), (F.col("license") != RESERVED).alias("grants"), F.col("similarity"),
                    F.col("t_words"), F.col("license"))
    matched = matched.groupBy(*unit).agg(F.max(best).alias("best"), F.first("n").alias("n"))
    # only matches with whole licence texts speak for a file
    run = F.max(F.when((F.col("kind") == "run") & F.col("best.long"), F.col("n")))
    own = (matched.groupBy("_row").agg(F.max("best").alias("best"), F.coalesce(run, F.lit(0)).alias("run"),
                                       F.max((F.col("kind") == "whole") & F.col("best.long")).alias("whole"))
           .join(cand.select("_row", F.size("words").alias("n_words")), "_row")
           .select("_row", F.col("best.license").alias("own"), F.col("best.similarity").alias("similarity"),
                   (F.col("whole") | ((F.col("run") > 0) & (F.col("run") >= file_share * F.col("n_words")))).alias("whole_text")))

    names_file = F.coalesce(F.col("path").rlike(FILE_NAME), F.lit(False))
    placed = scanned.select("_row", "doc", "path", F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("dir")) \
        .join(own, "_row", "left").withColumn("is_file", F.col("whole_text") | (F.col("own").isNotNull() & names_file))
    placed = materialize(placed, "own-licenses")
    if path is None:
        out = placed.withColumns({"licensed_by": F.lit(None).cast("string"), "given": F.lit(None).cast("string"),
                                  "given_similarity": F.lit(None).cast("double")})
    else:
        out = _inherit(placed)
    mine = F.col("own").isNotNull()
    return out.select(
        F.col("doc").alias(key), "path", F.coalesce("own", "given").alias("license"),
        F.coalesce("similarity", "given_similarity").alias("similarity"),
        F.when(mine & F.col("is_file"), "file").when(mine, "header").when(F.col("given").isNotNull(), "inherited")
        .alias("origin"),
        F.when(~mine, F.col("licensed_by")).alias("licensed_by"))


def _inherit(placed: DataFrame) -> DataFrame:
    """``placed`` with the nearest licensed ancestor directory of each row's ``dir`` (licensed_by) and its license."""
    votes = placed.where("is_file").groupBy("dir", "own").agg(
        F.count(F.lit(1)).alias("n"), F.max("similarity").alias("similarity"))
    licensed = materialize(votes.groupBy(F.col("dir").alias("licensed_by")).agg(
        F.max_by(F.struct("own", "similarity"), F.struct("n", "similarity", "own")).alias("v"))
        .select("licensed_by", F.col("v.own").alias("given"), F.col("v.similarity").alias("given_similarity")), "licensed")
    steps = F.split("dir", "/")
    # from the root "" on
    up = F.transform(F.sequence(F.lit(0), F.size(steps)), lambda n: F.array_join(F.slice(steps, 1, n), "/"))
    ancestors = materialize(placed.select("dir").distinct().select("dir", F.explode(F.array_distinct(up)).alias("licensed_by")),
                            "ancestors")
    nearest = (_join_by(ancestors, licensed, "licensed_by", "inner").groupBy("dir")
               .agg(F.max_by(F.struct("licensed_by", "given", "given_similarity"), F.length("licensed_by")).alias("n"))
               .select("dir", "n.*"))
    return _join_by(placed, materialize(nearest, "nearest"), "dir", "left")
