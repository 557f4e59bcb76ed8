"""Mixing sources to target weights by Sainte-Laguë apportionment.

The mix holds as many words as the sources together.  Each source's target is its share by
weight, at most ``max_epochs`` times its size, the excess reshared by weight.  The mix is made of
blocks of equally many words: blocks go to sources by the highest quotients target / (2 s + 1),
and a source's blocks to its shards the same way (by size), so every shard has an integer quota.
Inside a shard documents lie end to end in a seeded order; whole passes are taken first, and the
rest of the quota is a run of blocks from a seeded place, around the end if need be.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trailguard.llm.common import WORD, materialize, prepare
from trailguard.operators.numbering import number_rows

WEIGHTS = (5.0, 2.0, 1.0)
BLOCK_WORDS = 16
SHARD_ROWS = 10_000
PROBES = 32


def quotas(weights: np.ndarray, caps: np.ndarray, seats: int) -> np.ndarray:
    """Sainte-Laguë seats of each party, none above its cap; ties to the earlier party."""
    n = len(weights)
    out = np.zeros(n, np.int64)
    seats = int(min(seats, caps.sum()))
    if seats <= 0 or not n:
        return out
    total = float(weights.sum())
    lo, hi = 0.0, 2.0 * seats / total + 1.0
    count = lambda c: np.minimum(np.floor(weights * c + 0.5), caps).astype(np.int64)
    while count(hi).sum() < seats:
        hi *= 2
    for _ in range(200):
        mid = (lo + hi) / 2
        if count(mid).sum() <= seats:
            lo = mid
        else:
            hi = mid
        if hi - lo <= 1e-15 * hi:
            break
    out = count(lo)
    heap = [(-weights[i] / (2 * out[i] + 1), i) for i in range(n) if out[i] < caps[i]]
    heapq.heapify(heap)
    for _ in range(seats - int(out.sum())):
        _, i = heapq.heappop(heap)
        out[i] += 1
        if out[i] < caps[i]:
            heapq.heappush(heap, (-weights[i] / (2 * out[i] + 1), i))
    return out


def _source_seats(sources: DataFrame, seats: int) -> DataFrame:
    """``sources`` (sid, target, cap) with the seats of each.  The multiplier at which rounded
    targets add up to ``seats`` is searched with a few aggregations of many probes each; the
    seats left over by ties go to the highest next quotients."""
    got = lambda c: F.least(F.floor(F.col("target") * c + 0.5), F.col("cap")).cast("bigint")
    lo, hi = 0.0, 4.0 / BLOCK_WORDS
    while (sources.agg(F.sum(got(F.lit(hi)))).first()[0] or 0) < seats:
        hi *= 2
    for _ in range(12):
        probes = [lo + (hi - lo) * i / PROBES for i in range(1, PROBES)]
        sums = sources.agg(*[F.sum(got(F.lit(p))).alias(f"p{i}") for i, p in enumerate(probes)]).first()
        sums = [s or 0 for s in sums]           # no sources, no sums
        below = [p for p, s in zip(probes, sums) if s <= seats]
        above = [p for p, s in zip(probes, sums) if s > seats]
        lo, hi = max([lo, *below]), min([hi, *above])
        if hi - lo <= 1e-15 * hi or (below and max(s for s in sums if s <= seats) == seats):
            break
    out = sources.withColumn("seats", got(F.lit(lo)))
    left = seats - int(out.agg(F.sum("seats")).first()[0] or 0)
    if left <= 0:
        return out
    order = out.where("seats < cap").withColumn("_q", -F.col("target") / (2 * F.col("seats") + 1))
    more = number_rows(order.select("_q", "sid"), ["_q", "sid"], name="_n").where(F.col("_n") <= left)
    return (out.join(more.select("sid", F.lit(1).alias("_more")), "sid", "left")
            .withColumn("seats", F.col("seats") + F.coalesce("_more", F.lit(0))).drop("_more"))


def _targets(sources: DataFrame, max_epochs: float) -> DataFrame:
    """``sources`` (sid, weight, source_size) with target."""
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    s = sources.withColumn("cap_words", F.col("source_size") * max_epochs)
    ratio = -1.0
    while True:                 # a capped source stays capped: shares only grow
        capped = F.col("cap_words") / F.col("weight") < F.lit(ratio)
        free, taken = s.agg(F.sum(F.when(~capped, F.col("weight"))),
                            F.sum(F.when(capped, F.col("cap_words")))).first()
        share = (total - (taken or 0.0)) / free if free else 0.0
        if share <= ratio:
            break
        ratio = share
    return s.withColumn("target", F.least(F.col("weight") * F.lit(share), F.col("cap_words").cast("double")))


def _shard_quotas():
    schema = pa.schema([("sid", pa.int64()), ("shard", pa.int64()), ("words", pa.int64()), ("quota", pa.int64())])

    def run(key, table):
        t = table.sort_by("shard")
        words = t.column("words").to_numpy()
        q = quotas(words.astype(float), t.column("cap").to_numpy(), t.column("seats")[0].as_py())
        return pa.Table.from_arrays([t.column("sid").cast(pa.int64()), t.column("shard").cast(pa.int64()),
                                     pa.array(words, pa.int64()), pa.array(q, pa.int64())], schema=schema)
    return run


def mix_sources(docs: DataFrame, weights=WEIGHTS, max_epochs: int = 3, seed: int = 7,
                keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, size (words), source_size, target (of the source, in words), taken (words of the
    document in the mix, repeats counted), and the columns in ``keep``.

    Sources in code-point order (null last) weigh ``weights`` in turn.  Null text has size 0 and
    takes 0; null doc_ids are kept; repeated rows are documents of their own; an empty table, or
    one without words, gives zeros.  The same rows give the same mix on every run and layout.
    """
    prepare(docs.sparkSession)
    sized = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), *keep,
                        F.col("source").cast("string").alias("_source"),
                        F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"))
    sized = materialize(sized.withColumns({"_none": F.col("_source").isNull(),
                                           "_name": F.coalesce("_source", F.lit(""))}).drop("_source"), "sized")
    by_source = sized.groupBy("_none", "_name").agg(F.sum("size").alias("source_size"),
                                                    F.count(F.lit(1)).alias("_rows"))
    sources = number_rows(by_source, ["_none", "_name"], name="sid")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.pmod(F.col("sid") - 1, F.lit(len(weights))) + 1).cast("int"))
    sources = _targets(materialize(sources.withColumn("weight", weight), "sources"), max_epochs)
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    sources = sources.withColumn("cap", F.floor(F.col("cap_words") / BLOCK_WORDS).cast("bigint"))
    sources = materialize(_source_seats(sources, min(round(total / BLOCK_WORDS), int(
        sources.agg(F.sum("cap")).first()[0] or 0))), "seats")
    shards = F.greatest(F.lit(1), F.ceil(F.col("_rows") / SHARD_ROWS)).cast("bigint")
    facts = sources.select("_none", "_name", "sid", "source_size", "target", "seats", shards.alias("_shards"))
    place = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("size"))
    # a hot source is dealt to many shards; only the join on its name sees it whole, and that join
    # has one small side, so Spark broadcasts it or splits the hot side
    dealt = (sized.join(facts, ["_none", "_name"])
             .withColumns({"_place": place, "shard": F.pmod(F.xxhash64(F.lit(seed + 1), F.col("doc_id"), F.col("size")),
                                                            F.col("_shards"))}))
    cells = (dealt.groupBy("sid", "shard", "seats").agg(F.sum("size").alias("words"))
             .withColumn("cap", F.floor(F.col("words") * max_epochs / BLOCK_WORDS).cast("bigint")))
    quota = cells.groupBy("sid").applyInArrow(_shard_quotas(), "sid bigint, shard bigint, words bigint, quota bigint")
    order = Window.partitionBy("sid", "shard").orderBy("_place", "doc_id", "size", *keep) \
        .rowsBetween(Window.unboundedPreceding, -1)
    laid = (dealt.withColumn("_at", F.coalesce(F.sum("size").over(order), F.lit(0)))
            .join(quota, ["sid", "shard"]))
    due = F.col("quota") * BLOCK_WORDS
    passes = F.when(F.col("words") > 0, F.floor(due / F.col("words"))).otherwise(0).cast("bigint")
    laid = laid.withColumns({"_passes": passes, "_rest": due - passes * F.col("words"),
                             "_from": F.when(F.col("words") > 0, F.pmod(
                                 F.pmod(F.xxhash64(F.lit(seed + 2), "sid", "shard"),
                                        F.greatest(F.lit(1), F.ceil(F.col("words") / BLOCK_WORDS))) * BLOCK_WORDS,
                                 F.col("words"))).otherwise(0)})

    def overlap(lo, hi):
        return F.greatest(F.lit(0), F.least(F.col("_at") + F.col("size"), hi) - F.greatest(F.col("_at"), lo))

    end = F.col("_from") + F.col("_rest")
    taken = F.col("_passes") * F.col("size") + overlap(F.col("_from"), F.least(end, F.col("words"))) + \
        overlap(F.lit(0), end - F.col("words"))
    return laid.select("doc_id", *keep, "size", "source_size", "target", taken.cast("bigint").alias("taken"))
