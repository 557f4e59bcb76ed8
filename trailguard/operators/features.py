"""Per-account rolling statistics and derived features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailguard.functions.columns import (EPSILON, SMALL_AMOUNT, WINDOW_DAYS, date_text,
                                          mean_of_money, merge_money, money_aggs, ratio)
from trailguard.operators.numbering import partitions_for
from trailguard.operators.windows import anchor_dates, block_of, deal, to_anchors, to_blocks


def named(aggs: dict) -> list:
    return [c.alias(n) for n, c in aggs.items()]


def edges_of(ledger: DataFrame) -> DataFrame:
    """Ledger rows as directed edges ``src -> dst`` (already bank-qualified keys)."""
    return ledger.select(F.col("from_acc").alias("src"), F.col("to_acc").alias("dst"),
                         "txn_id", "amount_paid", "run_date")


def daily_targets(edges: DataFrame, threshold: float = SMALL_AMOUNT, by: tuple = ()) -> DataFrame:
    """One row per (src, day, dst) and ``by``: count, money aggregates, small-amount count.

    This is the pre-aggregation every window below starts from.
    """
    return edges.groupBy("src", *by, "run_date", "dst").agg(
        F.count(F.lit(1)).alias("n"),
        *named(money_aggs("amount_paid")),
        F.count_if(F.col("amount_paid") < threshold).alias("small"))


def windowed_days(edges: DataFrame, anchors: DataFrame, days: int = WINDOW_DAYS, include_anchor: bool = True,
                  threshold: float = SMALL_AMOUNT) -> DataFrame:
    """:func:`daily_targets` once for every anchor whose window holds the day, with the anchor's ``_block``.  Edges are shuffled
    once, by (src, ``_block``); what they are spread to is aggregated where it lies."""
    n = partitions_for(edges.sparkSession, edges.count() * days)
    dealt = deal(to_blocks(edges.select("src", "dst", "run_date", "amount_paid"), "run_date", days), n, "src", "_block")
    return to_anchors(daily_targets(dealt, threshold, ("_block",)), anchors, "run_date", days, include_anchor) \
        .where(block_of("anchor", days) == F.col("_block"))


def window_stats(edges: DataFrame, anchors: DataFrame, days: int = WINDOW_DAYS,
                 include_anchor: bool = True, threshold: float = SMALL_AMOUNT) -> DataFrame:
    """(src, anchor) -> tx_count, money aggregates, unique_targets, small_tx over the window."""
    w = windowed_days(edges, anchors, days, include_anchor, threshold)
    per_target = w.groupBy("src", "_block", "anchor", "dst").agg(
        F.sum("n").alias("n"), *named(merge_money()), F.sum("small").alias("small"))
    return per_target.groupBy("src", "_block", "anchor").agg(
        F.sum("n").cast("bigint").alias("tx_count"),
        *named(merge_money()),
        F.count(F.lit(1)).alias("unique_targets"),
        F.sum("small").cast("bigint").alias("small_tx"))


def tx_stats(edges: DataFrame, anchors: DataFrame | None = None, days: int = WINDOW_DAYS) -> DataFrame:
    """Count, mean amount paid and distinct targets of each sender, window (D-days, D]."""
    anchors = anchors if anchors is not None else anchor_dates(edges)
    s = window_stats(edges, anchors, days, include_anchor=True)
    return s.select(F.col("src").alias("account_id"), F.col("anchor").alias("anchor_date"),
                    F.col("tx_count"), mean_of_money().alias("avg_amount"),
                    F.col("unique_targets").cast("bigint").alias("unique_targets"))


def structuring(edges: DataFrame, anchors: DataFrame | None = None, days: int = WINDOW_DAYS,
                threshold: float = SMALL_AMOUNT) -> DataFrame:
    """senders' count of transactions below ``threshold`` in (D-days, D]."""
    anchors = anchors if anchors is not None else anchor_dates(edges)
    per_day = (edges.where(F.col("amount_paid") < threshold)
               .groupBy("src", "run_date").agg(F.count(F.lit(1)).alias("k")))
    w = to_anchors(per_day, anchors, "run_date", days, include_anchor=True)
    return w.groupBy(F.col("src").alias("account_id"), F.col("anchor").alias("anchor_date")) \
            .agg(F.sum("k").cast("bigint").alias("small_tx_count"))


def active_accounts(edges: DataFrame, anchors: DataFrame | None = None,
                    days: int = WINDOW_DAYS) -> DataFrame:
    """C4: accounts with at least one outgoing edge in (D-days, D], per anchor D."""
    anchors = anchors if anchors is not None else anchor_dates(edges)
    per_day = edges.select("src", "run_date").distinct()
    w = to_anchors(per_day, anchors, "run_date", days, include_anchor=True)
    return w.select(F.col("src").alias("account_id"), F.col("anchor").alias("anchor_date")).distinct()


def history_and_today(edges: DataFrame, anchors: DataFrame | None = None, days: int = WINDOW_DAYS,
                      threshold: float = SMALL_AMOUNT) -> tuple[DataFrame, DataFrame]:
    """D6 (history, anchor excluded) and D7 (the anchor day itself) per (account, anchor)."""
    anchors = anchors if anchors is not None else anchor_dates(edges)
    daily = daily_targets(edges, threshold)
    h = window_stats(edges, anchors, days, include_anchor=False, threshold=threshold)
    history = h.select(
        F.col("src").alias("account_id"), F.col("anchor"),
        F.col("tx_count").alias("feature_tx_count"),
        mean_of_money().alias("feature_avg_amount"),
        F.col("unique_targets").cast("bigint").alias("feature_unique_targets"),
        F.col("small_tx").alias("feature_small_tx"))
    t = (daily.join(anchors.select(F.col("anchor").alias("run_date")), "run_date", "left_semi")
         .groupBy("src", "run_date").agg(F.sum("n").cast("bigint").alias("today_tx"),
                                         *named(merge_money()),
                                         F.count(F.lit(1)).alias("today_targets")))
    today = t.select(F.col("src").alias("account_id"), F.col("run_date").alias("anchor"),
                     "today_tx", mean_of_money().alias("today_avg"),
                     F.col("today_targets").cast("bigint").alias("today_targets"))
    return history, today


FEATURE_COLUMNS = ["account_id", "feature_tx_count", "feature_avg_amount", "feature_unique_targets",
                   "feature_small_tx", "today_tx", "today_avg", "today_targets", "tx_count_delta",
                   "avg_amount_spike", "target_growth", "smurfing_score", "round_trip_combined",
                   "avg_round_trip_len", "feature_date"]


def derive(df: DataFrame, smurf_gate: float | None = None, eps: float = EPSILON) -> DataFrame:
    """Deltas and ratios from history (feature_*) and today (today_*) columns.

    ``smurf_gate``: the stream form scores smurfing only when today's mean is below the gate.
    """
    smurf = ratio(F.col("today_tx"), F.col("today_avg"), eps)
    if smurf_gate is not None:
        smurf = F.when(F.col("today_avg") < smurf_gate, smurf).otherwise(F.lit(0.0))
    return df.withColumns({
        "tx_count_delta": (F.col("today_tx") - F.col("feature_tx_count")).cast("bigint"),
        "avg_amount_spike": (F.col("today_avg") - F.col("feature_avg_amount"))
                            / (F.col("feature_avg_amount") + F.lit(eps)),
        "target_growth": ratio(F.col("today_targets"), F.col("feature_unique_targets"), eps),
        "smurfing_score": smurf,
    })


def rolling_sides(edges: DataFrame, anchors: DataFrame | None = None, days: int = WINDOW_DAYS,
                  threshold: float = SMALL_AMOUNT) -> DataFrame:
    """History and today of every (account, anchor day) with an edge in its window, in one plan (0 where a side has
    no rows).

    Daily rows are spread over the anchors that see them, the anchor day included; a row of the
    anchor day counts for today_*, any other for the history.  Both sides thus come from one
    pass, without the full outer join of :func:`history_and_today`.
    """
    anchors = anchors if anchors is not None else anchor_dates(edges)
    w = windowed_days(edges, anchors, days, True, threshold)
    sides = {"h_": F.col("run_date") < F.col("anchor"), "t_": F.col("run_date") == F.col("anchor")}
    parts = ["n", "small", "amt", "odd", "paid"]
    per_target = w.groupBy("src", "_block", "anchor", "dst").agg(
        *[F.sum(F.when(side, F.col(c))).alias(p + c) for p, side in sides.items() for c in parts])
    per_account = per_target.groupBy("src", "_block", "anchor").agg(
        *[F.coalesce(F.sum(p + c), F.lit(0)).cast("bigint").alias(p + c) for p in sides for c in ("n", "small")],
        *[F.count(p + "n").alias(p + "targets") for p in sides],
        *[c for p in sides for c in named(merge_money(p))])
    return per_account.select(
        F.col("src").alias("account_id"), "anchor",
        F.col("h_n").alias("feature_tx_count"),
        F.coalesce(mean_of_money("h_"), F.lit(0.0)).alias("feature_avg_amount"),
        F.col("h_targets").alias("feature_unique_targets"), F.col("h_small").alias("feature_small_tx"),
        F.col("t_n").alias("today_tx"), F.coalesce(mean_of_money("t_"), F.lit(0.0)).alias("today_avg"),
        F.col("t_targets").alias("today_targets"))


def finish_sides(sides: DataFrame, smurf_gate: float | None = None) -> DataFrame:
    """The feature rows of :func:`rolling_sides`, row by row."""
    j = derive(sides, smurf_gate).withColumns({
        "round_trip_combined": F.lit(0), "avg_round_trip_len": F.lit(0),
        "feature_date": date_text("anchor")})
    return j.select(*FEATURE_COLUMNS)


def rolling_features(edges: DataFrame, anchors: DataFrame | None = None, days: int = WINDOW_DAYS,
                     threshold: float = SMALL_AMOUNT, smurf_gate: float | None = None) -> DataFrame:
    """Training features for every anchor day."""
    return finish_sides(rolling_sides(edges, anchors, days, threshold), smurf_gate)


def with_round_trips(features: DataFrame, trips: DataFrame) -> DataFrame:
    """Q6 fixed: replace the constant round-trip columns with D9's per (account, day) values."""
    t = trips.select("account_id", date_text("anchor_date").alias("feature_date"),
                     F.col("round_trip_count").alias("_rt_n"),
                     F.col("avg_round_trip_length").alias("_rt_len"))
    j = features.join(t, ["account_id", "feature_date"], "left")
    return j.withColumns({
        "round_trip_combined": F.coalesce(F.col("_rt_n"), F.lit(0)).cast("bigint"),
        "avg_round_trip_len": F.coalesce(F.col("_rt_len"), F.lit(0.0)),
    }).select(*FEATURE_COLUMNS)


SNAPSHOT_COLUMNS = ["account_id", "feature_day_tx_count", "feature_day_avg_amount",
                    "feature_day_unique_targets", "feature_round_trip_count",
                    "feature_round_trip_avg_len", "feature_small_tx_count"]


def account_snapshot(edges: DataFrame, run_date: str, days: int = WINDOW_DAYS,
                     threshold: float = SMALL_AMOUNT) -> DataFrame:
    """M8: the three batch enrichers for one run_date, as one wide nullable table.

    Each enricher only reaches the accounts it has rows for, so absent properties stay NULL.
    """
    from trailguard.operators.cycles import round_trips
    spark = edges.sparkSession
    day = F.to_date(F.lit(run_date))
    # only edges of (D-days, D] can contribute: a literal range the Parquet scan prunes on,
    # so a daily snapshot reads its window instead of the whole history
    edges = edges.where((F.col("run_date") > F.date_sub(day, days)) & (F.col("run_date") <= day))
    anchors = spark.range(1).select(day.alias("anchor"))
    stats = tx_stats(edges, anchors, days).select(
        "account_id", F.col("tx_count").alias("feature_day_tx_count"),
        F.col("avg_amount").alias("feature_day_avg_amount"),
        F.col("unique_targets").alias("feature_day_unique_targets"))
    trips = round_trips(edges, anchors, days).select(
        "account_id", F.col("round_trip_count").alias("feature_round_trip_count"),
        F.col("avg_round_trip_length").alias("feature_round_trip_avg_len"))
    small = structuring(edges, anchors, days, threshold).select(
        "account_id", F.col("small_tx_count").alias("feature_small_tx_count"))
    return stats.join(trips, "account_id", "full").join(small, "account_id", "full") \
                .select(*SNAPSHOT_COLUMNS)


def merge_snapshot(old: DataFrame, new: DataFrame, replace: bool = False) -> DataFrame:
    """Upsert ``new`` into ``old`` by account_id; a property absent from ``new`` keeps its
    old value (Q11).  ``replace=True`` drops stale properties instead."""
    if replace:
        return new.select(*SNAPSHOT_COLUMNS)
    props = [c for c in SNAPSHOT_COLUMNS if c != "account_id"]
    o = old.select("account_id", *[F.col(c).alias(f"_o_{c}") for c in props])
    j = new.select("account_id", *props).join(o, "account_id", "full")
    return j.select("account_id", *[F.coalesce(F.col(c), F.col(f"_o_{c}")).alias(c) for c in props])
