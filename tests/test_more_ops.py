"""Snapshot join nulls (Q12), daily state mode, hot-day numbering, partitioned day reads."""

import datetime as dt
import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from trailguard.operators import features, ledger
from trailguard.sources import files
from trailguard.streaming import pipeline as P
from trailguard.streaming import state


def test_snapshot_join_known_null_vs_unknown(spark):
    stats = spark.createDataFrame(
        [(1, 10, "a", 3, 50.0, 2), (2, 10, "b", 1, 20.0, 1)],
        "txn_id long, from_bank long, from_acc string, today_tx long, today_avg double, "
        "today_targets long")
    snap = spark.createDataFrame(
        [("a", None, None, None, 4, None, 7)],
        "account_id string, feature_day_tx_count long, feature_day_avg_amount double, "
        "feature_day_unique_targets long, feature_round_trip_count long, "
        "feature_round_trip_avg_len double, feature_small_tx_count long")
    cyc = spark.createDataFrame([(1, 0, 0.0), (2, 1, 2.0)], "txn_id long, cycle_count long, avg_cycle_len double")
    out = {r.txn_id: r for r in P.stream_features(stats, snap, cyc).collect()}
    a, b = out[1], out[2]
    assert a.feature_tx_count is None and a.feature_avg_amount is None      # known, property missing
    assert a.feature_small_tx == 7 and a.tx_count_delta == 3                  # delta treats missing as 0
    assert (b.feature_tx_count, b.feature_avg_amount, b.feature_small_tx) == (0, 0.0, 0)  # unknown
    assert (b.round_trip_combined, b.avg_round_trip_len) == (1, 2.0)
    assert a.smurfing_score == 3 / (50.0 + 1e-6)


def test_daily_mode_resets_per_day(spark):
    ts = dt.datetime(2022, 9, 1, 10)
    ev = spark.createDataFrame(
        [(1, 1, "a", "x", 10.0, ts, dt.date(2022, 9, 1), "t", "2022-09-01"),
         (2, 1, "a", "y", 30.0, ts + dt.timedelta(hours=1), dt.date(2022, 9, 1), "t", "2022-09-01"),
         (3, 1, "a", "x", 5.0, ts + dt.timedelta(days=1), dt.date(2022, 9, 2), "t", "2022-09-02")],
        "txn_id long, from_bank long, from_acc string, to_acc string, amount_paid double, "
        "event_ts timestamp, event_date date, ts string, run_date string")
    since = {r.txn_id: (r.today_tx, r.today_avg, r.today_targets)
             for r in state.running_stats_batch(ev).collect()}
    daily = {r.txn_id: (r.today_tx, r.today_avg, r.today_targets)
             for r in state.running_stats_batch(ev, mode="daily").collect()}
    assert since == {1: (1, 10.0, 1), 2: (2, 20.0, 2), 3: (3, 15.0, 2)}
    assert daily[3] == (1, 5.0, 1) and daily[2] == (2, 20.0, 2)


def test_hot_day_numbering_spans_partitions(spark):
    # one day holds most rows; numbering per day must still be 1..n in (ts, txn_id) order
    base = dt.datetime(2022, 9, 1)
    rows = [(i, base + dt.timedelta(minutes=i % 300)) for i in range(400)]
    rows += [(1000 + i, base + dt.timedelta(days=1, minutes=i)) for i in range(5)]
    df = spark.createDataFrame(rows, "txn_id long, ts timestamp").repartition(6)
    got = ledger.number_within_day(df)
    w = Window.partitionBy("year", "month", "day").orderBy("ts", "global_txn_id")
    want = ledger.with_date_parts(df).withColumnRenamed("txn_id", "global_txn_id") \
        .withColumn("txn_id", F.row_number().over(w))
    key = ["global_txn_id", "txn_id"]
    assert sorted(got.select(*key).collect()) == sorted(want.select(*key).collect())


def test_partitioned_day_read_keeps_columns(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, dt.datetime(2022, 9, 1, 1)), (2, dt.datetime(2022, 9, 2, 1)), (3, dt.datetime(2022, 9, 2, 5))],
        "txn_id long, ts timestamp")
    root = str(tmp_path / "by_day")
    files.write_partitioned(ledger.with_date_parts(df), root, ["year", "month", "day"], ["ts"])
    files.write_partitioned(ledger.with_date_parts(df), root, ["year", "month", "day"], ["ts"])  # rerun
    day = files.read_partitioned(spark, root, "2022-09-02")
    assert sorted(r.txn_id for r in day.collect()) == [2, 3]
    assert {"year", "month", "day"} <= set(day.columns)
    assert files.read_partitioned(spark, root).count() == 3          # dynamic overwrite: no dupes


def test_registered_outputs_render_temporal_as_text(spark):
    from trailguard.plans.catalog import temporal_as_text
    df = spark.createDataFrame([(dt.date(2022, 9, 1), dt.datetime(2022, 9, 1, 6, 21), 1)],
                               "d date, t timestamp, n int")
    r = temporal_as_text(df).first()
    assert (r.d, r.t, r.n) == ("2022-09-01", "2022-09-01 06:21:00", 1)


def test_combine_edges_counts_shared_edges_once(spark):
    from trailguard.operators import graph
    cols = "src string, dst string, run_date date, txn_id long"
    b = spark.createDataFrame([("a", "b", dt.date(2022, 9, 1), 1), ("a", "c", dt.date(2022, 9, 1), 2)], cols)
    s = spark.createDataFrame([("a", "b", dt.date(2022, 9, 1), 1), ("c", "a", dt.date(2022, 9, 2), 1)], cols)
    got = {(r.src, r.dst): (r.in_batch, r.in_stream) for r in graph.combine_edges(b, s).collect()}
    assert got == {("a", "b"): (True, True), ("a", "c"): (True, False), ("c", "a"): (False, True)}


def _edges(spark, rows):
    return spark.createDataFrame([("a", "b", i, x, dt.date(2022, 9, day)) for i, (x, day) in enumerate(rows)],
                                 "src string, dst string, txn_id long, amount_paid double, run_date date")


def test_money_is_not_cut(spark):
    """Sub-cent, huge, NaN, infinite and missing amounts keep the mean of doubles."""
    e = _edges(spark, [(0.00000001, 1), (0.004, 1), (1e17, 11), (2e17, 11), (float("nan"), 21), (1.0, 21),
                       (1e300, 26), (None, 26)])
    t = {r.anchor.day: r for r in features.history_and_today(e)[1].collect()}
    assert t[1].today_avg == 0.00400001 / 2
    assert t[11].today_avg == 1.5e17
    assert math.isnan(t[21].today_avg) and t[21].today_tx == 2
    assert (t[26].today_avg, t[26].today_tx) == (1e300, 2)     # a missing amount has no part in the mean
    missing = features.history_and_today(_edges(spark, [(None, 1)]))[1].first()
    assert (missing.today_tx, missing.today_avg) == (1, None)


def test_running_money_keeps_ten_decimals(spark):
    rows = [(i, 1, "x", f"t{i}", x, dt.datetime(2022, 9, 1, 0, i), dt.date(2022, 9, 1), "", "2022-09-01")
            for i, x in enumerate([0.0000000001, 123456789012.25, 0.0000000002])]
    ev = spark.createDataFrame(rows, "txn_id long, from_bank long, from_acc string, to_acc string, amount_paid double, "
                                     "event_ts timestamp, event_date date, ts string, run_date string")
    got = [r.today_avg for r in state.running_stats_batch(ev).orderBy("txn_id").collect()]
    assert got == [0.0000000001, 123456789012.2500000001 / 2, 123456789012.2500000003 / 3]


def test_rolling_features_equal_joined_history_and_today(spark):
    """One pass gives what the full outer join of both sides gives, nulls and NaN included."""
    e = _edges(spark, [(1.5, 1), (float("nan"), 3), (None, 5), (20000.0, 5), (0.004, 12), (None, 20)])
    h, t = features.history_and_today(e)
    names = ["feature_tx_count", "feature_avg_amount", "feature_unique_targets", "feature_small_tx",
             "today_tx", "today_avg", "today_targets"]
    joined = h.join(t, ["account_id", "anchor"], "full").select(
        F.col("anchor").cast("string"), *[F.coalesce(c, F.lit(0)).alias(c) for c in names])
    got = features.rolling_features(e).select("feature_date", *names)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, joined.collect())))


def test_a_hot_day_is_exported_in_several_files(spark, tmp_path):
    from trailguard.sources.files import export_daily_csv
    root = tmp_path / "csv"
    df = spark.range(4000).selectExpr("id as txn_id", "if(id % 40 = 0, '2022-09-02', '2022-09-01') as date_str",
                                      "concat('t', lpad(cast(pmod(id * 7, 4000) as string), 5, '0')) as ts")
    small = "spark.sql.adaptive.coalescePartitions.enabled"     # would join partitions as small as these
    was = spark.conf.get(small)
    spark.conf.set(small, "false")
    try:
        export_daily_csv(df, str(root))
    finally:
        spark.conf.set(small, was)
    hot = sorted((root / "date_str=2022-09-01").glob("*.csv"))
    assert len(hot) > 1                                     # 97 % of the rows are one day's
    for f in hot:
        head, *lines = f.read_text().splitlines()
        assert head == "txn_id,ts" and lines == sorted(lines, key=lambda r: r.split(",")[1])
    back = spark.read.option("header", True).csv(str(root))
    assert back.selectExpr("cast(txn_id as bigint) as txn_id", "ts", "cast(date_str as string) as date_str") \
        .exceptAll(df.select("txn_id", "ts", "date_str")).count() == 0 and back.count() == 4000
