"""Numbering, suspects, window borders, rules, snapshot merge, upserts."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from trailguard.functions.rules import DEFAULTS, evaluate_rules
from trailguard.operators import features, graph, ledger
from trailguard.operators.numbering import number_rows


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 50)), min_size=1, max_size=60),
       st.integers(1, 5))
def test_two_pass_numbers_equal_row_number(spark, rows, parts):
    df = spark.createDataFrame([(g, v, i) for i, (g, v) in enumerate(rows)], "g int, v int, i int") \
              .repartition(parts)
    got = number_rows(df, ["v", "i"], by=["g"], name="n", partitions=parts)
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("v", "i")))
    assert sorted(got.select("i", "n").collect()) == sorted(want.select("i", "n").collect())
    glob = number_rows(df, ["v", "i"], name="n", partitions=parts)
    want = df.withColumn("n", F.row_number().over(Window.orderBy("v", "i")))
    assert sorted(glob.select("i", "n").collect()) == sorted(want.select("i", "n").collect())


def _ledger(spark, rows):
    return spark.createDataFrame(
        rows, "txn_id long, from_bank long, from_account string, to_bank long, to_account string, "
              "is_laundering int")


def test_related_sender_match_wins(spark):
    led = _ledger(spark, [(1, 1, "a", 2, "b", 1), (2, 3, "c", 1, "a", 0), (3, 2, "b", 1, "a", 0),
                          (4, 5, "x", 6, "y", 0)])
    sus = ledger.suspect_parties(led)
    assert sorted(tuple(r) for r in sus.collect()) == [(1, "a"), (2, "b")]
    rel = {r.txn_id: (r.bank, r.account) for r in ledger.related_transactions(led, sus).collect()}
    # txn 3: sender (2,b) is a suspect and so is the receiver; the sender wins
    assert rel == {1: (1, "a"), 2: (1, "a"), 3: (2, "b")}


def _edges(spark, rows):
    return spark.createDataFrame(
        [(s, d, i, float(a), dt.date(2022, 9, 1) + dt.timedelta(days=k)) for i, (s, d, a, k) in enumerate(rows)],
        "src string, dst string, txn_id long, amount_paid double, run_date date")


def test_window_borders(spark):
    # anchor = day 10; history window is days 6..9 (D-4 .. D-1); day 5 (D-5) is outside
    e = _edges(spark, [("a", "b", 100, 5), ("a", "b", 200, 6), ("a", "c", 300, 9), ("a", "d", 50, 10)])
    anchors = spark.createDataFrame([(dt.date(2022, 9, 11),)], "anchor date")
    r = features.rolling_features(e, anchors).collect()
    assert len(r) == 1
    row = r[0]
    assert (row.feature_tx_count, row.feature_unique_targets, row.today_tx) == (2, 2, 1)
    assert row.feature_avg_amount == 250.0 and row.today_avg == 50.0
    assert row.tx_count_delta == -1
    # the snapshot window (D-5, D] includes the anchor day: days 6..10
    s = features.tx_stats(e, anchors).collect()[0]
    assert (s.tx_count, s.unique_targets) == (3, 3)


def test_smurf_gate(spark):
    df = spark.createDataFrame([(3, 2.0, 0, 0.0, 1, 0), (3, 20000.0, 0, 0.0, 1, 0)],
                               "today_tx long, today_avg double, feature_tx_count long, "
                               "feature_avg_amount double, today_targets long, feature_unique_targets long")
    gated = [r.smurfing_score for r in features.derive(df, smurf_gate=10000).collect()]
    assert gated[0] > 1.0 and gated[1] == 0.0


def test_rules_just_below_and_above(spark):
    t = DEFAULTS
    base = dict(smurfing_score=0.0, target_growth=0.0, tx_count_delta=0.0, round_trip_combined=0,
                avg_round_trip_len=0.0, avg_amount_spike=0.0)
    cases = [("smurfing_score", t.smurfing, "Smurfing"),
             ("target_growth", t.target_growth, "New Targets Spike"),
             ("tx_count_delta", t.tx_count_delta, "Tx Count Burst"),
             ("avg_amount_spike", t.amount_spike, "Avg Amount Spike")]
    rows = []
    for col, thr, _ in cases:
        rows.append({**base, col: float(thr)})          # not above: no hit
        rows.append({**base, col: float(thr) + 0.5})    # above: hit
    rows.append({**base, "round_trip_combined": 1, "avg_round_trip_len": 3.0})
    rows.append({**base, "round_trip_combined": 1, "avg_round_trip_len": 2.9})
    rows.append({**base, "smurfing_score": None})        # missing compares as 0
    df = spark.createDataFrame(rows, "smurfing_score double, target_growth double, "
                               "tx_count_delta double, round_trip_combined long, "
                               "avg_round_trip_len double, avg_amount_spike double")
    out = [(r.rule_hit, r.rule_reason) for r in evaluate_rules(df).collect()]
    for k, (_, _, name) in enumerate(cases):
        assert out[2 * k] == (False, "")
        assert out[2 * k + 1] == (True, name)
    assert out[-3] == (True, "Round-trip") and out[-2] == (False, "") and out[-1] == (False, "")
    # the model smoke vector of the reference hits only "Round-trip"
    smoke = spark.createDataFrame([(0.02, 0.4, -3.0, 1, 3.0, 1.5)], df.schema)
    assert [(r.rule_hit, r.rule_reason) for r in evaluate_rules(smoke).collect()] == [(True, "Round-trip")]


def test_rule_order_is_fixed(spark):
    df = spark.createDataFrame([(11.0, 3.0, 11.0, 1, 3.0, 6.0)],
                               "smurfing_score double, target_growth double, tx_count_delta double, "
                               "round_trip_combined long, avg_round_trip_len double, avg_amount_spike double")
    assert evaluate_rules(df).first().rule_reason == \
        "Smurfing, New Targets Spike, Tx Count Burst, Round-trip, Avg Amount Spike"


def test_snapshot_merge_keeps_old_properties(spark):
    cols = features.SNAPSHOT_COLUMNS
    schema = ("account_id string, feature_day_tx_count long, feature_day_avg_amount double, "
              "feature_day_unique_targets long, feature_round_trip_count long, "
              "feature_round_trip_avg_len double, feature_small_tx_count long")
    old = spark.createDataFrame([("a", 1, 1.0, 1, 5, 2.0, 1), ("b", 2, 2.0, 2, None, None, 2)], schema)
    new = spark.createDataFrame([("a", 9, 9.0, 9, None, None, None), ("c", 3, 3.0, 3, 1, 3.0, None)], schema)
    got = {r.account_id: tuple(r) for r in features.merge_snapshot(old, new).select(*cols).collect()}
    assert got["a"] == ("a", 9, 9.0, 9, 5, 2.0, 1)          # round trip / small kept (Q11)
    assert got["b"] == ("b", 2, 2.0, 2, None, None, 2)
    assert got["c"] == ("c", 3, 3.0, 3, 1, 3.0, None)
    rep = {r.account_id for r in features.merge_snapshot(old, new, replace=True).collect()}
    assert rep == {"a", "c"}


def test_upsert_is_idempotent_and_latest_wins(spark, tmp_path):
    root = str(tmp_path / "edges")
    b0 = spark.createDataFrame([("a", "b", dt.date(2022, 9, 1), 1, 10.0), ("a", "c", dt.date(2022, 9, 1), 2, 20.0)],
                               "src string, dst string, run_date date, txn_id long, amount_paid double")
    b1 = spark.createDataFrame([("a", "b", dt.date(2022, 9, 1), 1, 11.0)], b0.schema)
    graph.upsert_edges(b0, 0, root)
    graph.upsert_edges(b1, 1, root)
    graph.upsert_edges(b1, 1, root)      # retried batch
    got = {r.txn_id: (r.amount_paid, r.batch_id) for r in graph.read_latest_edges(spark, root).collect()}
    assert got == {1: (11.0, 1), 2: (20.0, 0)}


def test_replace_day_and_prefix_delete(spark):
    e = _edges(spark, [("a", "b", 1, 0), ("a", "b", 2, 1), ("b", "c", 3, 40)])
    new = _edges(spark, [("x", "y", 9, 1)])
    out = graph.replace_day(e, new, "2022-09-02")
    assert sorted((r.src, r.dst) for r in out.collect()) == [("a", "b"), ("b", "c"), ("x", "y")]
    kept = graph.delete_by_prefix(e, "2022-09")
    assert [r.run_date for r in kept.collect()] == [dt.date(2022, 10, 11)]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 30), st.integers(-5, 5)), min_size=1,
                max_size=50), st.integers(1, 4))
def test_prefix_sums_equal_window(spark, rows, parts):
    from trailguard.operators.numbering import prefix_sums
    df = spark.createDataFrame([(g, v, x, i) for i, (g, v, x) in enumerate(rows)],
                               "g int, v int, x int, i int")
    got = prefix_sums(df, {"s": F.col("x")}, by=["g"], order=["v", "i"], partitions=parts)
    w = Window.partitionBy("g").orderBy("v", "i").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("s", F.sum("x").over(w))
    assert sorted(got.select("i", "s").collect()) == sorted(want.select("i", "s").collect())
