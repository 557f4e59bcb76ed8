"""Sources, wire decoding, stream/batch parity, model properties, driver contract."""

import datetime as dt
import json

import numpy as np
from pyspark.sql import functions as F

from trailguard.operators import model
from trailguard.sources import files
from trailguard.streaming import state, wire
from trailguard.streaming.sinks import TopicFolder

SF = "/root/testdata/sf0.001"


def test_raw_csv_duplicate_headers_and_bad_timestamp(spark, tmp_path):
    p = tmp_path / "raw.csv"
    p.write_text(
        "Timestamp,From Bank,Account,To Bank,Account,Amount Received,Receiving Currency,"
        "Amount Paid,Payment Currency,Payment Format,Is Laundering\n"
        "2022/09/18 01:18,11,ACCT-7,23,ACCT-9,250.0,Yen,250.0,Yen,Wire,1\n"
        "2022/09/18 06:21,11,ACCT-7,11,ACCT-7,90.5,Yuan,110.25,Yen,Wire,0\n"
        "not a time,1,A,2,B,1.0,Euro,1.0,Euro,ACH,0\n")
    good, bad = files.read_ledger_csv(spark, str(p))
    g = good.orderBy("ts").collect()
    assert len(g) == 2
    assert (g[0]["From Account"], g[0]["To Account"]) == ("ACCT-7", "ACCT-9")
    assert g[1]["From Account"] == g[1]["To Account"]          # self-transfer, currency change
    assert g[0]["ts"] == dt.datetime(2022, 9, 18, 1, 18)
    assert [tuple(r) for r in bad.select("error", "original").collect()] == [
        ("bad timestamp", "not a time,1,A,2,B,1.0,Euro,1.0,Euro,ACH,0")]   # the whole line


def test_decode_cases(spark):
    ok = {"from_bank": 1, "from_acc": "A", "to_bank": 2, "to_acc": "B", "txn_id": 7,
          "amount_received": 1.5, "receiving_currency": "Euro", "amount_paid": 2.5,
          "payment_currency": "Euro", "payment_format": "ACH",
          "ts": "2022-09-18T01:18:00.000Z", "run_date": "2022-09-18"}
    plain_ts = dict(ok, ts="2022-09-18 01:18:00", txn_id=8)
    numeric_text = dict(ok, amount_paid="3.25", txn_id=9)
    missing = {k: v for k, v in ok.items() if k != "to_acc"}
    bad_amount = dict(ok, amount_paid="lots")
    poison = [dict(ok, run_date="not-a-date"), dict(ok, ts="soon"), dict(ok, amount_paid="NaN"),
              dict(ok, amount_received=1e17)]
    msgs = [json.dumps(m) for m in poison] + [json.dumps(ok), json.dumps(plain_ts), json.dumps(numeric_text), "not json {",
            json.dumps(missing), json.dumps(bad_amount)]
    df = spark.createDataFrame([(m,) for m in msgs], "value string")
    good, bad = wire.decode_transactions(df)
    g = {r.txn_id: r for r in good.collect()}
    assert set(g) == {7, 8, 9}
    assert g[7].from_acc == "1_A" and g[7].to_acc == "2_B"
    assert g[7].event_ts == g[8].event_ts                       # both ts spellings parse
    assert g[9].amount_paid == 3.25
    errors = sorted(r.error for r in bad.collect())
    assert errors == ["malformed json"] + ["missing or invalid: " + f for f in (
        "amount_paid", "amount_paid", "amount_received", "run_date", "to_acc", "ts")]


def test_features_of_events_with_equal_ids(spark):
    from trailguard.streaming import pipeline as P
    ev = spark.sql("""SELECT 7L AS txn_id, 1L AS from_bank, a AS from_acc, 'x' AS to_acc, d AS run_date,
                      1L AS today_tx, 2.0D AS today_avg, 1L AS today_targets
                      FROM VALUES ('1_A', '2022-09-01'), ('1_A', '2022-09-02'), ('1_B', '2022-09-01') t(a, d)""")
    cyc = ev.select(P.event_key().alias("txn_id"), F.dayofmonth("run_date").cast("bigint").alias("cycle_count"),
                    F.lit(2.0).alias("avg_cycle_len"))
    snap = spark.createDataFrame([], "account_id string, feature_day_tx_count long, feature_day_avg_amount double, "
                                     "feature_day_unique_targets long, feature_small_tx_count long")
    got = sorted((r.account_id, r.round_trip_combined) for r in P.stream_features(ev, snap, cyc).collect())
    assert got == [("1_A", 1), ("1_A", 2), ("1_B", 1)]


def test_dedupe_drops_redelivery(spark):
    df = spark.createDataFrame([("a", "b", "2022-09-01", 1), ("a", "b", "2022-09-01", 1),
                                ("a", "b", "2022-09-01", 2)],
                               "from_acc string, to_acc string, run_date string, txn_id long")
    assert wire.dedupe_stream(df, ["from_acc", "to_acc", "run_date", "txn_id"]).count() == 2


def test_stream_running_stats_equal_batch_twin(spark, tmp_path):
    """availableNow over split files (with a redelivered file) equals the batch twin."""
    from trailguard.sources.ledger import prepared_ledger
    from trailguard.streaming.replay import replay_encode
    topic = str(tmp_path / "topic")
    sl = prepared_ledger(spark, SF).where("run_date between '1999-03-01' and '1999-03-21'")
    msgs = replay_encode(sl).persist()
    for week in (0, 1, 2, 0):                            # a file a week, the first one twice
        (msgs.where(F.floor(F.datediff(F.to_date("_day"), F.to_date(F.lit("1999-03-01"))) / 7) == week)
         .coalesce(1).select("value").write.mode("append").text(topic))
    good, _ = wire.decode_transactions(wire.file_source(spark, topic, 1))
    out = str(tmp_path / "out")

    def batch(rows, batch_id):
        rows = rows.persist()
        st = state.RunningState(spark, str(tmp_path / "state"), compact_every=2)
        st.maintain(rows, batch_id)
        for _ in range(1 + (batch_id == 1)):             # as after a failure: the second attempt replaces the first
            TopicFolder(out).write(st.advance(rows, batch_id), batch_id)
        rows.unpersist()
    q = (wire.dedupe_stream(good, ["from_acc", "to_acc", "run_date", "txn_id"]).writeStream.foreachBatch(batch)
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination(600)
    assert q.exception() is None
    streamed = {(r.txn_id, r.today_tx, r.today_avg, r.today_targets)
                for r in spark.read.parquet(out).collect()}
    gb, _ = wire.decode_transactions(spark.read.text(topic))
    twin = state.running_stats_batch(gb.dropDuplicates(["from_acc", "to_acc", "run_date", "txn_id"]))
    batch = {(r.txn_id, r.today_tx, r.today_avg, r.today_targets) for r in twin.collect()}
    assert streamed == batch and len(batch) == sl.count()


def _toy_features(spark, n=2000, outliers=10, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 6))
    x[:outliers] += 12.0
    rows = [(f"acc{i}", "2022-09-01", *map(float, x[i])) for i in range(n)]
    return spark.createDataFrame(rows, "account_id string, feature_date string, " +
                                 ", ".join(f"{c} double" for c in model.MODEL_FEATURES))


def test_forest_properties(spark):
    df = _toy_features(spark)
    f1 = model.fit_forest(df.repartition(3))
    f2 = model.fit_forest(df.repartition(7))
    t1 = sorted(tuple(r) for r in f1.trees.collect())
    t2 = sorted(tuple(r) for r in f2.trees.collect())
    assert t1 == t2                                            # independent of partitioning
    scored = model.score_forest(df, f1).toPandas()
    lowest = set(scored.nsmallest(10, "score")["account_id"])
    assert lowest == {f"acc{i}" for i in range(10)}            # planted outliers score lowest
    share = scored["is_anomaly"].mean()
    assert 0.005 <= share <= 0.02                              # about the contamination


def test_percentile_is_exact(spark):
    values = np.random.default_rng(5).normal(size=4001).round(2)         # many ties
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double").repartition(5)
    for q in (0.0, 0.01, 0.5, 0.987, 1.0):
        assert abs(model.percentile(df, "x", q) - np.quantile(values, q)) < 1e-12
    assert np.isnan(model.percentile(df.where("x is null"), "x", 0.01))


def test_every_row_can_enter_a_tree(spark):
    n = 60_000
    df = spark.range(n).select(F.col("id").cast("string").alias("k"))
    s = model.sample_for_trees(df, ["k"], n, n_trees=20, sample=256)
    sizes = {r.tree_id: r["count"] for r in s.groupBy("tree_id").count().collect()}
    assert sizes == {t: 256 for t in range(20)}
    # independent draws: 20 x 256 rows share few documents, as 5,120 draws of 60,000 would
    assert s.select("k").distinct().count() > 4_600


def test_draws_do_not_depend_on_the_number_of_rows(spark):
    df = spark.range(20_000).select(F.col("id").cast("string").alias("k"))
    for n, trees in ((10 ** 6, 300), (10 ** 8, 2000)):
        got = model.sample_for_trees(df, ["k"], n, n_trees=trees).count()
        want = 20_000 * trees * model.draw_chance(n)
        assert abs(got - want) < 6 * want ** 0.5 + 1, (n, got, want)
    # by formula: at any n a tree expects 512 rows, and the chance that a row goes on is no rounded zero
    for n in (10 ** 9, 10 ** 12, 10 ** 15):
        p = model.draw_chance(n)
        assert abs(n * p - 512) < 1e-6
        share = -np.expm1(100 * np.log1p(-p))
        assert share / 2.0 ** -53 > 100 and abs(share * n - 51_200) < 5
    everyone = model.sample_for_trees(df.limit(100), ["k"], 100, n_trees=7, sample=256)
    assert everyone.count() == 700


def test_scaler_matches_numpy(spark):
    df = _toy_features(spark, n=500)
    stats = model.fit_scaler(df).first()
    pdf = df.toPandas()
    for c in model.MODEL_FEATURES:
        assert abs(stats[f"mean_{c}"] - pdf[c].mean()) < 1e-9
        assert abs(stats[f"std_{c}"] - pdf[c].std(ddof=0)) < 1e-9   # population std


def test_means_do_not_depend_on_the_order_of_rows(spark):
    from fractions import Fraction
    rng = np.random.default_rng(8)
    x = np.concatenate((rng.normal(size=500) * 10.0 ** rng.integers(-9, 16, 500), [1e16, -1e16, 3.0, 0.1, -0.0]))
    odd = [float("nan"), float("inf"), None]
    got = set()
    for seed, parts in ((1, 1), (2, 7)):
        values = [float(v) for v in np.random.default_rng(seed).permutation(x)] + odd
        df = spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)
        got.add(model.exact_means(df, {"x": F.col("x")}).first()[0])
    exact = float(sum(map(Fraction, x.tolist())) / len(x))
    assert len(got) == 1 and abs(got.pop() - exact) <= 1e-15 * abs(exact) + 2.0 ** -50
    assert model.exact_means(df.limit(0), {"x": F.col("x")}).first()[0] is None


def test_model_save_load(spark, tmp_path):
    df = _toy_features(spark, n=600)
    f = model.fit_forest(df)
    model.save_model(f, str(tmp_path / "m"))
    g = model.load_model(spark, str(tmp_path / "m"))
    a = model.score_forest(df, f).orderBy("account_id").select("score").collect()
    b = model.score_forest(df, g).orderBy("account_id").select("score").collect()
    assert a == b


def test_driver_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert [f.name for f in df.schema.fields][:2] == ["account_id", "feature_tx_count"]
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 60
    assert all(callable(v) for v in q.values())


def test_ledger_view_counts(spark):
    from trailguard.sources.ledger import prepared_ledger
    led = prepared_ledger(spark, SF)
    assert led.count() == 6000
    assert led.select("txn_id").distinct().count() == 6000
    assert led.agg(F.min("txn_id"), F.max("txn_id")).first() == (1, 6000)
