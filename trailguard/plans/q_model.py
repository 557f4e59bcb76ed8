"""Model and rule queries: feature vector, rules, scaler, isolation forest, persistence."""

from __future__ import annotations

from pyspark.sql import functions as F

from trailguard.functions.rules import RuleThresholds, evaluate_rules
from trailguard.operators import cycles, features, model
from trailguard.operators.numbering import partitions_for
from trailguard.plans import oracle_sql as O
from trailguard.plans.catalog import register
from trailguard.session import scratch_path
from trailguard.sources.feature_table import read_bucketed, write_bucketed
from trailguard.sources.ledger import memo_path, prepared_ledger

# Thresholds for this data (FIXTURES F7); the defaults (10 for smurfing and count) are hit by
# unit fixtures only.
DATA_RULES = RuleThresholds(smurfing=1e-4, target_growth=2, tx_count_delta=1, amount_spike=5)


def _rolling(spark, sf_dir):
    """The rolling features from their table, written once per session."""
    def build(root):
        edges = features.edges_of(prepared_ledger(spark, sf_dir))
        # an edge is in as many windows as they have days, so there are no more rows than that
        write_bucketed(features.rolling_sides(edges), root, ["account_id"], ["account_id", "feature_date"],
                       partitions_for(spark, edges.count() * features.WINDOW_DAYS), features.finish_sides)
    return read_bucketed(spark, memo_path(spark, sf_dir, "feature-table", build))


def _rolling_full(spark, sf_dir):
    e = features.edges_of(prepared_ledger(spark, sf_dir))
    return features.with_round_trips(_rolling(spark, sf_dir), cycles.round_trips(e))


@register("feature_table", O.with_ledger("SELECT * FROM rolling", O.HISTORY, O.TODAY, O.FEATURES))
def feature_table(spark, sf_dir):
    """Every row of the written table, read back."""
    return _rolling(spark, sf_dir)


@register("account_profile", O.with_ledger("""
SELECT account_id, count(*) AS days, min(feature_date) AS first_day, max(feature_date) AS last_day,
       max(today_tx) AS most_tx, max(today_targets) AS most_targets
FROM rolling GROUP BY 1""", O.HISTORY, O.TODAY, O.FEATURES))
def account_profile(spark, sf_dir):
    """The feature table per account, aggregated in its buckets without a shuffle."""
    return _rolling(spark, sf_dir).groupBy("account_id").agg(
        F.count(F.lit(1)).alias("days"), F.min("feature_date").alias("first_day"),
        F.max("feature_date").alias("last_day"), F.max("today_tx").alias("most_tx"),
        F.max("today_targets").alias("most_targets"))


def model_path(spark, sf_dir) -> str:
    """The forest trained on the rolling features, fitted and saved once per session."""
    def build(path):
        model.save_model(model.fit_forest(_rolling(spark, sf_dir)), path)
    return memo_path(spark, sf_dir, "iforest", build)


def trained_model(spark, sf_dir) -> model.Forest:
    return model.load_model(spark, model_path(spark, sf_dir))


@register("model_features", O.with_ledger(
    "SELECT account_id, feature_date, "
    + ", ".join(f"CAST(coalesce({c}, 0) AS DOUBLE) AS {c}" for c in model.MODEL_FEATURES)
    + " FROM rolling", O.HISTORY, O.TODAY, O.FEATURES))
def model_features(spark, sf_dir):
    return model.model_features(_rolling(spark, sf_dir))


FULL = """full_feats AS (
SELECT r.account_id, tx_count_delta, avg_amount_spike, target_growth, smurfing_score,
       CAST(coalesce(t.round_trip_count, 0) AS BIGINT) AS round_trip_combined,
       coalesce(t.avg_round_trip_length, 0.0) AS avg_round_trip_len, r.feature_date
FROM rolling r LEFT JOIN trips t
  ON t.account_id = r.account_id AND strftime(t.anchor_date, '%Y-%m-%d') = r.feature_date)"""

_R = DATA_RULES
RULES_SQL = f"""SELECT account_id, feature_date,
  (smurfing_score > {_R.smurfing} OR target_growth > {_R.target_growth}
   OR tx_count_delta > {_R.tx_count_delta}
   OR (round_trip_combined > 0 AND avg_round_trip_len >= {_R.round_trip_len})
   OR avg_amount_spike > {_R.amount_spike}) AS rule_hit,
  concat_ws(', ',
    CASE WHEN smurfing_score > {_R.smurfing} THEN 'Smurfing' END,
    CASE WHEN target_growth > {_R.target_growth} THEN 'New Targets Spike' END,
    CASE WHEN tx_count_delta > {_R.tx_count_delta} THEN 'Tx Count Burst' END,
    CASE WHEN round_trip_combined > 0 AND avg_round_trip_len >= {_R.round_trip_len}
         THEN 'Round-trip' END,
    CASE WHEN avg_amount_spike > {_R.amount_spike} THEN 'Avg Amount Spike' END) AS rule_reason
FROM full_feats"""


@register("rule_eval", O.with_ledger(RULES_SQL, O.HISTORY, O.TODAY, O.FEATURES, O.TRAILS, FULL))
def rule_eval(spark, sf_dir):
    """J1 on every (account, day) feature row, round trips included."""
    return evaluate_rules(_rolling_full(spark, sf_dir), DATA_RULES).select(
        "account_id", "feature_date", "rule_hit", "rule_reason")


def _limb_mean(x: str) -> str:
    """SQL twin of ``model.exact_means`` for one expression: integer sums per limb, highest first."""
    def size(bits):
        return f"CAST({2.0 ** bits!r} AS DOUBLE)"

    at = [f"round_even(({x}) * {size(-model.LIMB_BITS * k)}, 0)" for k in model.LIMBS]
    limbs = [at[0], *(f"{low} - {high} * {size(model.LIMB_BITS)}" for high, low in zip(at, at[1:]))]
    terms = [f"CAST(CAST(sum(CAST({c} AS HUGEINT)) AS VARCHAR) AS DOUBLE) * {size(model.LIMB_BITS * k)}"
             for k, c in zip(model.LIMBS, limbs)]
    return f"({' + '.join(terms)}) / count(*)"


_F = list(model.MODEL_FEATURES)
SCALER = (f"feat AS (SELECT {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in _F)}, account_id, feature_date FROM rolling)",
          f"means AS (SELECT {', '.join(f'{_limb_mean(c)} AS mean_{c}' for c in _F)} FROM feat)",
          "far AS (SELECT " + ", ".join(f"({c} - mean_{c}) * ({c} - mean_{c}) AS {c}" for c in _F) + " FROM feat, means)",
          f"stds AS (SELECT {', '.join(f'sqrt({_limb_mean(c)}) AS std_{c}' for c in _F)} FROM far)")


@register("scaler_fit", O.with_ledger("SELECT * FROM means, stds", O.HISTORY, O.TODAY, O.FEATURES, *SCALER))
def scaler_fit(spark, sf_dir):
    """Means and population standard deviations, from order-independent sums."""
    return model.fit_scaler(model.model_features(_rolling(spark, sf_dir)))


@register("scaler_transform", O.with_ledger(
    "SELECT account_id, feature_date, " + ", ".join(
        f"({c} - mean_{c}) / CASE WHEN std_{c} = 0 THEN 1 ELSE std_{c} END AS {c}" for c in _F) + " FROM feat, means, stds",
    O.HISTORY, O.TODAY, O.FEATURES, *SCALER))
def scaler_transform(spark, sf_dir):
    """Every feature row scaled."""
    f = model.model_features(_rolling(spark, sf_dir))
    return model.apply_scaler(f, model.fit_scaler(f))


@register("iforest_trees")
def iforest_trees(spark, sf_dir):
    """A fresh fit; the node table of 100 trees."""
    return model.fit_forest(_rolling(spark, sf_dir)).trees


@register("iforest_score")
def iforest_score(spark, sf_dir):
    """Decision score and anomaly flag for every feature row."""
    return model.score_forest(_rolling(spark, sf_dir), trained_model(spark, sf_dir))


@register("anomaly_threshold")
def anomaly_threshold(spark, sf_dir):
    """The contamination offset, from the saved model table."""
    return spark.read.parquet(f"{model_path(spark, sf_dir)}/meta").select("offset", "sample_size")


@register("anomalies")
def anomalies(spark, sf_dir):
    """Flagged rows only."""
    s = model.score_forest(_rolling(spark, sf_dir), trained_model(spark, sf_dir))
    return s.where("is_anomaly")


@register("model_roundtrip", O.with_ledger(
    "SELECT account_id, feature_date, true AS same_score FROM rolling", O.HISTORY, O.TODAY, O.FEATURES))
def model_roundtrip(spark, sf_dir):
    """Save, load, score every row with both; equal scores are flagged row by row."""
    m = trained_model(spark, sf_dir)
    path = scratch_path(spark, "model-copy")
    model.save_model(m, path)
    copy = model.load_model(spark, path)
    keys = ("account_id", "feature_date")
    rows = model.model_features(_rolling(spark, sf_dir), m.cols, keep=keys)
    both = model.score_samples(model.score_samples(rows, m).withColumnRenamed("score_samples", "_first"), copy)
    return both.select(*keys, (F.col("_first") - m.offset == F.col("score_samples") - copy.offset)
                       .alias("same_score"))
