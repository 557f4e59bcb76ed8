"""DuckDB oracle SQL for the registered queries (tables pre-registered as views)."""

from __future__ import annotations

# The ledger view of FIXTURES F7, numbered by row_number over the full order.
LEDGER_CTE = """
src AS (
  SELECT l_orderkey, l_linenumber, l_partkey,
         CAST(f.s_nationkey AS BIGINT) AS from_bank, CAST(f.s_suppkey AS VARCHAR) AS from_account,
         CAST(t.s_nationkey AS BIGINT) AS to_bank, CAST(t.s_suppkey AS VARCHAR) AS to_account,
         l_extendedprice AS amount_paid, l_extendedprice * (1 - l_discount) AS amount_received,
         CASE l_linenumber % 4 WHEN 0 THEN 'Euro' WHEN 1 THEN 'US Dollar'
                               WHEN 2 THEN 'Yen' ELSE 'Yuan' END AS payment_currency,
         CASE l_quantity % 3 WHEN 0 THEN 'ACH' WHEN 1 THEN 'Wire' ELSE 'Cheque' END AS payment_format,
         CASE WHEN l_orderkey % 5000 = 7 THEN 1 ELSE 0 END AS is_laundering,
         l_shipdate + to_minutes(CAST((l_orderkey * 7 + l_linenumber * 13) % 1440 AS BIGINT)) AS ts,
         CAST(l_shipdate AS DATE) AS run_date
  FROM lineitem
  JOIN supplier f ON f.s_suppkey = l_suppkey
  JOIN supplier t ON t.s_suppkey = l_partkey % (SELECT count(*) FROM supplier)),
ledger AS (
  SELECT row_number() OVER (ORDER BY ts, from_bank, from_account, to_bank, to_account,
                                     l_orderkey, l_linenumber, l_partkey) AS txn_id,
         concat(from_bank, '_', from_account) AS from_acc,
         concat(to_bank, '_', to_account) AS to_acc,
         l_orderkey, l_linenumber, l_partkey, from_bank, from_account, to_bank, to_account,
         amount_paid, amount_received, payment_currency, payment_currency AS receiving_currency,
         payment_format, is_laundering, ts, run_date
  FROM src),
edges AS (
  SELECT from_acc AS src, to_acc AS dst, txn_id, amount_paid, run_date FROM ledger),
anchors AS (SELECT DISTINCT run_date AS anchor FROM ledger)"""


def with_ledger(body: str, *ctes: str) -> str:
    extra = "".join(f",\n{c}" for c in ctes)
    return f"WITH RECURSIVE {LEDGER_CTE}{extra}\n{body}"


def money_avg(col: str) -> str:
    # the exact sum becomes a double by way of its digits, which rounds once
    return f"CAST(CAST(sum(CAST({col} AS DECIMAL(28,10))) AS VARCHAR) AS DOUBLE) / count({col})"


HISTORY = f"""hist AS (
  SELECT e.src AS account_id, a.anchor, count(*) AS feature_tx_count,
         {money_avg('e.amount_paid')} AS feature_avg_amount,
         count(DISTINCT e.dst) AS feature_unique_targets,
         count(*) FILTER (WHERE e.amount_paid < 10000) AS feature_small_tx
  FROM edges e JOIN anchors a ON e.run_date > a.anchor - 5 AND e.run_date < a.anchor
  GROUP BY 1, 2)"""

TODAY = f"""today AS (
  SELECT src AS account_id, run_date AS anchor, count(*) AS today_tx,
         {money_avg('amount_paid')} AS today_avg,
         count(DISTINCT dst) AS today_targets
  FROM edges GROUP BY 1, 2)"""

FEATURES = """feats AS (
  SELECT account_id, anchor,
         coalesce(feature_tx_count, 0) AS feature_tx_count,
         coalesce(feature_avg_amount, 0.0) AS feature_avg_amount,
         coalesce(feature_unique_targets, 0) AS feature_unique_targets,
         coalesce(feature_small_tx, 0) AS feature_small_tx,
         coalesce(today_tx, 0) AS today_tx,
         coalesce(today_avg, 0.0) AS today_avg,
         coalesce(today_targets, 0) AS today_targets
  FROM hist FULL OUTER JOIN today USING (account_id, anchor)),
rolling AS (
  SELECT account_id, feature_tx_count, feature_avg_amount, feature_unique_targets,
         feature_small_tx, today_tx, today_avg, today_targets,
         today_tx - feature_tx_count AS tx_count_delta,
         (today_avg - feature_avg_amount) / (feature_avg_amount + 1e-6) AS avg_amount_spike,
         today_targets / (feature_unique_targets + 1e-6) AS target_growth,
         today_tx / (today_avg + 1e-6) AS smurfing_score,
         0 AS round_trip_combined, 0 AS avg_round_trip_len,
         strftime(anchor, '%Y-%m-%d') AS feature_date
  FROM feats)"""

# Closed trails (edge-distinct) of length 2 and 3 in the window (anchor-5, anchor], by brute
# force: every trail is listed once per starting edge, then spread over the anchors that see it.
TRAILS = """win AS (
  SELECT a.anchor, e.* FROM edges e JOIN anchors a
    ON e.run_date > a.anchor - 5 AND e.run_date <= a.anchor),
trails AS (
  SELECT e1.anchor, e1.src AS account_id, 2 AS len
  FROM win e1 JOIN win e2 ON e2.anchor = e1.anchor AND e2.src = e1.dst AND e2.dst = e1.src
   AND e2.txn_id <> e1.txn_id
  UNION ALL
  SELECT e1.anchor, e1.src, 3
  FROM win e1 JOIN win e2 ON e2.anchor = e1.anchor AND e2.src = e1.dst
  JOIN win e3 ON e3.anchor = e1.anchor AND e3.src = e2.dst AND e3.dst = e1.src
  WHERE e1.txn_id <> e2.txn_id AND e2.txn_id <> e3.txn_id AND e1.txn_id <> e3.txn_id),
trips AS (
  SELECT account_id, anchor AS anchor_date, count(*) AS round_trip_count,
         avg(len) AS avg_round_trip_length
  FROM trails GROUP BY 1, 2)"""

# Simple cycles of any length on the windowed graph with parallel edges collapsed: every path that stays
# within two edges of its first account, and the paths that can be closed.
CYCLES = """pwin AS (
  SELECT DISTINCT a.anchor, e.src, e.dst FROM edges e JOIN anchors a
    ON e.run_date > a.anchor - 5 AND e.run_date <= a.anchor),
outn AS (
  SELECT a.anchor, e.src, count(*) AS out_n FROM edges e JOIN anchors a
    ON e.run_date > a.anchor - 5 AND e.run_date <= a.anchor GROUP BY 1, 2),
reach AS (
  SELECT anchor, src, dst AS node FROM pwin
  UNION SELECT p.anchor, p.src, q.dst FROM pwin p JOIN pwin q ON q.anchor = p.anchor AND q.src = p.dst),
walk AS (
  SELECT anchor, src AS s, dst AS node, [dst] AS path FROM pwin WHERE src <> dst
  UNION ALL
  SELECT w.anchor, w.s, q.dst, list_append(w.path, q.dst) FROM walk w
    JOIN pwin q ON q.anchor = w.anchor AND q.src = w.node
    JOIN reach k ON k.anchor = w.anchor AND k.src = w.s AND k.node = q.dst
    WHERE q.dst <> w.s AND NOT list_contains(w.path, q.dst)),
cyc AS (
  SELECT p.anchor, p.src AS account_id, 1 AS len FROM pwin p
    JOIN outn o ON o.anchor = p.anchor AND o.src = p.src
    WHERE p.src = p.dst AND o.out_n >= 2
  UNION ALL
  SELECT w.anchor, w.s, len(w.path) + 1 FROM walk w
    JOIN pwin p ON p.anchor = w.anchor AND p.src = w.node AND p.dst = w.s),
active AS (
  SELECT DISTINCT e.src AS account_id, a.anchor AS anchor_date FROM edges e JOIN anchors a
    ON e.run_date > a.anchor - 5 AND e.run_date <= a.anchor),
cycles AS (
  SELECT s.account_id, s.anchor_date, count(c.len) AS cycle_count,
         coalesce(avg(c.len), 0.0) AS avg_cycle_len
  FROM active s LEFT JOIN cyc c ON c.account_id = s.account_id AND c.anchor = s.anchor_date
  GROUP BY 1, 2)"""


LEDGER_COLS = ["txn_id", "from_acc", "to_acc", "l_orderkey", "l_linenumber", "l_partkey",
               "from_bank", "from_account", "to_bank", "to_account", "amount_paid",
               "amount_received", "payment_currency", "receiving_currency", "payment_format",
               "is_laundering", "ts", "run_date"]


def cols(names=None, alias: str = "") -> str:
    """Select list with the temporal columns rendered as text."""
    p = f"{alias}." if alias else ""
    out = []
    for c in names or LEDGER_COLS:
        if c == "ts":
            out.append(f"strftime({p}ts, '%Y-%m-%d %H:%M:%S') AS ts")
        elif c == "run_date":
            out.append(f"strftime({p}run_date, '%Y-%m-%d') AS run_date")
        else:
            out.append(f"{p}{c}")
    return ", ".join(out)


SUSPECTS = """sus AS (
  SELECT from_bank AS bank, from_account AS account FROM ledger WHERE is_laundering = 1
  UNION
  SELECT to_bank, to_account FROM ledger WHERE is_laundering = 1)"""

# Reference formulation: union of sender and receiver matches, one row per txn_id, sender first.
RELATED = """matches AS (
  SELECT l.*, s.bank, s.account, 0 AS side FROM ledger l
    JOIN sus s ON l.from_bank = s.bank AND l.from_account = s.account
  UNION ALL
  SELECT l.*, s.bank, s.account, 1 AS side FROM ledger l
    JOIN sus s ON l.to_bank = s.bank AND l.to_account = s.account),
related AS (
  SELECT * EXCLUDE (rn, side) FROM (
    SELECT *, row_number() OVER (PARTITION BY txn_id ORDER BY side) AS rn FROM matches)
  WHERE rn = 1)"""


def trails_for(anchor_sql: str) -> str:
    """TRAILS restricted to the anchors of a sub-select, e.g. ``SELECT DATE '1999-03-10' AS anchor``."""
    return TRAILS.replace("JOIN anchors a", f"JOIN ({anchor_sql}) a")


def snapshot_sql(name: str, day: str) -> str:
    """CTEs ``{name}`` = account snapshot (M8) for one run_date."""
    a = f"SELECT DATE '{day}' AS anchor"
    t = trails_for(a).replace("win AS", f"{name}_win AS").replace("trails AS", f"{name}_trails AS") \
        .replace("trips AS", f"{name}_trips AS").replace("FROM win", f"FROM {name}_win") \
        .replace("JOIN win", f"JOIN {name}_win").replace("FROM trails", f"FROM {name}_trails")
    return t + f""",
{name}_stats AS (
  SELECT src AS account_id, count(*) AS feature_day_tx_count,
         {money_avg('amount_paid')} AS feature_day_avg_amount,
         count(DISTINCT dst) AS feature_day_unique_targets
  FROM edges WHERE run_date > DATE '{day}' - 5 AND run_date <= DATE '{day}' GROUP BY 1),
{name}_small AS (
  SELECT src AS account_id, count(*) AS feature_small_tx_count
  FROM edges WHERE run_date > DATE '{day}' - 5 AND run_date <= DATE '{day}'
   AND amount_paid < 10000 GROUP BY 1),
{name} AS (
  SELECT account_id, feature_day_tx_count, feature_day_avg_amount, feature_day_unique_targets,
         round_trip_count AS feature_round_trip_count,
         avg_round_trip_length AS feature_round_trip_avg_len, feature_small_tx_count
  FROM {name}_stats FULL OUTER JOIN {name}_trips USING (account_id)
       FULL OUTER JOIN {name}_small USING (account_id))"""
