"""SQL text of the fixture views and shared CTEs, for the DuckDB oracle.

Every oracle is ``WITH <views> <body>``: the views re-derive the transfer
ledger and the account dimension from the pre-registered driver tables,
exactly as :mod:`ledgerscope.sources.fixtures` does in Spark.
"""

TXN_VIEW = """txn AS (
  SELECT event_id AS transaction_id, ts AS "timestamp", user_id AS sender_account,
    CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS receiver_account,
    CAST(CASE WHEN event_id % 10 = 0 THEN ceil(value * 200 / 1000) * 1000
         ELSE round(value * 200, 2) END AS DOUBLE) AS amount,
    CASE event_type WHEN 'click' THEN 'ach' WHEN 'view' THEN 'wire_transfer'
      WHEN 'purchase' THEN 'cash_deposit' WHEN 'signup' THEN 'cash_withdrawal'
      ELSE 'internal_transfer' END AS transaction_type,
    CASE event_id % 4 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP' ELSE 'CHF' END AS currency,
    CAST(CASE WHEN event_id % 33 = 0 THEN 1 ELSE 0 END AS INTEGER) AS is_suspicious,
    CASE WHEN event_id % 33 <> 0 THEN 'normal' ELSE CASE (event_id // 33) % 4
      WHEN 0 THEN 'structuring' WHEN 1 THEN 'layering' WHEN 2 THEN 'round_tripping'
      ELSE 'rapid_movement' END END AS pattern_type
  FROM events
)"""

ACCT_VIEW = """acct AS (
  SELECT c_custkey AS account_id,
    CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'personal' WHEN 'AUTOMOBILE' THEN 'personal'
      WHEN 'FURNITURE' THEN 'personal' WHEN 'BUILDING' THEN 'business'
      WHEN 'MACHINERY' THEN 'corporate' END AS account_type,
    n_name AS country,
    CASE WHEN c_acctbal < 2000 THEN 'high' WHEN c_acctbal < 5000 THEN 'medium' ELSE 'low' END AS risk_rating,
    c_acctbal AS opening_balance
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
)"""

# Time pieces: micros since epoch, Monday = 0 day of week.
US = 'epoch_us("timestamp")'
DOW = 'CAST(isodow("timestamp") - 1 AS INTEGER)'


def velocity_sql(n: int) -> str:
    lower = n * 86_400_000_000 - 1
    w = (f"OVER (PARTITION BY sender_account ORDER BY {US} "
         f"RANGE BETWEEN {lower} PRECEDING AND CURRENT ROW)")
    return (f"count(amount) {w} AS txn_count_{n}d, "
            f"coalesce(sum(amount) {w}, 0) AS txn_sum_{n}d")


# The full feature frame (W6) as a CTE named ``feat``.
FEAT_VIEW = f"""feat AS (
  SELECT t.*,
    CAST(hour("timestamp") AS INTEGER) AS hour,
    {DOW} AS day_of_week,
    CASE WHEN {DOW} >= 5 THEN 1 ELSE 0 END AS is_weekend,
    CASE WHEN hour("timestamp") < 6 OR hour("timestamp") >= 22 THEN 1 ELSE 0 END AS is_night,
    CAST(month("timestamp") AS INTEGER) AS month,
    coalesce(({US} - lag({US}) OVER (PARTITION BY sender_account ORDER BY {US}, transaction_id)) / 1e6, 0.0)
      AS time_since_last_txn,
    coalesce(s.acct_avg_amount, 0) AS acct_avg_amount,
    coalesce(s.acct_std_amount, 0) AS acct_std_amount,
    coalesce(s.acct_median_amount, 0) AS acct_median_amount,
    coalesce(s.acct_min_amount, 0) AS acct_min_amount,
    coalesce(s.acct_max_amount, 0) AS acct_max_amount,
    coalesce(s.acct_total_txns, 0) AS acct_total_txns,
    CASE WHEN s.acct_std_amount > 0 THEN (amount - s.acct_avg_amount) / s.acct_std_amount ELSE 0.0 END AS amount_zscore,
    CASE WHEN s.acct_avg_amount > 0 THEN amount / s.acct_avg_amount ELSE 0.0 END AS amount_to_avg_ratio,
    CASE WHEN amount % 1000 = 0 THEN 1 ELSE 0 END AS is_round_amount,
    CASE WHEN amount >= 8000 AND amount < 10000 THEN 1 ELSE 0 END AS near_threshold,
    coalesce(r.n_unique_receivers, 0) AS n_unique_receivers,
    coalesce(q.n_unique_senders, 0) AS n_unique_senders,
    coalesce(p.pair_txn_count, 0) AS pair_txn_count,
    CASE WHEN t.sender_account = t.receiver_account THEN 1 ELSE 0 END AS is_self_transfer,
    {velocity_sql(1)}, {velocity_sql(7)}, {velocity_sql(30)}
  FROM txn t
  LEFT JOIN (SELECT sender_account, avg(amount) AS acct_avg_amount,
               stddev_samp(amount) AS acct_std_amount, median(amount) AS acct_median_amount,
               min(amount) AS acct_min_amount, max(amount) AS acct_max_amount,
               count(amount) AS acct_total_txns
             FROM txn GROUP BY sender_account) s USING (sender_account)
  LEFT JOIN (SELECT sender_account, count(DISTINCT receiver_account) AS n_unique_receivers
             FROM txn GROUP BY sender_account) r USING (sender_account)
  LEFT JOIN (SELECT receiver_account, count(DISTINCT sender_account) AS n_unique_senders
             FROM txn GROUP BY receiver_account) q USING (receiver_account)
  LEFT JOIN (SELECT least(sender_account, receiver_account) AS lo,
               greatest(sender_account, receiver_account) AS hi, count(*) AS pair_txn_count
             FROM txn WHERE sender_account IS NOT NULL AND receiver_account IS NOT NULL GROUP BY 1, 2) p
    ON t.sender_account IS NOT NULL AND t.receiver_account IS NOT NULL
   AND p.lo = least(t.sender_account, t.receiver_account)
   AND p.hi = greatest(t.sender_account, t.receiver_account)
), featr AS (
  SELECT *, CASE WHEN time_since_last_txn > 0 AND time_since_last_txn < 300 THEN 1 ELSE 0 END AS is_rapid
  FROM feat
)"""


def with_views(body: str, *views: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(views) + "\n" + body


def _d(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


# Rules + rules-only ensemble on top of the feature frame, as CTE ``scored``.
SCORED_VIEW = f"""ruled AS (
  SELECT *,
    CASE WHEN near_threshold = 1 AND txn_count_1d >= 3 THEN 1.0 ELSE 0.0 END::DOUBLE AS rule_structuring,
    CASE WHEN amount > 50000 AND transaction_type IN ('cash_deposit', 'cash_withdrawal') THEN 1.0 ELSE 0.0 END::DOUBLE AS rule_large_cash,
    CAST(is_rapid AS DOUBLE) AS rule_rapid,
    CASE WHEN is_night = 1 AND amount > 10000 THEN 1.0 ELSE 0.0 END::DOUBLE AS rule_night_activity,
    CASE WHEN is_round_amount = 1 AND amount > 5000 THEN 1.0 ELSE 0.0 END::DOUBLE AS rule_round_amount
  FROM featr
), scored0 AS (
  SELECT *, least(greatest(((((({_d(0.0)} + rule_structuring * {_d(0.3)}) + rule_large_cash * {_d(0.25)})
      + rule_rapid * {_d(0.2)}) + rule_night_activity * {_d(0.15)}) + rule_round_amount * {_d(0.1)}),
      {_d(0.0)}), {_d(1.0)}) AS rule_score
  FROM ruled
), scored AS (
  SELECT *, (rule_score * {_d(0.4)}) / {_d(0.4)} AS ensemble_score,
    CASE WHEN (rule_score * {_d(0.4)}) / {_d(0.4)} >= 0.5 THEN 1 ELSE 0 END AS is_alert
  FROM scored0
)"""


def _z(c: str) -> str:
    return (f"CASE WHEN stddev_pop({c}) OVER () > 0 THEN ({c} - avg({c}) OVER ()) / "
            f"stddev_pop({c}) OVER () ELSE 0.0 END AS {c}")


# Standardised per-sender vectors, as CTE ``acct_vec``.
ACCT_VEC_VIEW = f"""acct_vec0 AS (
  SELECT sender_account, avg(amount) AS f_avg, coalesce(stddev_samp(amount), 0.0) AS f_std,
    CAST(count(amount) AS DOUBLE) AS f_cnt, CAST(count(DISTINCT receiver_account) AS DOUBLE) AS f_rcv
  FROM txn GROUP BY sender_account
), acct_vec AS (
  SELECT sender_account, {_z("f_avg")}, {_z("f_std")}, {_z("f_cnt")}, {_z("f_rcv")} FROM acct_vec0
)"""

VEC_DIST = ("sqrt((a.f_avg - b.f_avg) * (a.f_avg - b.f_avg) + (a.f_std - b.f_std) * (a.f_std - b.f_std)"
            " + (a.f_cnt - b.f_cnt) * (a.f_cnt - b.f_cnt) + (a.f_rcv - b.f_rcv) * (a.f_rcv - b.f_rcv))")
