"""Registered queries: dashboard aggregates, alert lists, network extracts
(PF3, PF9, PF10, A13-A22, A25-A28, J5, S1-S3, G1-G3, U1-U2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerscope.functions.exprs import DAY_NAMES
from ledgerscope.operators import graph as GR
from ledgerscope.operators import report as RP
from ledgerscope.plans.oracle_sql import ACCT_VIEW, FEAT_VIEW, SCORED_VIEW, TXN_VIEW, with_views
from ledgerscope.plans.q_scoring import scored_table
from ledgerscope.plans.registry import memo_plan, register, sql_cols, views

DISP_VIEW = """disp AS (
  SELECT * REPLACE (CASE WHEN ensemble_score >= 0.5 THEN 1 ELSE 0 END AS is_alert)
  FROM scored
)"""
RISK_VIEW = """risk AS (
  SELECT r.*, a.account_type, a.country, a.risk_rating, a.opening_balance
  FROM (SELECT sender_account, avg(ensemble_score) AS avg_score, max(ensemble_score) AS max_score,
          count(*) AS txn_count, sum(amount) AS total_amount, sum(is_alert) AS flagged_count
        FROM disp GROUP BY sender_account) r
  LEFT JOIN acct a ON r.sender_account = a.account_id
)"""
FLAGGED_VIEW = """flagged AS (SELECT * FROM disp WHERE is_alert = 1)"""
TOP_VIEW = """top AS (
  SELECT * FROM disp WHERE is_alert = 1 ORDER BY ensemble_score DESC, transaction_id ASC LIMIT 200
)"""


def _sql(spec: str, body: str, *more: str) -> str:
    return with_views(f"SELECT {sql_cols(spec)} {body}", TXN_VIEW, FEAT_VIEW, SCORED_VIEW,
                      DISP_VIEW, *more)


def display(spark, sf, **kw):
    if kw:
        return RP.filter_view(scored_table(spark, sf), **kw)
    return memo_plan(spark, sf, "display", lambda: RP.filter_view(scored_table(spark, sf)))


@register("pf3_dashboard_filter", _sql(
    "transaction_id:i, amount:d, is_alert:i=CASE WHEN ensemble_score >= 0.3 THEN 1 ELSE 0 END",
    "FROM scored WHERE CAST(\"timestamp\" AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' "
    "AND amount >= 100 AND amount <= 20000 AND pattern_type = 'normal'"))
def pf3(spark, sf):
    """PF3: inclusive date / amount ranges, pattern equality, threshold 0.3."""
    d = RP.filter_view(scored_table(spark, sf), start="2024-01-05", end="2024-01-20",
                       amount_min=100, amount_max=20000, pattern="normal", threshold=0.3)
    return d.select("transaction_id", "amount", "is_alert")


@register("pf9_filter_domains", _sql(
    "min_date:t=CAST(min(\"timestamp\") AS DATE), max_date:t=CAST(max(\"timestamp\") AS DATE), "
    "min_amount:d=min(amount), max_amount:d=max(amount)", "FROM txn"))
def pf9(spark, sf):
    """PF9: slider domains."""
    txn, _ = views(spark, sf)
    return RP.filter_domains(txn)


@register("pf9b_pattern_options", _sql("pattern_type:s", "FROM (SELECT DISTINCT pattern_type FROM txn)"))
def pf9b(spark, sf):
    """PF9: sorted distinct patterns."""
    txn, _ = views(spark, sf)
    return RP.pattern_options(txn)


_A11 = ("(SELECT pattern_type, count(*) AS total, sum(CASE WHEN ensemble_score >= 0.5 THEN 1 ELSE 0 END) AS detected "
        "FROM scored WHERE is_suspicious = 1 GROUP BY pattern_type)")


@register("pf10_detection_band", _sql(
    "pattern_type:s, detection_rate:d=round_even(detected / total, 3), "
    "band:s=CASE WHEN round_even(detected / total, 3) < 0.5 THEN 'low' "
    "WHEN round_even(detected / total, 3) < 0.8 THEN 'medium' ELSE 'high' END", f"FROM {_A11}"))
def pf10(spark, sf):
    """PF10: detection-rate bands."""
    from ledgerscope.operators.evaluate import evaluate_by_pattern
    r = evaluate_by_pattern(scored_table(spark, sf))
    return RP.detection_band(r).select("pattern_type", "detection_rate", "band")


@register("a13_kpis", _sql(
    "n_total:i=count(*), n_flagged:i=coalesce(sum(is_alert), 0), "
    "alert_rate:d=CASE WHEN count(*) > 0 THEN coalesce(sum(is_alert), 0) / count(*) ELSE 0.0 END, "
    "n_patterns:i=count(DISTINCT CASE WHEN is_suspicious = 1 AND is_alert = 1 THEN pattern_type END), "
    "total_value:d=coalesce(sum(amount), 0), avg_score:d=avg(ensemble_score)", "FROM disp"))
def a13(spark, sf):
    """KPI row."""
    return RP.kpis(display(spark, sf))


@register("a14_daily_alerts", _sql(
    "date:t=CAST(\"timestamp\" AS DATE), n_alerts:i=sum(is_alert), n_txns:i=count(amount)",
    "FROM disp GROUP BY 1"))
def a14(spark, sf):
    """Daily alerts and transfers."""
    return RP.daily_alerts(display(spark, sf))


_WEEK = "CAST(\"timestamp\" AS DATE) + CAST((7 - isodow(\"timestamp\")) % 7 AS INTEGER)"


@register("a15_weekly_volume", _sql(
    "week_end:t=s.week_end, total:i=coalesce(a.total, 0), flagged:i=coalesce(a.flagged, 0), "
    "volume:d=coalesce(a.volume, 0.0)",
    f"FROM (SELECT CAST(unnest(generate_series(CAST(min(week_end) AS TIMESTAMP), CAST(max(week_end) AS TIMESTAMP), "
    f"INTERVAL 7 DAY)) AS DATE) AS week_end FROM (SELECT {_WEEK} AS week_end FROM disp)) s "
    f"LEFT JOIN (SELECT {_WEEK} AS week_end, count(amount) AS total, sum(is_alert) AS flagged, "
    f"sum(amount) AS volume FROM disp GROUP BY 1) a ON a.week_end = s.week_end"))
def a15(spark, sf):
    """Weekly volume with empty weeks as zero."""
    return RP.weekly_volume(display(spark, sf))


_DAYS = "[" + ", ".join(f"'{d}'" for d in DAY_NAMES) + "]"
_HOURS_SQL = ", ".join(f"h{h:02d}:i=coalesce(c.h{h:02d}, 0)" for h in range(24))
_HOURS_CNT = ", ".join(f"count(*) FILTER (WHERE hour(\"timestamp\") = {h}) AS h{h:02d}" for h in range(24))


@register("a16_suspicious_heatmap", _sql(
    f"day_of_week:i=d.range, day_name:s={_DAYS}[d.range + 1], {_HOURS_SQL}",
    f"FROM range(7) d LEFT JOIN (SELECT CAST(isodow(\"timestamp\") - 1 AS BIGINT) AS dow, {_HOURS_CNT} "
    "FROM scored WHERE is_suspicious = 1 GROUP BY 1) c ON c.dow = d.range"))
def a16(spark, sf):
    """Suspicious transfers by weekday x hour."""
    return RP.suspicious_heatmap(scored_table(spark, sf))


_HOURS_AVG = ", ".join(f"h{h:02d}:d=coalesce(avg(ensemble_score) FILTER (WHERE hour(\"timestamp\") = {h}), 0.0)"
                       for h in range(24))


@register("a17_pattern_hour_scores", _sql(
    f"pattern_type:s, {_HOURS_AVG}", "FROM disp WHERE is_suspicious = 1 GROUP BY pattern_type"))
def a17(spark, sf):
    """Mean score by pattern x hour."""
    return RP.pattern_hour_scores(display(spark, sf))


_RISK_SPEC = ("sender_account:i, avg_score:d, max_score:d, txn_count:i, total_amount:d, flagged_count:i, "
              "account_type:s, country:s, risk_rating:s, opening_balance:d")


def _risk(spark, sf):
    _, acct = views(spark, sf)
    return RP.account_risk_with_accounts(display(spark, sf), acct)


@register("a19_account_risk", _sql(
    "sender_account:i, avg_score:d, max_score:d, txn_count:i, total_amount:d, flagged_count:i",
    "FROM (SELECT sender_account, avg(ensemble_score) AS avg_score, max(ensemble_score) AS max_score, "
    "count(*) AS txn_count, sum(amount) AS total_amount, sum(is_alert) AS flagged_count FROM disp GROUP BY 1)"))
def a19(spark, sf):
    """Per-account risk roll-up."""
    return RP.account_risk(display(spark, sf))


@register("j5_account_risk_join", _sql(_RISK_SPEC, "FROM risk", ACCT_VIEW, RISK_VIEW))
def j5(spark, sf):
    """Account risk joined to the account dimension."""
    return _risk(spark, sf)


@register("s2_top_risky_accounts", _sql(
    _RISK_SPEC, "FROM (SELECT * FROM risk ORDER BY avg_score DESC, sender_account ASC LIMIT 30)",
    ACCT_VIEW, RISK_VIEW))
def s2(spark, sf):
    """Top 30 accounts by mean score."""
    return RP.top_risky_accounts(_risk(spark, sf), 30)


@register("a18_country_type_risk", _sql(
    "country:s, account_type:s, avg_score:d=avg(avg_score)",
    "FROM risk WHERE country IS NOT NULL AND account_type IS NOT NULL GROUP BY country, account_type",
    ACCT_VIEW, RISK_VIEW))
def a18(spark, sf):
    """Mean account score by country x account type."""
    return RP.country_type_risk(_risk(spark, sf))


@register("a20_country_risk", _sql(
    "country:s, avg_score:d, n_accounts:i, total_flagged:i, "
    "above_median:i=CASE WHEN avg_score > median(avg_score) OVER () THEN 1 ELSE 0 END",
    "FROM (SELECT country, avg(avg_score) AS avg_score, count(DISTINCT sender_account) AS n_accounts, "
    "sum(flagged_count) AS total_flagged FROM risk WHERE country IS NOT NULL GROUP BY country)",
    ACCT_VIEW, RISK_VIEW))
def a20(spark, sf):
    """A20 + A21: country risk with the above-median marking."""
    return RP.country_risk(_risk(spark, sf))


@register("a22_pattern_distribution", _sql(
    "pattern_type:s, count:i=count(*)", "FROM disp WHERE is_suspicious = 1 GROUP BY pattern_type"))
def a22(spark, sf):
    """Suspicious transfers per pattern."""
    return RP.pattern_distribution(display(spark, sf))


@register("a25_score_histogram", _sql(
    "bin:i, n_rows:i, bin_low:d=(bin - 1) / 80.0, bin_high:d=bin / 80.0",
    "FROM (SELECT least(CAST(floor(ensemble_score * 80) AS BIGINT) + 1, 80) AS bin, count(*) AS n_rows "
    "FROM disp WHERE ensemble_score IS NOT NULL GROUP BY 1)"))
def a25(spark, sf):
    """80-bin ensemble score histogram."""
    return RP.score_histogram(display(spark, sf), bins=80)


@register("a25b_rule_histogram", _sql(
    "bin:i, n_rows:i, bin_low:d=(bin - 1) / 50.0, bin_high:d=bin / 50.0",
    "FROM (SELECT least(CAST(floor(rule_score * 50) AS BIGINT) + 1, 50) AS bin, count(*) AS n_rows "
    "FROM disp WHERE rule_score IS NOT NULL GROUP BY 1)"))
def a25b(spark, sf):
    """50-bin rule score histogram."""
    return RP.score_histogram(display(spark, sf), score="rule_score", bins=50)


_QS = ", ".join(f"q{i}:d=quantile_cont(%s, {p})" for i, p in enumerate(RP.QUARTILES))


@register("a26_score_quartiles", _sql(
    "is_suspicious:i, " + _QS % tuple(["ensemble_score"] * 5), "FROM disp GROUP BY is_suspicious"))
def a26(spark, sf):
    """Exact score quartiles per truth label."""
    return RP.score_quartiles(display(spark, sf))


@register("a27_amount_by_pattern", _sql(
    "pattern_type:s, " + _QS % tuple(["amount"] * 5), "FROM disp WHERE is_suspicious = 1 GROUP BY pattern_type"))
def a27(spark, sf):
    """Exact amount quartiles per pattern (suspicious rows)."""
    return RP.amount_by_pattern(display(spark, sf))


@register("a27b_amount_log_histogram", _sql(
    "pattern_type:s, log_bin:i, n_rows:i",
    "FROM (SELECT pattern_type, CAST(floor(log10(amount) * 10) AS BIGINT) AS log_bin, count(*) AS n_rows "
    "FROM disp WHERE is_suspicious = 1 AND amount > 0 GROUP BY 1, 2)"))
def a27b(spark, sf):
    """Log-bucket amount density per pattern."""
    return RP.amount_log_histogram(display(spark, sf))


@register("a28_flagged_summary", _sql(
    "n_flagged:i=count(*), avg_flagged_amount:d=coalesce(avg(amount), 0.0), "
    "max_score:d=coalesce(max(ensemble_score), 0.0), true_positives:i=coalesce(sum(is_suspicious), 0)",
    "FROM disp WHERE is_alert = 1"))
def a28(spark, sf):
    """Flagged-transfer summary."""
    return RP.flagged_summary(display(spark, sf))


_QUEUE = ("transaction_id:i, timestamp:t, sender_account:i, receiver_account:i, amount:d, currency:s, "
          "transaction_type:s, pattern_type:s, ensemble_score:d, is_suspicious:i")


@register("s1_alert_queue", _sql(
    _QUEUE, "FROM (SELECT * FROM disp WHERE is_alert = 1 ORDER BY ensemble_score DESC, transaction_id LIMIT 500)"))
def s1(spark, sf):
    """Alert queue (top 500 by score)."""
    return RP.alert_queue(display(spark, sf), 500)


@register("s3_top_flagged", _sql(
    "transaction_id:i, sender_account:i, receiver_account:i, amount:d, ensemble_score:d", "FROM top", TOP_VIEW))
def s3(spark, sf):
    """S3: top 200 flagged transfers."""
    t = RP.top_flagged(display(spark, sf), 200)
    return t.select("transaction_id", "sender_account", "receiver_account", "amount", "ensemble_score")


def _edges(spark, sf):
    """Edges of every flagged transfer; a display that wants fewer takes S3 first."""
    return GR.flagged_edges(display(spark, sf).filter(F.col("is_alert") == 1))


@register("g1_flagged_edges", _sql(
    "transaction_id:i, src:i=sender_account, dst:i=receiver_account, amount:d, score:d=ensemble_score",
    "FROM flagged", FLAGGED_VIEW))
def g1(spark, sf):
    """G1: network edges of the flagged transfers."""
    return _edges(spark, sf)


@register("g2_node_table", _sql(
    "node:i, avg_score:d, degree:i, node_size:i=least(greatest(degree * 3, 6), 30)",
    "FROM (SELECT node, avg(score) AS avg_score, count(*) AS degree FROM ("
    "SELECT sender_account AS node, ensemble_score AS score FROM flagged UNION ALL "
    "SELECT receiver_account, ensemble_score FROM flagged WHERE receiver_account IS DISTINCT FROM sender_account) "
    "GROUP BY node)", FLAGGED_VIEW))
def g2(spark, sf):
    """G2 + G3: node scores, degrees and sizes."""
    return GR.node_table(_edges(spark, sf))


@register("u2_edge_accounts", _sql(
    "account:i", "FROM (SELECT sender_account AS account FROM flagged UNION SELECT receiver_account FROM flagged)",
    FLAGGED_VIEW))
def u2(spark, sf):
    """Distinct accounts in the flagged network."""
    return GR.edge_accounts(_edges(spark, sf))


@register("u1_union", with_views(
    "SELECT " + sql_cols("transaction_id:i, amount:d, pattern_type:s") +
    " FROM (SELECT * FROM txn WHERE is_suspicious = 0 UNION ALL SELECT * FROM txn WHERE is_suspicious = 1)",
    TXN_VIEW))
def u1(spark, sf):
    """Bag union of the normal and the suspicious ledgers."""
    txn, _ = views(spark, sf)
    parts = [txn.filter(F.col("is_suspicious") == 0), txn.filter(F.col("is_suspicious") == 1)]
    return GR.union_all(*parts).select("transaction_id", "amount", "pattern_type")


@register("j6_attach_sampled", _sql(
    "transaction_id:i, queue_score:d=coalesce(q.ensemble_score, 0.0)",
    "FROM txn t LEFT JOIN flagged q USING (transaction_id)", FLAGGED_VIEW))
def j6(spark, sf):
    """Scores computed on a subset (all alerts) attached to every
    transfer; transfers outside the subset get the default 0.0."""
    from ledgerscope.operators.sampling import attach_sampled
    txn, _ = views(spark, sf)
    q = display(spark, sf).filter(F.col("is_alert") == 1).select(
        "transaction_id", F.col("ensemble_score").alias("queue_score"))
    return attach_sampled(txn.select("transaction_id"), q, "queue_score", 0.0)
