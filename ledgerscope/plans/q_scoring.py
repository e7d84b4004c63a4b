"""Registered queries: rules, ensemble, normalisers, evaluation
(D1, D5, D8-D14, PF4, A9-A12, A29)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ledgerscope.operators import ensemble as EN
from ledgerscope.operators import evaluate as EV
from ledgerscope.operators import features as FE
from ledgerscope.operators import rules as RU
from ledgerscope.operators import scale as SC
from ledgerscope.plans.oracle_sql import FEAT_VIEW, SCORED_VIEW, TXN_VIEW, with_views
from ledgerscope.plans.registry import memo_plan, register, sql_cols, views
from ledgerscope.session import checkpoint_dir
from ledgerscope.sources import io as IO

THRESHOLD = 0.5


def scored_table(spark, sf, threshold: float = THRESHOLD):
    """Feature frame -> rules -> ensemble. The SQL-checkable scored table uses
    the rules detector only; forest and LOF join in the model queries."""
    def build():
        f = feature_table(spark, sf)
        r = RU.rule_scores(f)
        return EN.combine_scores(r, {"rules": "rule_score"}, EN.DEFAULT_WEIGHTS, threshold)
    return memo_plan(spark, sf, f"scored@{threshold}", build)


def feature_table(spark, sf):
    """The full feature frame of a directory (plan memoised per session)."""
    return memo_plan(spark, sf, "features", lambda: FE.engineer_all_features(views(spark, sf)[0]))


def _sql(spec: str, body: str) -> str:
    return with_views(f"SELECT {sql_cols(spec)} {body}", TXN_VIEW, FEAT_VIEW, SCORED_VIEW)


RULE_SPEC = ", ".join(f"{c}:d" for c in RU.RULE_COLUMNS)


@register("d8_rule_structuring", _sql("transaction_id:i, rule_structuring:d", "FROM scored"))
def d8(spark, sf):
    """Near threshold and >= 3 transfers in the trailing day."""
    return scored_table(spark, sf).select("transaction_id", "rule_structuring")


@register("d8b_rule_structuring_dashboard", _sql(
    "transaction_id:i, rule_structuring:d=CAST(near_threshold AS DOUBLE)", "FROM scored"))
def d8b(spark, sf):
    """D8 (dashboard variant): near threshold alone."""
    txn, _ = views(spark, sf)
    f = FE.engineer_dashboard_features(txn)
    return RU.rule_scores(f, strict=False).select("transaction_id", "rule_structuring")


@register("d9_rule_large_cash", _sql("transaction_id:i, rule_large_cash:d", "FROM scored"))
def d9(spark, sf):
    return scored_table(spark, sf).select("transaction_id", "rule_large_cash")


@register("d10_rule_rapid", _sql("transaction_id:i, rule_rapid:d", "FROM scored"))
def d10(spark, sf):
    return scored_table(spark, sf).select("transaction_id", "rule_rapid")


@register("d11_rule_night", _sql("transaction_id:i, rule_night_activity:d", "FROM scored"))
def d11(spark, sf):
    return scored_table(spark, sf).select("transaction_id", "rule_night_activity")


@register("d12_rule_round", _sql("transaction_id:i, rule_round_amount:d", "FROM scored"))
def d12(spark, sf):
    return scored_table(spark, sf).select("transaction_id", "rule_round_amount")


@register("d13_rule_score", _sql(
    f"transaction_id:i, {RULE_SPEC}, rule_score:d, rule_alert:i=CASE WHEN rule_score > 0.3 THEN 1 ELSE 0 END",
    "FROM scored"))
def d13(spark, sf):
    """Weighted, clipped rule score with its detail columns."""
    s = scored_table(spark, sf)
    return s.select("transaction_id", *RU.RULE_COLUMNS, "rule_score",
                    RU.rule_alert_flag().alias("rule_alert"))


@register("d14_ensemble", _sql("transaction_id:i, ensemble_score:d, is_alert:i", "FROM scored"))
def d14(spark, sf):
    """Weighted ensemble over the detectors present, >= threshold."""
    return scored_table(spark, sf).select("transaction_id", "ensemble_score", "is_alert")


@register("pf4_alert_flag", _sql(
    "transaction_id:i, alert_03:i=CASE WHEN ensemble_score >= 0.3 THEN 1 ELSE 0 END, "
    "alert_05:i=CASE WHEN ensemble_score >= 0.5 THEN 1 ELSE 0 END", "FROM scored"))
def pf4(spark, sf):
    """PF4: inclusive threshold flags at two thresholds."""
    s = scored_table(spark, sf)
    return s.select("transaction_id", EN.alert_flag("ensemble_score", 0.3).alias("alert_03"),
                    EN.alert_flag("ensemble_score", 0.5).alias("alert_05"))


_STD_COLS = ["amount", "acct_avg_amount", "txn_count_1d", "n_unique_receivers"]


@register("d1_standardize", _sql(
    "transaction_id:i, " + ", ".join(
        f"{c}:d=CASE WHEN stddev_pop({c}) OVER () > 0 THEN ({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () ELSE 0.0 END"
        for c in _STD_COLS), "FROM featr"))
def d1(spark, sf):
    """Population-std standardisation of model inputs."""
    txn, _ = views(spark, sf)
    f = FE.engineer_all_features(txn)
    out, _m = SC.standardize(f, _STD_COLS)
    return out.select("transaction_id", *_STD_COLS)


@register("d5_minmax_flip", _sql(
    "transaction_id:i, flipped:d=CASE WHEN max(amount_zscore) OVER () - min(amount_zscore) OVER () > 0 "
    "THEN 1.0 - (amount_zscore - min(amount_zscore) OVER ()) / (max(amount_zscore) OVER () - min(amount_zscore) OVER ()) ELSE 0.0 END",
    "FROM featr"))
def d5(spark, sf):
    """Min-max flip normaliser, applied to the amount z-score as a raw score."""
    txn, _ = views(spark, sf)
    f = FE.amount_features(txn)
    f = FE.fill_numeric_nulls(f)
    return SC.minmax_flip(f, "amount_zscore", "flipped").select("transaction_id", "flipped")


_EVAL_SQL = """FROM (SELECT sum(CASE WHEN is_suspicious = 1 AND is_alert = 1 THEN 1 ELSE 0 END) AS tp,
    sum(CASE WHEN is_suspicious = 0 AND is_alert = 1 THEN 1 ELSE 0 END) AS fp,
    sum(CASE WHEN is_suspicious = 0 AND is_alert = 0 THEN 1 ELSE 0 END) AS tn,
    sum(CASE WHEN is_suspicious = 1 AND is_alert = 0 THEN 1 ELSE 0 END) AS fn,
    sum(is_alert) AS total_alerts, sum(is_suspicious) AS total_suspicious,
    avg(CAST(is_alert AS DOUBLE)) AS alert_rate,
    max(CASE WHEN is_suspicious = 0 OR is_alert = 0 THEN 1 ELSE 0 END) AS has0,
    max(CASE WHEN is_suspicious = 1 OR is_alert = 1 THEN 1 ELSE 0 END) AS has1
  FROM scored)"""
_EVAL_SPEC = ("precision:d=CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END, "
              "recall:d=CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END, "
              "f1_score:d=CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END, "
              "true_positives:i=CASE WHEN has0 = 1 AND has1 = 1 THEN tp ELSE 0 END, "
              "false_positives:i=CASE WHEN has0 = 1 AND has1 = 1 THEN fp ELSE 0 END, "
              "true_negatives:i=CASE WHEN has0 = 1 AND has1 = 1 THEN tn ELSE 0 END, "
              "false_negatives:i=CASE WHEN has0 = 1 AND has1 = 1 THEN fn ELSE 0 END, "
              "total_alerts:i, total_suspicious:i, alert_rate:d")


@register("a9_detection_metrics", _sql(_EVAL_SPEC, _EVAL_SQL))
def a9(spark, sf):
    """Confusion matrix, precision, recall, F1, totals, alert rate."""
    return EV.evaluate_detection(scored_table(spark, sf))


_VOL_VALUES = ", ".join(f"({t!r})" for t in EV.DEFAULT_THRESHOLDS)


@register("a10_alert_volume", _sql(
    "threshold:d=t.threshold, n_alerts:i=count(s.ensemble_score), "
    "alert_rate:d=count(s.ensemble_score) / (SELECT count(*) FROM scored), "
    "daily_alerts_est:d=count(s.ensemble_score) / 365.0",
    f"FROM (VALUES {_VOL_VALUES}) t(threshold) LEFT JOIN scored s ON s.ensemble_score >= t.threshold "
    "GROUP BY t.threshold"))
def a10(spark, sf):
    """A10: alerts by threshold, in one aggregate pass."""
    return EV.alert_volume(scored_table(spark, sf))


@register("a11_by_pattern", _sql(
    "pattern_type:s, total:i, detected:i, avg_score:d, detection_rate:d=round_even(detected / total, 3)",
    "FROM (SELECT pattern_type, count(*) AS total, sum(CASE WHEN ensemble_score >= 0.5 THEN 1 ELSE 0 END) AS detected, "
    "avg(ensemble_score) AS avg_score FROM scored WHERE is_suspicious = 1 GROUP BY pattern_type)"))
def a11(spark, sf):
    """Detection by pattern among labelled-suspicious transfers."""
    return EV.evaluate_by_pattern(scored_table(spark, sf), threshold=THRESHOLD)


@register("a12_sar_metrics", _sql(
    "total_alerts:i=n_alerts, n_investigated:i, n_filed:i, "
    "investigation_rate:d=CASE WHEN n_alerts > 0 THEN n_investigated / n_alerts ELSE 0.0 END, "
    "sar_filing_rate:d=CASE WHEN n_investigated > 0 THEN n_filed / n_investigated ELSE 0.0 END, "
    "alert_to_sar_ratio:d=CASE WHEN n_filed > 0 THEN n_alerts / n_filed ELSE 'inf'::DOUBLE END, "
    "coverage:d=CASE WHEN n_true > 0 THEN n_filed / n_true ELSE 0.0 END",
    "FROM (SELECT sum(is_alert) AS n_alerts, sum(is_suspicious) AS n_true, "
    "sum(CASE WHEN is_alert = 1 AND ensemble_score >= 0.6 THEN 1 ELSE 0 END) AS n_investigated, "
    "sum(CASE WHEN is_alert = 1 AND ensemble_score >= 0.6 AND is_suspicious = 1 THEN 1 ELSE 0 END) AS n_filed FROM scored)"))
def a12(spark, sf):
    """SAR funnel over the scored table (investigated: score >= 0.6)."""
    return EV.sar_metrics(scored_table(spark, sf), investigate_threshold=0.6)


@register("a29_run_summary", _sql(
    "total_transactions:i, suspicious_transactions:i, suspicious_rate:d, " + _EVAL_SPEC,
    "FROM (SELECT count(*) AS total_transactions, sum(is_suspicious) AS suspicious_transactions, "
    "avg(CAST(is_suspicious AS DOUBLE)) AS suspicious_rate FROM scored), " + _EVAL_SQL[5:]))
def a29(spark, sf):
    """Run summary totals with the detection metrics (flat form)."""
    return EV.run_summary_flat(scored_table(spark, sf))


@register("io5_report")
def io5(spark, sf):
    """IO5: the nested one-row report (struct / array / map columns), as
    written to JSON by :func:`ledgerscope.sources.io.write_report`."""
    return EV.run_summary(scored_table(spark, sf), threshold=THRESHOLD, n_clusters=8)


@register("io5b_report_file", _sql(
    "total_transactions:i, suspicious_transactions:i, suspicious_rate:d, " + _EVAL_SPEC + ", n_thresholds:i=9, n_clusters:i=8",
    "FROM (SELECT count(*) AS total_transactions, sum(is_suspicious) AS suspicious_transactions, "
    "avg(CAST(is_suspicious AS DOUBLE)) AS suspicious_rate FROM scored), " + _EVAL_SQL[5:]))
def io5b(spark, sf):
    """IO5: the report written as one JSON document, read back and flattened."""
    report = EV.run_summary(scored_table(spark, sf), threshold=THRESHOLD, n_clusters=8)
    path = f"{checkpoint_dir(spark).rstrip('/')}/io5-{uuid.uuid4().hex}"
    IO.write_report(report, path)
    back = spark.read.schema(report.schema).json(path)
    return back.select("total_transactions", "suspicious_transactions", "suspicious_rate", "detection_metrics.*",
                       F.size("alert_volume").alias("n_thresholds"), "n_clusters")


_LEVELS = ", ".join(f"(CAST({t!r} AS DOUBLE))" for t in EV.DEFAULT_THRESHOLDS)


@register("io5c_report_values", _sql(
    "section:s, item:s, measure:s, value:d",
    "FROM (WITH v AS (SELECT t, sum(CASE WHEN ensemble_score >= t THEN 1 ELSE 0 END) AS n, count(*) AS total "
    f"FROM scored, (VALUES {_LEVELS}) l(t) GROUP BY t), "
    f"p AS (SELECT coalesce(pattern_type, '(none)') AS pattern, count(*) AS total, "
    f"sum(CASE WHEN ensemble_score >= {THRESHOLD} THEN 1 ELSE 0 END) AS detected, avg(ensemble_score) AS score "
    "FROM scored WHERE is_suspicious = 1 GROUP BY 1) "
    "SELECT 'alert_volume' AS section, CAST(round(t * 10) AS INTEGER)::VARCHAR AS item, 'n_alerts' AS measure, CAST(n AS DOUBLE) AS value FROM v "
    "UNION ALL SELECT 'alert_volume', CAST(round(t * 10) AS INTEGER)::VARCHAR, 'alert_rate', n / total FROM v "
    "UNION ALL SELECT 'alert_volume', CAST(round(t * 10) AS INTEGER)::VARCHAR, 'daily_alerts_est', n / 365.0 FROM v "
    "UNION ALL SELECT 'pattern_detection', pattern, 'total', total FROM p "
    "UNION ALL SELECT 'pattern_detection', pattern, 'detected', detected FROM p "
    "UNION ALL SELECT 'pattern_detection', pattern, 'avg_score', score FROM p "
    "UNION ALL SELECT 'pattern_detection', pattern, 'detection_rate', round_even(detected / total, 3) FROM p)"))
def io5c(spark, sf):
    """IO5: every value of the report's ``alert_volume`` array and ``pattern_detection`` maps, from the file."""
    report = EV.run_summary(scored_table(spark, sf), threshold=THRESHOLD, n_clusters=8)
    path = f"{checkpoint_dir(spark).rstrip('/')}/io5c-{uuid.uuid4().hex}"
    IO.write_report(report, path)
    back = spark.read.schema(report.schema).json(path)
    v = back.select(F.explode("alert_volume").alias("v"))
    level = F.round(F.col("v.threshold") * 10).cast("int").cast("string")
    out = None
    for m in ("n_alerts", "alert_rate", "daily_alerts_est"):
        part = v.select(F.lit("alert_volume").alias("section"), level.alias("item"), F.lit(m).alias("measure"),
                        F.col(f"v.{m}").cast("double").alias("value"))
        out = part if out is None else out.unionByName(part)
    for m in ("total", "detected", "avg_score", "detection_rate"):
        out = out.unionByName(back.select(F.explode(f"pattern_detection.{m}").alias("item", "value")).select(
            F.lit("pattern_detection").alias("section"), "item", F.lit(m).alias("measure"), F.col("value").cast("double").alias("value")))
    return out
