"""Evaluation against ground-truth labels.

Each metric is a single aggregate pass with map-side partial aggregation:
no label/score vector ever reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed default threshold grid of the alert-volume analysis.
DEFAULT_THRESHOLDS = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]
DAYS_PER_YEAR = 365.0


def _div0(a, b):
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def _detection_aggs(t, p) -> list:
    return [
        F.sum(F.when((t == 1) & (p == 1), 1).otherwise(0)).alias("tp"),
        F.sum(F.when((t == 0) & (p == 1), 1).otherwise(0)).alias("fp"),
        F.sum(F.when((t == 0) & (p == 0), 1).otherwise(0)).alias("tn"),
        F.sum(F.when((t == 1) & (p == 0), 1).otherwise(0)).alias("fn"),
        F.sum(p).alias("total_alerts"),
        F.sum(t).alias("total_suspicious"),
        F.avg(p.cast("double")).alias("alert_rate"),
        F.max(((t == 0) | (p == 0)).cast("int")).alias("_has0"),
        F.max(((t == 1) | (p == 1)).cast("int")).alias("_has1"),
    ]


def _detection_cols() -> list:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    two = (F.col("_has0") == 1) & (F.col("_has1") == 1)
    names = {"tp": "true_positives", "fp": "false_positives", "tn": "true_negatives",
             "fn": "false_negatives"}
    return [
        _div0(tp.cast("double"), (tp + fp).cast("double")).alias("precision"),
        _div0(tp.cast("double"), (tp + fn).cast("double")).alias("recall"),
        _div0((2 * tp).cast("double"), (2 * tp + fp + fn).cast("double")).alias("f1_score"),
        *[F.when(two, F.col(c)).otherwise(F.lit(0)).cast("long").alias(n) for c, n in names.items()],
        F.coalesce(F.col("total_alerts"), F.lit(0)).cast("long").alias("total_alerts"),
        F.coalesce(F.col("total_suspicious"), F.lit(0)).cast("long").alias("total_suspicious"),
        F.col("alert_rate"),
    ]


def evaluate_detection(df: DataFrame, truth: str = "is_suspicious",
                       pred: str = "is_alert") -> DataFrame:
    """Confusion counts, precision / recall / F1 (0 on zero division),
    alert and label totals, alert rate; one row from one aggregate pass.

    Like the reference, when truth and prediction together hold a single
    label value the four confusion counts are reported as 0."""
    t, p = F.col(truth).cast("long"), F.col(pred).cast("long")
    return df.agg(*_detection_aggs(t, p)).select(*_detection_cols())


def alert_volume(df: DataFrame, score: str = "ensemble_score",
                 thresholds=None) -> DataFrame:
    """A10: alerts at each threshold (score >= t), their rate, and count / 365.
    One pass computes every threshold; the result is unpivoted to rows."""
    thresholds = list(thresholds or DEFAULT_THRESHOLDS)
    s = F.col(score)
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, t in enumerate(thresholds):
        aggs.append(F.sum(F.when(s >= F.lit(float(t)), 1).otherwise(0)).alias(f"_a{i}"))
    wide = df.agg(*aggs)
    pairs = ", ".join(f"CAST({float(t)!r} AS DOUBLE), _a{i}" for i, t in enumerate(thresholds))
    long = wide.selectExpr("_n", f"stack({len(thresholds)}, {pairs}) AS (threshold, n_alerts)")
    n_alerts = F.coalesce(F.col("n_alerts"), F.lit(0)).cast("long")
    return long.select(
        "threshold",
        n_alerts.alias("n_alerts"),
        (n_alerts / F.col("_n")).alias("alert_rate"),
        (n_alerts / F.lit(DAYS_PER_YEAR)).alias("daily_alerts_est"),
    )


def evaluate_by_pattern(df: DataFrame, score: str = "ensemble_score", threshold: float = 0.5,
                        truth: str = "is_suspicious", pattern: str = "pattern_type",
                        percent: bool = False) -> DataFrame:
    """Per pattern among labelled-suspicious rows: total, detected
    (score >= threshold), mean score and detection rate (3 dp, half-even like
    pandas; ``percent=True`` gives the dashboard's x100 with 1 dp). Sorted by
    rate, highest first. Empty when no row is suspicious."""
    sus = df.filter(F.col(truth) == 1)
    det = (F.col(score) >= F.lit(threshold)).cast("int")
    g = sus.groupBy(pattern).agg(
        F.count(det).alias("total"),
        F.sum(det).cast("long").alias("detected"),
        F.avg(score).alias("avg_score"),
    )
    rate = F.col("detected") / F.col("total")
    rate = F.bround(rate * 100, 1) if percent else F.bround(rate, 3)
    return g.withColumn("detection_rate", rate).orderBy(F.desc("detection_rate"), pattern)


def sar_metrics(df: DataFrame, investigate_threshold: float = 0.5,
                alert: str = "is_alert", score: str = "ensemble_score",
                truth: str = "is_suspicious") -> DataFrame:
    """SAR funnel over a scored table. A case is investigated when an
    alert's score reaches ``investigate_threshold`` and a SAR is filed when
    the investigated transfer is truly suspicious. Ratios as in the
    reference: 0 on empty denominators, alert-to-SAR ratio infinite when
    nothing is filed."""
    a = F.col(alert) == 1
    inv = a & (F.col(score) >= F.lit(investigate_threshold))
    filed = inv & (F.col(truth) == 1)
    c = df.agg(
        F.sum(a.cast("long")).alias("n_alerts"),
        F.sum((F.col(truth) == 1).cast("long")).alias("n_true"),
        F.sum(inv.cast("long")).alias("n_investigated"),
        F.sum(filed.cast("long")).alias("n_filed"),
    ).na.fill(0)
    na, nt, ni, nf = (F.col(x).cast("double") for x in ("n_alerts", "n_true", "n_investigated", "n_filed"))
    return c.select(
        F.col("n_alerts").cast("long").alias("total_alerts"),
        F.col("n_investigated").cast("long").alias("n_investigated"),
        F.col("n_filed").cast("long").alias("n_filed"),
        _div0(ni, na).alias("investigation_rate"),
        _div0(nf, ni).alias("sar_filing_rate"),
        F.when(nf > 0, na / nf).otherwise(F.lit(float("inf"))).alias("alert_to_sar_ratio"),
        _div0(nf, nt).alias("coverage"),
    )


def run_summary_flat(df: DataFrame, truth: str = "is_suspicious", pred: str = "is_alert") -> DataFrame:
    """A29 (flat): totals and suspicious rate next to the detection metrics,
    in the same single aggregate pass."""
    t, p = F.col(truth).cast("long"), F.col(pred).cast("long")
    agg = df.agg(F.count(F.lit(1)).alias("total_transactions"),
                 F.sum(t).alias("suspicious_transactions"),
                 F.avg(t.cast("double")).alias("suspicious_rate"), *_detection_aggs(t, p))
    return agg.select("total_transactions",
                      F.coalesce("suspicious_transactions", F.lit(0)).cast("long").alias("suspicious_transactions"),
                      "suspicious_rate", *_detection_cols())


def _combine_rows(*parts: DataFrame) -> DataFrame:
    """One row from several one-row aggregates with disjoint columns: union
    them null-padded, then take each column's non-null value (no join)."""
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p, allowMissingColumns=True)
    cols = [c for p in parts for c in p.columns]
    return u.agg(*[F.first(c, ignorenulls=True).alias(c) for c in cols])


NO_PATTERN = "(none)"


def run_summary(df: DataFrame, score: str = "ensemble_score", truth: str = "is_suspicious",
                pred: str = "is_alert", threshold: float = 0.5, thresholds=None,
                n_clusters: int | None = None) -> DataFrame:
    """A29 / IO5: the nested one-row report: totals, ``detection_metrics``
    struct, ``alert_volume`` array, ``pattern_detection`` maps, cluster count.
    All parts are small aggregates; nothing but the final row is collected
    by a writer."""
    flat = run_summary_flat(df, truth, pred)
    metric_cols = ["precision", "recall", "f1_score", "true_positives", "false_positives",
                   "true_negatives", "false_negatives", "total_alerts", "total_suspicious",
                   "alert_rate"]
    vol = alert_volume(df, score, thresholds).agg(
        F.sort_array(F.collect_list(F.struct("threshold", "n_alerts", "alert_rate",
                                             "daily_alerts_est"))).alias("alert_volume"))
    # A map key cannot be null: suspicious rows without a pattern go by a name of their own.
    named = evaluate_by_pattern(df, score, threshold, truth).withColumn("pattern_type", F.coalesce("pattern_type", F.lit(NO_PATTERN)))
    pat = named.agg(
        F.map_from_entries(F.collect_list(F.struct("pattern_type", F.col("total").cast("double")))).alias("total"),
        F.map_from_entries(F.collect_list(F.struct("pattern_type", F.col("detected").cast("double")))).alias("detected"),
        F.map_from_entries(F.collect_list(F.struct("pattern_type", "avg_score"))).alias("avg_score"),
        F.map_from_entries(F.collect_list(F.struct("pattern_type", "detection_rate"))).alias("detection_rate"),
    ).select(F.struct("total", "detected", "avg_score", "detection_rate").alias("pattern_detection"))
    out = _combine_rows(flat, vol, pat)
    return out.select(
        "total_transactions", "suspicious_transactions", "suspicious_rate",
        F.struct(*metric_cols).alias("detection_metrics"), "alert_volume", "pattern_detection",
        F.lit(n_clusters).cast("int").alias("n_clusters"))
