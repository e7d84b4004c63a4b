"""Weighted ensemble of detector scores (D14) and the threshold flag (PF4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed default weights of the reference ensemble.
DEFAULT_WEIGHTS = {"isolation_forest": 0.35, "lof": 0.25, "rules": 0.40}
DEFAULT_THRESHOLD = 0.5


def alert_flag(score, threshold: float = DEFAULT_THRESHOLD) -> Column:
    """PF4: inclusive threshold, score >= t, as 0/1."""
    s = F.col(score) if isinstance(score, str) else score
    return F.coalesce((s >= F.lit(threshold)).cast("int"), F.lit(0))


def combine_scores(df: DataFrame, scores: dict, weights: dict | None = None,
                   threshold: float = DEFAULT_THRESHOLD, score_col: str = "ensemble_score",
                   alert_col: str = "is_alert") -> DataFrame:
    """Weighted mean over detectors with a known non-zero weight.

    ``scores`` maps detector name -> score column (in the order given);
    detectors without a weight are skipped. Raises if none applies."""
    weights = DEFAULT_WEIGHTS if weights is None else weights
    total_w, acc = 0.0, None
    for name, col in scores.items():
        w = weights.get(name, 0)
        if not w:
            continue
        term = (F.col(col) if isinstance(col, str) else col) * F.lit(float(w))
        acc = term if acc is None else acc + term
        total_w += w
    if acc is None:
        raise ValueError("no detector in the score set has a non-zero ensemble weight: "
                         f"scores={list(scores)}, weights={weights}")
    ens = acc / F.lit(float(total_w))
    return df.withColumn(score_col, ens).withColumn(alert_col, alert_flag(score_col, threshold))
