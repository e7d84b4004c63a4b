"""Column statistics that must be known as scalars to build the next plan:
standardisation (D1) and the min-max flip normaliser (D5).

Each costs one aggregate job whose result is a handful of doubles; the
expression built from them stays inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def column_moments(df: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """{col: (mean, population std)} in one aggregate pass."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}")]
    r = df.agg(*aggs).first()
    return {c: (r[f"m_{c}"] or 0.0, r[f"s_{c}"] or 0.0) for c in cols}


def standardize(df: DataFrame, cols: list[str], moments: dict | None = None,
                suffix: str = "") -> tuple[DataFrame, dict]:
    """(x - mean) / population std; a constant column becomes 0.

    Returns the frame and the moments, so one fit can be reused by several
    detectors (the reference refits the same scaler per detector)."""
    moments = moments or column_moments(df, cols)
    exprs = {}
    for c in cols:
        m, s = moments[c]
        x = F.coalesce(F.col(c).cast("double"), F.lit(0.0))
        exprs[c + suffix] = (x - F.lit(m)) / F.lit(s) if s and s > 0 else F.lit(0.0)
    return df.withColumns(exprs), moments


def minmax_flip(df: DataFrame, raw_col: str, out_col: str) -> DataFrame:
    """1 - (s - min) / (max - min), 0 when all raw scores are equal.
    Lower raw score = more anomalous -> higher output. ``df`` is read twice
    (scalars, then rows): pass a pinned (checkpointed) frame when its scores
    come from aggregates whose float order may vary between runs."""
    r = df.agg(F.min(raw_col).alias("lo"), F.max(raw_col).alias("hi")).first()
    lo, hi = r["lo"], r["hi"]
    if lo is None or hi is None or not (hi - lo > 0):
        return df.withColumn(out_col, F.lit(0.0))
    return df.withColumn(out_col, F.lit(1.0) - (F.col(raw_col) - F.lit(lo)) / F.lit(hi - lo))
