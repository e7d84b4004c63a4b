"""Isolation forest (D2-D4): trees grown per group in Arrow batches, scored
by a vectorised traversal in ``mapInPandas``.

* Subsamples: psi = min(256, n) rows per tree, the rows with the smallest
  seeded hash per tree. A hash threshold first keeps about 3 * psi
  candidates per tree, so the (row, tree) candidate table is bounded by
  3 * psi * trees rows whatever n is.
* Fit: ``groupBy("tree").applyInPandas`` grows each tree (random feature,
  uniform cut between the node's min and max, height limit ceil(log2 psi)).
  The node table holds at most trees * (2 psi - 1) rows: a proven size bound,
  so it ships to the scoring tasks inside the function closure.
* Score: s = 2^(-E[h(x)] / c(psi)); raw = -s (lower = more anomalous).
* Labels: -1 below the contamination quantile of the training raw scores
  (exact distributed quantile).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from ledgerscope.session import pin

from ledgerscope.operators.quantiles import exact_quantiles
from ledgerscope.operators.sampling import hash_unit
from ledgerscope.operators.scale import minmax_flip, standardize

MAX_SAMPLES = 256
EULER_GAMMA = 0.5772156649015329

NODE_SCHEMA = ("tree long, node long, feature long, threshold double, left long, "
               "right long, size long, depth long")


def average_path_length(n):
    """c(n): mean path length of an unsuccessful search in a binary tree."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    two = n == 2
    big = n > 2
    out[two] = 1.0
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER_GAMMA) - 2.0 * (n[big] - 1.0) / n[big]
    return out


def _grow(pdf: pd.DataFrame, cols: list[str], seed: int, height: int) -> pd.DataFrame:
    tree = int(pdf["tree"].iloc[0])
    pdf = pdf.sort_values("_id", kind="stable")
    X = pdf[cols].to_numpy(float)
    rng = np.random.default_rng([seed, tree])
    nodes = []  # (node, feature, threshold, left, right, size, depth)
    stack = [(0, np.arange(X.shape[0]), 0)]
    next_id = 1
    while stack:
        nid, idx, depth = stack.pop()
        size = len(idx)
        if depth >= height or size <= 1:
            nodes.append((nid, -1, 0.0, -1, -1, size, depth))
            continue
        sub = X[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        usable = np.flatnonzero(hi > lo)
        if usable.size == 0:
            nodes.append((nid, -1, 0.0, -1, -1, size, depth))
            continue
        f = int(usable[rng.integers(usable.size)])
        thr = float(lo[f] + rng.random() * (hi[f] - lo[f]))
        go_left = sub[:, f] <= thr
        left, right = next_id, next_id + 1
        next_id += 2
        nodes.append((nid, f, thr, left, right, size, depth))
        stack.append((left, idx[go_left], depth + 1))
        stack.append((right, idx[~go_left], depth + 1))
    a = np.array(nodes, dtype=object)
    return pd.DataFrame({"tree": tree, "node": a[:, 0].astype(np.int64),
                         "feature": a[:, 1].astype(np.int64), "threshold": a[:, 2].astype(float),
                         "left": a[:, 3].astype(np.int64), "right": a[:, 4].astype(np.int64),
                         "size": a[:, 5].astype(np.int64), "depth": a[:, 6].astype(np.int64)})


@dataclass
class IsolationForestModel:
    cols: list
    moments: dict
    nodes: pd.DataFrame
    psi: int
    n_trees: int
    contamination: float = 0.03
    offset: float | None = None

    def _arrays(self):
        out = []
        for t, g in self.nodes.groupby("tree"):
            g = g.sort_values("node")
            m = int(g["node"].max()) + 1
            feat = np.full(m, -1, np.int64)
            thr = np.zeros(m)
            left = np.full(m, -1, np.int64)
            right = np.full(m, -1, np.int64)
            leafval = np.zeros(m)
            n = g["node"].to_numpy()
            feat[n], thr[n] = g["feature"].to_numpy(), g["threshold"].to_numpy()
            left[n], right[n] = g["left"].to_numpy(), g["right"].to_numpy()
            leafval[n] = g["depth"].to_numpy() + average_path_length(g["size"].to_numpy())
            out.append((feat, thr, left, right, leafval))
        return out

    def raw_scores(self, df: DataFrame, out: str = "if_raw") -> DataFrame:
        """D3 raw: -2^(-mean path / c(psi)) per row (lower = more anomalous)."""
        x, _ = standardize(df, self.cols, self.moments, suffix="__z")
        zc = [c + "__z" for c in self.cols]
        trees = self._arrays()
        cpsi = float(average_path_length([self.psi])[0])

        # Only the model's inputs travel to Python and one number comes back.
        @F.pandas_udf(T.DoubleType())
        def score(*inputs: pd.Series) -> pd.Series:
            X = np.column_stack([c.to_numpy(float) for c in inputs])
            n = X.shape[0]
            total = np.zeros(n)
            rows = np.arange(n)
            for feat, thr, left, right, leafval in trees:
                node = np.zeros(n, np.int64)
                while True:
                    f = feat[node]
                    inner = f >= 0
                    if not inner.any():
                        break
                    fi = np.where(inner, f, 0)
                    go_left = X[rows, fi] <= thr[node]
                    node = np.where(inner, np.where(go_left, left[node], right[node]), node)
                total += leafval[node]
            return pd.Series(-np.power(2.0, -(total / len(trees)) / cpsi) if cpsi > 0 else np.full(n, -1.0))

        return x.withColumn(out, score(*zc)).drop(*zc)


def fit_isolation_forest(df: DataFrame, id_col: str, cols: list[str], n_estimators: int = 200,
                         contamination: float = 0.03, seed: int = 42,
                         max_samples: int = MAX_SAMPLES, with_offset: bool = True) -> IsolationForestModel:
    """Fit on the standardised input (moments kept with the model). The
    label offset is the contamination quantile of the training scores and is
    stored with the model; ``with_offset=False`` leaves it to the caller."""
    x, moments = standardize(df, cols, suffix="__z")
    zc = [c + "__z" for c in cols]
    n = x.count()
    psi = int(min(max_samples, n))
    height = int(math.ceil(math.log2(max(psi, 2))))
    p = min(1.0, 3.0 * psi / max(n, 1))
    base = x.select(F.col(id_col).alias("_id"), *zc)
    # One rule for every size: a row is a candidate of tree t when its tree-salted
    # hash is below p; only those (row, tree) pairs are emitted, about 3 * psi a tree.
    def unit(t):
        h = F.xxhash64(F.col("_id"), F.lit(int(seed)), t)
        return F.when(h < 0, -(h + F.lit(1))).otherwise(h).cast("double") / F.lit(float(2 ** 63))
    trees = F.filter(F.sequence(F.lit(0).cast("long"), F.lit(n_estimators - 1).cast("long")),
                     lambda t: unit(t) < F.lit(p))
    cand = base.withColumn("tree", F.explode(trees))
    cand = cand.withColumn("_h", hash_unit("_id", seed + 1, F.col("tree")))
    from pyspark.sql import Window
    w = Window.partitionBy("tree").orderBy("_h", "_id")
    sample = cand.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= psi)

    def grow(pdf):
        return _grow(pdf, zc, seed, height)

    nodes = (sample.select("tree", "_id", *zc).groupBy("tree").applyInPandas(grow, NODE_SCHEMA)
             .toPandas())
    model = IsolationForestModel(list(cols), moments, nodes, psi, n_estimators,
                                 contamination=contamination)
    if with_offset:
        model.offset = _offset(pin(model.raw_scores(df.select(*cols)).select("if_raw")), contamination)
    return model


def _offset(raw: DataFrame, contamination: float) -> float:
    return exact_quantiles(raw, "if_raw", [contamination]).first()[0]


def isolation_forest_scores(df: DataFrame, id_col: str, cols: list[str], n_estimators: int = 200,
                            contamination: float = 0.03, seed: int = 42,
                            model: IsolationForestModel | None = None) -> DataFrame:
    """D3 + D4: raw score, label (-1 anomaly / 1 normal) and the min-max
    flipped score ``if_score`` in [0, 1] (1 = most suspicious). Without a
    ``model``, one is fitted on ``df``, whose scores then give the label offset; a
    given model brings the offset of its own training frame."""
    fitted_here = model is None
    model = model or fit_isolation_forest(df, id_col, cols, n_estimators, contamination, seed, with_offset=False)
    if model.offset is None and not fitted_here:
        raise ValueError("the model has no label offset: fit it with with_offset=True")
    # Pinned once: the label offset, the normaliser and the caller all read it.
    raw = pin(model.raw_scores(df))
    if model.offset is None:
        model.offset = _offset(raw, model.contamination)
    lab = F.when(F.col("if_raw") < F.lit(model.offset), -1).otherwise(1)
    return minmax_flip(raw.withColumn("if_label", lab), "if_raw", "if_score")
