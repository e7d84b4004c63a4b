"""Local outlier factor (D6, D7) as joins and aggregates over an exact
k-nearest-neighbour edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from ledgerscope.session import pin

from ledgerscope.operators.knn import nearest_rows
from ledgerscope.operators.quantiles import exact_quantiles
from ledgerscope.operators.sampling import attach_sampled, sample_exact
from ledgerscope.operators.scale import minmax_flip, standardize

LRD_EPS = 1e-10  # fixed smoothing term of the reachability density


def lof_from_knn(knn: DataFrame, k: int) -> DataFrame:
    """(id, kdist, lrd, lof) from kNN edges (qid, rid, dist, rank)."""
    kd = knn.filter(F.col("rank") == k).select(F.col("qid").alias("id"), F.col("dist").alias("kdist"))
    reach = (knn.join(kd, knn.rid == kd.id)
             .select("qid", F.greatest(F.col("kdist"), F.col("dist")).alias("reach")))
    lrd = reach.groupBy("qid").agg(
        (F.lit(1.0) / (F.avg("reach") + F.lit(LRD_EPS))).alias("lrd")).withColumnRenamed("qid", "id")
    o = lrd.select(F.col("id").alias("_oid"), F.col("lrd").alias("_olrd"))
    p = lrd.select(F.col("id").alias("_pid"), F.col("lrd").alias("_plrd"))
    lof = (knn.join(o, knn.rid == o._oid).join(p, knn.qid == p._pid)
           .groupBy("qid").agg(F.avg(F.col("_olrd") / F.col("_plrd")).alias("lof"))
           .withColumnRenamed("qid", "id"))
    return kd.join(lrd, "id").join(lof, "id")


def local_outlier_factor(df: DataFrame, id_col: str, cols: list[str], k: int = 20,
                         contamination: float = 0.03, scale: bool = True, neighbours=nearest_rows) -> DataFrame:
    """Transductive LOF. Returns (id, negative_outlier_factor, lof_label,
    lof_score) with label -1 below the contamination percentile of the
    negative factor and score the min-max flip of it (1 = most outlying).
    ``neighbours`` joins the rows with themselves (any number of them by default)."""
    x = pin(standardize(df, cols)[0]) if scale else df
    n = x.count()
    k_eff = max(1, min(k, n - 1))
    # The edge table feeds three joins: compute it once.
    knn = pin(neighbours(x, x, id_col, cols, k_eff))
    # Pinned: the label offset, the normaliser and the output must see the
    # same doubles (aggregation order can differ between recomputations).
    f = pin(lof_from_knn(knn, k_eff).select(F.col("id").alias(id_col),
                                            (-F.col("lof")).alias("negative_outlier_factor")),
            cache=False)
    off = exact_quantiles(f, "negative_outlier_factor", [contamination]).first()[0]
    f = f.withColumn("lof_label", F.when(F.col("negative_outlier_factor") < F.lit(off), -1)
                     .otherwise(1))
    return minmax_flip(f, "negative_outlier_factor", "lof_score")


def sampled_lof(df: DataFrame, id_col: str, cols: list[str], sample_size: int = 50000,
                seed: int = 42, k: int = 20, contamination: float = 0.03, score_all: bool = True) -> DataFrame:
    """LOF fitted on an exact-size seeded sample (``sample_size``, a
    documented bound on the fit). Every other row is scored against the fitted
    sample (k nearest sample rows, their k-distance and density); with
    ``score_all=False`` it gets 0.0. Standardisation is fitted on the full input.

    The sample's metric index is broadcast (its size is bounded and checked) and the
    other rows stream past it; only their k edges go on."""
    # ``df`` is read a few times (moments, sample): pass a pinned frame.
    x = standardize(df, cols)[0]
    # An ordered take ends in one partition: spread the sample again, its search is the costly part.
    spread = max(int(x.sparkSession.conf.get("spark.sql.shuffle.partitions")), x.sparkSession.sparkContext.defaultParallelism)
    s = pin(sample_exact(x.select(id_col, *cols), sample_size, seed, id_col).repartition(spread, id_col), cache=False)
    if not score_all:
        fit = local_outlier_factor(s, id_col, cols, k, contamination, scale=False)
        return attach_sampled(df, fit.select(id_col, "lof_score"), "lof_score", 0.0, id_col)
    n = s.count()
    k_eff = max(1, min(k, n - 1))
    knn_s = pin(nearest_rows(s, s, id_col, cols, k_eff))
    fitted = pin(lof_from_knn(knn_s, k_eff), cache=False)
    kq = nearest_rows(x, s, id_col, cols, k_eff, skip_known=True)
    j = kq.join(fitted.select("id", "kdist", "lrd"), kq.rid == F.col("id"))
    lrd_q = j.groupBy("qid").agg(
        (F.lit(1.0) / (F.avg(F.greatest("kdist", "dist")) + F.lit(LRD_EPS))).alias("lrd_q"),
        F.avg("lrd").alias("lrd_o"))
    new = lrd_q.select(F.col("qid").alias(id_col),
                       (-(F.col("lrd_o") / F.col("lrd_q"))).alias("negative_outlier_factor"))
    own = fitted.select(F.col("id").alias(id_col), (-F.col("lof")).alias("negative_outlier_factor"))
    # The normaliser's bounds and the output read it: the rest's kernel runs once.
    allf = minmax_flip(pin(own.unionByName(new)), "negative_outlier_factor", "lof_score")
    return df.join(allf.select(id_col, "lof_score"), id_col, "left").na.fill(0.0, ["lof_score"])
