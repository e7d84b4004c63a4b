"""End-to-end scoring (D15): features, three detectors, ensemble, clusters.

The feature frame is checkpointed once to the shared checkpoint folder: the
forest fit, forest scoring, LOF sample, rules and K-Means all read it, and
recomputing its shuffles for each would multiply the cost."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerscope.operators import clustering as CL
from ledgerscope.operators import dbscan as DB
from ledgerscope.operators import ensemble as EN
from ledgerscope.operators import features as FE
from ledgerscope.operators import iforest as IF
from ledgerscope.operators import lof as LO
from ledgerscope.operators import rules as RU
from ledgerscope.operators.sampling import attach_sampled
from ledgerscope.session import checkpoint_dir, pin

OUTPUT_COLUMNS = ["transaction_id", "timestamp", "sender_account", "receiver_account", "amount",
                  "transaction_type", "currency", "is_suspicious", "pattern_type", "hour",
                  "is_alert", "ensemble_score", "if_score", "lof_score", "rule_score",
                  "km_cluster", "db_cluster"]


def score_transactions(txn: DataFrame, *, id_col: str = "transaction_id", n_estimators: int = 200,
                       contamination: float = 0.03, lof_sample: int = 50000, lof_k: int = 20,
                       weights: dict | None = None, threshold: float = 0.5,
                       n_clusters: int = 8, km_n_init: int = 10, dbscan_eps: float = 0.5,
                       dbscan_min_samples: int = 10, seed: int = 42) -> DataFrame:
    spark = txn.sparkSession
    checkpoint_dir(spark)
    f = pin(FE.engineer_all_features(txn))
    cols = FE.feature_columns(f)

    # The detectors only share the pinned features: their jobs run side by side, one's short steps beside another's
    # long ones. Forest: fitted on standardised inputs, scored in Arrow batches (narrow). LOF is fitted on at most
    # ``lof_sample`` rows and scores every row; DBSCAN clusters every row.
    inputs = f.select(id_col, *cols)
    with ThreadPoolExecutor(max_workers=3) as pool:
        forest = pool.submit(IF.isolation_forest_scores, f, id_col, cols, n_estimators, contamination, seed)
        lof = pool.submit(LO.sampled_lof, inputs, id_col, cols, lof_sample, seed, lof_k, contamination)
        db = pool.submit(DB.dbscan, inputs, id_col, cols, dbscan_eps, dbscan_min_samples)
        s, lof, db = forest.result().drop("if_raw", "if_label"), lof.result(), db.result()

    # A transfer without an id keeps its row: it can be matched with nothing and scores 0.
    s = attach_sampled(s, lof.filter(F.col(id_col).isNotNull()), "lof_score", 0.0, id_col)
    s = attach_sampled(s, db.filter(F.col(id_col).isNotNull()).select(id_col, F.col("cluster").alias("db_cluster")),
                       "db_cluster", DB.NOT_SAMPLED, id_col)

    s = RU.rule_scores(s)
    s = EN.combine_scores(s, {"isolation_forest": "if_score", "lof": "lof_score",
                              "rules": "rule_score"}, weights, threshold)
    # K-Means reads its input twice and the output once more: the joins run once.
    s = pin(s.select(*dict.fromkeys([c for c in OUTPUT_COLUMNS if c in s.columns] + cols)))
    s, _km = CL.kmeans(s, cols, k=n_clusters, seed=seed, n_init=km_n_init, out="km_cluster")
    return s.select(*[c for c in OUTPUT_COLUMNS if c in s.columns])
