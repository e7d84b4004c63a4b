"""Registered queries: sampling, neighbours, clusters, forest, end to end
(S4, S5, J6, D2-D4, D6, D7, D15, C1-C9, A23, A24, IO3, IO4)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerscope.operators import clustering as CL
from ledgerscope.operators import dbscan as DB
from ledgerscope.operators import features as FE
from ledgerscope.operators import iforest as IF
from ledgerscope.operators import lof as LO
from ledgerscope.operators import sampling as SA
from ledgerscope.plans.oracle_sql import ACCT_VEC_VIEW, ACCT_VIEW, FEAT_VIEW, TXN_VIEW, US, VEC_DIST, with_views
from ledgerscope.plans.q_features import TXN_SPEC
from ledgerscope.plans.registry import register, sql_cols, table, views
from ledgerscope.session import checkpoint_dir, pin
from ledgerscope.sources import io as IO

VEC = FE.ACCOUNT_VECTOR_COLUMNS
LOF_K = 20
DB_EPS, DB_MIN = 0.8, 5
EMB_DIM = 64


def _acct_vec(spark, sf):
    txn, _ = views(spark, sf)
    return FE.account_vectors(txn)


# -- sampling and ids ----------------------------------------------------------------

@register("s4_sequential_ids", with_views(
    "SELECT " + sql_cols("transaction_id:i, seq:i, display_id:s=concat('TXN', lpad(CAST(seq AS VARCHAR), 8, '0'))")
    + f" FROM (SELECT transaction_id, row_number() OVER (ORDER BY \"timestamp\", transaction_id) - 1 AS seq FROM txn)",
    TXN_VIEW))
def s4(spark, sf):
    """0-based position in timestamp order, with a zero-padded display id."""
    txn, _ = views(spark, sf)
    s = SA.sequential_ids(txn.select("transaction_id", "timestamp"))
    return s.select("transaction_id", "seq", SA.format_ids("seq").alias("display_id"))


@register("s5_exact_sample")
def s5(spark, sf):
    """Exact-size seeded sample (2,000 rows) of the ledger."""
    txn, _ = views(spark, sf)
    return SA.sample_exact(txn, 2000, seed=42)


# -- account-level LOF and DBSCAN (exact SQL oracles) ----------------------------------

_KNN = (f"pairs AS (SELECT a.sender_account AS qid, b.sender_account AS rid, {VEC_DIST} AS dist "
        "FROM acct_vec a JOIN acct_vec b ON a.sender_account <> b.sender_account), "
        f"keff AS (SELECT least({LOF_K}, count(*) - 1) AS k FROM acct_vec), "
        "knn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, rid) AS rn "
        "FROM pairs) WHERE rn <= (SELECT k FROM keff)), "
        "kd AS (SELECT qid AS id, dist AS kdist FROM knn WHERE rn = (SELECT k FROM keff)), "
        "lrd AS (SELECT k.qid AS id, 1.0 / (avg(greatest(kd.kdist, k.dist)) + 1e-10) AS lrd "
        "FROM knn k JOIN kd ON kd.id = k.rid GROUP BY k.qid), "
        "lof AS (SELECT k.qid AS id, -avg(o.lrd / p.lrd) AS nof FROM knn k JOIN lrd o ON o.id = k.rid "
        "JOIN lrd p ON p.id = k.qid GROUP BY k.qid)")


@register("d6_lof_accounts", with_views(
    "SELECT " + sql_cols(
        "sender_account:i=id, negative_outlier_factor:d=nof, "
        "lof_label:i=CASE WHEN nof < (SELECT quantile_cont(nof, 0.03) FROM lof) THEN -1 ELSE 1 END, "
        "lof_score:d=1.0 - (nof - min(nof) OVER ()) / (max(nof) OVER () - min(nof) OVER ())") + " FROM lof",
    TXN_VIEW, ACCT_VEC_VIEW, _KNN))
def d6(spark, sf):
    """LOF (k = 20) over standardised per-sender vectors."""
    return LO.local_outlier_factor(_acct_vec(spark, sf), "sender_account", VEC, k=LOF_K)


@register("d6b_knn_accounts", with_views(
    "SELECT " + sql_cols("qid:i, rid:i, dist:d, rank:i=rn") + " FROM knn", TXN_VIEW, ACCT_VEC_VIEW, _KNN))
def d6b(spark, sf):
    """D6 building block: exact 20-nearest-neighbour edges (ties by id)."""
    from ledgerscope.operators.knn import knn_edges
    from ledgerscope.operators.scale import standardize
    x = standardize(_acct_vec(spark, sf), VEC)[0]
    return knn_edges(x, x, "sender_account", VEC, LOF_K)


_DB = (f"pairs AS (SELECT a.sender_account AS a, b.sender_account AS b FROM acct_vec a, acct_vec b "
       f"WHERE {VEC_DIST} <= {DB_EPS}), "
       f"core AS (SELECT a AS id FROM pairs GROUP BY a HAVING count(*) >= {DB_MIN}), "
       "ce AS (SELECT p.a, p.b FROM pairs p JOIN core c1 ON p.a = c1.id JOIN core c2 ON p.b = c2.id), "
       "reach(id, lab) AS (SELECT id, id FROM core UNION SELECT ce.b, reach.lab FROM reach JOIN ce ON ce.a = reach.id), "
       "comp AS (SELECT id, min(lab) AS comp FROM reach GROUP BY id), "
       "num AS (SELECT id, dense_rank() OVER (ORDER BY comp) - 1 AS cluster FROM comp), "
       "border AS (SELECT p.a AS id, min(n.cluster) AS cluster FROM pairs p JOIN num n ON n.id = p.b "
       "WHERE p.a NOT IN (SELECT id FROM core) GROUP BY p.a), "
       "labels AS (SELECT v.sender_account, coalesce(n.cluster, b.cluster, -1) AS cluster, "
       "CASE WHEN n.id IS NOT NULL THEN 1 ELSE 0 END AS is_core FROM acct_vec v "
       "LEFT JOIN num n ON n.id = v.sender_account LEFT JOIN border b ON b.id = v.sender_account)")


def _dbscan_acct(spark, sf):
    return DB.dbscan(_acct_vec(spark, sf), "sender_account", VEC, eps=DB_EPS, min_samples=DB_MIN)


@register("c6_dbscan_accounts", with_views(
    "SELECT " + sql_cols("sender_account:i, cluster:i, is_core:i, is_noise:i=CASE WHEN cluster = -1 THEN 1 ELSE 0 END")
    + " FROM labels", TXN_VIEW, ACCT_VEC_VIEW, _DB, recursive=True))
def c6(spark, sf):
    """DBSCAN (eps 0.8, min 5) over standardised per-sender vectors."""
    return _dbscan_acct(spark, sf)


@register("c6b_dbscan_summary", with_views(
    "SELECT " + sql_cols("n_clusters:i=count(DISTINCT CASE WHEN cluster >= 0 THEN cluster END), "
                         "n_noise:i=sum(CASE WHEN cluster = -1 THEN 1 ELSE 0 END), "
                         "noise_share:d=avg(CASE WHEN cluster = -1 THEN 1.0 ELSE 0.0 END)") + " FROM labels",
    TXN_VIEW, ACCT_VEC_VIEW, _DB, recursive=True))
def c6b(spark, sf):
    """Cluster count, noise count and share."""
    return DB.dbscan_summary(_dbscan_acct(spark, sf))


@register("c7_outlier_statistics", with_views(
    "SELECT " + sql_cols("feature:s, inlier_mean:d=round_even(i, 4), outlier_mean:d=round_even(o, 4), "
                         "ratio:d=round_even(CASE WHEN i <> 0 THEN o / i ELSE 0.0 END, 4)") + " FROM (" +
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, avg(CASE WHEN l.cluster <> -1 THEN v.{c} END) AS i, "
        f"avg(CASE WHEN l.cluster = -1 THEN v.{c} END) AS o FROM acct_vec0 v JOIN labels l USING (sender_account)"
        for c in VEC) + ")",
    TXN_VIEW, ACCT_VEC_VIEW, _DB, recursive=True))
def c7(spark, sf):
    """Inlier vs outlier feature means (raw features) and their ratio."""
    vec = _acct_vec(spark, sf)
    lab = _dbscan_acct(spark, sf)
    return DB.outlier_statistics(vec.join(lab, "sender_account"), VEC)


# -- embeddings: silhouette and profiles (labels as clusters) ---------------------------

def _emb(spark, sf):
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(f"e{i:02d}")
                                         for i in range(EMB_DIM)])


_EMB_COLS = [f"e{i:02d}" for i in range(EMB_DIM)]
_EMB_VIEW = "emb AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)"


@register("c2_silhouette", with_views(
    "SELECT " + sql_cols("silhouette:d=avg(CASE WHEN own_n <= 1 OR b IS NULL THEN 0.0 ELSE (b - a) / greatest(a, b) END), "
                         "n_points:i=count(*)") +
    " FROM (SELECT q, max(CASE WHEN lab = own THEN dsum / (cnt - 1) END) AS a, "
    "max(CASE WHEN lab = own THEN cnt END) AS own_n, min(CASE WHEN lab <> own THEN dsum / cnt END) AS b "
    "FROM (SELECT a.vec_id AS q, a.label AS own, b.label AS lab, sum(list_distance(a.e, b.e)) AS dsum, count(*) AS cnt "
    "FROM emb a, emb b GROUP BY ALL) GROUP BY q)", _EMB_VIEW))
def c2(spark, sf):
    """Exact Euclidean silhouette of the embedding labels."""
    return CL.silhouette(_emb(spark, sf), "vec_id", _EMB_COLS, "label")


@register("c3_cluster_profile", with_views(
    "SELECT " + sql_cols("label:i, " + ", ".join(
        f"{c}_mean:d=round_even(avg(e[{i + 1}]), 4), {c}_count:i=count(e[{i + 1}])"
        for i, c in enumerate(_EMB_COLS))) + " FROM emb GROUP BY label", _EMB_VIEW))
def c3(spark, sf):
    """Per-cluster mean and count of every feature."""
    return CL.cluster_profile(_emb(spark, sf), _EMB_COLS, "label")


@register("c4_cluster_summary", with_views(
    "SELECT " + sql_cols("label:i, " + ", ".join(
        f"{c}:d=round_even(avg(e[{i + 1}]), 4)" for i, c in enumerate(_EMB_COLS)) + ", count:i=count(*)")
    + " FROM emb GROUP BY label", _EMB_VIEW))
def c4(spark, sf):
    """C4: per-cluster feature means and size."""
    return CL.cluster_summary(_emb(spark, sf), _EMB_COLS, "label")


# -- seeded models (rows-only checks) -----------------------------------------------------

def _features(spark, sf):
    """Feature frame pinned in the shared checkpoint folder: model fitting
    runs several actions over it."""
    checkpoint_dir(spark)
    txn, _ = views(spark, sf)
    f = pin(FE.engineer_all_features(txn))
    return f, FE.feature_columns(f)


def _inputs(spark, sf):
    """As :func:`_features`, but only ids and model inputs are pinned: what a query never reads is not written."""
    checkpoint_dir(spark)
    txn, _ = views(spark, sf)
    f = FE.engineer_all_features(txn)
    cols = FE.feature_columns(f)
    return pin(f.select("transaction_id", *cols)), cols


@register("c1_kmeans")
def c1(spark, sf):
    """K-Means (k = 8, best of 10 seeded fits) over the 28 inputs."""
    f, cols = _features(spark, sf)
    lab, _ = CL.kmeans(f, cols, k=8, seed=42, n_init=10)
    return lab.select("transaction_id", "cluster")


@register("c5_optimal_k")
def c5(spark, sf):
    """Silhouette for k = 3..10 on one sample; the best k is flagged."""
    f, cols = _inputs(spark, sf)
    best, scores = CL.find_optimal_k(f, "transaction_id", cols, range(3, 11))
    return spark.createDataFrame([(k, float(v), int(k == best)) for k, v in scores.items()],
                                 "k long, silhouette double, is_best long")


@register("c8_pca")
def c8(spark, sf):
    """Two principal components of the standardised inputs."""
    f, cols = _features(spark, sf)
    out, ev = CL.pca_projection(f, cols, 2, keep=["transaction_id"])
    return out.withColumns({"explained_1": F.lit(ev[0]), "explained_2": F.lit(ev[1])})


@register("d2_iforest_nodes")
def d2(spark, sf):
    """The fitted forest's node table (200 trees)."""
    f, cols = _features(spark, sf)
    m = IF.fit_isolation_forest(f, "transaction_id", cols, with_offset=False)
    return spark.createDataFrame(m.nodes, IF.NODE_SCHEMA)


@register("d3_iforest_scores")
def d3(spark, sf):
    """D3 + D4: forest raw score, label and normalised score per transfer."""
    f, cols = _features(spark, sf)
    s = IF.isolation_forest_scores(f, "transaction_id", cols)
    return s.select("transaction_id", "if_raw", "if_label", "if_score")


_LOF_COLUMNS = ["amount", *FE.TIME_COLUMNS, *FE.AMOUNT_COLUMNS, *FE.NETWORK_COLUMNS, *FE.velocity_columns(FE.DEFAULT_WINDOWS)]
_Z = ", ".join(f"CASE WHEN stddev_pop({c}) OVER () > 0 THEN (coalesce({c}, 0) - avg({c}) OVER ()) / stddev_pop({c}) OVER () "
               "ELSE 0.0 END" for c in _LOF_COLUMNS)
# Up to 50,000 transfers the sample is the whole ledger, so the whole-ledger LOF is the answer.
_LOF_ALL = (f"zed AS MATERIALIZED (SELECT transaction_id AS id, [{_Z}]::DOUBLE[{len(_LOF_COLUMNS)}] AS e FROM featr), "
            f"near AS MATERIALIZED (SELECT a.id AS qid, min({{'dist': array_distance(a.e, b.e), 'rid': b.id}}, {LOF_K}) AS ns "
            "FROM zed a JOIN zed b ON a.id <> b.id GROUP BY a.id), "
            "knn AS MATERIALIZED (SELECT qid, n.rid AS rid, n.dist AS dist FROM (SELECT qid, unnest(ns) AS n FROM near)), "
            "kd AS (SELECT qid AS id, max(dist) AS kdist FROM knn GROUP BY qid), "
            "lrd AS MATERIALIZED (SELECT k.qid AS id, 1.0 / (avg(greatest(kd.kdist, k.dist)) + 1e-10) AS lrd "
            "FROM knn k JOIN kd ON kd.id = k.rid GROUP BY k.qid), "
            "lof AS (SELECT k.qid AS id, -avg(o.lrd / p.lrd) AS nof FROM knn k JOIN lrd o ON o.id = k.rid "
            "JOIN lrd p ON p.id = k.qid GROUP BY k.qid)")


@register("d7_sampled_lof", with_views(
    "SELECT " + sql_cols("transaction_id:i=id, lof_score:d=1.0 - (nof - min(nof) OVER ()) / (max(nof) OVER () - min(nof) OVER ())")
    + " FROM lof", TXN_VIEW, FEAT_VIEW, _LOF_ALL))
def d7(spark, sf):
    """LOF fitted on the default 50,000-row sample, every other row scored against it.
    A ledger of no more rows is its own sample."""
    f, cols = _inputs(spark, sf)
    return LO.sampled_lof(f, "transaction_id", cols).select("transaction_id", "lof_score")


@register("d7b_sampled_lof_score_all")
def d7b(spark, sf):
    """D7 with a small fitted sample (2,000 rows): every other row scored against it."""
    f, cols = _inputs(spark, sf)
    return LO.sampled_lof(f, "transaction_id", cols, sample_size=2000).select("transaction_id", "lof_score")


@register("d15_scoring_end_to_end")
def d15(spark, sf):
    """Features -> forest + sampled LOF + rules -> ensemble -> K-Means
    and DBSCAN labels of every row."""
    from ledgerscope.plans.scoring import score_transactions
    txn, _ = views(spark, sf)
    return score_transactions(txn)


@register("a23_cluster_business_profile")
def a23(spark, sf):
    """Business profile of K-Means clusters."""
    from ledgerscope.plans.scoring import score_transactions
    txn, _ = views(spark, sf)
    return CL.business_profile(score_transactions(txn))


@register("a24_outlier_cluster_summary")
def a24(spark, sf):
    """DBSCAN rows, outliers and rate."""
    from ledgerscope.plans.scoring import score_transactions
    txn, _ = views(spark, sf)
    return DB.outlier_cluster_summary(score_transactions(txn))


@register("c9_scatter_extract")
def c9(spark, sf):
    """Seeded scatter sample with amount, score and truth."""
    from ledgerscope.plans.q_scoring import scored_table
    return CL.scatter_extract(scored_table(spark, sf))


# -- IO round trips -------------------------------------------------------------------

@register("io4_csv_roundtrip", with_views(f"SELECT {sql_cols(TXN_SPEC)} FROM txn", TXN_VIEW))
def io4(spark, sf):
    """IO4 + IO1: land the ledger as month-partitioned CSV in the shared
    checkpoint folder and read it back with the explicit schema."""
    txn, _ = views(spark, sf)
    path = f"{checkpoint_dir(spark).rstrip('/')}/io4-{uuid.uuid4().hex}"
    IO.write_table(txn, path, fmt="csv")
    back = IO.read_transactions(spark, path, fmt="csv", id_type=T.LongType())
    return back.select(*[c for c in txn.columns])


_TEXT_IDS = ("transaction_id:s=concat('TXN', lpad(CAST(transaction_id AS VARCHAR), 8, '0')), timestamp:t, "
             "sender_account:s=concat('ACC', lpad(CAST(sender_account AS VARCHAR), 6, '0')), "
             "receiver_account:s=concat('ACC', lpad(CAST(receiver_account AS VARCHAR), 6, '0')), amount:d")


@register("io1b_text_ids", with_views(f"SELECT {sql_cols(_TEXT_IDS)} FROM txn", TXN_VIEW))
def io1b(spark, sf):
    """IO1 with text identifiers: the ledger with TXN.../ACC... ids landed as
    CSV and read back by the default (text) schema."""
    txn, _ = views(spark, sf)
    pad = lambda c, prefix, n: F.concat(F.lit(prefix), F.lpad(F.col(c).cast("string"), n, "0"))
    named = txn.withColumns({"transaction_id": pad("transaction_id", "TXN", 8),
                             "sender_account": pad("sender_account", "ACC", 6),
                             "receiver_account": pad("receiver_account", "ACC", 6)})
    path = f"{checkpoint_dir(spark).rstrip('/')}/io1b-{uuid.uuid4().hex}"
    IO.write_table(named, path, fmt="csv")
    back = IO.read_transactions(spark, path, fmt="csv")
    return back.select("transaction_id", "timestamp", "sender_account", "receiver_account", "amount")


@register("io2b_accounts_file", with_views(
    "SELECT " + sql_cols("account_id:i, account_type:s, country:s, risk_rating:s, opening_balance:d") + " FROM acct", ACCT_VIEW))
def io2b(spark, sf):
    """IO2: the account dimension landed as parquet and read by its reader."""
    _, acct = views(spark, sf)
    path = f"{checkpoint_dir(spark).rstrip('/')}/io2b-{uuid.uuid4().hex}"
    IO.write_table(acct, path, partition_by_month=False)
    return IO.read_accounts(spark, path, id_type=T.LongType()).select(*acct.columns)


@register("io3_parquet_roundtrip", with_views(f"SELECT {sql_cols(TXN_SPEC)} FROM txn", TXN_VIEW))
def io3(spark, sf):
    """IO4 + IO3: land as month-partitioned parquet and reload typed."""
    txn, _ = views(spark, sf)
    path = f"{checkpoint_dir(spark).rstrip('/')}/io3-{uuid.uuid4().hex}"
    IO.write_table(txn, path, fmt="parquet")
    return IO.read_features(spark, path).select(*txn.columns)
