"""End-to-end scoring (D15): the scored table is written once and what is derived from it is checked in SQL."""

import numpy as np
import pytest

from ledgerscope.operators import clustering as CL
from ledgerscope.operators import dbscan as DB
from ledgerscope.plans.scoring import OUTPUT_COLUMNS, score_transactions

duckdb = pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def scored(spark, ledger, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("scored") / "table")
    score_transactions(ledger[0], n_estimators=20, lof_sample=400, km_n_init=2).write.parquet(path)
    return spark.read.parquet(path), path


def test_scored_table_is_whole(scored, ledger):
    table, _ = scored
    assert table.columns == OUTPUT_COLUMNS
    ids = [r[0] for r in table.select("transaction_id").collect()]
    assert sorted(ids) == sorted(r[0] for r in ledger[0].select("transaction_id").collect())


def test_three_detectors_make_the_ensemble(scored):
    _, path = scored
    n, off, wrong, low, high, used = duckdb.sql(f"""
        SELECT count(*), max(abs(ensemble_score - (0.35 * if_score + 0.25 * lof_score + 0.40 * rule_score))),
               count(*) FILTER (is_alert <> (ensemble_score >= 0.5)::int),
               min(least(if_score, lof_score, rule_score)), max(greatest(if_score, lof_score, rule_score)),
               (count(DISTINCT if_score) > 1)::int + (count(DISTINCT lof_score) > 1)::int + (count(DISTINCT rule_score) > 1)::int
        FROM '{path}/*.parquet'""").fetchall()[0]
    assert n > 0 and off < 1e-12 and wrong == 0 and 0 <= low and high <= 1 and used == 3


def test_cluster_profile_and_outlier_summary(scored):
    table, path = scored
    got = sorted(tuple(r) for r in CL.business_profile(table).collect())
    want = duckdb.sql(f"""
        SELECT km_cluster, count(*), avg(amount), avg(ensemble_score), avg(is_alert::double), avg(is_suspicious::double)
        FROM '{path}/*.parquet' GROUP BY 1 ORDER BY 1""").fetchall()
    assert len(want) > 1 and [g[:2] for g in got] == [w[:2] for w in want]
    for g, w in zip(got, want):
        assert all(abs(a - b) <= 5.1e-5 for a, b in zip(g[2:], w[2:]))
    sampled, out, rate = DB.outlier_cluster_summary(table).first()
    assert (sampled, out) == duckdb.sql(f"SELECT count(*), count(*) FILTER (db_cluster = -1) FROM '{path}/*.parquet' "
                                        "WHERE db_cluster <> -2").fetchall()[0]
    assert rate == pytest.approx(out / sampled)


def test_kmeans_rows_sit_at_their_nearest_centre(spark):
    """Labels follow the returned centres, and the best of several starts is the one of least cost."""
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(c, s, (n, 3)) for c, s, n in ((0, 1, 300), (6, .5, 120), (-9, 2, 80))]) * [1, 50, .01]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, a double, b double, c double")
    labelled, model = CL.kmeans(df, ["a", "b", "c"], k=3, n_init=3)
    assert set(labelled.columns) == {"id", "a", "b", "c", "cluster"}
    centres = np.array(model.clusterCenters())
    z = (x - x.mean(0)) / x.std(0)
    far = ((z[:, None, :] - centres[None]) ** 2).sum(2)
    label = {r.id: r.cluster for r in labelled.select("id", "cluster").collect()}
    assert len(label) == len(x) and all(far[i, label[i]] <= far[i].min() + 1e-9 for i in label)
    own = np.array([label[i] for i in range(len(x))])
    assert np.allclose([z[own == k].mean(0) for k in range(3)], centres, atol=1e-2)
    one = min(CL.kmeans(df, ["a", "b", "c"], k=3, seed=42 + i, n_init=1)[1].summary.trainingCost for i in range(3))
    assert model.summary.trainingCost == pytest.approx(one)


def test_detectors_run_side_by_side(ledger, monkeypatch):
    """Forest, LOF and DBSCAN have all begun before any of them ends."""
    from threading import Barrier

    from ledgerscope.plans import scoring as SC

    class Together(Exception):
        pass

    begun = Barrier(3)

    def detector(*args, **kwargs):
        begun.wait(30)
        raise Together

    for module, name in ((SC.IF, "isolation_forest_scores"), (SC.LO, "sampled_lof"), (SC.DB, "dbscan")):
        monkeypatch.setattr(module, name, detector)
    with pytest.raises(Together):
        score_transactions(ledger[0])
