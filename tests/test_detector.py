"""Detectors, ensemble and evaluation."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerscope.operators import metric_index as MI
from ledgerscope.operators import ensemble as EN
from ledgerscope.operators import evaluate as EV
from ledgerscope.operators import features as FE
from ledgerscope.operators import iforest as IF
from ledgerscope.operators import lof as LO
from ledgerscope.operators import rules as RU


def test_isolation_forest_labels_and_scores(features):
    cols = FE.feature_columns(features)
    s = IF.isolation_forest_scores(features, "transaction_id", cols, n_estimators=50)
    r = s.agg(F.min("if_score"), F.max("if_score"), F.collect_set("if_label"), F.count("*")).first()
    assert 0.0 <= r[0] and r[1] <= 1.0 and set(r[2]) <= {-1, 1} and r[3] == features.count()
    share = s.filter(F.col("if_label") == -1).count() / r[3]
    assert 0.0 < share <= 0.1


def test_iforest_isolates_an_outlier(spark):
    rng = np.random.default_rng(0)
    pts = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.normal(size=(300, 2)))]
    pts.append((999, 25.0, -25.0))
    df = spark.createDataFrame(pts, "id long, a double, b double")
    s = IF.isolation_forest_scores(df, "id", ["a", "b"], n_estimators=100)
    top = s.orderBy(F.desc("if_score")).first()
    assert top["id"] == 999 and top["if_score"] == 1.0


def test_forest_scores_follow_the_stored_nodes(features):
    """Recursive SQL walks the stored node table for every row of the ledger: scores, offset, labels and flipped scores agree."""
    duckdb = pytest.importorskip("duckdb")
    cols = FE.feature_columns(features)
    model = IF.fit_isolation_forest(features, "transaction_id", cols, n_estimators=20, contamination=0.03)
    got = {r.transaction_id: r for r in IF.isolation_forest_scores(features, "transaction_id", cols, model=model)
           .select("transaction_id", "if_raw", "if_label", "if_score").collect()}
    x = features.select("transaction_id", *cols).toPandas()  # noqa: F841 (read by the SQL)
    nodes = model.nodes  # noqa: F841
    assert set(nodes["tree"]) == set(range(20)) and (nodes[nodes["node"] == 0].groupby("tree")["size"].sum() == model.psi).all()
    scaled = ", ".join(f"(coalesce({c}::double, 0) - avg(coalesce({c}::double, 0)) over ()) / "
                       f"coalesce(nullif(stddev_pop(coalesce({c}::double, 0)) over (), 0), 1)" for c in cols)
    length = "CASE WHEN {0} > 2 THEN 2 * (ln({0} - 1) + 0.5772156649015329) - 2 * ({0} - 1) / {0} WHEN {0} = 2 THEN 1 ELSE 0 END"
    want = duckdb.sql(f"""
        WITH RECURSIVE z AS (SELECT transaction_id, [{scaled}] AS v FROM x),
        walk AS (
            SELECT z.transaction_id, n.tree, n.node, n.feature, n.threshold, n."left" AS l, n."right" AS r, n.size, n.depth
            FROM z CROSS JOIN nodes n WHERE n.node = 0
            UNION ALL
            SELECT w.transaction_id, n.tree, n.node, n.feature, n.threshold, n."left", n."right", n.size, n.depth
            FROM walk w JOIN z USING (transaction_id)
            JOIN nodes n ON n.tree = w.tree AND n.node = CASE WHEN z.v[w.feature + 1] <= w.threshold THEN w.l ELSE w.r END
            WHERE w.feature >= 0),
        raw AS (
            SELECT transaction_id, -power(2, -avg(depth + {length.format("size::double")}) / ({length.format(f"{model.psi}.0")})) AS s
            FROM walk WHERE feature < 0 GROUP BY 1 HAVING count(*) = 20),
        cut AS (SELECT quantile_cont(s, 0.03) AS q FROM raw)
        SELECT transaction_id, s, q, (max(s) OVER () - s) / (max(s) OVER () - min(s) OVER ()) AS flipped FROM raw, cut""").fetchall()
    assert len(want) == len(got) == features.count()
    assert model.offset == pytest.approx(want[0][2], rel=1e-9)
    near = 0
    for i, s, q, flipped in want:
        assert got[i].if_raw == pytest.approx(s, rel=1e-9) and got[i].if_score == pytest.approx(flipped, abs=1e-8)
        near += abs(s - q) < 1e-9
        assert abs(s - q) < 1e-9 or got[i].if_label == (-1 if s < q else 1)
    assert near < 0.01 * len(want)


def test_lof_range_and_outlier(spark):
    rng = np.random.default_rng(1)
    pts = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.normal(size=(400, 2)))]
    pts.append((999, 9.0, 9.0))
    df = spark.createDataFrame(pts, "id long, a double, b double")
    s = LO.local_outlier_factor(df, "id", ["a", "b"], k=20)
    r = s.agg(F.min("lof_score"), F.max("lof_score"), F.count("*")).first()
    assert r[0] == 0.0 and r[1] == 1.0 and r[2] == 401
    assert s.orderBy(F.desc("lof_score")).first()["id"] == 999


def _nearest(query, ref, k, exclude_self=True):
    """Brute force: {(query id, rank): (reference id, distance)}, ties by the smaller id."""
    out = {}
    for qid, *q in query:
        d = sorted((float(np.sqrt(sum((np.float64(a) - np.float64(b)) ** 2 for a, b in zip(q, r)))), rid)
                   for rid, *r in ref if not (exclude_self and rid == qid))
        out.update({(qid, n + 1): (rid, round(dist, 9)) for n, (dist, rid) in enumerate(d[:k])})
    return out


def _found(edges):
    rows = edges.collect()
    got = {(r.qid, r["rank"]): (r.rid, round(r.dist, 9)) for r in rows}
    assert len(got) == len(rows)
    return got


def test_knn_is_exact_for_any_cells_and_chunks(spark):
    from ledgerscope.operators.knn import knn_edges, nearest_rows
    rng = np.random.default_rng(2)
    pts = [(i, *map(float, v)) for i, v in enumerate(rng.integers(0, 5, size=(200, 3)))]  # many ties
    pts += [(500 + i, 1.0, 1.0, 1.0) for i in range(60)]  # many equal rows
    pts += [(800 + i, *map(float, v)) for i, v in enumerate(rng.normal(200, 0.01, size=(40, 3)))]  # a far cluster
    df = spark.createDataFrame(pts, "id long, a double, b double, c double").cache()
    cols, want = ["a", "b", "c"], _nearest(pts, pts, 7)
    for cell_rows, chunk_rows in ((10_000, 10_000), (16, 10_000), (20, 6)):
        assert _found(knn_edges(df, df, "id", cols, 7, cell_rows=cell_rows, chunk_rows=chunk_rows)) == want
    assert _found(nearest_rows(df, df, "id", cols, 7)) == want
    assert _found(nearest_rows(df, df, "id", cols, 7, broadcast_bytes=0)) == want


def test_knn_of_other_queries_and_text_ids(spark):
    from ledgerscope.operators.knn import knn_edges, nearest_rows
    rng = np.random.default_rng(4)
    pts = [(f"p{i:03d}", *map(float, v)) for i, v in enumerate(rng.normal(size=(150, 4)) * [1, 5, 0.1, 0])]
    asked = [(f"q{i}", *map(float, v)) for i, v in enumerate(rng.normal(size=(30, 4)) * 8)] + pts[:10]
    schema, cols = "id string, a double, b double, c double, d double", ["a", "b", "c", "d"]
    ref, query = spark.createDataFrame(pts, schema).cache(), spark.createDataFrame(asked, schema).cache()
    for same in (True, False):
        want = _nearest(asked, pts, 5, same)
        assert _found(knn_edges(query, ref, "id", cols, 5, same, cell_rows=10, chunk_rows=7)) == want
        assert _found(nearest_rows(query, ref, "id", cols, 5, same)) == want
    few = ref.limit(3)
    assert len(_found(knn_edges(few, few, "id", cols, 5))) == 6 and knn_edges(query, ref.limit(0), "id", cols, 5).count() == 0


def test_sampled_lof_scores_the_rest_as_new_rows(spark):
    rng = np.random.default_rng(8)
    pts = [(i, *map(float, v)) for i, v in enumerate(rng.normal(size=(300, 3)))] + [(999, 30.0, 30.0, -30.0)]
    df = spark.createDataFrame(pts, "id long, a double, b double, c double").cache()
    whole = {r.id: r.lof_score for r in LO.sampled_lof(df, "id", ["a", "b", "c"], sample_size=1000).collect()}
    plain = {r.id: r.lof_score for r in LO.local_outlier_factor(df, "id", ["a", "b", "c"]).collect()}
    assert whole.keys() == plain.keys() and all(abs(whole[i] - plain[i]) < 1e-9 for i in plain)
    part = {r.id: r.lof_score for r in LO.sampled_lof(df, "id", ["a", "b", "c"], sample_size=120).collect()}
    assert part[999] == 1.0 and len(part) == 301 and min(part.values()) == 0.0


def test_rule_scores_range_and_details(features):
    r = RU.rule_scores(features)
    for c in RU.RULE_COLUMNS + ["rule_score"]:
        assert c in r.columns
    m = r.agg(F.min("rule_score"), F.max("rule_score")).first()
    assert 0.0 <= m[0] and m[1] <= 1.0


def test_rules_degrade_with_missing_columns(ledger):
    r = RU.rule_scores(ledger[0])  # raw ledger: only amount / type rules apply
    assert r.filter(F.col("rule_rapid") != 0).count() == 0
    assert r.filter(F.col("rule_large_cash") == 1).filter(F.col("amount") <= 50000).count() == 0


def test_ensemble_threshold_monotone(spark):
    rng = np.random.default_rng(3)
    rows = [(i, *map(float, rng.random(3))) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double")
    counts = []
    for t in (0.3, 0.5, 0.7):
        e = EN.combine_scores(df, {"isolation_forest": "a", "lof": "b", "rules": "c"}, threshold=t)
        counts.append(e.filter(F.col("is_alert") == 1).count())
    assert counts[0] >= counts[1] >= counts[2]
    e = EN.combine_scores(df, {"isolation_forest": "a", "lof": "b", "rules": "c"}).collect()
    for r in e[:10]:
        assert abs(r["ensemble_score"] - (0.35 * r["a"] + 0.25 * r["b"] + 0.4 * r["c"])) < 1e-12


def test_ensemble_requires_a_weighted_detector(spark):
    df = spark.range(3).withColumn("x", F.lit(0.5))
    with pytest.raises(ValueError):
        EN.combine_scores(df, {"unknown": "x"})


def test_edge_scores_inclusive_threshold(spark):
    df = spark.createDataFrame([(1, 0.5), (2, 0.5)], "id long, s double")
    e = EN.combine_scores(df, {"rules": "s"}, threshold=0.5)
    assert e.filter(F.col("is_alert") == 1).count() == 2
    from ledgerscope.operators.scale import minmax_flip
    assert minmax_flip(df, "s", "n").agg(F.max("n")).first()[0] == 0.0


def test_detection_metrics_fixture(spark):
    truth = [1, 1, 0, 0, 1, 0, 0, 1]
    pred = [1, 0, 0, 1, 1, 0, 0, 1]
    df = spark.createDataFrame(list(zip(truth, pred)), "is_suspicious int, is_alert int")
    m = EV.evaluate_detection(df).first()
    assert (m.true_positives, m.false_positives, m.false_negatives, m.true_negatives) == (3, 1, 1, 3)
    assert m.precision == m.recall == m.f1_score == 0.75


def test_edge_labels_single_class(spark):
    df = spark.createDataFrame([(0, 0)] * 5, "is_suspicious int, is_alert int")
    m = EV.evaluate_detection(df).first()
    assert (m.true_negatives, m.precision, m.recall) == (0, 0.0, 0.0)


def test_alert_volume_monotone(spark):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(float(x),) for x in rng.random(5000)], "ensemble_score double")
    v = EV.alert_volume(df).orderBy("threshold").collect()
    assert [r.threshold for r in v] == EV.DEFAULT_THRESHOLDS
    n = [r.n_alerts for r in v]
    assert n == sorted(n, reverse=True)
    assert abs(v[0].daily_alerts_est - n[0] / 365) < 1e-12


def test_search_reuses_its_products(monkeypatch):
    """Distance products of a search lie in one scratch array, and the answer is that of all pairs, crowded leaves included."""
    rng = np.random.default_rng(8)
    monkeypatch.setattr(MI, "REF_BLOCK", 300)
    ref = np.concatenate([rng.normal(size=(1500, 6)), np.repeat(rng.normal(size=(1, 6)), 500, axis=0)])
    q = np.concatenate([rng.normal(size=(400, 6)), ref[1490:1510]])
    own = np.concatenate([np.full(400, -1), np.arange(1490, 1510)])
    at, dot = set(), np.matmul
    monkeypatch.setattr(MI.np, "matmul", lambda a, b, out: at.add(out.ctypes.data) or dot(a, b, out=out))
    i, d2, code = MI.search(MI.build(ref, np.arange(len(ref))), q, own, 5)
    assert 1 <= len(at) <= 6  # the scratch array, and one for each visit to the leaf that it cannot hold
    far = MI.exact_squared(np.repeat(q, len(ref), axis=0), np.tile(ref, (len(q), 1))).reshape(len(q), -1)
    far[np.arange(400, 420), own[400:]] = np.inf
    want = np.argsort(far, axis=1, kind="stable")[:, :5]
    assert np.array_equal(code.reshape(-1, 5), want) and np.array_equal(i.reshape(-1, 5)[:, 0], np.arange(len(q)))
    assert np.array_equal(d2.reshape(-1, 5), np.take_along_axis(far, want, axis=1))


@pytest.mark.parametrize("make, single", [(lambda x: x, True), (lambda x: np.concatenate([x, x[:9] + 1e7]), False), (lambda x: x * 1e-25, False),
                                          (lambda x: x * 1e18, False), (lambda x: np.repeat(x[::40], 40, axis=0), False)])
def test_search_screens_in_single_precision(monkeypatch, make, single):
    """Products are single where their rounding is small beside the distances, double otherwise; the answer is that of all pairs."""
    monkeypatch.setattr(MI, "REF_BLOCK", 300)
    x = make(np.random.default_rng(9).normal(size=(2400, 6)))
    q, own, kinds, dot = x[-300:], np.arange(len(x) - 300, len(x)), set(), np.matmul
    monkeypatch.setattr(MI.np, "matmul", lambda a, b, out: kinds.add(out.dtype.itemsize) or dot(a, b, out=out))
    i, d2, code = MI.search(MI.build(x, np.arange(len(x))), q, own, 5)
    assert (4 in kinds) == single and 8 in kinds
    far = MI.exact_squared(np.repeat(q, len(x), axis=0), np.tile(x, (len(q), 1))).reshape(len(q), -1)
    far[np.arange(300), own] = np.inf
    want = np.argsort(far, axis=1, kind="stable")[:, :5]
    assert np.array_equal(code.reshape(-1, 5), want)
    assert np.array_equal(d2.reshape(-1, 5), np.take_along_axis(far, want, axis=1))
