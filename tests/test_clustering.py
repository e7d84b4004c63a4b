"""Clustering, silhouette, DBSCAN, quantiles and sequential ids."""

import numpy as np
from pyspark import RDD
from pyspark.ml.clustering import KMeans
from pyspark.sql import functions as F

from ledgerscope.operators import clustering as CL
from ledgerscope.operators import dbscan as DB
from ledgerscope.operators.quantiles import exact_quantiles
from ledgerscope.operators.sampling import sample_exact, sequential_ids


def _blobs(spark, n=200, centers=(0.0, 5.0, -5.0), dims=5, seed=0):
    rng = np.random.default_rng(seed)
    rows, lab = [], []
    i = 0
    for c, m in enumerate(centers):
        for v in rng.normal(m, 1.0, size=(n, dims)):
            rows.append((i, c, *map(float, v)))
            i += 1
    cols = [f"x{j}" for j in range(dims)]
    return spark.createDataFrame(rows, "id long, truth long, " + ", ".join(f"{c} double" for c in cols)), cols


def test_kmeans_finds_three_blobs(spark):
    df, cols = _blobs(spark)
    lab, _ = CL.kmeans(df, cols, k=3, n_init=3)
    pairs = lab.groupBy("truth").agg(F.count_distinct("cluster").alias("n")).collect()
    assert all(r.n == 1 for r in pairs)
    assert CL.cluster_summary(lab, cols).count() == 3


def test_kmeans_starts_share_passes(spark, monkeypatch):
    """Every start ends where Spark's own fit of its seed ends; the passes are those of the longest fit."""
    df, cols = _blobs(spark, n=400)
    x = CL._assemble(CL.standardize(df, cols)[0], cols).select("_features").cache()
    want = [KMeans(k=5, seed=42 + i, maxIter=300, featuresCol="_features").fit(x) for i in range(4)]
    fits, passes, lloyd, collect = [], [], CL._lloyd, RDD.collect
    monkeypatch.setattr(RDD, "collect", lambda rdd: passes.append(1) or collect(rdd))
    monkeypatch.setattr(CL, "_lloyd", lambda *a: fits.extend(lloyd(*a)) or fits)
    _, best = CL.kmeans(df, cols, k=5, n_init=4)
    assert [f.numIter for f in fits] == [m.summary.numIter for m in want]
    assert np.allclose([f.trainingCost for f in fits], [m.summary.trainingCost for m in want])
    assert all(np.allclose(f.clusterCenters(), m.clusterCenters()) for f, m in zip(fits, want))
    assert len(passes) == max(f.numIter for f in fits) and best.trainingCost == min(f.trainingCost for f in fits)
    x.unpersist()


def test_kmeans_pass_is_one_task_a_core(spark, monkeypatch):
    """However the input is dealt, a pass has one task a core; equal centres tie to the first, a row that is no number goes to the first, too."""
    df, cols = _blobs(spark, n=100)
    tasks, lloyd = [], CL._lloyd
    monkeypatch.setattr(CL, "_lloyd", lambda b, *a: tasks.append(b.getNumPartitions()) or lloyd(b, *a))
    CL.kmeans(df.repartition(40), cols, k=3, n_init=1)
    assert tasks == [spark.sparkContext.defaultParallelism]
    x = np.array([[0.0, 0.0], [0.0, 2.0], [10.0, 0.0], [10.0, 2.0]])
    start = np.array([[0.0, 1.0], [0.0, 1.0], [9.0, 1.0]])
    fit, = lloyd(spark.sparkContext.parallelize([x.tobytes()]), [start], 1, 1e-4)
    assert np.allclose(fit.centres, [[0.0, 1.0], [0.0, 1.0], [10.0, 1.0]]) and np.isclose(fit.trainingCost, 1 + 1 + 2 + 2)
    odd = np.array([[0.0, 0.0], [np.nan, 1.0]])
    fit, = lloyd(spark.sparkContext.parallelize([odd.tobytes()]), [start[1:]], 1, 1e-4)
    assert np.isnan(fit.centres[0]).any() and np.array_equal(fit.centres[1], start[2])


def test_silhouette_matches_brute_force(spark):
    df, cols = _blobs(spark, n=60, dims=3)
    got = CL.silhouette(df, "id", cols, "truth", block_rows=50).first()["silhouette"]
    pdf = df.toPandas()
    X, y = pdf[cols].to_numpy(), pdf["truth"].to_numpy()
    d = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1))
    s = []
    for i in range(len(X)):
        own = y == y[i]
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, y == c].mean() for c in set(y) if c != y[i])
        s.append((b - a) / max(a, b))
    assert abs(got - np.mean(s)) < 1e-9


def test_dbscan_cluster_and_noise(spark):
    rng = np.random.default_rng(5)
    pts = [(i, *map(float, v)) for i, v in enumerate(rng.normal(0, 0.3, size=(500, 3)))]
    pts += [(1000 + i, float(8 + 3 * i), 20.0 - i, 8.0) for i in range(5)]
    df = spark.createDataFrame(pts, "id long, a double, b double, c double")
    lab = DB.dbscan(df, "id", ["a", "b", "c"], eps=0.5, min_samples=10, scale=False)
    out = {r["id"]: r["cluster"] for r in lab.collect()}
    assert all(out[1000 + i] == -1 for i in range(5))
    assert out[0] == 0
    stats = DB.outlier_statistics(df.join(lab, "id"), ["a", "b", "c"]).collect()
    assert {r.feature for r in stats} == {"a", "b", "c"}


def test_dbscan_border_takes_lowest_cluster(spark):
    # two dense lines (clusters 0 and 1) and one border point touching both
    pts = [(i, float(i) * 0.1, 0.0) for i in range(10)] + [(100 + i, 1.9 + i * 0.1, 0.0) for i in range(10)]
    pts.append((50, 1.4, 0.0))  # within 0.5 of both ends, not core
    df = spark.createDataFrame(pts, "id long, a double, b double")
    lab = {r["id"]: (r["cluster"], r["is_core"]) for r in
           DB.dbscan(df, "id", ["a", "b"], eps=0.5, min_samples=5, scale=False).collect()}
    assert lab[0][0] == 0 and lab[100][0] == 1
    assert lab[50] == (0, 0)


def _plain_dbscan(ids, x, eps, min_samples):
    """Labels by all pairs: components of core points in the order of their smallest id, borders to the lowest."""
    d = np.zeros((len(x), len(x)))
    for j in range(x.shape[1]):
        d += (x[:, None, j] - x[None, :, j]) ** 2
    near = np.sqrt(d) <= eps
    core = near.sum(axis=1) >= min_samples
    label, n = np.full(len(x), -1), 0
    for s in sorted(np.flatnonzero(core), key=lambda i: ids[i]):
        if label[s] < 0:
            todo, label[s] = [s], n
            while todo:
                for j in np.flatnonzero(near[todo.pop()] & core & (label < 0)):
                    label[j] = n
                    todo.append(j)
            n += 1
    out = label.copy()
    for i in np.flatnonzero(~core):
        touched = label[near[i] & core]
        out[i] = touched.min() if len(touched) else -1
    return out, core


def test_dbscan_equals_all_pairs(spark):
    """Uneven density, copies, exact ties at eps and a crowded cell, with one cell and with many, whole and cut."""
    rng = np.random.default_rng(11)
    dense, loose = rng.normal(0, 0.15, size=(500, 3)), rng.normal(0, 2.0, size=(300, 3))
    line = np.stack([3 + 0.25 * np.arange(60), np.full(60, 3.0), np.zeros(60)], axis=1)  # steps of exactly eps / 2
    ring = np.stack([5 * np.cos(np.arange(250) / 40), 5 * np.sin(np.arange(250) / 40), rng.normal(0, 0.02, 250)], axis=1)
    x = np.concatenate([dense, loose, line, ring, np.repeat([[9.0, 9.0, 9.0]], 30, axis=0), np.repeat([[-9.0, 0.0, 0.0]], 3, axis=0)])
    ids = rng.permutation(len(x)) + 10
    df = spark.createDataFrame([(int(i), *map(float, v)) for i, v in zip(ids, x)], "id long, a double, b double, c double")
    want, core = _plain_dbscan(ids, x, 0.5, 5)
    assert want.max() > 2 and (want == -1).any() and ((want >= 0) & ~core).any()
    for cell_rows, chunk_rows in ((10 ** 6, 10 ** 6), (60, 10 ** 6), (300, 70)):
        got = {r["id"]: (r["cluster"], r["is_core"], r["is_noise"]) for r in DB.dbscan(
            df, "id", ["a", "b", "c"], 0.5, 5, scale=False, cell_rows=cell_rows, chunk_rows=chunk_rows).collect()}
        assert got == {int(i): (int(w), int(k), int(w == -1)) for i, w, k in zip(ids, want, core)}


def test_dbscan_odd_rows(spark):
    """Rows without an id are clustered, rows with a missing or endless input are noise, no rows give none."""
    nan, inf = float("nan"), float("inf")
    rows = [(None, 0.0, 0.0), (1, 0.0, -0.0), (1, 0.1, 0.0), (2, nan, 0.0), (3, None, 0.0), (4, inf, 0.0), (5, 7.0, 7.0)]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    got = sorted(((r["id"] or 0), r["cluster"], r["is_core"]) for r in DB.dbscan(df, "id", ["a", "b"], 0.5, 3, scale=False).collect())
    assert got == [(0, 0, 1), (1, 0, 1), (1, 0, 1), (2, -1, 0), (3, -1, 0), (4, -1, 0), (5, -1, 0)]
    assert DB.dbscan(df.filter("false"), "id", ["a", "b"]).count() == 0


def test_optimal_k_in_range(spark):
    df, cols = _blobs(spark, n=60)
    best, scores = CL.find_optimal_k(df, "id", cols, range(2, 5), n_init=1)
    assert best in scores and best == 3


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(6)
    vals = rng.integers(0, 50, size=3000).astype(float)  # ties
    grp = np.where(rng.random(3000) < 0.9, 0, 1)  # one hot group
    df = spark.createDataFrame([(int(g), float(v)) for g, v in zip(grp, vals)], "g long, v double")
    q = {r["g"]: r for r in exact_quantiles(df, "v", [0, 0.25, 0.5, 0.75, 1], ["g"], num_partitions=7).collect()}
    for g in (0, 1):
        want = np.percentile(vals[grp == g], [0, 25, 50, 75, 100])
        got = [q[g][f"q{i}"] for i in range(5)]
        assert np.allclose(got, want)


def test_sequential_ids_and_sample(spark, ledger):
    txn = ledger[0]
    s = sequential_ids(txn.select("transaction_id", "timestamp"), num_partitions=5)
    got = [r["transaction_id"] for r in s.orderBy("seq").collect()]
    want = [r["transaction_id"] for r in txn.orderBy("timestamp", "transaction_id").collect()]
    assert got == want and s.agg(F.max("seq")).first()[0] == len(want) - 1
    a = {r[0] for r in sample_exact(txn, 100, seed=7).select("transaction_id").collect()}
    b = {r[0] for r in sample_exact(txn.repartition(3), 100, seed=7).select("transaction_id").collect()}
    assert len(a) == 100 and a == b


def test_exact_quantiles_small_path_agrees(spark):
    rng = np.random.default_rng(9)
    df = spark.createDataFrame([(int(g), float(v)) for g, v in zip(rng.integers(0, 3, 500), rng.random(500))],
                               "g long, v double")
    probs = [0.03, 0.5, 0.97]
    a = {r["g"]: tuple(r)[1:] for r in exact_quantiles(df, "v", probs, ["g"]).collect()}
    b = {r["g"]: tuple(r)[1:] for r in exact_quantiles(df, "v", probs, ["g"]).collect()}
    assert a.keys() == b.keys() and all(np.allclose(a[k], b[k]) for k in a)


def test_silhouette_of_lone_points_and_copies(spark):
    """A cluster of one point scores 0, as does a point whose every distance is 0; several labellings share the distances."""
    rows = [(0, 0.0, 0, 0), (1, 1.0, 0, 1), (2, 9.0, 1, 1), (3, 5.0, 2, 0)]
    df = spark.createDataFrame(rows, "id long, x double, a int, b int")
    one = CL.silhouette(df, "id", ["x"], "a").first()["silhouette"]
    # ids 0 and 1: own distance 1, the nearest other cluster (id 3) at 5 and 4; ids 2 and 3 are alone.
    assert abs(one - ((5 - 1) / 5 + (4 - 1) / 4) / 4) < 1e-12
    assert np.allclose(CL.silhouettes(df, "id", ["x"], ["a", "b"]),
                       [CL.silhouette(df, "id", ["x"], c).first()["silhouette"] for c in ("a", "b")])
    same = spark.createDataFrame([(0, 2.0, 0), (1, 2.0, 0), (2, 2.0, 1), (3, 2.0, 1)], "id long, x double, a int")
    assert CL.silhouette(same, "id", ["x"], "a").first()["silhouette"] == 0.0


def test_optimal_k_over_many_columns(spark, monkeypatch):
    """28 columns do not drown the optimizer; all fits of all k share their passes; a far point alone in its cluster is no error."""
    df, cols = _blobs(spark, n=20, dims=28)
    df = df.union(spark.createDataFrame([(999, 9, *[1e3] * 28)], df.schema))
    calls, lloyd = [], CL._lloyd
    monkeypatch.setattr(CL, "_lloyd", lambda b, starts, *a: calls.append(len(starts)) or lloyd(b, starts, *a))
    best, scores = CL.find_optimal_k(df, "id", cols, range(2, 5), n_init=2)
    assert calls == [6] and best == max(scores, key=lambda k: (scores[k], -k))
    z = CL.standardize(df, cols)[0]
    lab = CL.kmeans(z, cols, k=3, seed=42, n_init=2, scale=False, out="k")[0].toPandas()
    x, y = lab[cols].to_numpy(), lab["k"].to_numpy()
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    s = []
    for i in range(len(x)):
        own = y == y[i]
        a, b = d[i, own].sum() / max(own.sum() - 1, 1), min(d[i, y == c].mean() for c in set(y) if c != y[i])
        s.append(0.0 if own.sum() == 1 else (b - a) / max(a, b))
    assert abs(scores[3] - np.mean(s)) < 1e-9


def test_dbscan_measures_only_near_boxes(monkeypatch):
    """Points that one coordinate keeps apart are not measured, however wide their balls are; weights, components and borders agree with all pairs."""
    from ledgerscope.operators import density as DE
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(0, 0.4, (1500, 12)), rng.integers(0, 2, (1500, 3)) * 3.0], axis=1)
    x[:300, :12] = rng.normal(0, 0.02, (300, 12))
    w, pairs, plain = rng.integers(1, 4, len(x)), [], DE.within
    monkeypatch.setattr(DE, "within", lambda a, b, eps: pairs.append(len(a) * len(b)) or plain(a, b, eps))
    got = DE.neighbour_weights(x, x, w, 0.5, 10)
    assert sum(pairs) < len(x) ** 2 / 2
    near = np.array([np.sqrt(((x - r) ** 2).sum(axis=1)) <= 0.5 for r in x])
    want = near @ w
    assert (np.minimum(got, 10) == np.minimum(want, 10)).all()
    core = want >= 10
    root = DE.core_components(x[core], np.arange(core.sum()), x[core], np.arange(core.sum()), int(core.sum()), 0.5)
    link, label = near[np.ix_(core, core)], np.arange(core.sum())
    while True:
        new = np.where(link, label[None, :], len(label)).min(axis=1)
        if (new == label).all():
            break
        label = new
    assert (root == label).all()
    i, c = DE.border_contacts(x[~core], x[core], root, 0.5)
    r, k = np.nonzero(near[np.ix_(~core, core)])
    assert set(zip(i.tolist(), c.tolist())) == set(zip(r.tolist(), root[k].tolist()))


def test_kmeans_starts_share_one_cached_input(spark, monkeypatch):
    """Every start reads the same cached vectors (of an input that is not cached each fit persists its own copy), and they are released."""
    df, cols = _blobs(spark, n=50)
    seen, fit = [], KMeans.fit
    monkeypatch.setattr(KMeans, "fit", lambda self, data: seen.append((id(data), data.storageLevel.useMemory)) or fit(self, data))
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    CL.kmeans(df, cols, k=3, n_init=3)
    assert len(seen) == 3 and len(set(seen)) == 1 and seen[0][1]
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) <= before


def test_silhouette_of_a_missing_value_stays_in_its_cluster(spark):
    """A row that is no number spoils the sums of its own cluster, not those of the others."""
    from ledgerscope.operators.knn import cluster_distance_sums
    rows = [(0, 0.0, 0), (1, 1.0, 0), (2, 5.0, 1), (3, None, 2), (4, 7.0, 1)]
    df = spark.createDataFrame(rows, "id long, x double, a int")
    got = {(r.qid, r.lab): r.dsum for r in cluster_distance_sums(df, "id", ["x"], "a").collect()}
    assert got[0, 0] == 1.0 and got[0, 1] == 12.0 and got[2, 0] == 9.0 and np.isnan(got[0, 2] if got[0, 2] is not None else np.nan)
