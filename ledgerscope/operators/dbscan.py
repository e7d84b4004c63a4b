"""DBSCAN (C6) and outlier statistics (C7) over metric cells, without a pair table.

* equal rows are one weighted point, so copies cost nothing.
* cells: seeded pivots cut the points (nearest pivot). A point is at home in one cell and
  visits every cell that can hold a point within eps of it, by the covering radius and by the
  half-plane between two pivots. So a cell and its visitors hold all neighbours of its points.
* tasks: a cell, or for a crowded one every chunk of its points against every chunk of points and
  visitors. Inside a task balls of points are compared
  (:mod:`ledgerscope.operators.density`): a ball of diameter eps with min_samples points is all core.
* core points: weight within eps (self included) >= min_samples, summed over tasks.
* clusters: a task names the component of each core point it sees; components of
  different tasks that share a point are joined by min-label propagation with pointer jumping. That
  graph has one node a component, not one a point; each round is checkpointed to the
  shared checkpoint folder so lineage stays short.
* numbering as the reference: clusters ordered by their smallest core id;
  a border point joins the lowest-numbered cluster among its core neighbours.

Rows without an id are clustered like any other; rows with a null, NaN or infinite input
(only possible with ``scale=False`` for null) are noise.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerscope.operators import density as DE
from ledgerscope.operators import metric_index as MI
from ledgerscope.operators.sampling import sample_exact, sequential_ids
from ledgerscope.operators.scale import standardize
from ledgerscope.session import checkpoint_dir, pin

NOISE = -1
NOT_SAMPLED = -2
CELL_ROWS = 4096      # points a pivot, on average
MAX_PIVOTS = 8192     # pivots are broadcast; beyond it cells grow and are cut into chunks
CHUNK_ROWS = 16384    # points of a cell, or of its visitors, in one task


def connected_min_labels(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, comp) with comp = smallest id in the node's component.
    ``edges`` (a, b) must be symmetric. Labels only fall, so the loop ends."""
    spark = nodes.sparkSession
    checkpoint_dir(spark)
    lab = pin(nodes.select(F.col("id"), F.col("id").alias("comp")), cache=False)
    while True:
        nb = (edges.join(lab, edges.b == lab.id).groupBy("a").agg(F.min("comp").alias("nmin"))
              .withColumnRenamed("a", "id"))
        new = (lab.join(nb, "id", "left")
               .select("id", F.least("comp", F.coalesce("nmin", "comp")).alias("comp")))
        # Pointer jumping: adopt the label of your label.
        hop = new.select(F.col("id").alias("_j"), F.col("comp").alias("_jc"))
        new = (new.join(hop, new.comp == hop._j, "left")
               .select("id", F.least("comp", F.coalesce("_jc", "comp")).alias("comp")))
        new = pin(new, cache=False)  # inputs are pinned: cheap to recompute
        changed = new.join(lab.withColumnRenamed("comp", "_old"), "id").filter(
            F.col("comp") != F.col("_old")).limit(1).count()
        lab = new
        if changed == 0:
            break
    return lab


def _placed(points: DataFrame, xs: list[str], eps: float, cell_rows: int) -> DataFrame:
    """(key, weight, xs, cell, home): each point in its own cell (home) and in every cell that can hold
    a point within eps of it. Written once."""
    cells = max(1, min(MAX_PIVOTS, math.ceil(points.count() / cell_rows)))
    pivots = sample_exact(points, cells, 7, "key").select(*xs).toPandas().to_numpy(float)
    sc, vec = points.sparkSession.sparkContext, ", ".join(f"{x} double" for x in xs)
    tops = sc.broadcast(pivots)
    base = f"key long, weight long, {vec}, cell long"

    def assign(batches):
        for b in batches:
            x = b[xs].to_numpy(float)
            at = [MI.squared(x[i:i + 2048], tops.value) for i in range(0, len(x), 2048)]
            yield b.assign(cell=np.concatenate([d.argmin(axis=1) for d in at] or [np.zeros(0, np.int64)]),
                           away=np.sqrt(np.concatenate([d.min(axis=1) for d in at] or [np.zeros(0)])))

    homes = pin(points.select("key", "weight", *xs).mapInPandas(assign, f"{base}, away double"))
    widest = homes.groupBy("cell").agg(F.max("away").alias("radius")).toPandas()  # one row a pivot
    radius = np.full(len(pivots), -np.inf)
    radius[widest["cell"]] = widest["radius"]
    reach = sc.broadcast(radius)

    def visit(batches):
        p, far = tops.value, reach.value
        pn = (p * p).sum(axis=1)
        for b in batches:
            for i in range(0, len(b), 2048):
                part = b.iloc[i:i + 2048]
                x, own = part[xs].to_numpy(float), part["cell"].to_numpy()
                n2 = (x * x).sum(axis=1)[:, None] + pn[None, :] + (eps * eps + pn[own])[:, None]
                blur = 4 * DE._rounding(x.shape[1], n2)
                d2 = MI.squared(x, p)
                to_radius = np.sqrt(d2) - far[None, :] - 1e-6 * (1.0 + np.sqrt(n2)) <= eps
                between = np.sqrt(MI.squared(p[own], p) + blur)  # own pivot to the other one
                to_plane = d2 - d2[np.arange(len(x)), own][:, None] - blur <= 2.0 * eps * (1.0 + 1e-9) * between
                near = to_radius & to_plane
                near[np.arange(len(x)), own] = True
                r, c = np.nonzero(near)
                yield part.iloc[r].drop(columns=["away"]).assign(cell=c, home=own[r] == c)

    return pin(homes.mapInPandas(visit, f"{base}, home boolean"))


def _chunked(placed: DataFrame, sizes: DataFrame) -> DataFrame:
    """Rows of the tasks (cell, i, j): chunk i of a cell's points, ``asked``, against chunk j of its points
    and visitors, ``other``. A cell of one chunk sends each row once, in both parts."""
    rows = placed.join(F.broadcast(sizes), "cell")
    chunk = lambda n: F.pmod(F.xxhash64("key", F.lit(3)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    one, many = rows.filter("others = 1"), rows.filter("others > 1")
    none, yes, no = F.lit(0), F.lit(True), F.lit(False)
    return (one.withColumns({"i": none, "j": none, "asked": F.col("home"), "other": yes})
            .unionByName(many.filter("home").withColumns({"i": chunk("homes"), "asked": yes, "other": no}).withColumn("j", every("others")))
            .unionByName(many.withColumns({"j": chunk("others"), "asked": no, "other": yes}).withColumn("i", every("homes")))
            .drop("homes", "others", "home"))


def dbscan(df: DataFrame, id_col: str, cols: list[str], eps: float = 0.5, min_samples: int = 10, scale: bool = True,
           cell_rows: int = CELL_ROWS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(id, cluster, is_core, is_noise); cluster -1 is noise."""
    checkpoint_dir(df.sparkSession)
    x = standardize(df, cols)[0] if scale else df
    xs = [f"x{i}" for i in range(len(cols))]
    # Rows meet their point again by its coordinates, so these are written once.
    flat = pin(x.select(F.col(id_col).alias("id"), *[F.col(c).cast("double").alias(v) for c, v in zip(cols, xs)]))
    finite = F.lit(True)
    for v in xs:
        finite = finite & (F.abs(v) < F.lit(float("inf")))
    points = pin(flat.filter(finite).groupBy(*xs).agg(F.count(F.lit(1)).alias("weight"), F.min("id").alias("first"))
                 .withColumn("key", F.monotonically_increasing_id()))
    placed = _placed(points, xs, eps, cell_rows)
    # One row a cell: bounded by the number of pivots.
    parts = lambda n: F.ceil(n / F.lit(chunk_rows)).cast("int")
    sizes = pin(placed.groupBy("cell").agg(parts(F.greatest(F.count_if("home"), F.lit(1))).alias("homes"),
                                           parts(F.count(F.lit(1))).alias("others")), cache=False)

    # A task's work is far more than its bytes: their number is named, or few would hold all of them.
    pairs = sizes.agg(F.sum(F.col("homes") * F.col("others"))).first()[0] or 1
    tasks = int(min(pairs, max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.sparkSession.sparkContext.defaultParallelism)))

    def dealt(rows: DataFrame):
        return _chunked(rows, sizes).repartition(tasks, "cell", "i", "j").groupBy("cell", "i", "j")

    def weigh(t: pd.DataFrame) -> pd.DataFrame:
        a, o = t[t["asked"]], t[t["other"]]
        got = DE.neighbour_weights(a[xs].to_numpy(float), o[xs].to_numpy(float), o["weight"].to_numpy(), eps, min_samples)
        return pd.DataFrame({"key": a["key"].to_numpy(), "weight": got})

    core = pin(dealt(placed).applyInPandas(weigh, "key long, weight long")
               .groupBy("key").agg(F.sum("weight").alias("weight")).filter(F.col("weight") >= min_samples)
               .select("key", F.lit(True).alias("is_core")))

    def link(t: pd.DataFrame) -> pd.DataFrame:
        dense = t["is_core"].to_numpy(bool)
        a, o, b = t[t["asked"] & dense], t[t["other"] & dense], t[t["asked"] & ~dense]
        names, node = np.unique(np.concatenate([a["key"].to_numpy(), o["key"].to_numpy()]), return_inverse=True)
        ax, ox = a[xs].to_numpy(float), o[xs].to_numpy(float)
        root = DE.core_components(ax, node[:len(a)], ox, node[len(a):], len(names), eps)
        i, c = DE.border_contacts(b[xs].to_numpy(float), ox, root[node[len(a):]], eps)
        return pd.DataFrame({"key": np.concatenate([names, b["key"].to_numpy()[i]]), "part": np.concatenate([names[root], names[c]]),
                             "border": np.repeat([False, True], [len(names), len(i)])})

    marked = placed.join(core, "key", "left").withColumn("is_core", F.coalesce("is_core", F.lit(False))).filter("home OR is_core")
    links = pin(dealt(marked).applyInPandas(link, "key long, part long, border boolean"))
    seen = links.filter("NOT border")
    own = pin(seen.groupBy("key").agg(F.min("part").alias("part")), cache=False)
    shared = (seen.select("key", F.col("part").alias("b")).join(own.withColumnRenamed("part", "a"), "key")
              .filter(F.col("a") != F.col("b")).select("a", "b"))
    edges = pin(shared.union(shared.select("b", "a")).distinct())
    comp = connected_min_labels(seen.select(F.col("part").alias("id")).distinct(), edges)
    named = comp.withColumnRenamed("id", "part")
    core_comp = own.join(named, "part").select("key", "comp")
    firsts = core_comp.join(points.select("key", "first"), "key").groupBy("comp").agg(F.min("first").alias("first"))
    order = sequential_ids(firsts, order_cols=("first", "comp"), out="cluster").select("comp", "cluster")
    border = (links.filter("border").join(named, "part").join(order, "comp")
              .groupBy("key").agg(F.min("cluster").alias("bcluster")))
    labels = (points.select("key", *xs).join(core_comp.join(order, "comp").select("key", "cluster"), "key", "left")
              .join(border, "key", "left").drop("key"))
    cl = F.coalesce("cluster", "bcluster", F.lit(NOISE)).cast("long")
    return flat.join(labels, xs, "left").select(
        F.col("id").alias(id_col), cl.alias("cluster"), F.col("cluster").isNotNull().cast("int").alias("is_core"),
        (cl == NOISE).cast("int").alias("is_noise"))


def dbscan_summary(labels: DataFrame) -> DataFrame:
    """C6 counts: clusters, noise points, noise share."""
    return labels.agg(
        F.count_distinct(F.when(F.col("cluster") >= 0, F.col("cluster"))).alias("n_clusters"),
        F.sum("is_noise").cast("long").alias("n_noise"),
        F.avg(F.col("is_noise").cast("double")).alias("noise_share"))


def outlier_statistics(df: DataFrame, cols: list[str], label_col: str = "cluster") -> DataFrame:
    """Per feature the inlier and outlier means and their ratio (0 when the
    inlier mean is 0), 4 dp half-even. One aggregate pass, then unpivoted."""
    out = F.col(label_col) == NOISE
    aggs = []
    for c in cols:
        aggs += [F.avg(F.when(~out, F.col(c))).alias(f"i_{c}"), F.avg(F.when(out, F.col(c))).alias(f"o_{c}")]
    wide = df.agg(*aggs)
    pairs = ", ".join(f"'{c}', `i_{c}`, `o_{c}`" for c in cols)
    long = wide.selectExpr(f"stack({len(cols)}, {pairs}) AS (feature, inlier_mean, outlier_mean)")
    ratio = F.when(F.col("inlier_mean") != 0, F.col("outlier_mean") / F.col("inlier_mean")).otherwise(F.lit(0.0))
    return long.select("feature", F.bround("inlier_mean", 4).alias("inlier_mean"),
                       F.bround("outlier_mean", 4).alias("outlier_mean"),
                       F.bround(ratio, 4).alias("ratio"))


def outlier_cluster_summary(df: DataFrame, label_col: str = "db_cluster") -> DataFrame:
    """Sampled rows, DBSCAN outliers and their rate (rows labelled -2
    were not sampled and are excluded)."""
    s = df.filter(F.col(label_col) != NOT_SAMPLED)
    return s.agg(F.count(F.lit(1)).alias("n_sampled"),
                 F.sum((F.col(label_col) == NOISE).cast("long")).alias("n_outliers")) \
        .withColumn("outlier_rate", F.when(F.col("n_sampled") > 0,
                                           F.col("n_outliers") / F.col("n_sampled")).otherwise(0.0))
