"""Exact k nearest neighbours and per-cluster distance sums, distributed.

:func:`knn_edges` joins any number of queries with any number of reference rows through
a metric partition: seeded pivots cut the reference rows into cells (nearest pivot), each with
its covering radius. A query first meets its own cell, whose k-th distance bounds the
answer; then it is sent only to the cells that can hold something nearer, by the radius
bound and by the half-plane bound between two pivots. Inside a cell a ball partition
(:mod:`ledgerscope.operators.metric_index`) does the search. Cells and their queries are cut into
chunks of bounded size, so a crowded cell is many tasks; equal reference rows beyond the
k + 1 smallest ids can never be neighbours and are left out first.

:func:`nearest_rows` takes the same join, except that a reference measured to be within
``BROADCAST_BYTES`` (a fitted sample, a small table) is broadcast as one ball partition and the
queries stream past it without a shuffle.

:func:`cluster_distance_sums` needs all distances by definition: every task holds one block of
points and the others stream by, so only the stream is copied, once per block."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerscope.operators import metric_index as MI
from ledgerscope.operators.sampling import sample_exact
from ledgerscope.session import pin

CELL_ROWS = 1024          # reference rows a pivot, on average
MAX_PIVOTS = 16384        # pivots are broadcast; beyond it cells grow instead
CHUNK_ROWS = 32768        # rows of a cell, or of its queries, in one task
BROADCAST_BYTES = 64 << 20
POINT_BLOCK = 16384


def _ids(values) -> np.ndarray:
    """Ids as an array that sorts: numbers as they are, anything else as objects."""
    a = np.asarray(values)
    return a if a.dtype.kind in "iuf" else a.astype(object)


def _positions(sorted_ids: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Place of each id in ``sorted_ids``, -1 where it is not there."""
    if not len(sorted_ids):
        return np.full(len(ids), -1)
    at = np.minimum(np.searchsorted(sorted_ids, ids), len(sorted_ids) - 1)
    return np.where(sorted_ids[at] == ids, at, -1)


def _partition(ids: np.ndarray, points: np.ndarray):
    """(sorted distinct ids, ball partition) of the reference rows."""
    names = np.unique(ids)
    return names, MI.build(points, np.searchsorted(names, ids))


def _edges(names, index, qid, q, k, exclude_self, limit=None) -> pd.DataFrame:
    own = _positions(names, qid) if exclude_self else np.full(len(qid), -1)
    i, d2, code = MI.search(index, q, own, k, limit)
    return pd.DataFrame({"qid": qid[i], "rid": names[code], "dist": np.sqrt(d2)})


def _vectors(df: DataFrame, id_col: str, cols: list[str], name: str) -> DataFrame:
    return df.select(F.col(id_col).alias(name), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])


def _ranked(edges: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("qid").orderBy("dist", "rid")
    return edges.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def nearest_rows(query: DataFrame, ref: DataFrame, id_col: str, cols: list[str], k: int, exclude_self: bool = True,
                 skip_known: bool = False, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """:func:`knn_edges`, with the reference broadcast where it is measured to be within
    ``broadcast_bytes``. ``skip_known`` leaves out queries whose id the reference holds."""
    if ref.count() * (len(cols) + 4) * 16 > broadcast_bytes:
        if skip_known:
            query = query.join(ref.select(id_col), id_col, "left_anti")
        return knn_edges(query, ref, id_col, cols, k, exclude_self)
    xs = [f"x{i}" for i in range(len(cols))]
    points = _vectors(ref, id_col, cols, "rid").toPandas()
    held = query.sparkSession.sparkContext.broadcast(_partition(_ids(points["rid"]), points[xs].to_numpy(float)))

    def kernel(batches):
        names, index = held.value
        for b in batches:
            ids, x = _ids(b["qid"]), b[xs].to_numpy(float)
            if skip_known:
                new = _positions(names, ids) < 0
                ids, x = ids[new], x[new]
            out = _edges(names, index, ids, x, k, exclude_self)
            out["rank"] = (out.groupby("qid", sort=False).cumcount() + 1).astype("int32")
            yield out

    return _vectors(query, id_col, cols, "qid").mapInPandas(
        kernel, f"qid {_type(query, id_col)}, rid {_type(ref, id_col)}, dist double, rank int")


def knn_edges(query: DataFrame, ref: DataFrame, id_col: str, cols: list[str], k: int,
              exclude_self: bool = True, cell_rows: int = CELL_ROWS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Exact k nearest reference rows of every query row.

    Returns (qid, rid, dist, rank) with rank 1..k; ties in distance are broken by the
    smaller reference id. With ``exclude_self`` a row is not its own neighbour (ids
    compared), as in transductive LOF. Both frames are read more than once: pass pinned ones."""
    xs = [f"x{i}" for i in range(len(cols))]
    vec = ", ".join(f"{x} double" for x in xs)
    qtype, rtype = _type(query, id_col), _type(ref, id_col)
    r = _vectors(ref, id_col, cols, "rid")
    same = Window.partitionBy(*xs).orderBy("rid")
    r = r.withColumn("_n", F.row_number().over(same)).filter(F.col("_n") <= k + 1).drop("_n")
    n = r.count()
    schema = f"qid {qtype}, rid {rtype}, dist double"
    if not n:
        return _ranked(query.sparkSession.createDataFrame([], schema), k)
    cells = max(1, min(MAX_PIVOTS, math.ceil(n / cell_rows)))
    pivots = sample_exact(r, cells, 7, "rid").select(*xs).toPandas().to_numpy(float)
    sc = query.sparkSession.sparkContext
    tops = sc.broadcast((pivots, MI.build(pivots, np.arange(len(pivots)))))

    def assign(batches):
        p, index = tops.value
        for b in batches:
            x = b[xs].to_numpy(float)
            _, d2, cell = MI.search(index, x, np.full(len(x), -1), 1)
            yield b.assign(cell=cell, away=np.sqrt(d2))

    r = pin(r.mapInPandas(assign, f"rid {rtype}, {vec}, cell long, away double"))
    q = pin(_vectors(query, id_col, cols, "qid").mapInPandas(assign, f"qid {qtype}, {vec}, cell long, away double"))
    # One row a cell: bounded by the number of pivots.
    stats = r.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("radius")).toPandas()
    asked = q.groupBy("cell").agg(F.count("*").alias("n")).toPandas()
    size, radius, q_size = np.zeros(cells, np.int64), np.full(cells, -np.inf), np.zeros(cells, np.int64)
    size[stats["cell"]], radius[stats["cell"]], q_size[asked["cell"]] = stats["n"], stats["radius"], asked["n"]
    r_parts = np.maximum(1, -(-size // chunk_rows))
    layout = sc.broadcast((size, radius, r_parts))

    def parts(sizes, name):  # one row a cell: chunks of its rows
        table = pd.DataFrame({"cell": np.arange(cells), name: np.maximum(1, -(-sizes // chunk_rows))})
        return F.broadcast(query.sparkSession.createDataFrame(table))

    chunk = lambda key, name: F.pmod(F.xxhash64(key, F.lit(3)), F.col(name)).cast("int")
    every = lambda name: F.explode(F.sequence(F.lit(0), F.col(name).cast("int") - 1))
    r = r.join(parts(size, "rps"), "cell").withColumn("rp", chunk("rid", "rps")).drop("rps", "away")
    # Own cell (its first chunk): a k-th distance that bounds the answer.
    mine = q.join(parts(q_size, "qps"), "cell").withColumn("qp", chunk("qid", "qps")).drop("qps")
    first = r.filter("rp = 0").join(parts(q_size, "qps"), "cell").withColumn("qp", every("qps")).drop("qps", "rp")

    def own_cell(qp: pd.DataFrame, rp: pd.DataFrame) -> pd.DataFrame:
        far = np.full(len(qp), np.inf)
        if len(qp) and len(rp):
            ids = _ids(qp["qid"])
            names, index = _partition(_ids(rp["rid"]), rp[xs].to_numpy(float))
            own = _positions(names, ids) if exclude_self else np.full(len(ids), -1)
            i, d2, _ = MI.search(index, qp[xs].to_numpy(float), own, k)
            last = np.searchsorted(i, np.arange(len(qp)), side="right") - 1
            full = np.bincount(i, minlength=len(qp)) >= k
            far[full] = np.sqrt(d2[last[full]])
        return qp.drop(columns=["qp"]).assign(far=far)

    bounded = mine.groupBy("cell", "qp").cogroup(first.groupBy("cell", "qp")).applyInPandas(
        own_cell, f"qid {qtype}, {vec}, cell long, away double, far double")

    def send(batches):
        (p, _), (sizes, radii, rps) = tops.value, layout.value
        slack = 1e-9
        for b in batches:
            for a in range(0, len(b), 2048):
                part = b.iloc[a:a + 2048]
                x, far = part[xs].to_numpy(float), part["far"].to_numpy(float)
                d = np.sqrt(MI.squared(x, p))
                wide = slack * (1.0 + d) + 1e-6 * np.sqrt((x * x).sum(axis=1))[:, None]
                lower = np.maximum(d - radii[None, :], (d - part["away"].to_numpy(float)[:, None]) / 2) - wide
                i, c = np.nonzero((lower <= far[:, None]) & (sizes > 0)[None, :])
                times = rps[c]
                i, c = np.repeat(i, times), np.repeat(c, times)
                rp = np.arange(len(c)) - np.repeat(np.cumsum(times) - times, times)
                out = part.iloc[i].drop(columns=["away"]).assign(to=c, rp=rp.astype("int32"))
                yield out

    sent = pin(bounded.mapInPandas(send, f"qid {qtype}, {vec}, cell long, far double, to long, rp int")
               .withColumnRenamed("cell", "home").withColumnRenamed("to", "cell"))
    # What each cell is asked, from all sides: its queries are cut into chunks, too.
    asked = (sent.groupBy("cell", "rp").agg(F.count("*").alias("n")).groupBy("cell").agg(F.max("n").alias("n"))).toPandas()
    to_size = np.zeros(cells, np.int64)
    to_size[asked["cell"]] = asked["n"]
    there = sent.join(parts(to_size, "qps"), "cell").withColumn("qp", chunk("qid", "qps")).drop("qps")
    met = r.join(parts(to_size, "qps"), "cell").withColumn("qp", every("qps")).drop("qps")

    def kernel(qp: pd.DataFrame, rp: pd.DataFrame) -> pd.DataFrame:
        if qp.empty or rp.empty:
            return pd.DataFrame({"qid": qp["qid"].iloc[:0], "rid": rp["rid"].iloc[:0], "dist": np.zeros(0)})
        names, index = _partition(_ids(rp["rid"]), rp[xs].to_numpy(float))
        far = qp["far"].to_numpy(float) * (1 + 1e-12)
        return _edges(names, index, _ids(qp["qid"]), qp[xs].to_numpy(float), k, exclude_self, far)

    part = there.groupBy("cell", "rp", "qp").cogroup(met.groupBy("cell", "rp", "qp")).applyInPandas(kernel, schema)
    return _ranked(part, k)


def cluster_distance_sums(points: DataFrame, id_col: str, cols: list[str], label_col: str | list[str],
                          block_rows: int = POINT_BLOCK) -> DataFrame:
    """For every point and every cluster label: the sum of Euclidean distances to that
    cluster's points and their count (self included). Several label columns (of one type) share the
    distances; ``labelling`` is the place of the column. ``points`` is read three times: pass a pinned frame.

    A task holds the points of its blocks and every point streams by them; the points
    come first in a block's partition, so only a stream's batch and one block are in memory."""
    labels = [label_col] if isinstance(label_col, str) else list(label_col)
    xs, ls = [f"x{i}" for i in range(len(cols))], [f"lab{i}" for i in range(len(labels))]
    rows = points.select(F.col(id_col).alias("qid"), *[F.col(c).alias(x) for c, x in zip(labels, ls)],
                         *[F.col(c).cast("double").alias(x) for c, x in zip(cols, xs)])
    n = points.count()
    blocks = max(1, math.ceil(n / block_rows), min(points.sparkSession.sparkContext.defaultParallelism, math.ceil(n / 1024)))
    block = F.pmod(F.xxhash64("qid", F.lit(17)), F.lit(blocks)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    # A block's work is far more than its bytes: the number of partitions is named, or they would be put together again.
    both = (rows.withColumns({"block": block, "side": F.lit(0)})
            .unionByName(rows.withColumns({"block": every, "side": F.lit(1)}))
            .repartition(4 * blocks, "block").sortWithinPartitions("block", "side"))

    def run(batches):
        at, ids, held, sums = None, [], [], {}

        def flush():
            if at is None:
                return
            names = np.concatenate(ids)
            for (labelling, lab), (d, n) in sums.items():
                yield pd.DataFrame({"qid": names, "labelling": labelling, "lab": lab, "dsum": d, "cnt": n})

        for b in batches:
            for (block_no, side), part in b.groupby(["block", "side"], sort=False):
                if block_no != at:
                    yield from flush()
                    at, ids, held, sums = block_no, [], [], {}
                x = part[xs].to_numpy(float)
                if side == 0:
                    ids.append(part["qid"].to_numpy())
                    held.append(x)
                    continue
                if len(held) > 1:
                    held = [np.concatenate(held)]
                keys, member = [], []
                for j, c in enumerate(ls):
                    code, names = pd.factorize(part[c], use_na_sentinel=False)
                    keys += [(j, None if pd.isna(lab) else lab) for lab in names]
                    member.append(np.eye(len(names))[code])
                member = np.concatenate(member, axis=1)  # a column a cluster of every labelling
                new = np.zeros((len(held[0]) if held else 0, len(keys)))
                if held:
                    for a in range(0, len(x), 256):
                        d, of = _distances(held[0], x[a:a + 256]), member[a:a + 256]
                        step = d @ of
                        if not np.isfinite(step).all():  # what is no number counts for its own cluster only
                            step = np.stack([d[:, m > 0].sum(axis=1) for m in of.T], axis=1)
                        new += step
                for i, key in enumerate(keys):
                    d, n = sums.get(key, (0.0, 0))
                    sums[key] = d + new[:, i], n + int(member[:, i].sum())
        if at is not None and ids:
            yield from flush()

    out = both.mapInPandas(run, f"qid {_type(points, id_col)}, labelling int, lab {_type(points, labels[0])}, dsum double, cnt long")
    return out.drop("labelling") if isinstance(label_col, str) else out


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances by a matrix product; those it cannot resolve are measured coordinate by coordinate."""
    d2 = MI.squared(a, b)
    norm = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :]
    i, j = np.nonzero(d2 <= 1e-6 * norm)
    d2[i, j] = MI.exact_squared(a[i], b[j])
    return np.sqrt(d2)


def _type(df: DataFrame, col: str) -> str:
    return df.schema[col].dataType.simpleString()
