"""Exact embedding near-duplicates by cover-tree dual traversal.

Unit vectors, chord distance: cosine >= t is distance <= tau = sqrt(2 - 2t). A
cover tree over bounded pivots has nested levels of halving radii; every vector
hangs below its nearest pivot, and the covering radius of each node is the true
largest distance of its vectors. The dual traversal starts at (root, root) and
drops a pair of nodes when the centres are further apart than both covering
radii and tau; what survives are pairs of leaves. A vector then visits a leaf
only if its own distance to the leaf's centre is within the leaf's radius and
tau. By the triangle inequality no pair within tau is lost.

A leaf's residents are cut into chunks of about ``LEAF_ROWS`` (a leaf may hold a
third of all rows), and its visitors stream past each chunk in blocks: memory is
one chunk and one block. Two leaves meet once, and the links count on both sides. A chunk
reports a link count per visitor and resident and enough edges to connect what is
linked, all linear in its rows, never its pairs.

The tree holds at most ``MAX_PIVOTS`` pivots, taken in hash order (documented
bound); all rows are indexed and compared, so recall is 1 whatever the pivots.

Defined cases: null vectors, zero vectors and vectors with null or non-finite
components have no links and are their own component; equal vectors link with
each other (cosine 1); vectors of different lengths compare as if padded with
zeros; a null vec_id is a row like others and never names a component that has
an id; repeated rows count as separate vectors; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerscope.llm.common import Shipped, components, stage

THRESHOLD = 0.95
LEAF_ROWS = 4096
MAX_PIVOTS = 4096
_SLACK = 1e-7  # over the rounding of distances, in bounds only
_SCREEN = 1e-4  # over the rounding of single-precision cosines
_BLOCK = 512


def unit(values: list, width: int) -> np.ndarray:
    """Rows of unit length in double precision, padded with zeros to ``width``."""
    if len(values) and all(len(v) == width for v in values):
        out = np.concatenate(values).reshape(-1, width).astype(float)
    else:
        out = np.zeros((len(values), width))
        for i, v in enumerate(values):
            out[i, :len(v)] = v
    out /= np.abs(out).max(axis=1, keepdims=True)
    return out / np.sqrt(np.einsum("ij,ij->i", out, out))[:, None]


def chord(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (x @ c.T), 0))


class CoverTree:
    """Nested nets over pivots: a node of level i covers its children within 2^(1-i)
    and a node is its own child on the next level. Leaves are the pivots."""

    def __init__(self, pivots: np.ndarray):
        self.pivots = pivots
        self.levels: list[dict[int, list[int]]] = []  # per level: node -> children on the next level
        nodes, radius = [0], 2.0
        while len(nodes) < len(pivots):
            radius /= 2
            net, child = list(nodes), {n: [n] for n in nodes}
            if radius < 1e-6:  # only equal pivots are left; they all go below the first
                child[nodes[0]] += sorted(set(range(len(pivots))) - set(nodes))
                net = list(range(len(pivots)))
            far = chord(pivots, pivots[net]).min(axis=1)
            far[net] = 0.0
            while far.max() > radius:
                new = int(far.argmax())
                child[nodes[int(chord(pivots[new:new + 1], pivots[nodes]).argmin())]].append(new)
                net.append(new)
                far = np.minimum(far, chord(pivots, pivots[new:new + 1])[:, 0])
                far[new] = 0.0
            self.levels.append(child)
            nodes = net

    def surviving(self, radii: np.ndarray, tau: float) -> np.ndarray:
        """Leaf pairs (boolean matrix) that the dual traversal cannot rule out."""
        cover = [radii]  # covering radius of each node, from the leaves up
        for child in reversed(self.levels):
            up = np.full(len(radii), -np.inf)
            for n, kids in child.items():
                up[n] = max(d + r for d, r in zip(chord(self.pivots[n:n + 1], self.pivots[kids])[0], cover[0][kids]))
            cover.insert(0, up)
        pairs = np.array([[0, 0]])
        for level, child in enumerate(self.levels):
            most = max(map(len, child.values()))
            table = np.full((len(radii), most), -1)
            for n, kids in child.items():
                table[n, :len(kids)] = kids
            a, b = np.repeat(table[pairs[:, 0]], most, axis=1).ravel(), np.tile(table[pairs[:, 1]], (1, most)).ravel()
            ok = (a >= 0) & (b >= 0)
            a, b = a[ok], b[ok]
            r, kept = cover[level + 1], []
            for i in range(0, len(a), 1 << 16):
                x, y = a[i:i + (1 << 16)], b[i:i + (1 << 16)]
                gap = np.sqrt(np.maximum(2 - 2 * np.einsum("ij,ij->i", self.pivots[x], self.pivots[y]), 0))
                near = gap <= r[x] + r[y] + tau + _SLACK
                kept.append(np.stack([x[near], y[near]], axis=1))
            pairs = np.concatenate(kept)
        out = np.zeros((len(radii), len(radii)), bool)
        out[pairs[:, 0], pairs[:, 1]] = True
        return out


def _assign(tree, width):
    def run(batches):
        t = tree.value
        for pdf in batches:
            d = chord(unit(pdf["embedding"].tolist(), width), t.pivots) if len(pdf) else np.zeros((0, 1))
            yield pdf.assign(home=d.argmin(axis=1), dist=d.min(axis=1))
    return run


def _visit(tree, plan, width, tau):
    """(leaf, chunk, role, gid, n, embedding): each vector once as a resident (role 0), as a visitor of its
    own leaf (1), and as a visitor of other leaves where it may link (2). Two leaves meet once: which
    one visits is settled by the parity of their numbers, so that all leaves visit about as often."""
    def run(batches):
        t, (radii, near, chunks) = tree.value, plan.value
        for pdf in batches:
            if not len(pdf):
                continue
            d = chord(unit(pdf["embedding"].tolist(), width), t.pivots)
            home = pdf["home"].to_numpy()
            leaves = np.arange(len(radii))[None, :]
            first = (home[:, None] < leaves) ^ ((home[:, None] + leaves) % 2 == 1)
            go = near[home] & (d <= radii[None, :] + tau + _SLACK) & (first | (home[:, None] == leaves))
            for leaf in np.flatnonzero(go.any(axis=0)):
                part, at = pdf[go[:, leaf]], home[go[:, leaf]]
                for chunk in range(chunks[leaf]):
                    yield part[["gid", "n", "embedding"]].assign(leaf=leaf, chunk=chunk, role=np.where(at == leaf, 1, 2))
            own = pdf["gid"].to_numpy() % chunks[home]
            yield pdf[["gid", "n", "embedding"]].assign(leaf=home, chunk=own, role=0)
    return run


class _Chunk:
    """Residents of one chunk: link counts of visitors, of residents by visitors from other leaves, and
    the residents' local components. Cosines are screened in single precision and decided in double."""

    def __init__(self):
        self.parts = []

    def add(self, gid, n, vec):
        self.parts.append((gid, n, vec))

    def close(self):
        self.gid, self.n = (np.concatenate([p[i] for p in self.parts]) for i in (0, 1))
        self.x = np.concatenate([p[2] for p in self.parts])
        self.x32 = self.x.astype(np.float32)
        self.label, self.links = np.arange(len(self.gid)), np.zeros(len(self.gid), np.int64)

    def meet(self, gid, n, x, threshold, foreign):
        """(gid, links, a linked resident) of the visitors that link; ``foreign`` ones come from other leaves."""
        out, x32 = [], x.astype(np.float32)
        for i in range(0, len(gid), _BLOCK):
            v, r = np.nonzero(x32[i:i + _BLOCK] @ self.x32.T >= threshold - _SCREEN)
            if not len(v):
                continue
            hit = (np.einsum("ij,ij->i", x[i + v], self.x[r]) >= threshold) & (gid[i + v] != self.gid[r])
            v, r = v[hit], r[hit]
            if not len(v):
                continue
            if foreign:
                np.add.at(self.links, r, n[i + v])
            firsts = np.flatnonzero(np.r_[True, v[1:] != v[:-1]])
            out.append((gid[i + v[firsts]], np.add.reduceat(self.n[r], firsts), self.gid[r[firsts]]))
            same = np.flatnonzero(v[1:] == v[:-1])  # residents that one visitor links belong together
            a, b = r[same], r[same + 1]
            while True:
                la, lb = self.label[a], self.label[b]
                odd = la != lb
                if not odd.any():
                    break
                lo, hi = np.minimum(la[odd], lb[odd]), np.maximum(la[odd], lb[odd])
                to = np.arange(len(self.label))
                np.minimum.at(to, hi, lo)
                while (to[to] != to).any():
                    to = to[to]
                self.label = to[self.label]
        return out

    def edges(self):
        move = (self.label != np.arange(len(self.label))) | (self.links > 0)
        return self.gid[move], self.links[move], self.gid[self.label[move]]


def _link(width, threshold):
    def run(batches):
        key, chunk, ready = None, None, False

        def frame(rows):
            return pd.DataFrame({"gid": np.concatenate([r[0] for r in rows]), "links": np.concatenate([r[1] for r in rows]),
                                 "peer": np.concatenate([r[2] for r in rows])})

        for pdf in batches:
            if not len(pdf):
                continue
            keys = pdf[["leaf", "chunk", "role"]].to_numpy()
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, len(pdf)]):
                part, k = pdf.iloc[lo:hi], tuple(keys[lo, :2])
                if k != key:
                    if chunk is not None and ready:
                        yield frame([chunk.edges()])
                    key, chunk, ready = k, _Chunk(), False
                gid, x = part["gid"].to_numpy(), unit(part["embedding"].tolist(), width)
                if keys[lo, 2] == 0:
                    chunk.add(gid, part["n"].to_numpy(), x)
                    continue
                if not ready:
                    if not chunk.parts:
                        continue  # visitors of a chunk that got no resident
                    chunk.close()
                    ready = True
                found = chunk.meet(gid, part["n"].to_numpy(), x, threshold, keys[lo, 2] == 2)
                if found:
                    yield frame(found)
        if chunk is not None and ready:
            yield frame([chunk.edges()])
    return run


def embedding_groups(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = THRESHOLD,
                     leaf_rows: int = LEAF_ROWS, max_pivots: int = MAX_PIVOTS) -> DataFrame:
    """One row per row of ``rows``: vec_id, n_links, component_id, kept."""
    spark = rows.sparkSession
    vec = F.col(vec_col)
    valid = F.coalesce(F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
                       & F.exists(vec, lambda v: v != 0), F.lit(False))
    src = rows.select(F.col(id_col).alias("vec_id"), F.when(valid, vec).alias("embedding"))
    distinct = stage(src.filter("embedding is not null").groupBy("embedding")
                     .agg(F.min("vec_id").alias("first_id"), F.count("*").alias("n"))
                     .withColumn("gid", F.monotonically_increasing_id()), "vectors")
    total, width = distinct.agg(F.count("*"), F.max(F.size("embedding"))).first()
    ids = src.filter("embedding is null").select("vec_id").withColumns(
        {"n_links": F.lit(0).cast("long"), "component_id": F.col("vec_id")})
    if total:
        tau = float(np.sqrt(2 - 2 * threshold))
        m = int(min(max_pivots, max(1, -(-total // leaf_rows))))
        sample = distinct.select("embedding").orderBy(F.xxhash64("embedding"), "embedding").limit(m).collect()
        tree = Shipped(spark, CoverTree(unit([r.embedding for r in sample], width)))
        homes = stage(distinct.mapInPandas(_assign(tree, width), distinct.schema.simpleString()[7:-1] + ", home bigint, dist double"), "homes")
        radii, sizes = np.full(m, -np.inf), np.zeros(m, int)
        for r in homes.groupBy("home").agg(F.max("dist").alias("r"), F.count("*").alias("n")).collect():  # one row a pivot
            radii[r.home], sizes[r.home] = r.r, r.n
        plan = spark.sparkContext.broadcast((radii, tree.value.surviving(radii, tau), np.maximum(1, -(-sizes // leaf_rows))))
        kind = homes.schema["embedding"].dataType.simpleString()
        visits = (homes.mapInPandas(_visit(tree, plan, width, tau), f"gid bigint, n bigint, embedding {kind}, leaf bigint, chunk bigint, role bigint")
                  .repartition("leaf", "chunk").sortWithinPartitions("leaf", "chunk", "role"))
        links = stage(visits.mapInPandas(_link(width, threshold), "gid bigint, links bigint, peer bigint"), "links")
        roots = components(links.select(F.col("gid").alias("a"), F.col("peer").alias("b")))
        counts = links.groupBy("gid").agg(F.sum("links").alias("links"))
        groups = stage(distinct.join(roots.withColumnRenamed("node", "gid"), "gid", "left").join(counts, "gid", "left")
                       .select("embedding", "first_id", F.coalesce("root", "gid").alias("root"),
                               (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")), "groups")
        names = groups.groupBy("root").agg(F.min("first_id").alias("component_id"))
        named = stage(groups.join(names, "root").select("embedding", "n_links", "component_id"), "named")
        ids = ids.union(src.filter("embedding is not null").join(named, "embedding").select("vec_id", "n_links", "component_id"))
    return ids.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
