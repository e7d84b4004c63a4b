"""Exact nearest-neighbour search in one task: a ball partition with distance bounds.

Points are split at medians into leaves; a leaf is a centre and a covering radius. A
query's k-th distance among the leaves nearest to it bounds its answer, and the triangle
inequality drops every leaf that lies wholly beyond. What is left is screened with one
matrix product per block of queries (in single precision where that is fine enough), widened by
its rounding error, and only the survivors are measured exactly (coordinate by coordinate, like a SQL sum of squared
differences). Ties go to the smaller id.

A partition is a tuple of plain arrays, so it can be broadcast without this package."""

from __future__ import annotations

import numpy as np

LEAF_ROWS = 64
QUERY_BLOCK = 256
FIRST_ROWS = 1024
REF_BLOCK = 8192
_EPS = float(np.finfo(float).eps)
_EPS32 = float(np.finfo(np.float32).eps)


def build(points: np.ndarray, codes: np.ndarray, leaf_rows: int = LEAF_ROWS):
    """(points, codes, starts, centres, radii, mean, folded): points in leaf order, leaf i from starts[i]
    to starts[i + 1]; ``codes`` are the ranks of the points' ids; ``folded`` makes one matrix product
    with ``_fold_query`` give squared distances."""
    order, starts, stack = np.arange(len(points)), [], [(0, len(points))]
    while stack:
        lo, hi = stack.pop()
        part = points[order[lo:hi]]
        spread = np.ptp(part, axis=0) if hi > lo else np.zeros(1)
        if hi - lo <= leaf_rows or not spread.max() > 0:
            starts.append(lo)
            continue
        mid = (hi - lo) // 2
        order[lo:hi] = order[lo:hi][np.argpartition(part[:, int(spread.argmax())], mid)]
        stack += [(lo + mid, hi), (lo, lo + mid)]
    starts = np.array(starts + [len(points)])
    p = points[order]
    centres = np.array([p[a:b].mean(axis=0) for a, b in zip(starts, starts[1:])]).reshape(-1, points.shape[1])
    radii = np.array([np.sqrt(((p[a:b] - c) ** 2).sum(axis=1).max(initial=0.0)) for a, b, c in zip(starts, starts[1:], centres)])
    mean = p.mean(axis=0) if len(p) else np.zeros(points.shape[1])
    return p, codes[order], starts, centres, radii, mean, _fold_points(p - mean)


def _fold_points(b: np.ndarray) -> np.ndarray:
    return np.concatenate([-2.0 * b, (b * b).sum(axis=1)[:, None], np.ones((len(b), 1))], axis=1)


def _fold_query(a: np.ndarray) -> np.ndarray:
    return np.concatenate([a, np.ones((len(a), 1)), (a * a).sum(axis=1)[:, None]], axis=1)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a to all rows of b, by one matrix product."""
    return np.maximum((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2.0 * (a @ b.T), 0.0)


def exact_squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of matching rows, summed in column order."""
    out = np.zeros(len(a))
    for j in range(a.shape[1]):
        t = a[:, j] - b[:, j]
        out += t * t
    return out


def _best(q, d2, row, code, k):
    """The k nearest per query of (q, d2, row), ties by code, sorted by query and distance."""
    order = np.lexsort((code[row], d2, q))
    q, d2, row = q[order], d2[order], row[order]
    first = np.searchsorted(q, q)
    keep = np.arange(len(q)) - first < k
    return q[keep], d2[keep], row[keep]


def _room(scratch: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """An array of ``shape`` in ``scratch``, where it fits: fresh pages for every product cost more than the product."""
    n = shape[0] * shape[1]
    return scratch[:n].reshape(shape) if n <= len(scratch) else np.empty(shape, scratch.dtype)


def _within(d2: np.ndarray, limits: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Flat places of the distances within their row's limit, which is rounded up to their precision."""
    limits = np.nextafter(limits.astype(d2.dtype), np.inf, dtype=d2.dtype)
    return np.flatnonzero(np.less_equal(d2, limits[:, None], out=mask).ravel())


def _block(index, folded32, q, own, k, limit, scratch):
    p, codes, starts, centres, radii, mean, folded = index
    qc, far = q - mean, np.full(len(q), np.inf) if limit is None else limit * limit
    fq = _fold_query(qc)
    norm = np.sqrt((qc * qc).sum(axis=1))
    most = np.sqrt(np.maximum(folded[:, -2], 0.0).max(initial=0.0))

    def slack2(eps=_EPS):  # rounding of the matrix product, for points no further than ``far``
        reach = np.where(np.isfinite(far), 2 * norm + np.sqrt(np.where(np.isfinite(far), far, 0.0)), norm + most)
        return 16 * eps * (p.shape[1] + 4) * reach * reach
    to_centre = np.sqrt(squared(qc, centres - mean))
    wide = 4 * np.sqrt(16 * _EPS * (p.shape[1] + 4)) * (norm[:, None] + to_centre)
    bound = np.maximum(to_centre - radii - wide, 0.0) ** 2
    # Leaves in the order of the block's nearness: the first ones give a k-th distance that drops most others.
    sizes, leaves = np.diff(starts), np.argsort(bound.mean(axis=0), kind="stable")
    modest = norm.max() + most < 1e15  # squares far from the ends of single precision
    found_q, found_d, found_r = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
    at, room, named = 0, FIRST_ROWS, bool((own >= 0).any())
    while at < len(leaves):
        rest = leaves[at:]
        rest = rest[(bound[:, rest] <= (far + slack2())[:, None]).any(axis=0)]
        leaves, at = rest, 0
        if not len(leaves):
            break
        at = max(1, int(np.searchsorted(np.cumsum(sizes[leaves]), room, side="right")))
        rows = np.concatenate([np.arange(starts[i], starts[i + 1]) for i in leaves[:at]])
        room = REF_BLOCK
        # Single precision halves the product where its rounding lets few more through to the exact measure.
        single = modest and 1e-20 < far.min() and far.max() < 1e20 and bool((slack2(_EPS32) <= far / 16).all())
        eps, refs = (_EPS32, folded32) if single else (_EPS, folded)
        d2, mask = (_room(s, (len(q), len(rows))) for s in (scratch[0].view(refs.dtype), scratch[1]))
        np.matmul(fq.astype(refs.dtype, copy=False), refs[rows].T, out=d2)
        hit = np.flatnonzero(np.isin(own, codes[rows])) if named else ()
        if len(hit):
            d2[hit] = np.where(own[hit][:, None] == codes[rows][None, :], np.inf, d2[hit])
        flat = _within(d2, far + slack2(eps), mask)
        if len(rows) > k and len(flat) > 3 * k * len(q):
            far = np.minimum(far, np.maximum(np.partition(d2, k - 1, axis=1)[:, k - 1], 0.0) + slack2(eps))
            flat = _within(d2, far + slack2(eps), mask)
        i, j = np.divmod(flat, len(rows))
        j = rows[j]
        other = own[i] != codes[j]
        i, j = i[other], j[other]
        found_q, found_r = np.concatenate([found_q, i]), np.concatenate([found_r, j])
        found_d = np.concatenate([found_d, exact_squared(q[i], p[j])])
        found_q, found_d, found_r = _best(found_q, found_d, found_r, codes, k)
        full = np.bincount(found_q, minlength=len(q)) >= k
        if full.any():
            last = np.searchsorted(found_q, np.arange(len(q)), side="right") - 1
            far = np.where(full, np.minimum(far, found_d[np.maximum(last, 0)]), far)
    return found_q, found_d, found_r


def search(index, queries: np.ndarray, own: np.ndarray, k: int, limit: np.ndarray | None = None):
    """The k nearest points per query: (query row, squared distance, code of the point), sorted by query,
    distance and code. ``own`` is the code that a query must not meet (-1: none); only
    points within ``limit`` (a distance per query) are asked for, if given."""
    p, codes, starts, centres = index[:4]
    none = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
    if not len(queries) or not len(p):
        return none
    home = np.concatenate([squared(queries[a:a + 4096], centres).argmin(axis=1) for a in range(0, len(queries), 4096)])
    order = np.argsort(home, kind="stable")  # queries of one leaf share their candidates
    out, size = [], min(QUERY_BLOCK, len(queries)) * min(REF_BLOCK, len(p))
    scratch = np.empty(size), np.empty(size, bool)
    with np.errstate(over="ignore"):  # not used where squares are that large
        folded32 = index[-1].astype(np.float32)
    for a in range(0, len(order), QUERY_BLOCK):
        rows = order[a:a + QUERY_BLOCK]
        q, d, r = _block(index, folded32, queries[rows], own[rows], k, None if limit is None else limit[rows], scratch)
        out.append((rows[q], d, codes[r]))
    q, d, c = (np.concatenate(x) for x in zip(*out))
    order = np.lexsort((c, d, q))
    return q[order], d[order], c[order]
