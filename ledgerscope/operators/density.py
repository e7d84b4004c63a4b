"""Density links inside one task: neighbour counts, core components and border contacts.

Both sides are cut into balls (:func:`ledgerscope.operators.metric_index.build`). Two balls
that lie wholly within eps of each other need no distance, two that lie apart neither; a ball of
diameter eps is one node, and balls already in one component are not measured again. So a dense
spot costs ball pairs, not point pairs, and no pair is ever stored. Between balls that are neither, only the points within
eps of the other ball's box are measured: in many dimensions balls are wide, but a box is narrow in some.
Distances near eps are measured exactly (coordinate by coordinate, like a SQL sum of squares)."""

from __future__ import annotations

import numpy as np

from ledgerscope.operators import metric_index as MI

_EPS = float(np.finfo(float).eps)
_LOOSE = 1.0 + 1e-9  # a box's squared distance is rounded otherwise than a point's


def _balls(points: np.ndarray):
    """(points in ball order, their rows, starts, centres, radii, least and most coordinates, points by dimension)."""
    if not len(points):
        return points, np.zeros(0, np.int64), np.zeros(1, np.int64), points, np.zeros(0), points, points, points.T
    p, rows, starts, centres, radii = MI.build(points, np.arange(len(points)))[:5]
    low, high = (f.reduceat(p, starts[:-1], axis=0) for f in (np.minimum, np.maximum))
    return p, rows, starts, centres, radii, low, high, np.ascontiguousarray(p.T)


def _rounding(n_dims: int, norm2):
    """Bound on the rounding of a squared distance by matrix product, for squared norms summing to ``norm2``."""
    return 32 * _EPS * (n_dims + 4) * norm2


def within(x: np.ndarray, y: np.ndarray, eps: float) -> np.ndarray:
    """Matrix of sqrt(sum of squares) <= eps."""
    d2 = MI.squared(x, y)
    slack = _rounding(x.shape[1], (x * x).sum(axis=1) + (y * y).sum(axis=1).max(initial=0.0))[:, None]
    out = d2 <= eps * eps
    i, j = np.nonzero(np.abs(d2 - eps * eps) <= slack)
    out[i, j] = np.sqrt(MI.exact_squared(x[i], y[j])) <= eps
    return out


def _ball_pairs(a, b, eps: float):
    """For each ball of ``a``: its number, the balls of ``b`` wholly within eps of it, and those that may
    hold a point within eps."""
    ca, ra, low_a, high_a = a[3:7]
    cb, rb, low_b, high_b = b[3:7]
    if not len(b[0]):
        return
    nb = np.sqrt((cb * cb).sum(axis=1))
    for i in range(len(ca)):
        d = np.sqrt(MI.squared(ca[i:i + 1], cb)[0])
        wide = 1e-6 * (1.0 + np.sqrt((ca[i] * ca[i]).sum()) + nb)
        inside = d + ra[i] + rb + wide <= eps
        near = np.flatnonzero(~inside & (d - ra[i] - rb - wide <= eps))
        gap = np.maximum(np.maximum(low_b[near] - high_a[i], low_a[i] - high_b[near]), 0.0)
        yield i, np.flatnonzero(inside), near[(gap * gap).sum(axis=1) <= eps * eps * _LOOSE]


def _near_box(a, i: int, b, balls: np.ndarray, eps: float) -> np.ndarray:
    """Rows of the ``balls`` of ``b`` within eps of the box of ball i of ``a``: its narrow sides are asked first."""
    low, high, by_dim = a[5][i], a[6][i], b[7]
    rows = _rows(b[2], balls)
    d2, limit = np.zeros(len(rows)), eps * eps * _LOOSE
    for n, j in enumerate(np.argsort(high - low, kind="stable")):
        y = by_dim[j][rows]
        gap = np.maximum(np.maximum(low[j] - y, y - high[j]), 0.0)
        d2 += gap * gap
        if n % 3 == 2 or n == len(low) - 1:
            keep = d2 <= limit
            rows, d2 = rows[keep], d2[keep]
    return rows


def _rows(starts: np.ndarray, balls: np.ndarray) -> np.ndarray:
    sizes = starts[balls + 1] - starts[balls]
    return np.arange(sizes.sum()) + np.repeat(starts[balls] - np.cumsum(sizes) + sizes, sizes)


def neighbour_weights(asked: np.ndarray, others: np.ndarray, weight: np.ndarray, eps: float, enough: int) -> np.ndarray:
    """Weight of the others within eps of each asked row. Where the balls wholly within eps hold
    ``enough``, that is the answer (a lower bound), and nothing is measured."""
    a, b = _balls(asked), _balls(others)
    out = np.zeros(len(asked), np.int64)
    if not len(asked) or not len(others):
        return out
    w = weight[b[1]]
    ball_w = np.add.reduceat(w, b[2][:-1])
    for i, inside, near in _ball_pairs(a, b, eps):
        rows = slice(a[2][i], a[2][i + 1])
        sure = int(ball_w[inside].sum())
        out[a[1][rows]] = sure
        if sure < enough and len(near):
            c = _near_box(a, i, b, near, eps)
            x, y = np.nonzero(within(a[0][rows], b[0][c], eps))
            np.add.at(out, a[1][rows][x], w[c[y]])
    return out


def _root(parent: np.ndarray, nodes):
    r = parent[nodes]
    while True:
        up = parent[r]
        if np.array_equal(up, r):
            return r
        r = up


def _unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Unite a[i] with b[i]; the smaller node becomes the root."""
    a, b = _root(parent, a), _root(parent, b)
    different = a != b
    if not different.any():
        return
    pairs = np.unique(np.stack([np.minimum(a, b)[different], np.maximum(a, b)[different]]), axis=1)
    for x, y in pairs.T.tolist():
        while parent[x] != x:
            x = int(parent[x])
        while parent[y] != y:
            y = int(parent[y])
        if x != y:
            parent[max(x, y)] = min(x, y)


def core_components(asked: np.ndarray, asked_node: np.ndarray, others: np.ndarray, other_node: np.ndarray,
                    n_nodes: int, eps: float) -> np.ndarray:
    """Root of each node after uniting asked and other core rows within eps. One row may stand on both
    sides as the same node; the root is the smallest node of its component."""
    parent = np.arange(n_nodes)
    a, b = _balls(asked), _balls(others)
    an, bn = asked_node[a[1]], other_node[b[1]]
    tight = []
    for (_, _, starts, c, r), nodes in ((a[:5], an), (b[:5], bn)):
        wide = 1e-6 * (1.0 + np.sqrt((c * c).sum(axis=1)))
        tight.append(2 * r + wide <= eps)
        for i in np.flatnonzero(tight[-1]):
            of = nodes[starts[i]:starts[i + 1]]
            _unite(parent, of[:1].repeat(len(of)), of)
    for i, inside, near in _ball_pairs(a, b, eps):
        rows = slice(a[2][i], a[2][i + 1])
        mine = an[rows]
        if len(inside):
            there = bn[_rows(b[2], inside)]
            _unite(parent, mine[:1].repeat(len(there)), there)
            _unite(parent, mine, there[:1].repeat(len(mine)))
        if tight[0][i] and len(near):  # balls of one component need no distance
            same = tight[1][near] & (_root(parent, bn[b[2][near]]) == _root(parent, mine[:1]))
            near = near[~same]
        if len(near):
            c = _near_box(a, i, b, near, eps)
            hit = within(a[0][rows], b[0][c], eps)
            if tight[0][i]:
                touched = bn[c[hit.any(axis=0)]]
                _unite(parent, mine[:1].repeat(len(touched)), touched)
            else:
                x, y = np.nonzero(hit)
                _unite(parent, mine[x], bn[c[y]])
    return _root(parent, np.arange(n_nodes))


def border_contacts(asked: np.ndarray, others: np.ndarray, component: np.ndarray, eps: float):
    """Distinct (asked row, component) of the others within eps."""
    a, b = _balls(asked), _balls(others)
    found = [np.zeros((2, 0), np.int64)]
    for i, inside, near in _ball_pairs(a, b, eps):
        rows = a[1][a[2][i]:a[2][i + 1]]
        c = np.concatenate([_rows(b[2], inside), _near_box(a, i, b, near, eps)])
        if len(c):
            x, y = np.nonzero(within(a[0][a[2][i]:a[2][i + 1]], b[0][c], eps))
            found.append(np.unique(np.stack([rows[x], component[b[1][c[y]]]]), axis=1))
    return np.concatenate(found, axis=1)
