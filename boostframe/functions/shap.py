"""Path-dependent TreeSHAP (Lundberg, Erion & Lee 2018, Algorithm 2), vectorised over the rows of a batch.

The recursion walks each tree once; the path state (feature, zero fraction) is shared by all rows
because it depends only on the tree, while one-fractions and path weights are ``[rows]`` arrays
(a row's one-fraction is 1 on the branch it takes, 0 on the other).
"""

from __future__ import annotations

import numpy as np

from .kernel import Forest, go_left


def _extend(ds, zs, os_, ws, pz, po, pi):
    n = po.shape[0]
    l = len(ds)
    ds = ds + [pi]
    zs = zs + [pz]
    os_ = os_ + [po]
    ws = [w.copy() for w in ws] + [np.ones(n) if l == 0 else np.zeros(n)]
    for i in range(l - 1, -1, -1):
        ws[i + 1] = ws[i + 1] + po * ws[i] * (i + 1) / (l + 1)
        ws[i] = pz * ws[i] * (l - i) / (l + 1)
    return ds, zs, os_, ws


def _unwind(ds, zs, os_, ws, i):
    l = len(ds) - 1
    o, z = os_[i], zs[i]
    nxt = ws[l].copy()
    ws = [w.copy() for w in ws]
    nz = o != 0
    for j in range(l - 1, -1, -1):
        with np.errstate(divide="ignore", invalid="ignore"):
            a = nxt * (l + 1) / ((j + 1) * np.where(nz, o, 1.0))
            b = ws[j] * (l + 1) / (z * (l - j)) if z != 0 else np.zeros_like(ws[j])
        tmp = ws[j]
        ws[j] = np.where(nz, a, b)
        nxt = np.where(nz, tmp - ws[j] * z * (l - j) / (l + 1), nxt)
    ds = ds[:i] + ds[i + 1:]
    zs = zs[:i] + zs[i + 1:]
    os_ = os_[:i] + os_[i + 1:]
    ws = ws[:l]
    return ds, zs, os_, ws


def _unwound_sum(zs, os_, ws, i):
    l = len(ws) - 1
    o, z = os_[i], zs[i]
    nz = o != 0
    total = np.zeros_like(ws[0])
    nxt = ws[l].copy()
    for j in range(l - 1, -1, -1):
        with np.errstate(divide="ignore", invalid="ignore"):
            tmp = nxt * (l + 1) / ((j + 1) * np.where(nz, o, 1.0))
            alt = ws[j] * (l + 1) / (z * (l - j)) if z != 0 else np.zeros_like(ws[j])
        total = total + np.where(nz, tmp, alt)
        nxt = np.where(nz, ws[j] - tmp * z * (l - j) / (l + 1), nxt)
    return total


def tree_shap(forest: Forest, cover: np.ndarray, X: np.ndarray, tree: int, phi: np.ndarray) -> None:
    """Add tree ``tree``'s contributions for rows ``X`` into ``phi`` ([rows, features])."""
    n = X.shape[0]
    weight = forest.tree_weight[tree]

    def recurse(node, ds, zs, os_, ws, pz, po, pi):
        ds, zs, os_, ws = _extend(ds, zs, os_, ws, pz, po, pi)
        f = forest.feat[node]
        if f < 0:
            v = forest.value[node] * weight
            for i in range(1, len(ds)):
                w = _unwound_sum(zs, os_, ws, i)
                phi[:, ds[i]] += w * (os_[i] - zs[i]) * v
            return
        left, right = forest.left[node], forest.right[node]
        goes_left = go_left(forest, np.full(n, node), X[:, f])
        iz, io = 1.0, np.ones(n)
        k = next((i for i in range(1, len(ds)) if ds[i] == f), None)
        if k is not None:
            iz, io = zs[k], os_[k]
            ds, zs, os_, ws = _unwind(ds, zs, os_, ws, k)
        c = cover[node] if cover[node] > 0 else 1.0
        recurse(left, ds, zs, os_, ws, iz * cover[left] / c, io * goes_left, f)
        recurse(right, ds, zs, os_, ws, iz * cover[right] / c, io * (~goes_left), f)

    recurse(int(forest.roots[tree]), [], [], [], [], 1.0, np.ones(n), -1)


def expected_value(forest: Forest, cover: np.ndarray, tree: int) -> float:
    """Cover-weighted mean leaf value of one tree (its contribution to the base value)."""
    root = int(forest.roots[tree])
    total = 0.0
    stack = [(root, 1.0)]
    while stack:
        node, frac = stack.pop()
        if forest.feat[node] < 0:
            total += frac * forest.value[node]
            continue
        c = cover[node] if cover[node] > 0 else 1.0
        for child in (forest.left[node], forest.right[node]):
            stack.append((child, frac * cover[child] / c))
    return total * forest.tree_weight[tree]


def contributions(scorer, cover: np.ndarray, X: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Contributions ``[groups, rows, features]`` of the rows of ``X`` and the base value of every group."""
    phi, base = np.zeros((scorer.K, len(X), X.shape[1])), np.array(scorer.base, dtype=np.float64)
    if scorer.linear:
        return np.nan_to_num(X)[None] * scorer.W.T[:, None, :], base + scorer.B
    for t in range(scorer.forest.n_trees):
        group = scorer.forest.tree_class[t]
        base[group] += expected_value(scorer.forest, cover, t)
        tree_shap(scorer.forest, cover, X, t, phi[group])
    return phi, base
