"""Vectorised numpy kernels run inside Arrow tasks: tree routing, margins, links, row hashing.

Trees are flattened into parallel arrays with global node indices so one routing loop moves every
row through every tree at once (``[rows, trees]`` index arrays, one step per tree level).
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

FIXED_SCALE = float(1 << 20)  # fixed-point scale for gradient / hessian sums


@dataclass
class Forest:
    feat: np.ndarray          # int32 [N], -1 at leaves
    thr: np.ndarray           # float64 [N], x < thr goes left (numeric splits)
    dleft: np.ndarray         # bool [N], missing goes left
    left: np.ndarray          # int32 [N], global index of the left child
    right: np.ndarray         # int32 [N]
    value: np.ndarray         # float64 [N], leaf value (0 at inner nodes)
    catrow: np.ndarray        # int32 [N], row of ``catbits`` for categorical splits, else -1
    catbits: np.ndarray       # bool [C, W + 1], which of ``catcodes`` go left; the last entry stands for all other codes
    catcodes: np.ndarray      # int64 [W], the codes that any split names, in order
    roots: np.ndarray         # int32 [T]
    tree_class: np.ndarray    # int32 [T]
    tree_weight: np.ndarray   # float64 [T]
    depth: int                # max depth over trees
    offsets: np.ndarray = field(default=None)  # int32 [T], first global index of each tree

    @property
    def n_trees(self) -> int:
        return int(self.roots.shape[0])


def build_forest(trees: list[dict], tree_class: list[int], tree_weight: list[float]) -> Forest:
    """``trees``: dicts of per-node lists (local ids): feat, thr, dleft, left, right, value, cats
    (a list of left-going category codes or None)."""
    feats, thrs, dls, lefts, rights, vals, catrows = [], [], [], [], [], [], []
    cat_sets: list[list[int]] = []
    roots, offsets = [], []
    depth = 0
    base = 0
    for tr in trees:
        n = len(tr["feat"])
        roots.append(base)
        offsets.append(base)
        feats.extend(tr["feat"])
        thrs.extend(tr["thr"])
        dls.extend(tr["dleft"])
        lefts.extend([(base + c) if c >= 0 else -1 for c in tr["left"]])
        rights.extend([(base + c) if c >= 0 else -1 for c in tr["right"]])
        vals.extend(tr["value"])
        for cs in tr["cats"]:
            if cs is None:
                catrows.append(-1)
            else:
                catrows.append(len(cat_sets))
                cat_sets.append(list(cs))
        depth = max(depth, _tree_depth(tr["left"], tr["right"]))
        base += n
    codes = np.unique(np.concatenate([np.asarray(cs, np.int64) for cs in cat_sets])) if cat_sets else np.empty(0, np.int64)
    catbits = np.zeros((max(len(cat_sets), 1), len(codes) + 1), dtype=bool)
    for i, cs in enumerate(cat_sets):
        catbits[i, np.searchsorted(codes, cs)] = True
    return Forest(
        feat=np.asarray(feats, dtype=np.int32), thr=np.asarray(thrs, dtype=np.float64),
        dleft=np.asarray(dls, dtype=bool), left=np.asarray(lefts, dtype=np.int32),
        right=np.asarray(rights, dtype=np.int32), value=np.asarray(vals, dtype=np.float64),
        catrow=np.asarray(catrows, dtype=np.int32), catbits=catbits, catcodes=codes,
        roots=np.asarray(roots, dtype=np.int32), tree_class=np.asarray(tree_class, dtype=np.int32),
        tree_weight=np.asarray(tree_weight, dtype=np.float64), depth=depth,
        offsets=np.asarray(offsets, dtype=np.int32))


def _tree_depth(left: list[int], right: list[int]) -> int:
    if not left:
        return 0
    depth = [0] * len(left)
    best = 0
    for i in range(len(left)):  # children always have larger ids than parents
        for c in (left[i], right[i]):
            if c >= 0:
                depth[c] = depth[i] + 1
                best = max(best, depth[c])
    return best


def go_left(forest: Forest, idx: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Decision at nodes ``idx`` for feature values ``x`` (NaN = missing, categories as codes)."""
    miss = np.isnan(x)
    with np.errstate(invalid="ignore"):
        res = x < forest.thr[idx]
    cr = forest.catrow[idx]
    is_cat = cr >= 0
    if is_cat.any():
        res = np.where(is_cat, forest.catbits[np.maximum(cr, 0), _code_place(forest, x)], res)
    return np.where(miss, forest.dleft[idx], res)


def route(forest: Forest, X: np.ndarray, tree_ids: np.ndarray | None = None) -> np.ndarray:
    """Global leaf index for every (row, tree): int array ``[rows, trees]``. One tree at a time, so its node arrays stay
    in cache; leaves are their own children, so no row has to be masked out."""
    trees = np.arange(forest.n_trees) if tree_ids is None else np.asarray(tree_ids)
    n, width = X.shape
    out = np.empty((n, len(trees)), dtype=np.int32)
    if n == 0:
        return out
    flat, start = np.ascontiguousarray(X).ravel(), np.arange(n, dtype=np.int64) * width
    miss = np.isnan(flat)
    some_missing = bool(miss.any())
    ends = np.append(forest.offsets[1:], len(forest.feat))
    for j, t in enumerate(trees):
        lo, hi = int(forest.offsets[t]), int(ends[t])
        feat = forest.feat[lo:hi]
        inner = feat >= 0
        own = np.arange(hi - lo)
        child = np.stack([np.where(inner, forest.right[lo:hi] - lo, own), np.where(inner, forest.left[lo:hi] - lo, own)],
                         1).ravel()
        feat, thr, dleft = np.where(inner, feat, 0), forest.thr[lo:hi], forest.dleft[lo:hi]
        cats = forest.catrow[lo:hi]
        by_category = bool((cats >= 0).any())
        at = np.full(n, int(forest.roots[t]) - lo)
        levels = _tree_depth(*(np.where(inner, side[lo:hi] - lo, -1).tolist() for side in (forest.left, forest.right)))
        for _ in range(levels):
            cell = start + feat[at]
            x = flat[cell]
            left = x < thr[at]
            if by_category:
                left = _category_left(forest, cats[at], x, left)
            if some_missing:
                left = np.where(miss[cell], dleft[at], left)
            at = child[2 * at + left]
        out[:, j] = at + lo
    return out


def _code_place(forest: Forest, x: np.ndarray) -> np.ndarray:
    """Column of ``catbits`` for codes ``x``: the last one for codes (or missing values) that no split names."""
    codes = forest.catcodes
    place = np.searchsorted(codes, x)
    return np.where(codes[np.minimum(place, len(codes) - 1)] == x, place, len(codes)) if len(codes) else np.zeros(len(x), np.int64)


def _category_left(forest: Forest, rows: np.ndarray, x: np.ndarray, left: np.ndarray) -> np.ndarray:
    bits = forest.catbits[np.maximum(rows, 0), _code_place(forest, x)]
    return np.where(rows >= 0, bits, left)


def margins(forest: Forest, X: np.ndarray, base: np.ndarray, n_groups: int,
            trees: np.ndarray | None = None) -> np.ndarray:
    """Raw margins ``[rows, n_groups]`` = base + Σ tree_weight · leaf value per output group, of all or of some trees."""
    out = np.tile(np.asarray(base, dtype=np.float64), (X.shape[0], 1))
    trees = np.arange(forest.n_trees) if trees is None else trees
    if len(trees) == 0 or X.shape[0] == 0:
        return out
    leaves = route(forest, X, trees)
    for j, t in enumerate(trees):  # tree order, as the training state accumulates
        out[:, forest.tree_class[t]] += forest.value[leaves[:, j]] * forest.tree_weight[t]
    return out


def sigmoid(m: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-m))


def softmax(m: np.ndarray) -> np.ndarray:
    z = m - m.max(axis=1, keepdims=True)
    e = np.exp(z)
    return e / e.sum(axis=1, keepdims=True)


LOG_LINK = ("count:poisson", "reg:gamma", "reg:tweedie")


def link(objective: str, margin: np.ndarray) -> np.ndarray:
    """A regression margin in the units of the target."""
    if objective in LOG_LINK:
        return np.exp(margin)
    return sigmoid(margin) if objective == "reg:logistic" else margin


def gradients(objective: str, margin: np.ndarray, y: np.ndarray, scale_pos_weight: float = 1.0, power: float = 1.5,
              slope: float = 1.0, max_step: float = 0.0, alpha: float = 0.5) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives ``[rows, groups]`` of the loss at the current margins. ``power``: of the Tweedie
    variance; ``slope``: of the pseudo-Huber loss; ``alpha``: the quantile; ``max_step`` (0.7 if not set) steadies Poisson's second derivative."""
    t = y[:, None]
    if objective == "reg:squarederror":
        g = margin - t
        h = np.ones_like(g)
    elif objective in ("binary:logistic", "binary:logitraw", "reg:logistic"):
        p = sigmoid(margin)
        g = p - t
        h = np.maximum(p * (1.0 - p), 1e-16)
        if scale_pos_weight != 1.0:
            w = np.where(y == 1.0, scale_pos_weight, 1.0)[:, None]
            g = g * w
            h = h * w
    elif objective == "binary:hinge":
        sign = 2.0 * t - 1.0
        inside = margin * sign < 1.0
        g = np.where(inside, -sign, 0.0)
        h = np.where(inside, 1.0, 1e-16)
    elif objective == "reg:squaredlogerror":
        p = np.maximum(margin, -1 + 1e-6) + 1.0
        gap = np.log(p) - np.log1p(t)
        g = gap / p
        h = np.maximum((1.0 - gap) / (p * p), 1e-6)
    elif objective == "reg:pseudohubererror":
        z = margin - t
        root = np.sqrt(1.0 + (z / slope) ** 2)
        g = z / root
        h = 1.0 / root ** 3
    elif objective == "reg:absoluteerror":
        g = np.sign(margin - t)
        h = np.ones_like(g)
    elif objective == "reg:quantileerror":
        g = np.where(margin >= t, 1.0 - alpha, -alpha)
        h = np.ones_like(g)
    elif objective == "count:poisson":
        mean = np.exp(margin)
        g = mean - t
        h = mean * np.exp(max_step or 0.7)
    elif objective == "reg:gamma":
        h = t * np.exp(-margin)
        g = 1.0 - h
    elif objective == "reg:tweedie":
        low, high = t * np.exp((1.0 - power) * margin), np.exp((2.0 - power) * margin)
        g = high - low
        h = (2.0 - power) * high - (1.0 - power) * low
    else:  # multi:softprob / multi:softmax
        p = softmax(margin)
        onehot = (np.arange(margin.shape[1])[None, :] == t).astype(np.float64)
        g = p - onehot
        h = np.maximum(2.0 * p * (1.0 - p), 1e-16)
    return g, h


def row_losses(metric: str, margin: np.ndarray, y: np.ndarray, objective: str) -> np.ndarray:
    """What a row adds to an evaluation metric (`P.EVAL_METRICS`); the metric is their mean, its root for rmse."""
    if metric in ("rmse", "mae"):
        gap = np.abs(link(objective, margin[:, 0]) - y)
        return gap * gap if metric == "rmse" else gap
    if metric == "error":
        return ((margin[:, 0] > 0) != (y > 0.5)).astype(float)
    if metric == "merror":
        return (np.argmax(margin, axis=1) != y).astype(float)
    p = sigmoid(margin[:, 0]) if metric == "logloss" else softmax(margin)[np.arange(len(y)), y.astype(np.int64)]
    if metric == "logloss":
        p = np.where(y > 0.5, p, 1.0 - p)
    return -np.log(np.clip(p, 1e-15, 1.0))


def scale_for(largest: float) -> float:
    """Fixed-point scale, a power of two, for sums of values up to ``largest``: 2^20 for ordinary magnitudes, else such
    that the largest value takes about 32 bits, so a task can add 2^30 of them."""
    exponent = int(np.frexp(largest)[1]) if largest > 0 else 0
    return FIXED_SCALE if -4 <= exponent <= 12 else float(2.0 ** (32 - exponent))


def to_fixed(v: np.ndarray, scale: float = FIXED_SCALE) -> np.ndarray:
    """Round to the fixed-point grid (half up, as SQL ``floor(x + 0.5)``)."""
    out = np.floor(v * scale + 0.5)
    if out.size and not np.abs(out).max() < 2.0 ** 36:
        raise OverflowError("a gradient is too large for exact sums: rescale the target or lower learning_rate")
    return out


_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser on uint64 arrays (wrapping arithmetic)."""
    with np.errstate(over="ignore"):
        z = (x + _GOLD).astype(np.uint64)
        z = (z ^ (z >> np.uint64(30))) * _M1
        z = (z ^ (z >> np.uint64(27))) * _M2
        return z ^ (z >> np.uint64(31))


def uniform(rid: np.ndarray, *salt: int) -> np.ndarray:
    """Deterministic uniform [0, 1) per row id and salt values (independent of partitioning)."""
    z = rid.astype(np.int64).view(np.uint64)
    for s in salt:
        with np.errstate(over="ignore"):
            z = mix64(z ^ mix64(np.full(z.shape, np.uint64(s & 0xFFFFFFFFFFFFFFFF), dtype=np.uint64)))
    z = mix64(z)
    return (z >> np.uint64(11)).astype(np.float64) * (1.0 / float(1 << 53))
