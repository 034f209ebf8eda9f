"""Distributed second-order histogram boosting (level-wise) over a persisted, binned table.

Per boosting round and tree level there is exactly one data pass: a ``mapInArrow`` that, for every
row, computes gradients from the row's stored margins, routes the row through every tree being grown
(all models × classes × parallel trees at once), and adds fixed-point (g, h, 1) into a per-partition
histogram keyed by (slot, feature, bin). The partials are shuffled by (slot, feature) and searched for
splits where they meet (`splits`); the driver receives the best split of every slot, one row each. Trees grown since the state was last written are applied again inside the
pass (they are few); when they are ``PENDING_TREES``, or every ``CHECKPOINT_EVERY`` rounds, a narrow
``mapInArrow`` writes the margin columns with their leaf values and the new state is persisted (and
checkpointed to the cluster's checkpoint directory to cut lineage). Until then no margin is stored: every row has
the starting ones. Trees of the last rounds are added where the final rows are read. The margins are the same either way.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions import kernel as K
from ..memory import bound_batches, releasing, storage
from . import quantiles, splits, summaries
from .binning import BINS_COL, DataStats, code_type

PENDING_TREES = 32          # trees applied inside the passes before the margins are rewritten
CHECKPOINT_EVERY = 10       # rounds between reliable checkpoints of the state (when a dir is configured)


@dataclass
class ModelSpec:
    params: dict
    rounds: int
    parallel: int
    objective: str
    n_groups: int
    base: np.ndarray
    test_fold: int = -1
    seed: int = 0
    n_train: int = 0
    g_scale: float = K.FIXED_SCALE      # fixed-point scales of the gradients and of the second derivatives
    h_scale: float = K.FIXED_SCALE
    monotone: np.ndarray | None = None  # per feature: 1 rising, -1 falling, 0 free
    groups: list | None = None          # sets of features (by position) that may share a path
    leaf_quantile: float | None = None  # leaves are this quantile of the residuals
    metric: str | None = None           # evaluated after every round on the rows that are not learned from
    metric_scale: float = K.FIXED_SCALE
    history: list = field(default_factory=list)
    best_round: int | None = None
    stopped: bool = False

    def note(self, total: float, n: int) -> None:
        """Take the metric after one more round; stop if it has not fallen for ``early_stopping_rounds``."""
        value = total / n if n else float("nan")
        self.history.append(value ** 0.5 if self.metric == "rmse" else value)
        self.best_round = 1 + int(np.argmin(np.nan_to_num(self.history, nan=np.inf)))
        patience = self.params["early_stopping_rounds"]
        self.stopped = patience is not None and len(self.history) - self.best_round >= patience


@dataclass
class Grower:
    """A tree being grown on the driver, in bin space."""
    model: int
    group: int
    par: int
    allowed: np.ndarray                 # bool [F] after colsample_bytree
    feat: list = field(default_factory=list)
    split_bin: list = field(default_factory=list)
    cats: list = field(default_factory=list)
    dleft: list = field(default_factory=list)
    left: list = field(default_factory=list)
    right: list = field(default_factory=list)
    gain: list = field(default_factory=list)
    G: list = field(default_factory=list)
    H: list = field(default_factory=list)
    N: list = field(default_factory=list)
    depth: list = field(default_factory=list)
    open: list = field(default_factory=list)   # node may still be split
    value: list = field(default_factory=list)
    low: list = field(default_factory=list)       # bounds of the leaf value under monotone constraints
    high: list = field(default_factory=list)
    path: list = field(default_factory=list)      # features used above the node
    cuts: dict = field(default_factory=dict)      # features cut anew this round → the cuts; their thresholds are values
    waiting: dict = field(default_factory=dict)   # best-first growth: node → its best split, not made yet

    def add(self, G: float, H: float, N: int, depth: int, low: float = -np.inf, high: float = np.inf,
            path: frozenset = frozenset()) -> int:
        self.feat.append(-1)
        self.split_bin.append(-1)
        self.cats.append(None)
        self.dleft.append(True)
        self.left.append(-1)
        self.right.append(-1)
        self.gain.append(0.0)
        self.G.append(G)
        self.H.append(H)
        self.N.append(N)
        self.depth.append(depth)
        self.open.append(True)
        self.value.append(0.0)
        self.low.append(low)
        self.high.append(high)
        self.path.append(path)
        return len(self.feat) - 1

    def n_leaves(self) -> int:
        return sum(1 for f in self.feat if f < 0)

    def split(self, node: int, best, sign: int = 0) -> None:
        """Make the split ``best``; along a rising (1) or falling (-1) feature the middle of the two leaf values bounds
        all that grows below either side."""
        f = -best["minus_feature"]
        self.feat[node], self.split_bin[node], self.cats[node] = f, best["split_bin"], best["cats"]
        self.dleft[node], self.gain[node] = best["default_left"], best["gain"]
        low, high, middle = self.low[node], self.high[node], (best["wl"] + best["wr"]) / 2
        sides = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}[sign]
        GL, HL, NL = best["gl"], best["hl"], best["nl"]
        depth, path = self.depth[node] + 1, self.path[node] | {f}
        self.left[node] = self.add(GL, HL, NL, depth, *sides[0], path)
        self.right[node] = self.add(self.G[node] - GL, self.H[node] - HL, self.N[node] - NL, depth, *sides[1], path)

    def split_best(self, spec: ModelSpec) -> bool:
        """Make the waiting split with the largest gain (the first of equal ones), if another leaf is allowed."""
        if not self.waiting or self.n_leaves() >= spec.params["max_leaves"]:
            return False
        node = max(self.waiting, key=lambda n: (self.waiting[n]["gain"], -n))
        best = self.waiting.pop(node)
        self.split(node, best, _sign(spec, best))
        return True

    def bin_tree(self) -> dict:
        """Tree for routing rows of the state: numeric threshold = split bin + 0.5 (a value where cuts are taken anew every
        round), categories by code."""
        return {
            "feat": list(self.feat),
            "thr": [0.0 if f < 0 else float(self.cuts[f][b]) if f in self.cuts else b + 0.5 for f, b in zip(self.feat, self.split_bin)],
            "dleft": list(self.dleft),
            "left": list(self.left),
            "right": list(self.right),
            "value": list(self.value),
            "cats": list(self.cats),
        }


def _sign(spec: ModelSpec, best) -> int:
    return 0 if spec.monotone is None else int(spec.monotone[-best["minus_feature"]])


def may_follow(groups: list | None, path: frozenset, n_feat: int) -> np.ndarray:
    """Features that may split a node below ``path``: those of all groups that hold the whole path, and the path's own."""
    out = np.ones(n_feat, dtype=bool)
    if groups is not None and path:
        out[:] = False
        out[sorted(path.union(*[g for g in groups if path <= g]))] = True
    return out


def best_first(p: dict) -> bool:
    """Without a limit on leaves, all splits are made in the end and the order does not matter."""
    return p["grow_policy"] == "lossguide" and p["max_leaves"] > 0


def gradient_options(p: dict) -> tuple:
    return tuple(float(p[k]) for k in ("scale_pos_weight", "tweedie_variance_power", "huber_slope", "max_delta_step",
                                       "quantile_alpha"))


def _feature_offsets(stats: DataStats) -> tuple[np.ndarray, np.ndarray, int]:
    nb = np.array([f.n_bins for f in stats.features], dtype=np.int64)
    off = np.concatenate([[0], np.cumsum(nb + 1)[:-1]]).astype(np.int64)
    return nb, off, int((nb + 1).sum())


def _colsample(rng: np.random.RandomState, allowed: np.ndarray, frac: float) -> np.ndarray:
    if frac >= 1.0:
        return allowed.copy()
    idx = np.nonzero(allowed)[0]
    k = max(1, int(frac * idx.size))
    pick = rng.choice(idx, size=k, replace=False) if idx.size else idx
    out = np.zeros_like(allowed)
    out[pick] = True
    return out


# ----------------------------------------------------------------------------------------------
# executor kernels


class _Codes:
    """Bin codes of a batch as the models of each fold see them (-1: those of all rows, which see them as they are).
    Rows are routed by codes, or by the numbers themselves where features are cut anew every round (``raw``)."""

    def __init__(self, X: np.ndarray, maps: list | None, raw: dict):
        self.maps, self.raw, self.seen = maps, raw, {-1: (X, self._routed(X, raw))}

    @staticmethod
    def _routed(X: np.ndarray, raw: dict) -> np.ndarray:
        Xn = np.where(X < 0, np.nan, X)
        for j, value in raw.items():
            Xn[:, j] = value
        return Xn

    def binned(self, fold: int, cuts: dict) -> np.ndarray:
        """Codes for a histogram: of a round's cuts where there are any."""
        X = self.of(fold)[0]
        if cuts:
            X = X.copy()
            for j, at in cuts.items():
                X[:, j] = np.where(np.isnan(self.raw[j]), -1.0, np.searchsorted(at, self.raw[j], side="right"))
        return X

    def of(self, fold: int) -> tuple[np.ndarray, np.ndarray]:
        fold = fold if self.maps is not None else -1
        if fold not in self.seen:
            X = self.seen[-1][0].copy()
            for j, codes in enumerate(self.maps[fold]):
                if codes is not None:
                    X[:, j] = np.where(X[:, j] < 0, -1, codes[np.maximum(X[:, j], 0).astype(np.int64)])
            self.seen[fold] = X, self._routed(X, self.raw)
        return self.seen[fold]

    def route(self, forest: K.Forest, folds: list[int]) -> np.ndarray:
        """Leaves of all trees, the t-th of which belongs to a model of fold ``folds[t]``."""
        if self.maps is None:
            return K.route(forest, self.of(-1)[1])
        out = np.empty((len(self.seen[-1][0]), forest.n_trees), np.int32)
        for fold in set(folds):
            mine = np.array([t for t, f in enumerate(folds) if f == fold])
            out[:, mine] = K.route(forest, self.of(fold)[1], mine)
        return out


#: Numbers of the state that a block holds as bytes, by the beginning of their name.
_PACKED = {"__rid": "<i8", "__y": "<f8", "__fold": "<i4", "__val": "u1", "__w": "<f8", "__m": "<f8"}


def _packed_kind(name: str) -> str | None:
    return next((kind for start, kind in _PACKED.items() if name == start or name.startswith(start) and name[len(start):].isdigit()), None)


def pack_state(state: DataFrame) -> DataFrame:
    """The state as blocks of rows: one value of bytes per column, so a pass hands Python a few buffers instead of rows.
    Other columns (an id) become an array per block."""
    fields = [T.StructField("n", T.IntegerType(), False)]
    for f in state.schema:
        bytes_ = f.name == BINS_COL or _packed_kind(f.name)
        fields.append(T.StructField(f.name, T.BinaryType() if bytes_ else T.ArrayType(f.dataType), False))

    def kernel(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [pa.array([batch.num_rows], pa.int32())]
            for name, col in zip(batch.schema.names, batch.columns):
                kind = _packed_kind(name)
                if name == BINS_COL:
                    offsets = np.frombuffer(col.buffers()[1], np.int32)[col.offset:col.offset + len(col) + 1]
                    cols.append(pa.array([bytes(memoryview(col.buffers()[2])[offsets[0]:offsets[-1]])], pa.binary()))
                elif kind:
                    cols.append(pa.array([col.to_numpy(zero_copy_only=False).astype(kind).tobytes()], pa.binary()))
                else:
                    cols.append(pa.ListArray.from_arrays(pa.array([0, len(col)], pa.int32()), col))
            yield pa.RecordBatch.from_arrays(cols, names=["n", *batch.schema.names])

    return state.mapInArrow(releasing(kernel), T.StructType(fields))


def unpack_state(packed: DataFrame, schema: T.StructType, ctx: dict) -> DataFrame:
    """Rows of a packed state: the columns of ``schema``, the margins with the trees that the stored ones lack."""
    arrow = {f.name: f.type for f in to_arrow_schema(schema)}

    def kernel(batches):
        for batch in batches:
            for i, block in enumerate(_blocks(batch)):
                codes, M, _, _, _ = _state_arrays(block, ctx["n_feat"], ctx["start"], ctx["has_fold"], ctx["kind"], ctx["maps"], ctx["raw"])
                _add_pending(ctx["pending"], codes, M)
                cols = []
                for name in schema.names:
                    if name.startswith("__m"):
                        cols.append(pa.array(M[:, int(name[3:])]))
                    elif _packed_kind(name):
                        cols.append(pa.array(block[name]).cast(arrow[name]))
                    else:
                        cols.append(batch.column(batch.schema.get_field_index(name)).slice(i, 1).flatten())
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return packed.mapInArrow(releasing(kernel), schema)


def _blocks(batch: pa.RecordBatch):
    """The blocks of a batch of the packed state: name → numbers (bins: bytes)."""
    names = batch.schema.names
    for i in range(batch.num_rows):
        block = {"n": batch.column(0)[i].as_py()}
        for name, col in zip(names, batch.columns):
            kind = "u1" if name == BINS_COL else _packed_kind(name)
            if kind:
                block[name] = np.frombuffer(col[i].as_buffer(), kind)
        yield block


def _state_arrays(block: dict, n_feat: int, start: np.ndarray, has_fold: bool, kind: str, maps: list | None = None,
                  raw: list | tuple = ()):
    """Codes, margins, targets, row hashes (None where nothing is sampled) and folds of a block; ``start``: the margins
    before any tree, those of every row until margins are stored."""
    n = block["n"]
    codes = _Codes(block[BINS_COL].view(kind).reshape(n, n_feat).astype(np.float64), maps, {j: block[f"__w{j}"] for j in raw})
    M = np.tile(start, (n, 1))
    for j in range(len(start)) if "__m0" in block else ():
        M[:, j] = block[f"__m{j}"]
    fold = block["__fold"] if has_fold else None
    if "__val" in block:                  # rows that are only evaluated are the held-out fold -1 of every model
        fold = np.where(block["__val"].astype(bool), -1, 0 if fold is None else fold)
    return codes, M, block["__y"], block.get("__rid"), fold


@dataclass
class Pending:
    """Trees whose leaf values the stored margins lack, in the order in which they count."""
    trees: list = field(default_factory=list)
    weights: list = field(default_factory=list)
    cols: list = field(default_factory=list)
    folds: list = field(default_factory=list)

    def add(self, tree: dict, weight: float, col: int, fold: int) -> None:
        self.trees.append(tree)
        self.weights.append(weight)
        self.cols.append(col)
        self.folds.append(fold)

    def forest(self):
        """(forest, margin column and fold of each tree), or None without trees."""
        if not self.trees:
            return None
        return K.build_forest(self.trees, [0] * len(self.trees), self.weights), list(self.cols), list(self.folds)


def _add_pending(pending, codes: _Codes, M: np.ndarray) -> None:
    if pending is None:
        return
    forest, cols, folds = pending
    leaves = codes.route(forest, folds)
    for t, c in enumerate(cols):
        M[:, c] += forest.value[leaves[:, t]] * forest.tree_weight[t]


def _make_hist_kernel(ctx: dict):
    F_ = ctx["n_feat"]
    start = ctx["start"]
    has_fold = ctx["has_fold"]
    nb = ctx["nb"]
    off = ctx["off"]
    TB = ctx["TB"]
    n_slots = ctx["n_slots"]

    def kernel(batches):
        forest: K.Forest = ctx["forest"]
        slot_of = ctx["slot_of"]
        sums = splits.PartialSums((n_slots + len(ctx["watch"])) * TB)
        for block in (b for batch in batches for b in _blocks(batch)):
            n = block["n"]
            codes, M, y, rid, fold = _state_arrays(block, F_, start, has_fold, ctx["kind"], ctx["maps"], ctx["raw"])
            _add_pending(ctx["pending"], codes, M)
            drop = ctx.get("drop_forest")
            if drop is not None:   # dart: gradients at the margins without this round's dropped trees
                dv = drop.value[codes.route(drop, ctx["drop_fold"])] * drop.tree_weight[None, :]
                for t, c in enumerate(ctx["drop_col"]):
                    M[:, c] -= dv[:, t]
            # gradients for every (model, group) margin column, fixed point
            Gf = np.empty_like(M)
            Hf = np.empty_like(M)
            known = y if fold is None else np.where(fold == -1, 0.0, y)       # targets of rows that are learned from
            for obj, kk, c0, options, g_scale, h_scale in ctx["models"]:
                g, h = K.gradients(obj, M[:, c0:c0 + kk], known, *options)
                Gf[:, c0:c0 + kk] = K.to_fixed(g, g_scale)
                Hf[:, c0:c0 + kk] = K.to_fixed(h, h_scale)
            for slot, c0, kk, objective, metric, scale, test_fold in ctx["watch"]:
                mine = (fold == test_fold) & ~np.isnan(y) if fold is not None else np.zeros(n, bool)
                loss = K.to_fixed(K.row_losses(metric, M[mine, c0:c0 + kk], y[mine], objective), scale)
                sums.add(np.full(len(loss), slot * TB, np.int64), loss, np.zeros(len(loss)))
            tree_folds = [t[1] for t in ctx["trees"]]
            slots = slot_of[codes.route(forest, tree_folds)]     # [n, T]
            valid = slots >= 0
            # (row, tree) pairs that feed a slot, by the fold whose bins they take, in chunks bounded in memory
            pairs: dict = {}
            for t, (mcol, test_fold, sub, salt) in enumerate(ctx["trees"]):
                v = valid[:, t]
                if fold is not None:
                    v &= fold != test_fold
                if sub < 1.0:
                    v &= K.uniform(rid, *salt) < sub
                r = np.nonzero(v)[0]
                if r.size:
                    view = test_fold if ctx["maps"] is not None else -1, mcol if ctx["cuts"] else -1
                    pairs.setdefault(view, []).append((r, np.full(r.size, t, dtype=np.int64)))
            mcols = np.asarray([tc[0] for tc in ctx["trees"]], dtype=np.int64)
            step = max(1, (1 << 22) // max(F_, 1))
            for view, parts in pairs.items():
                X = codes.binned(view[0], ctx["cuts"].get(view[1], {}))
                binfix = np.where(X < 0, nb[None, :], X).astype(np.int64) + off[None, :]
                rr_all, tt_all = (np.concatenate(p) for p in zip(*parts))
                for s in range(0, rr_all.size, step):
                    rr, tt = rr_all[s:s + step], tt_all[s:s + step]
                    base = slots[rr, tt].astype(np.int64) * TB
                    mc = mcols[tt]
                    sums.add((base[:, None] + binfix[rr]).ravel(), np.repeat(Gf[rr, mc], F_), np.repeat(Hf[rr, mc], F_))
                    if sums.full:
                        yield splits.partial_batch(*sums.take(), off, TB)
        yield splits.partial_batch(*sums.take(), off, TB)

    return kernel


def _make_update_kernel(ctx: dict):
    F_ = ctx["n_feat"]
    start = ctx["start"]
    has_fold = ctx["has_fold"]

    def kernel(batches):
        for batch in batches:
            names = [n for n in batch.schema.names if not n.startswith("__m")]
            for i, block in enumerate(_blocks(batch)):
                codes, M, _, _, _ = _state_arrays(block, F_, start, has_fold, ctx["kind"], ctx["maps"], ctx["raw"])
                _add_pending(ctx["pending"], codes, M)
                cols = batch.slice(i, 1).select(names).columns + [pa.array([m.tobytes()], pa.binary()) for m in M.T]
                yield pa.RecordBatch.from_arrays(cols, names=names + [f"__m{j}" for j in range(len(start))])

    return kernel


def _prune(gr: Grower, gamma: float, params: dict) -> None:
    """Bottom-up: collapse splits whose children are leaves and whose loss change is below gamma."""
    if gamma <= 0:
        return
    changed = True
    while changed:
        changed = False
        for i in range(len(gr.feat)):
            if gr.feat[i] >= 0:
                li, ri = gr.left[i], gr.right[i]
                if gr.feat[li] < 0 and gr.feat[ri] < 0 and gr.gain[i] < gamma:
                    gr.feat[i] = -1
                    gr.left[i] = gr.right[i] = -1
                    gr.cats[i] = None
                    changed = True


def _compact(gr: Grower) -> Grower:
    """Renumber reachable nodes in breadth-first order (root 0, children in left/right order)."""
    order = [0]
    i = 0
    while i < len(order):
        n = order[i]
        if gr.feat[n] >= 0:
            order += [gr.left[n], gr.right[n]]
        i += 1
    new_id = {old: new for new, old in enumerate(order)}
    out = Grower(gr.model, gr.group, gr.par, gr.allowed, cuts=gr.cuts)
    for old in order:
        out.add(gr.G[old], gr.H[old], gr.N[old], gr.depth[old], gr.low[old], gr.high[old], gr.path[old])
        j = new_id[old]
        out.feat[j] = gr.feat[old]
        out.split_bin[j] = gr.split_bin[old]
        out.cats[j] = gr.cats[old]
        out.dleft[j] = gr.dleft[old]
        out.gain[j] = gr.gain[old] if gr.feat[old] >= 0 else 0.0
        out.value[j] = gr.value[old]
        if gr.feat[old] >= 0:
            out.left[j] = new_id[gr.left[old]]
            out.right[j] = new_id[gr.right[old]]
        out.open[j] = False
    return out


# ----------------------------------------------------------------------------------------------
# driver loop


def _checkpoint_ok(spark) -> bool:
    try:
        return spark.sparkContext.getCheckpointDir() is not None
    except Exception:
        return False


def train(state: DataFrame, stats: DataStats, specs: list[ModelSpec], has_fold: bool):
    """Grow every model in ``specs`` in shared passes over the rows of ``state`` (with starting margins in ``__m*`` columns,
    laid out model by model). Returns ``(trees, final_state)``; ``trees[m]`` is a list of ``(Grower, tree_weight)``. The
    final state (target, fold, id and the margins after the last round; computed as it is read) is
    returned with a ``cleanup`` callable that releases the persisted generations once the caller is done."""
    spark = state.sparkSession
    bound_batches(spark)                  # the packed state is read a few blocks at a time
    n_feat = len(stats.features)
    kind = code_type(stats.features)          # of the stored codes
    anew = [j for j, i in enumerate(stats.features) if i.sketched] if specs[0].params["tree_method"] == "approx" else []
    if anew:
        most = np.arange(specs[0].params["max_bin"] - 1, dtype=np.float64)
        stats = replace(stats, features=[replace(i, cuts=most) if j in anew else i for j, i in enumerate(stats.features)])
    start = np.concatenate([s.base for s in specs]).astype(np.float64)
    col0 = np.concatenate([[0], np.cumsum([s.n_groups for s in specs])[:-1]]).astype(int)
    models_ctx = [(s.objective, s.n_groups, int(col0[i]), gradient_options(s.params), s.g_scale, s.h_scale)
                  for i, s in enumerate(specs)]
    trees: list[list] = [[] for _ in specs]
    rngs = [np.random.RandomState(s.seed & 0x7FFFFFFF) for s in specs]
    max_rounds = max(s.rounds for s in specs)
    sampled, at = any(s.params["subsample"] < 1.0 for s in specs), storage(stats.n_rows)
    rows = T.StructType([f for f in state.schema if f.name not in (BINS_COL, "__rid") and not f.name.startswith("__w")])
    state.unpersist()                     # what stays is the packed form
    margins = [f"__m{j}" for j in range(len(start))]
    state0 = state = pack_state(state.drop(*margins, *([] if sampled else ["__rid"]))).persist(at)
    packed = T.StructType([*state.schema, *(T.StructField(m, T.BinaryType(), False) for m in margins)])
    partitions = state.rdd.getNumPartitions()         # may compute the packed form, so not asked of the rows
    row_ctx = {"n_feat": n_feat, "start": start, "has_fold": has_fold, "kind": kind, "maps": stats.fold_maps, "raw": anew}
    older = None
    pending = Pending()
    watch = [(i, s) for i, s in enumerate(specs) if s.metric is not None]
    for rnd in range(max_rounds):
        growers: list[Grower] = []
        for mi, s in enumerate(specs):
            if rnd >= s.rounds or s.stopped:
                continue
            for k in range(s.n_groups):      # tree order within a round: class-major, then parallel tree
                for p in range(s.parallel):
                    allowed = _colsample(rngs[mi], np.ones(n_feat, dtype=bool), s.params["colsample_bytree"])
                    g = Grower(mi, k, p, allowed)
                    g.add(0.0, 0.0, 0, 0)
                    growers.append(g)
        cuts: dict = {}
        if anew:
            cuts = _round_cuts(state, stats, specs, models_ctx, start, has_fold, anew, pending.forest())
            for g in growers:
                g.cuts = cuts[int(col0[g.model] + g.group)]
        # dart: trees dropped for this round, per model (indices into trees[m])
        drop_sets: dict[int, list[int]] = {}
        for mi, s in enumerate(specs):
            if s.params["booster"] == "dart" and rnd < s.rounds and trees[mi] and s.params["rate_drop"] > 0:
                if rngs[mi].rand() >= s.params["skip_drop"]:
                    mask = rngs[mi].rand(len(trees[mi])) < s.params["rate_drop"]
                    if mask.any():
                        drop_sets[mi] = [int(i) for i in np.nonzero(mask)[0]]
        drop_trees = [(mi, i) for mi, idx in drop_sets.items() for i in idx]
        drop_forest = None
        drop_col, drop_fold = [], [specs[mi].test_fold for mi, _ in drop_trees]
        if drop_trees:
            drop_forest = K.build_forest([trees[mi][i][0].bin_tree() for mi, i in drop_trees], [0] * len(drop_trees),
                                         [trees[mi][i][1] for mi, i in drop_trees])
            drop_col = [int(col0[mi] + trees[mi][i][0].group) for mi, i in drop_trees]
        # per-tree contexts: margin column, held-out fold, subsample, sampling salt
        tree_ctx = []
        for g in growers:
            s = specs[g.model]
            tree_ctx.append((int(col0[g.model] + g.group), s.test_fold, float(s.params["subsample"]),
                             (s.seed, rnd, g.group, g.par)))
        level = 0
        level_allowed = {}
        if not growers:
            break
        while True:
            frontier = []
            for gi, g in enumerate(growers):
                s = specs[g.model]
                md = s.params["max_depth"]
                for ni in range(len(g.feat)):
                    if not g.open[ni]:
                        continue
                    if (md > 0 and g.depth[ni] >= md) or (level > 0 and g.N[ni] < 2) or \
                            (level > 0 and g.H[ni] < 2 * s.params["min_child_weight"]):
                        g.open[ni] = False
                        continue
                    frontier.append((gi, ni))
            if not frontier:
                if any([g.split_best(specs[g.model]) for g in growers]):
                    continue
                break
            # column sampling by level / node
            allowed = np.zeros((len(frontier), n_feat), dtype=bool)
            for i, (gi, ni) in enumerate(frontier):
                g = growers[gi]
                s = specs[g.model]
                lk = (gi, level)
                if lk not in level_allowed:
                    level_allowed[lk] = _colsample(rngs[g.model], g.allowed, s.params["colsample_bylevel"])
                may = level_allowed[lk] & may_follow(s.groups, g.path[ni], n_feat)
                allowed[i] = _colsample(rngs[g.model], may, s.params["colsample_bynode"])
            asked = _waiting(watch, rnd) if level == 0 else []
            partials = level_partials(state, stats, growers, frontier, tree_ctx, models_ctx, start, has_fold, drop_forest,
                                      drop_col, pending.forest(), drop_fold, cuts, anew,
                                      _watched(asked, specs, col0, len(frontier)))
            best, noted = _level_splits(partials, stats, specs, growers, frontier, allowed, partitions, asked)
            for i, row in noted:
                specs[i].note(row["gt"], row["nt"])
            if any(specs[i].stopped for i, _ in noted):       # what grows of a model that has ended is not kept
                for g in growers:
                    if specs[g.model].stopped:
                        g.open = [False] * len(g.open)
                best = [None if specs[growers[gi].model].stopped else b for b, (gi, _) in zip(best, frontier)]
            # under a leaf limit the best-gain splits of the level come first; best-first growth makes one at a time
            order = sorted(range(len(frontier)), key=lambda i: -(best[i]["gain"] if best[i] else -1.0))
            leaves_now = {gi: growers[gi].n_leaves() for gi in {f[0] for f in frontier}}
            for i in order:
                gi, ni = frontier[i]
                g = growers[gi]
                s = specs[g.model]
                b = best[i]
                if level == 0 and b:
                    g.G[ni], g.H[ni], g.N[ni] = b["gt"], b["ht"], b["nt"]
                g.open[ni] = False
                ml = s.params["max_leaves"]
                if b is None or b["gain"] <= 0 or (ml > 0 and leaves_now[gi] + 1 > ml and not best_first(s.params)):
                    continue
                if best_first(s.params):
                    g.waiting[ni] = b
                    continue
                g.split(ni, b, _sign(s, b))
                leaves_now[gi] += 1
            for g in {gi: growers[gi] for gi, _ in frontier}.values():
                g.split_best(specs[g.model])
            level += 1
        # leaf values, pruning, compaction
        growers, tree_ctx = (list(x) for x in zip(*[(g, c) for g, c in zip(growers, tree_ctx) if not specs[g.model].stopped])) \
            if any(not specs[g.model].stopped for g in growers) else ([], [])
        done = []
        for g in growers:
            s = specs[g.model]
            eta = s.params["learning_rate"] / s.parallel
            for ni in range(len(g.feat)):
                g.value[ni] = float(splits.weight(g.G[ni], g.H[ni], s.params, g.low[ni], g.high[ni])) * eta
            _prune(g, s.params["gamma"], s.params)
            cg = _compact(g)
            done.append(cg)
        if any(specs[g.model].leaf_quantile is not None for g in growers):
            _order_leaves(state, stats, specs, done, tree_ctx, start, has_fold, pending.forest(), anew)
        # dart "tree" normalisation: new trees weigh 1/(k+lr), dropped trees are scaled by k/(k+lr)
        new_w = []
        for cg in done:
            s = specs[cg.model]
            k = len(drop_sets.get(cg.model, []))
            lr = s.params["learning_rate"] / (s.n_groups * s.parallel)
            new_w.append(1.0 / (k + lr) if k else 1.0)
        for cg, w in zip(done, new_w):
            pending.add(cg.bin_tree(), w, int(col0[cg.model] + cg.group), specs[cg.model].test_fold)
        for mi, idx in drop_sets.items():
            s = specs[mi]
            k = len(idx)
            lr = s.params["learning_rate"] / (s.n_groups * s.parallel)
            factor = k / (k + lr)
            for i in idx:
                g_old, w_old = trees[mi][i]
                trees[mi][i] = (g_old, w_old * factor)
                pending.add(g_old.bin_tree(), w_old * factor - w_old, int(col0[mi] + g_old.group), s.test_fold)
        for cg, w in zip(done, new_w):
            trees[cg.model].append((cg, w))
        ended = rnd == max_rounds - 1 or all(s.stopped or rnd + 1 >= s.rounds for s in specs)
        if ended and watch:
            _finish_watch(state, stats, specs, watch, col0, models_ctx, start, has_fold, pending, partitions, anew, trees)
        if ended:
            break
        save = (rnd + 1) % CHECKPOINT_EVERY == 0
        if not (save or len(pending.trees) >= PENDING_TREES):
            continue
        # margin update: new persisted state (first read by the next round's root pass)
        ctx = {**row_ctx, "pending": pending.forest()}
        pending = Pending()
        new_state = state.mapInArrow(releasing(_make_update_kernel(ctx)), packed).persist(at)
        if save and _checkpoint_ok(spark):
            ck = new_state.checkpoint(eager=True)
            new_state.unpersist()
            new_state = ck.persist(at)
        # ``state`` was materialised by this round's passes, so the generation before it can go
        if older is not None:
            older.unpersist()
        older = state if state is not state0 else None
        state = new_state

    def cleanup() -> None:
        for frame in (older, state, state0):
            if frame is not None:
                frame.unpersist()

    return trees, unpack_state(state, rows, {**row_ctx, "pending": pending.forest()}), cleanup


def _waiting(watch, rnd: int) -> list[int]:
    """Models whose metric after ``rnd`` rounds is not known yet."""
    return [i for i, s in watch if not s.stopped and len(s.history) == rnd - 1 and 1 <= rnd <= s.rounds]


def _watched(models: list[int], specs, col0, slots: int) -> list:
    """(slot, margin columns, loss) of the models whose metric a pass sums behind its own ``slots``."""
    return [(slots + n, int(col0[i]), specs[i].n_groups, specs[i].objective, specs[i].metric, specs[i].metric_scale, specs[i].test_fold)
            for n, i in enumerate(models)]


def _finish_watch(state, stats, specs, watch, col0, models_ctx, start, has_fold, pending, partitions, anew, trees) -> None:
    """The metric after the last round of the models that went so far; then every watched model that may stop early keeps
    the rounds up to its best one, in its trees and in the margins."""
    rounds = {i: len(trees[i]) // (s.n_groups * s.parallel) for i, s in watch}
    for rnd in sorted({r for i, r in rounds.items() if len(specs[i].history) < r}):
        asked = _waiting([(i, s) for i, s in watch if rounds[i] == rnd], rnd)
        partials = level_partials(state, stats, [], [], [], models_ctx, start, has_fold, pending=pending.forest(), raw=anew,
                                  watch=_watched(asked, specs, col0, 0))
        _, noted = _level_splits(partials, stats, specs, [], [], np.zeros((0, len(stats.features)), bool), partitions, asked)
        for i, row in noted:
            specs[i].note(row["gt"], row["nt"])
    for i, s in watch:
        if s.params["early_stopping_rounds"] is None or not s.history:
            continue
        keep = s.best_round * s.n_groups * s.parallel
        for grower, w in trees[i][keep:]:
            pending.add(grower.bin_tree(), -w, int(col0[i] + grower.group), s.test_fold)
        del trees[i][keep:]


def _round_cuts(state, stats, specs, models_ctx, start, has_fold, anew, pending) -> dict:
    """Margin column → feature → cuts of this round: quantiles of the column's training rows, weighted by its second
    derivatives, from one pass over the state."""
    n_feat, kind, maps, folds = len(stats.features), code_type(stats.features), stats.fold_maps, [s.test_fold for s in specs]

    def weighed(batch):
        for block in _blocks(batch):
            codes, M, y, _, fold = _state_arrays(block, n_feat, start, has_fold, kind, maps, anew)
            _add_pending(pending, codes, M)
            known = y if fold is None else np.where(fold == -1, 0.0, y)
            for (objective, k, c0, options, _, h_scale), test_fold in zip(models_ctx, folds):
                h = K.to_fixed(K.gradients(objective, M[:, c0:c0 + k], known, *options)[1], h_scale)
                mine = np.ones(len(y), bool) if fold is None else fold != test_fold
                for c in range(k):
                    for j in anew:
                        yield c0 + c, j, codes.raw[j][mine], h[mine, c]

    found = summaries.weighted_cuts(state, weighed, specs[0].params["max_bin"])
    return {c: {j: found.get((c, j), np.empty(0)) for j in anew} for c in range(len(start))}


def _order_leaves(state, stats, specs, growers, tree_ctx, start, has_fold, pending, raw) -> None:
    """Set the leaves of trees under an order-statistic objective: the quantile of the residuals of the rows that grew them."""
    mine = [i for i, g in enumerate(growers) if specs[g.model].leaf_quantile is not None]
    forest = K.build_forest([growers[i].bin_tree() for i in mine], [0] * len(mine), [1.0] * len(mine))
    slot_of = np.full(len(forest.feat), -1, np.int64)
    leaves = [(i, n) for i in mine for n, f in enumerate(growers[i].feat) if f < 0]
    at = {i: int(forest.offsets[j]) for j, i in enumerate(mine)}
    for slot, (i, n) in enumerate(leaves):
        slot_of[at[i] + n] = slot
    n_feat, kind, maps, trees = len(stats.features), code_type(stats.features), stats.fold_maps, [tree_ctx[i] for i in mine]

    def pairs(batch):
        slots, values = [np.empty(0, np.int64)], [np.empty(0)]
        for block in _blocks(batch):
            codes, M, y, rid, fold = _state_arrays(block, n_feat, start, has_fold, kind, maps, raw)
            _add_pending(pending, codes, M)
            leaf = codes.route(forest, [t[1] for t in trees])
            for t, (mcol, test_fold, sub, salt) in enumerate(trees):
                used = np.ones(len(y), bool)
                if fold is not None:
                    used &= fold != test_fold
                if sub < 1.0:
                    used &= K.uniform(rid, *salt) < sub
                slots.append(slot_of[leaf[used, t]])
                values.append((y - M[:, mcol])[used])
        return np.concatenate(slots), np.concatenate(values)

    counts = np.array([growers[i].N[n] for i, n in leaves])
    probs = np.array([specs[growers[i].model].leaf_quantile for i, _ in leaves])
    for (i, n), value in zip(leaves, quantiles.quantiles(state, pairs, counts, probs)):
        s = specs[growers[i].model]
        growers[i].value[n] = 0.0 if np.isnan(value) else float(value) * s.params["learning_rate"] / s.parallel


def level_partials(state, stats, growers, frontier, tree_ctx, models_ctx, start, has_fold, drop_forest=None,
                   drop_col=None, pending=None, drop_fold=None, cuts=None, raw=(), watch=()) -> DataFrame:
    """The partial histograms of one data pass (`splits.PARTIAL` rows) for all slots of ``frontier``."""
    nb, off, TB = _feature_offsets(stats)
    forest = K.build_forest([g.bin_tree() for g in growers], [0] * len(growers), [1.0] * len(growers))
    slot_of = np.full(forest.feat.shape[0], -1, dtype=np.int64)
    for i, (gi, ni) in enumerate(frontier):
        slot_of[forest.offsets[gi] + ni] = i
    ctx = {"n_feat": len(stats.features), "start": start, "has_fold": has_fold, "nb": nb, "off": off, "TB": TB,
           "kind": code_type(stats.features), "n_slots": len(frontier), "forest": forest, "slot_of": slot_of,
           "trees": tree_ctx, "models": models_ctx, "drop_forest": drop_forest, "drop_col": drop_col or [],
           "drop_fold": drop_fold or [], "maps": stats.fold_maps, "pending": pending, "cuts": cuts or {}, "raw": raw, "watch": watch}
    return state.mapInArrow(releasing(_make_hist_kernel(ctx)), splits.PARTIAL)


def _level_splits(partials: DataFrame, stats, specs, growers, frontier, allowed, partitions: int, watched: list[int]):
    """Best split of every slot of the frontier (None for a slot that no row reached), and (model, its row) of the metrics
    that the pass summed behind the slots for the models ``watched``."""
    model_of = [growers[gi].model for gi, _ in frontier]
    n_bins, n_feat, extra = _feature_offsets(stats)[0], len(stats.features), len(watched)
    own = None
    if stats.fold_maps is not None:
        of = [n_bins] + [np.array([n if m is None or info.categorical else int(m.max()) + 1 for n, m, info in zip(n_bins, row, stats.features)])
                         for row in stats.fold_maps]
        own = np.stack([of[specs[m].test_fold + 1] for m in model_of + watched])
    if any(growers[gi].cuts for gi, _ in frontier):
        own = np.tile(n_bins, (len(frontier) + extra, 1)) if own is None else own
        for i, (gi, _) in enumerate(frontier):
            for j, at in growers[gi].cuts.items():
                own[i, j] = len(at) + 1
    models = sorted(set(model_of + watched))
    search = splits.Search(
        n_bins=n_bins, own_bins=own, categorical=np.array([f.categorical for f in stats.features]),
        params=[specs[m].params for m in models], params_of=np.searchsorted(models, model_of + watched),
        g_scale=np.array([specs[m].g_scale for m in model_of] + [specs[m].metric_scale for m in watched]),
        h_scale=np.array([specs[m].h_scale for m in model_of] + [1.0] * extra),
        allowed=np.concatenate([allowed, np.zeros((extra, n_feat), bool)]),
        low=np.array([growers[gi].low[ni] for gi, ni in frontier] + [-np.inf] * extra),
        high=np.array([growers[gi].high[ni] for gi, ni in frontier] + [np.inf] * extra), monotone=[specs[m].monotone for m in models])
    best: list = [None] * len(frontier)
    noted = []
    for row in splits.choose_splits(partials, search, partitions).collect():
        if row["slot"] < len(frontier):
            best[row["slot"]] = row
        else:
            noted.append((watched[row["slot"] - len(frontier)], row))
    return best, noted
