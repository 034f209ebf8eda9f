"""Split choice inside tasks: partial histograms in, one row per tree node out.

A histogram pass sends one row per (slot, feature) of its partition: the bins that occur there and their fixed-point sums
(`PartialSums`). The rows are shuffled by (feature, slot), so the histogram of a node's feature is summed and searched in
the task that owns it (`split_kernel`), whatever the number of nodes, features and bins; the best feature of a slot is a
grouped maximum. The driver gets one row per slot and never a histogram.

Sums travel as 64-bit integers and are added in two 32-bit limbs, so they are exact and do not depend on the order of tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..memory import releasing

DENSE_CELLS = 1 << 22       # cells that a histogram pass adds up in plain arrays; beyond, occurring cells only
SPARSE_CELLS = 1 << 21      # occurring cells that a task holds before it sends them on
BLOCK_CELLS = 1 << 20       # cells that are searched for splits at a time
SLOT_BYTES = 16 << 20       # partials of a slot that one task reads rather than one task per feature
RT_EPS = 1e-6               # minimum loss change of a split

PARTIAL = "slot int, feature int, bins binary, g binary, h binary, n binary"
SPLIT = ("slot int, gain double, minus_feature int, split_bin int, cats array<int>, default_left boolean, gl double, hl double, "
         "nl long, gt double, ht double, nt long, wl double, wr double")


# ------------------------------------------------------------------------------------------------ partial sums

class PartialSums:
    """Sums of (g, h, 1) by cell number: in arrays over all cells if these are few, else over the cells that occur."""

    def __init__(self, size: int):
        self.size, self.dense = size, size <= DENSE_CELLS
        self._clear()

    def _clear(self) -> None:
        self.parts, self.held = [], 0
        self.sums = np.zeros((3, self.size), np.int64) if self.dense else None

    def add(self, keys: np.ndarray, g: np.ndarray, h: np.ndarray) -> None:
        if self.dense and self.size <= 4 * keys.size:
            self.sums[0] += np.rint(np.bincount(keys, weights=g, minlength=self.size)).astype(np.int64)
            self.sums[1] += np.rint(np.bincount(keys, weights=h, minlength=self.size)).astype(np.int64)
            self.sums[2] += np.bincount(keys, minlength=self.size)
            return
        cells, at = np.unique(keys, return_inverse=True)
        new = np.stack([np.rint(np.bincount(at, weights=g)).astype(np.int64),
                        np.rint(np.bincount(at, weights=h)).astype(np.int64), np.bincount(at)])
        if self.dense:
            self.sums[:, cells] += new
            return
        self.parts.append((cells, new))
        self.held += len(cells)
        if self.held > SPARSE_CELLS:
            self._merge()

    def _merge(self) -> None:
        cells = np.concatenate([p[0] for p in self.parts])
        values = np.concatenate([p[1] for p in self.parts], axis=1)
        order = np.argsort(cells, kind="stable")
        cells, values = cells[order], values[:, order]
        first = np.flatnonzero(np.diff(cells, prepend=-1))
        self.parts = [(cells[first], np.add.reduceat(values, first, axis=1))]
        self.held = len(first)

    @property
    def full(self) -> bool:
        return not self.dense and self.held > SPARSE_CELLS // 2

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        """(cells in order, [3, cells] sums); the sums start again at zero."""
        if self.dense:
            cells = np.flatnonzero(self.sums[2])
            out = cells, self.sums[:, cells]
        elif self.parts:
            self._merge()
            out = self.parts[0]
        else:
            out = np.empty(0, np.int64), np.empty((3, 0), np.int64)
        self._clear()
        return out


def _binary(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """One binary value per run of ``values`` that begins at ``starts``."""
    offsets = (np.append(starts, len(values)) * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def partial_batch(cells: np.ndarray, sums: np.ndarray, offsets: np.ndarray, total: int) -> pa.RecordBatch:
    """PARTIAL rows of sums by cell: cell = slot * total + offsets[feature] + bin."""
    slot, place = np.divmod(cells, total)
    feature = np.searchsorted(offsets, place, side="right") - 1
    bins = (place - offsets[feature]).astype(np.int32)
    starts = np.flatnonzero((np.diff(slot, prepend=-1) != 0) | (np.diff(feature, prepend=-1) != 0))
    return pa.RecordBatch.from_arrays(
        [pa.array(slot[starts].astype(np.int32)), pa.array(feature[starts].astype(np.int32)), _binary(bins, starts),
         *(_binary(s.astype(np.int64), starts) for s in sums)], names=["slot", "feature", "bins", "g", "h", "n"])


def _flat(column: pa.Array, kind) -> np.ndarray:
    """All numbers of a binary column, one value after the other."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]].view(kind) if data is not None else np.empty(0, kind)


def unpack_partials(batches):
    """PARTIAL rows as (slot, feature, bin, g, h, n) rows."""
    for batch in batches:
        if not batch.num_rows:
            continue
        bins = batch.column(2)
        offsets = np.frombuffer(bins.buffers()[1], np.int32)[bins.offset:bins.offset + len(bins) + 1]
        sizes = np.diff(offsets) // 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(batch.column(i).to_numpy(), sizes)) for i in (0, 1)] + [pa.array(_flat(bins, np.int32))]
            + [pa.array(_flat(batch.column(i), np.int64)) for i in (3, 4, 5)], names=["slot", "feature", "bin", "g", "h", "n"])


# ------------------------------------------------------------------------------------------------ scores

def _shrunk(G, alpha: float):
    return G if alpha == 0 else np.sign(G) * np.maximum(np.abs(G) - alpha, 0.0)


def weight(G, H, p: dict, low=-np.inf, high=np.inf):
    """The best leaf value (before the learning rate) of gradient sums: its step is limited by ``max_delta_step`` and it
    lies within the bounds that monotone constraints set."""
    step = p["max_delta_step"]
    with np.errstate(divide="ignore", invalid="ignore"):
        w = np.where(H + p["reg_lambda"] > 0, -(_shrunk(G, p["reg_alpha"]) / (H + p["reg_lambda"])), 0.0)
    if step > 0:
        w = np.clip(w, -step, step)
    return np.clip(w, low, high)


def score(G, H, p: dict, low=None, high=None):
    """Twice the loss that the best leaf value saves."""
    lam = p["reg_lambda"]
    Gt = _shrunk(G, p["reg_alpha"])
    if p["max_delta_step"] == 0 and low is None:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(H + lam > 0, Gt * Gt / (H + lam), 0.0)
    w = weight(G, H, p, *(() if low is None else (low, high)))
    return -(2.0 * Gt * w + (H + lam) * w * w)


# ------------------------------------------------------------------------------------------------ search

@dataclass
class Search:
    """What the split choice needs to know: bins per feature, and per slot its parameters, scales, allowed features and,
    under monotone constraints, the bounds of its leaf value."""
    n_bins: np.ndarray
    categorical: np.ndarray
    params: list                    # the different parameter sets
    params_of: np.ndarray           # slot → its parameter set
    g_scale: np.ndarray
    h_scale: np.ndarray
    allowed: np.ndarray             # [slots, features]
    low: np.ndarray                 # per slot
    high: np.ndarray
    monotone: list                  # per parameter set: None, or a sign per feature
    own_bins: np.ndarray | None = None      # [slots, features]: bins of the numbers that a slot's model knows, if fewer


def _candidates(G, H, N, categorical: bool, onehot: bool, lam: float, most: int):
    """(G, H, N) of the left sides, which of them count, and the order of categories (or None). Many categories are
    ordered by G / (H + lambda); the left side is a run of at most ``most`` from either end of this order."""
    if categorical and onehot:
        return (G, H, N), N > 0, None
    if not categorical:
        sums = tuple(np.cumsum(x, 1)[:, :-1] for x in (G, H, N))
        return sums, np.ones(sums[0].shape, bool), None
    present = N > 0
    order = np.argsort(np.where(present, G / (H + lam + 1e-300), np.inf), axis=1, kind="stable")
    sums = tuple(np.cumsum(np.take_along_axis(x, order, 1), 1)[:, :-1] for x in (G, H, N))
    size, held = np.arange(1, G.shape[1])[None, :], present.sum(1, keepdims=True)
    sums = tuple(np.where(size <= most, s, x.sum(1, keepdims=True) - s) for s, x in zip(sums, (G, H, N)))
    return sums, (size < held) & ((size <= most) | (held - size <= most)), order


def best_splits(search: Search, feature: int, slots: np.ndarray, G: np.ndarray, H: np.ndarray, N: np.ndarray) -> list[tuple]:
    """SPLIT rows of one feature: for every slot (a row of G, H, N; the last bin holds missing values) its best split.

    Ties go to the lowest bin, then to missing values on the left; a gain of -1 marks that there is none.
    """
    bins, rows = int(search.n_bins[feature]), []
    total = [x.sum(1) for x in (G, H, N)]
    of = search.params_of[slots]
    for which in np.unique(of):
        p, mine = search.params[which], np.flatnonzero(of == which)
        Gt, Ht, Nt = (t[mine][:, None] for t in total)
        none = [(int(slots[i]), -1.0, -feature, -1, None, True, 0.0, 0.0, 0, float(total[0][i]), float(total[1][i]),
                 int(total[2][i]), 0.0, 0.0) for i in mine]
        ok = search.allowed[slots[mine], feature]
        if bins < 2 or not ok.any():
            rows += none
            continue
        categorical = bool(search.categorical[feature])
        onehot = categorical and bins < p["max_cat_to_onehot"]
        missing = tuple(x[mine, bins][:, None] for x in (G, H, N))
        left, counts, order = _candidates(*(x[mine, :bins] for x in (G, H, N)), categorical, onehot, p["reg_lambda"],
                                          p["max_cat_threshold"])
        GL, HL, NL = (np.stack([c + m, c], axis=2) for c, m in zip(left, missing))     # missing values left, or right
        GR, HR, NR = (t[:, :, None] - x for t, x in zip((Gt, Ht, Nt), (GL, HL, NL)))
        if search.own_bins is not None and not categorical:
            counts = counts & (np.arange(bins - 1)[None, :] < search.own_bins[slots[mine], feature][:, None] - 1)
        signs = search.monotone[which]
        bounds = () if signs is None else (search.low[slots[mine]][:, None], search.high[slots[mine]][:, None])
        wide = tuple(b[:, :, None] for b in bounds)
        gain = score(GL, HL, p, *wide) + score(GR, HR, p, *wide) - score(Gt, Ht, p, *bounds)[:, :, None]
        least = p["min_child_weight"]
        valid = (HL >= least) & (HR >= least) & (NL > 0) & (NR > 0) & counts[:, :, None] & ok[:, None, None]
        if signs is not None and signs[feature]:
            valid &= signs[feature] * (weight(GR, HR, p, *wide) - weight(GL, HL, p, *wide)) >= 0
        flat = np.where(valid, gain, -np.inf).reshape(len(mine), -1)
        top = np.argmax(flat, axis=1)
        for i, at in enumerate(top.tolist()):
            if not flat[i, at] > RT_EPS:
                rows.append(none[i])
                continue
            b, side = divmod(at, 2)
            cats = None if not categorical else [b] if order is None else sorted(
                (order[i, :b + 1] if b < p["max_cat_threshold"] else order[i, b + 1:int((N[mine[i], :bins] > 0).sum())]).tolist())
            edge = () if signs is None else (float(wide[0][i, 0, 0]), float(wide[1][i, 0, 0]))
            wl, wr = (float(weight(g[i, b, side], h[i, b, side], p, *edge)) for g, h in ((GL, HL), (GR, HR)))
            rows.append((int(slots[mine[i]]), float(flat[i, at]), -feature, b, cats, side == 0, float(GL[i, b, side]),
                         float(HL[i, b, side]), int(NL[i, b, side]), *none[i][9:12], wl, wr))
    return rows


class _Sums:
    """Exact sums of a run of PARTIAL rows sorted by (feature, slot), searched as soon as a (feature, slot) is complete."""

    def __init__(self, search: Search):
        self.search, self.carry = search, None

    def _limbs(self, keys, values, size):
        low = np.bincount(keys, weights=(values & 0xFFFFFFFF).astype(np.float64), minlength=size)
        high = np.bincount(keys, weights=(values >> 32).astype(np.float64), minlength=size)
        return low.astype(np.int64), high.astype(np.int64)

    def feed(self, batch: pa.RecordBatch):
        """Splits of the groups that end in ``batch``; the sums of its last group are carried on."""
        slot, feature = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        bins = batch.column(2)
        offsets = np.frombuffer(bins.buffers()[1], np.int32)[bins.offset:bins.offset + len(bins) + 1]
        ends = (offsets - offsets[0]) // 4
        flat_bins = _flat(bins, np.int32)
        g, h, n = (_flat(batch.column(i), np.int64) for i in (3, 4, 5))
        new = np.flatnonzero((np.diff(slot, prepend=-1) != 0) | (np.diff(feature, prepend=-1) != 0))
        stops = np.append(new[1:], len(slot))
        at = 0
        while at < len(new):
            f = int(feature[new[at]])
            width = int(self.search.n_bins[f]) + 1
            same = int(np.searchsorted(feature[new], f, side="right"))
            end = min(same, at + max(1, BLOCK_CELLS // width))
            a, b = int(ends[new[at]]), int(ends[stops[end - 1]])
            group = np.repeat(np.arange(end - at), np.diff(np.append(ends[new[at:end]], b)))
            keys, size = group * width + flat_bins[a:b], (end - at) * width
            sums = [*self._limbs(keys, g[a:b], size), *self._limbs(keys, h[a:b], size),
                    np.bincount(keys, weights=n[a:b], minlength=size).astype(np.int64)]
            sums = [s.reshape(end - at, width) for s in sums]
            slots = slot[new[at:end]]
            if self.carry is not None:
                key, held = self.carry
                if key == (f, int(slots[0])):
                    for s, more in zip(sums, held):
                        s[0] += more
                else:
                    yield from self._search(key[0], np.array([key[1]]), [x[None, :] for x in held])
                self.carry = None
            if end == len(new):
                self.carry = ((f, int(slots[-1])), [s[-1].copy() for s in sums])
                slots, sums = slots[:-1], [s[:-1] for s in sums]
            if len(slots):
                yield from self._search(f, slots, sums)
            at = end

    def finish(self):
        if self.carry is not None:
            key, held = self.carry
            yield from self._search(key[0], np.array([key[1]]), [x[None, :] for x in held])

    def _search(self, feature, slots, sums):
        g_low, g_high, h_low, h_high, n = sums
        G = (g_high * 4294967296.0 + g_low) / self.search.g_scale[slots][:, None]
        H = (h_high * 4294967296.0 + h_low) / self.search.h_scale[slots][:, None]
        yield from best_splits(self.search, feature, slots, G, H, n)


def split_kernel(search: Search):
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "array<int>": pa.list_(pa.int32())}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in SPLIT.split(", "))])

    def kernel(batches):
        sums, best = _Sums(search), {}

        def keep(rows):
            for row in rows:
                held = best.get(row[0])
                if held is None or row[1:3] > held[1:3]:
                    best[row[0]] = row

        for batch in batches:
            if batch.num_rows:
                keep(sums.feed(batch))
        keep(sums.finish())
        if best:
            rows = list(best.values())
            yield pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(zip(*rows), schema)],
                                             schema=schema)

    return kernel


def choose_splits(partials: DataFrame, search: Search, partitions: int) -> DataFrame:
    """One SPLIT row per slot with data: that of its best feature (ties: the first). ``partitions`` of the table send
    partials. Where those of all features of a slot are few bytes together, a slot goes to one task; else its features
    are searched in different tasks and a grouped maximum follows."""
    names = [c.split()[0] for c in SPLIT.split(", ")]
    one_task = 28 * int((search.n_bins + 1).sum()) * partitions <= SLOT_BYTES
    splits = (partials.repartition(*(["slot"] if one_task else ["feature", "slot"])).sortWithinPartitions("feature", "slot")
              .mapInArrow(releasing(split_kernel(search)), SPLIT))
    if one_task:
        return splits
    return splits.groupBy("slot").agg(F.max(F.struct(*names[1:])).alias("best")).select("slot", "best.*")
