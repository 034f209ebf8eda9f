"""Exact order statistics of many groups at once, without sorting or collecting any group.

Doubles become 64-bit keys of the same order. Four passes look at 16 bits each: every pass counts, per group, the rows that
share the bits found so far by their next 16 bits (counted in the tasks, summed in a shuffle), and a window over these counts
finds the bits of the wanted rank. The driver gets one row per wanted value and pass; groups may be of any size.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..memory import releasing

DIGIT = 16
HELD_CELLS = 1 << 20        # counted cells that a task holds before it sends them on


def to_keys(values: np.ndarray) -> np.ndarray:
    """Unsigned integers in the order of the doubles (both zeros are one)."""
    bits = (np.asarray(values, np.float64) + 0.0).view(np.int64)
    return (bits ^ ((bits >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))).view(np.uint64) ^ np.uint64(1 << 63)


def from_keys(keys: np.ndarray) -> np.ndarray:
    bits = (np.asarray(keys, np.uint64) ^ np.uint64(1 << 63)).view(np.int64)
    return (bits ^ ((bits >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))).view(np.float64)


def _count_kernel(pairs: Callable, low: np.ndarray, high: np.ndarray, level: int):
    def kernel(batches):
        held: list = []
        size = 0

        def merged():
            cells, at = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
            return cells, np.bincount(at, weights=np.concatenate([h[1] for h in held])).astype(np.int64)

        for batch in batches:
            slot, value = pairs(batch)
            keep = ~np.isnan(value)
            slot, keys = slot[keep], to_keys(value[keep])
            shift = np.uint64(64 - DIGIT * (level + 1))
            digit = ((keys >> shift) & np.uint64((1 << DIGIT) - 1)).astype(np.int64)
            front = keys >> (shift + np.uint64(DIGIT)) if level else np.zeros(len(keys), np.uint64)
            for side, prefix in enumerate((low, high)):
                mine = front == prefix[slot]
                if side:                                  # where both ranks share a prefix it is counted once
                    mine &= low[slot] != high[slot]
                cells, counts = np.unique(((slot[mine] * 2 + side) << DIGIT) | digit[mine], return_counts=True)
                held.append((cells, counts))
                size += len(cells)
            if size > HELD_CELLS:
                held = [merged()]
                size = len(held[0][0])
                if size > HELD_CELLS // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], names=["cell", "n"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in merged()], names=["cell", "n"])

    return kernel


def order_statistics(rows: DataFrame, pairs: Callable, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of ranks ``low[s]`` and ``high[s]`` (from 0, ``low <= high``; -1: none, the value is NaN) among the values
    of every slot s. ``pairs`` turns an Arrow batch of ``rows`` into (slot, value) arrays; NaN values don't count."""
    spark, slots = rows.sparkSession, len(low)
    ranks = np.stack([low, high], 1).astype(np.int64)
    prefix = np.zeros((slots, 2), np.uint64)
    live = np.flatnonzero(ranks[:, 0] >= 0)
    for level in range(64 // DIGIT) if len(live) else ():
        counts = (rows.mapInArrow(releasing(_count_kernel(pairs, prefix[:, 0].copy(), prefix[:, 1].copy(), level)), "cell long, n long")
                  .groupBy("cell").agg(F.sum("n").alias("n"))
                  .select(F.shiftright("cell", DIGIT).alias("at"), F.col("cell").bitwiseAND(F.lit((1 << DIGIT) - 1)).alias("digit"), "n"))
        upto = F.sum("n").over(Window.partitionBy("at").orderBy("digit")).alias("upto")
        wanted = [(int(2 * s + (side if prefix[s, 0] != prefix[s, 1] else 0)), int(2 * s + side), int(ranks[s, side]))
                  for s in live for side in (0, 1)]
        want = spark.createDataFrame(wanted, "at long, target long, place long")
        found = (counts.select("at", "digit", "n", upto).join(want, "at")
                 .where((F.col("place") < F.col("upto")) & (F.col("place") >= F.col("upto") - F.col("n")))
                 .select("target", "digit", (F.col("upto") - F.col("n")).alias("before")).collect())
        for r in found:
            s, side = divmod(r["target"], 2)
            prefix[s, side] = (int(prefix[s, side]) << DIGIT) | r["digit"]
            ranks[s, side] -= r["before"]
    out = from_keys(prefix.ravel()).reshape(slots, 2)
    out[ranks[:, 0] < 0] = np.nan
    return out[:, 0], out[:, 1]


def many_order_statistics(rows: DataFrame, groups: Callable, ranks: list[np.ndarray], digit: int = 8) -> list[np.ndarray]:
    """Per group the values of many ranks at once (ascending, from 0), as for cut points.

    ``groups`` turns an Arrow batch into (group, values) pairs; NaN values don't count. Each pass counts, per prefix that a
    wanted rank lies under, the next ``digit`` bits: at most 2^digit cells a wanted rank, however many rows there are.
    """
    spark = rows.sparkSession
    prefix = [np.zeros(len(r), np.uint64) for r in ranks]
    place = [np.asarray(r, np.int64).copy() for r in ranks]
    first = np.concatenate([[0], np.cumsum([len(r) for r in ranks])])
    for level in range(64 // digit) if first[-1] else ():
        under = [np.unique(p) for p in prefix]
        base = np.concatenate([[0], np.cumsum([len(u) for u in under])])

        def count(batches, level=level, under=under, base=base):
            shift = np.uint64(64 - digit * (level + 1))
            held: list = []
            for batch in batches:
                for g, value in groups(batch):
                    keys = to_keys(value[~np.isnan(value)])
                    if not len(keys) or not len(under[g]):
                        continue
                    front = keys >> (shift + np.uint64(digit)) if level else np.zeros(len(keys), np.uint64)
                    at = np.minimum(np.searchsorted(under[g], front), len(under[g]) - 1)
                    mine = under[g][at] == front
                    code = ((base[g] + at[mine]) << digit) | ((keys[mine] >> shift) & np.uint64((1 << digit) - 1)).astype(np.int64)
                    held.append(np.unique(code, return_counts=True))
                if len(held) > 64 or sum(len(h[0]) for h in held) > HELD_CELLS:
                    cells, place_of = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
                    held = [(cells, np.bincount(place_of, weights=np.concatenate([h[1] for h in held])).astype(np.int64))]
            for cells, counts in held:
                yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(counts)], names=["cell", "n"])

        counts = (rows.mapInArrow(releasing(count), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
                  .select(F.shiftright("cell", digit).alias("at"), F.col("cell").bitwiseAND(F.lit((1 << digit) - 1)).alias("digit"), "n"))
        wanted = [(int(base[g] + i), int(first[g] + t), int(p)) for g in range(len(ranks))
                  for t, (i, p) in enumerate(zip(np.searchsorted(under[g], prefix[g]), place[g]))]
        want = spark.createDataFrame(wanted, "at long, target long, place long")
        upto = F.sum("n").over(Window.partitionBy("at").orderBy("digit")).alias("upto")
        found = (counts.select("at", "digit", "n", upto).join(want, "at")
                 .where((F.col("place") < F.col("upto")) & (F.col("place") >= F.col("upto") - F.col("n")))
                 .select("target", "digit", (F.col("upto") - F.col("n")).alias("before")).toArrow())
        for target, bits, before in zip(*(found.column(c).to_pylist() for c in ("target", "digit", "before"))):
            g = int(np.searchsorted(first, target, side="right")) - 1
            t = target - int(first[g])
            prefix[g][t] = (int(prefix[g][t]) << digit) | bits
            place[g][t] -= before
    return [from_keys(p) for p in prefix]


def quantiles(rows: DataFrame, pairs: Callable, counts: np.ndarray, prob) -> np.ndarray:
    """The ``prob`` quantile (between neighbours linearly) of every slot, of which ``counts`` values exist; NaN if none do."""
    place = np.asarray(prob, np.float64) * (np.asarray(counts, np.int64) - 1)
    low = np.floor(place).astype(np.int64)
    high = np.minimum(low + 1, np.asarray(counts, np.int64) - 1)
    empty = np.asarray(counts) == 0
    a, b = order_statistics(rows, pairs, np.where(empty, -1, low), np.where(empty, -1, high))
    return a + (b - a) * (place - low)


def group_quantiles(rows: DataFrame, probs: list[float]) -> dict[int, list[float]]:
    """Quantiles of column ``v`` (double; null and NaN don't count) per value of column ``g`` (long). Groups are few: folds,
    classes, features; their sizes don't matter."""
    rows = rows.select(F.col("g").cast("long").alias("g"), F.col("v").cast("double").alias("v")).where("v IS NOT NULL AND NOT isnan(v)")
    sizes = sorted((r["g"], r["n"]) for r in rows.groupBy("g").agg(F.count(F.lit(1)).alias("n")).collect())
    names = np.array([g for g, _ in sizes], np.int64)
    width = len(probs)

    def pairs(batch: pa.RecordBatch):
        slot = np.searchsorted(names, batch.column(0).to_numpy(zero_copy_only=False)) * width
        value = batch.column(1).to_numpy(zero_copy_only=False)
        return np.concatenate([slot + i for i in range(width)]), np.tile(value, width)

    got = quantiles(rows, pairs, np.repeat([n for _, n in sizes], width), np.tile(probs, len(names)))
    return {int(g): got[i * width:(i + 1) * width].tolist() for i, g in enumerate(names)}
