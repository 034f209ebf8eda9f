"""Global row numbers without a single-partition window.

Rows are range-partitioned and sorted by the order key and, behind it, by the place of the row in its
input partition, so equal rows spread over partitions however many there are (they are interchangeable,
so which one gets which number changes no result). Within a partition the groups lie one after the other. The layout,
with each row's position in its partition, is kept on disk (range bounds come from a sample and must not be drawn twice; as
large as the table, it would fill the executors' heaps), one small job counts rows per (partition, group), and a column expression adds what is before the partition's group.
The driver only sees the partitions × groups count table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .features import quoted

_POSITION = (1 << 33) - 1     # the bits of `monotonically_increasing_id` that count rows of a partition


@dataclass
class RankInfo:
    groups: list            # group values (sorted)
    totals: list[int]       # rows per group
    first: list             # smallest order key (as a tuple) per group; None without groups


def with_rank(df: DataFrame, order_cols: list[str], group_col: str | None = None,
              rank_col: str = "__rank", keep: list[str] | None = None) -> tuple[DataFrame, RankInfo, DataFrame]:
    """Return ``(ranked, info, layout)``: ``ranked`` = ``df`` + ``rank_col`` (0-based position of the row
    within its group in order-key order; BIGINT). ``layout`` is persisted; unpersist it when done. Of ``df`` only the
    columns ``keep`` need to stay once the rows are in order (all without it); `RankInfo.first` is known with a group only."""
    key = [*order_cols, "__place"]
    needed = set(df.columns if keep is None else keep) | set([group_col, *order_cols] if group_col else [])
    layout = (df.withColumn("__place", F.monotonically_increasing_id())
              .repartitionByRange(*[F.col(c) for c in key])
              .sortWithinPartitions(*[c for c in [group_col] if c], *key).select(*[quoted(c) for c in df.columns if c in needed])
              .withColumn("__pid", F.spark_partition_id())
              .withColumn("__pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION)))
              .persist(StorageLevel.DISK_ONLY))
    gexpr = F.col(group_col) if group_col else F.lit(0)
    least = [F.min(F.struct(*[F.col(c) for c in order_cols])).alias("m")] if group_col else []
    cnt = layout.groupBy(F.col("__pid"), gexpr.alias("__g")).agg(F.count(F.lit(1)).alias("c"), F.min("__pos").alias("p"), *least).collect()
    groups = sorted({r["__g"] for r in cnt})
    gidx = {g: i for i, g in enumerate(groups)}
    n_pid = max([r["__pid"] for r in cnt] + [0]) + 1
    counts = np.zeros((n_pid, max(len(groups), 1)), dtype=np.int64)
    starts = np.zeros_like(counts)                # position of a group's first row in a partition
    first: dict = {}
    for r in cnt:
        counts[r["__pid"], gidx[r["__g"]]] += r["c"]
        starts[r["__pid"], gidx[r["__g"]]] = r["p"]
        g, key = r["__g"], tuple(r["m"]) if group_col else None
        if g not in first or group_col and key < first[g]:
            first[g] = key
    offsets = np.cumsum(counts, axis=0) - counts  # rows of the same group in earlier partitions
    info = RankInfo(groups, [int(v) for v in counts.sum(axis=0)], [first[g] for g in groups])
    shift = F.lit((offsets - starts).ravel().tolist())
    group = F.array_position(F.array(*map(F.lit, groups)).cast(T.ArrayType(df.schema[group_col].dataType)), F.col(group_col)).cast("int") - 1 if group_col and groups else F.lit(0)
    rank = F.col("__pos") + F.element_at(shift, F.col("__pid") * max(len(groups), 1) + group + 1).cast("long")
    return layout.select("*", rank.alias(rank_col)).drop("__pos"), info, layout


def class_starts(info: RankInfo) -> dict:
    """Per group: rows of the groups numbered before it (groups are numbered by first appearance in row order)."""
    order = sorted(range(len(info.groups)), key=lambda i: info.first[i])
    before = np.cumsum([0] + [info.totals[i] for i in order])
    return {info.groups[i]: int(before[k]) for k, i in enumerate(order)}


def stratified_bounds(info: RankInfo, n_splits: int) -> dict:
    """Per group: cumulative fold sizes (row r of the group goes to the first fold whose bound exceeds r).

    Classes are numbered by first appearance in row order; fold f takes, from the class-sorted order,
    the positions ≡ f (mod n_splits).
    """
    order = sorted(range(len(info.groups)), key=lambda i: info.first[i])
    bounds = {}
    start = 0
    for i in order:
        cnt = info.totals[i]
        alloc = np.array([_count_congruent(start, start + cnt, f, n_splits) for f in range(n_splits)])
        bounds[info.groups[i]] = np.cumsum(alloc)
        start += cnt
    return bounds


def _count_congruent(lo: int, hi: int, f: int, k: int) -> int:
    """#{i in [lo, hi) : i ≡ f (mod k)}."""
    def upto(x: int) -> int:  # count in [0, x)
        return 0 if x <= f else (x - f - 1) // k + 1
    return upto(hi) - upto(lo)


def plain_bounds(n: int, n_splits: int) -> np.ndarray:
    sizes = np.full(n_splits, n // n_splits, dtype=np.int64)
    sizes[: n % n_splits] += 1
    return np.cumsum(sizes)
