"""Dataset sources: labelled tables over any DataFrame, and seeded synthetic generators.

Generators are narrow ``spark.range`` plans: every value is an integer hash of (seed, row, column)
turned into a uniform, then a normal by Box-Muller, so any partitioning gives the same rows. The
hash uses only BIGINT arithmetic below 2^62 so the same numbers can be written in plain SQL.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans import ranks

_P = 2147483647  # 2^31 - 1


def normalize_names(names: list[str]) -> list[str]:
    """Lower-case, runs of non-alphanumerics → '_', trimmed; '' → 'feature'; leading digit → 'f_';
    collisions get '_2', '_3', …"""
    out: list[str] = []
    seen: dict[str, int] = {}
    for raw in names:
        n = re.sub(r"[^0-9a-z]+", "_", str(raw).lower()).strip("_") or "feature"
        if n[0].isdigit():
            n = "f_" + n
        if n in seen:
            seen[n] += 1
            cand = f"{n}_{seen[n]}"
            while cand in seen:
                seen[n] += 1
                cand = f"{n}_{seen[n]}"
            n = cand
        seen.setdefault(n, 1)
        out.append(n)
    return out


def labelled_table(df: DataFrame, features: list[str], label: str, order_by: list[str] | None = None,
                   task: str = "classification") -> DataFrame:
    """``sample_id BIGINT`` (0-based position in ``order_by`` order), snake-cased DOUBLE features, and
    ``target INT`` code + ``target_name`` (classification) or ``target DOUBLE`` (regression)."""
    order_by = order_by or features + [label]
    names = normalize_names(features)
    keyed = df.select(*[F.col(c) for c in dict.fromkeys(order_by + features + [label])])
    ranked, info, layout = ranks.with_rank(keyed, list(order_by))
    cols = [F.col("__rank").alias("sample_id")]
    cols += [F.col(f).cast("double").alias(n) for f, n in zip(features, names)]
    if task == "classification":
        labels = df.select(F.col(label).alias("__lv")).where(F.col("__lv").isNotNull()).distinct()
        codes, _, _ = ranks.with_rank(labels, ["__lv"])              # Spark chooses the join by the size it finds
        out = ranked.join(codes.select("__lv", F.col("__rank").cast("int").alias("__code")), F.col(label) == F.col("__lv"), "left")
        return out.select(*cols, F.col("__code").alias("target"), F.col(label).cast("string").alias("target_name"))
    return ranked.select(*cols, F.col(label).cast("double").alias("target"))


def _mix(v: Column) -> Column:
    v = (v.cast("long") % F.lit(_P)) * F.lit(48271) % F.lit(_P)
    v = (v * F.lit(69621) + F.lit(12345)) % F.lit(_P)
    return v * F.lit(48271) % F.lit(_P)


def uniform_col(seed: int, row: Column, j: int) -> Column:
    """Uniform (0, 1) from (seed, row, column j) by integer mixing; mirrored in SQL."""
    h = _mix(F.lit(seed % _P) + F.lit(1))
    h = _mix(h + row % F.lit(_P))
    h = _mix(h + F.lit(j + 1))
    return (h + F.lit(0.5)) / F.lit(float(_P))


def normal_col(seed: int, row: Column, j: int) -> Column:
    u1 = uniform_col(seed, row, 2 * j)
    u2 = uniform_col(seed, row, 2 * j + 1)
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)


def make_classification(spark: SparkSession, n_samples: int = 100, n_features: int = 20, n_informative: int = 2,
                        n_classes: int = 2, random_state: int = 0) -> DataFrame:
    """``sample_id BIGINT, feature_0.. DOUBLE, target INT``: class c = sample_id mod n_classes; the first
    ``n_informative`` features hold the class's hypercube vertex (±1 by the bits of c) plus N(0,1) noise,
    the rest pure noise. ``n_informative`` is raised to ⌈log2 n_classes⌉ (min 1) and capped at n_features."""
    if n_samples < 1 or n_features < 1 or n_classes < 2:
        raise ValueError("make_classification needs n_samples >= 1, n_features >= 1, n_classes >= 2")
    n_inf = min(max(n_informative, max(1, math.ceil(math.log2(n_classes)))), n_features)
    base = spark.range(n_samples)
    row = F.col("id")
    target = (row % F.lit(n_classes)).cast("int")
    cols = [row.alias("sample_id")]
    for j in range(n_features):
        noise = normal_col(random_state, row, j)
        if j < n_inf:
            bit = F.floor(target / F.lit(2 ** j)) % F.lit(2)
            cols.append((F.lit(2.0) * bit - F.lit(1.0) + noise).alias(f"feature_{j}"))
        else:
            cols.append(noise.alias(f"feature_{j}"))
    cols.append(target.alias("target"))
    return base.select(*cols)


def regression_coefficients(n_features: int, n_informative: int, random_state: int) -> list[float]:
    """Coefficient j: 100 · u(seed, -1, j) for the first ``n_informative`` features, else 0."""
    out = []
    for j in range(n_features):
        if j >= n_informative:
            out.append(0.0)
            continue
        h = _py_mix(random_state % _P + 1)
        h = _py_mix(h + (-1) % _P)
        h = _py_mix(h + j + 1)
        out.append(100.0 * (h + 0.5) / _P)
    return out


def _py_mix(v: int) -> int:
    v = (v % _P) * 48271 % _P
    v = (v * 69621 + 12345) % _P
    return v * 48271 % _P


def make_regression(spark: SparkSession, n_samples: int = 100, n_features: int = 20, n_informative: int = 10,
                    noise: float = 0.0, random_state: int = 0, rows: DataFrame | None = None) -> DataFrame:
    """``sample_id BIGINT, feature_0.. DOUBLE, target DOUBLE`` with target = Σ coef_j · x_j + noise · z. With ``rows`` (a
    BIGINT column ``id``) there is one sample for each of its rows, drawn by that id, instead of ``n_samples``."""
    if n_samples < 1 or n_features < 1:
        raise ValueError("make_regression needs n_samples >= 1 and n_features >= 1")
    n_inf = min(max(n_informative, 0), n_features)
    coef = regression_coefficients(n_features, n_inf, random_state)
    row = F.col("id")
    feats = [normal_col(random_state, row, j) for j in range(n_features)]
    target = F.lit(0.0)
    for j in range(n_inf):
        target = target + F.lit(coef[j]) * feats[j]
    if noise:
        target = target + F.lit(float(noise)) * normal_col(random_state, row, n_features)
    return (spark.range(n_samples) if rows is None else rows).select(row.alias("sample_id"),
                                         *[f.alias(f"feature_{j}") for j, f in enumerate(feats)],
                                         target.alias("target"))
