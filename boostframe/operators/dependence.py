"""``partial_dependence``: average model output as one numeric feature sweeps a grid.

The grid is the feature's distinct values if they are fewer than its resolution (found exactly: each
task gives up on the first value beyond), else evenly spaced between the 5th and 95th percentiles.
Between two neighbouring thresholds of the feature the output is the same, so each Arrow batch scores
the trees without the feature once and the others once per interval that the grid meets; it emits
``(grid index, class, Σ, n)`` partials and ``groupBy`` averages them. Rows × grid is never materialised.
"""

from __future__ import annotations

from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import kernel as K
from ..plans.binning import distinct_values
from ..plans.features import positional, quoted, require_features
from ..plans.quantiles import group_quantiles
from ..schemas import CLASSIFICATION, PD_SCHEMA
from .common import resolve_model
from .predict import Scorer, _broadcast


def pd_grid(df: DataFrame, feature: str, grid_resolution: int) -> np.ndarray:
    values = distinct_values(df, [feature], [False], grid_resolution - 1)[0]
    if values:
        return np.asarray(values, dtype=np.float64)
    if values is not None:
        raise ValueError(f"feature {feature!r} has no non-missing values")
    col = F.nanvl(quoted(feature).cast("double"), F.lit(None).cast("double"))
    lo, hi = group_quantiles(df.select(F.lit(0).alias("g"), col.alias("v")), [0.05, 0.95])[0]
    return np.linspace(lo, hi, grid_resolution)


def _intervals(scorer: Scorer, j: int, grid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a grid value for each interval between the feature's thresholds that the grid meets, interval of each grid value)."""
    if scorer.linear:
        return grid, np.arange(len(grid))
    cuts = np.unique(scorer.forest.thr[scorer.forest.feat == j])
    _, first, which = np.unique(np.searchsorted(cuts, grid, side="right"), return_index=True, return_inverse=True)
    return grid[first], which


def partial_dependence(df: DataFrame, model_name: str = "", model: Any = None, feature: str = "",
                       grid_resolution: int = 100, root: str | None = None) -> DataFrame:
    spark = df.sparkSession
    m = resolve_model(spark, model_name, model, prefer="value", root=root)
    feats = m.meta.feature_names
    if not feature:
        raise ValueError("partial_dependence requires 'feature'")
    if feature not in feats:
        raise ValueError(f"feature {feature!r} not found among the model features: {', '.join(feats)}")
    j = feats.index(feature)
    if (m.meta.categorical or [False] * len(feats))[j]:
        raise ValueError(f"partial_dependence supports numeric features only; {feature!r} is categorical")
    require_features(df, feats)
    if grid_resolution < 2:
        raise ValueError("grid_resolution must be >= 2")
    data = df.select(*positional(feats))
    if data.isEmpty():
        raise ValueError("partial_dependence received no rows")
    grid = pd_grid(df, feature, grid_resolution)
    G = len(grid)
    scorer = _broadcast(spark, Scorer(m))
    is_cls = m.meta.task == CLASSIFICATION
    n_cls = len(m.meta.classes or [])
    multi = is_cls and n_cls > 2

    def kernel(batches):
        sc: Scorer = scorer.value
        values, which = _intervals(sc, j, grid)
        uses = None if sc.linear else np.array([bool((sc.forest.feat[a:b] == j).any()) for a, b in zip(
            sc.forest.offsets, np.append(sc.forest.offsets[1:], len(sc.forest.feat)))], dtype=bool)
        acc, n = None, 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            X = sc.matrix(batch)
            n += batch.num_rows
            rest = None if sc.linear else K.margins(sc.forest, X, sc.base, sc.K, np.flatnonzero(~uses))
            sums = []
            for v in values:
                X[:, j] = v
                M = sc.margins(X) if sc.linear else rest + K.margins(sc.forest, X, np.zeros(sc.K), sc.K, np.flatnonzero(uses))
                out = sc.values(M)[:, None] if not is_cls else sc.proba(M) if multi else sc.proba(M)[:, 1:2]
                sums.append(out.sum(axis=0))
            acc = (0 if acc is None else acc) + np.stack(sums)[which]
        if acc is None:
            return
        gi, c = np.meshgrid(np.arange(G), np.arange(acc.shape[1]), indexing="ij")
        yield pa.RecordBatch.from_arrays([pa.array(gi.ravel().astype(np.int32)), pa.array(c.ravel().astype(np.int64)),
                                          pa.array(acc.ravel()), pa.array(np.full(gi.size, n, dtype=np.int64))],
                                         names=["g", "c", "s", "n"])

    parts = data.mapInArrow(kernel, "g int, c long, s double, n long")
    agg = parts.groupBy("g", "c").agg((F.sum("s") / F.sum("n")).alias("pd"))
    grid_df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(grid)], "g int, feature_value double")
    out = agg.join(F.broadcast(grid_df), "g").select(
        F.col("feature_value"),
        (F.col("c") if multi else F.lit(None).cast("long")).alias("class"),
        F.col("pd").alias("partial_dependence"))
    return out.select(*[F.col(f.name).cast(f.dataType) for f in PD_SCHEMA.fields]).orderBy("class", "feature_value")
