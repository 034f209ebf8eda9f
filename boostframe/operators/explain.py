"""``explain``: per-row SHAP contributions in long form; Σ shap + base = raw margin. A linear model's contributions are its
terms, weight × value (0 where the value is missing)."""

from __future__ import annotations

from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..functions import shap as S
from ..plans.features import check_feature_types, positional, quoted, require_features
from ..schemas import CLASSIFICATION
from .common import resolve_model
from .predict import Scorer, _arrow_schema, _broadcast


def explain(df: DataFrame, model_name: str = "", model: Any = None, id: str = "",
            root: str | None = None) -> DataFrame:
    """Rows ``[id,] [class,] feature, shap_value, base_value``; ``class`` only for > 2 classes."""
    spark = df.sparkSession
    m = resolve_model(spark, model_name, model, prefer="value", root=root)
    feats = m.meta.feature_names
    if id and id not in df.columns:
        raise ValueError(f"id column {id!r} not found in input; columns: {', '.join(df.columns)}")
    require_features(df, feats)
    check_feature_types(df, feats, m.meta.categorical or [False] * len(feats))
    multiclass = m.meta.n_groups > 2 if m.meta.task == CLASSIFICATION else False
    fields = []
    if id:
        fields.append(df.schema[id])
    if multiclass:
        fields.append(T.StructField("class", T.LongType(), False))
    fields += [T.StructField("feature", T.StringType(), False), T.StructField("shap_value", T.DoubleType(), False),
               T.StructField("base_value", T.DoubleType(), False)]
    schema = T.StructType(fields)
    arrow_schema = _arrow_schema(schema)
    scorer = Scorer(m)
    cover = np.asarray(m.nodes["cover"], dtype=np.float64)
    K = scorer.K
    base = np.array(scorer.base, dtype=np.float64)
    if scorer.linear:
        base = base + scorer.B
    else:
        for t in range(scorer.forest.n_trees):
            base[scorer.forest.tree_class[t]] += S.expected_value(scorer.forest, cover, t)
    bc = _broadcast(spark, (scorer, cover, base))
    n_feat = len(feats)
    names = pa.array(feats, pa.string())
    cols = ([quoted(id).alias("__id")] if id else []) + positional(feats)

    def kernel(batches):
        sc, cov, b0 = bc.value
        fr = sc.forest
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            X = sc.matrix(batch)
            phi = np.zeros((K, n, n_feat))
            if sc.linear:
                phi = np.nan_to_num(X)[None] * sc.W.T[:, None, :]
            else:
                for t in range(fr.n_trees):
                    S.tree_shap(fr, cov, X, t, phi[fr.tree_class[t]])
            out_k = range(K) if multiclass else [0]
            parts = []
            for k in out_k:
                row_idx = np.repeat(np.arange(n), n_feat)
                cols_ = []
                if id:
                    cols_.append(batch.column("__id").take(pa.array(row_idx)))
                if multiclass:
                    cols_.append(pa.array(np.full(n * n_feat, k, dtype=np.int64)))
                cols_ += [names.take(pa.array(np.tile(np.arange(n_feat), n))), pa.array(phi[k].ravel()),
                          pa.array(np.full(n * n_feat, b0[k]))]
                parts.append(pa.RecordBatch.from_arrays(cols_, schema=arrow_schema))
            yield from parts

    return df.select(*cols).mapInArrow(kernel, schema)
