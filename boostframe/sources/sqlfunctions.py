"""Table functions for SQL: ``predict``, ``explain`` and ``feature_importance``.

    SELECT * FROM predict(TABLE(new_rows), model_name => 'churn', id => 'id')
    SELECT * FROM explain(TABLE(new_rows), model => m, id => 'id')          -- m: a session variable with a model value
    SELECT * FROM feature_importance(model_name => 'churn', importance_type => 'gain')

A function's columns follow from the model and the table (its ``analyze`` step). The rows of each partition stay where they
are: they are taken up a block at a time and scored by the same kernels as `operators.predict` and `operators.explain`.
"""

from __future__ import annotations

from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import udtf
from pyspark.sql.udtf import AnalyzeResult

from ..functions import shap as S
from ..model import Model
from ..operators.predict import Scorer, check_modes, output_schema
from ..plans.features import check_feature_types, require_features
from ..schemas import CLASSIFICATION, IMPORTANCE_SCHEMA
from ..session import ensure_session
from . import registry

BLOCK = 4096


def _given(argument, otherwise=None):
    """The constant behind an argument of ``analyze``."""
    return otherwise if argument is None or argument.value is None else argument.value


def _model(known: dict[str, bytes], name, value, prefer: str) -> Model:
    """The model of a name (of those registered) or a value; ``prefer`` decides when both are given."""
    if value is not None and (prefer == "value" or not name):
        return Model.from_bytes(value)
    if not name:
        raise ValueError("either 'model_name' or 'model' must be given")
    if name not in known:
        raise ValueError(f"model {name!r} not found among those that register_functions was called for: {sorted(known)}")
    return Model.from_bytes(known[name])


def _check_table(table: T.StructType, model: Model, id_col: str) -> SimpleNamespace:
    rows = SimpleNamespace(schema=table, columns=table.names)
    if id_col and id_col not in rows.columns:
        raise ValueError(f"id column {id_col!r} not found in input; columns: {', '.join(rows.columns)}")
    require_features(rows, model.meta.feature_names)
    check_feature_types(rows, model.meta.feature_names, model.meta.categorical or [False] * len(model.meta.feature_names))
    return rows


class _Blocks:
    """Rows of a partition, scored a block at a time."""

    def __init__(self):
        self.scorer, self.rows, self.ids = None, [], []

    def _start(self, model: Model) -> None:
        self.model, self.scorer = model, Scorer(model)
        self.categorical = model.meta.categorical or [False] * len(model.meta.feature_names)

    def _take(self, row, id_col) -> bool:
        self.rows.append([row[name] for name in self.model.meta.feature_names])
        self.ids.append((row[id_col],) if id_col else ())
        return len(self.rows) >= BLOCK

    def _matrix(self) -> np.ndarray:
        columns = list(zip(*self.rows))
        arrays = [pa.array(c, pa.string()) if cat else pa.array([None if v is None else float(v) for v in c], pa.float64())
                  for c, cat in zip(columns, self.categorical)]
        return self.scorer.matrix(pa.RecordBatch.from_arrays(arrays, names=[f"f{j}" for j in range(len(arrays))]))

    def _done(self) -> list[tuple]:
        ids, self.rows, self.ids = self.ids, [], []
        return ids


def predict_function(known: dict[str, bytes]):
    class Predict(_Blocks):
        @staticmethod
        def analyze(data, model_name=None, model=None, id=None, with_proba=None, output_margin=None, pred_leaf=None):
            modes = [bool(_given(a, False)) for a in (with_proba, output_margin, pred_leaf)]
            check_modes(*modes)
            m, id_col = _model(known, _given(model_name), _given(model), "name"), _given(id, "")
            return AnalyzeResult(output_schema(_check_table(data.dataType, m, id_col), m, id_col, *modes))

        def eval(self, data, model_name=None, model=None, id=None, with_proba=None, output_margin=None, pred_leaf=None):
            if self.scorer is None:
                self._start(_model(known, model_name, model, "name"))
                self.modes = bool(with_proba), bool(output_margin), bool(pred_leaf)
            if self._take(data, id):
                yield from self._score()

        def terminate(self):
            if self.rows:
                yield from self._score()

        def _score(self):
            proba, margin, leaf = self.modes
            scorer, meta, X = self.scorer, self.model.meta, self._matrix()
            if leaf:
                columns = [scorer.leaves(X).tolist()]
            else:
                M = scorer.margins(X)
                if margin:
                    columns = [M.max(axis=1).tolist()]
                elif meta.task == CLASSIFICATION:
                    columns = [[meta.classes[c] for c in scorer.codes(M)]]
                else:
                    columns = [scorer.values(M).tolist()]
                if proba and meta.task == CLASSIFICATION:
                    columns += [p.tolist() for p in scorer.proba(M).T]
            yield from (i + r for i, r in zip(self._done(), zip(*columns)))

    return Predict


def explain_function(known: dict[str, bytes]):
    class Explain(_Blocks):
        @staticmethod
        def analyze(data, model_name=None, model=None, id=None):
            m, id_col = _model(known, _given(model_name), _given(model), "value"), _given(id, "")
            _check_table(data.dataType, m, id_col)
            fields = [data.dataType[id_col]] if id_col else []
            if m.meta.task == CLASSIFICATION and len(m.meta.classes or []) > 2:
                fields.append(T.StructField("class", T.LongType(), False))
            return AnalyzeResult(T.StructType([*fields, T.StructField("feature", T.StringType(), False),
                                               T.StructField("shap_value", T.DoubleType(), False), T.StructField("base_value", T.DoubleType(), False)]))

        def eval(self, data, model_name=None, model=None, id=None):
            if self.scorer is None:
                self._start(_model(known, model_name, model, "value"))
            if self._take(data, id):
                yield from self._contributions()

        def terminate(self):
            if self.rows:
                yield from self._contributions()

        def _contributions(self):
            scorer, meta, X = self.scorer, self.model.meta, self._matrix()
            phi, base = S.contributions(scorer, np.asarray(self.model.nodes["cover"], np.float64), X)
            multi = meta.task == CLASSIFICATION and len(meta.classes or []) > 2
            for k in range(scorer.K if multi else 1):
                for i, row in zip(self.ids, phi[k].tolist()):
                    for name, value in zip(meta.feature_names, row):
                        yield (*i, *((k,) if multi else ()), name, value, float(base[k]))
            self._done()

    return Explain


def importance_function(known: dict[str, bytes]):
    class FeatureImportance:
        @staticmethod
        def analyze(model_name=None, model=None, importance_type=None):
            return AnalyzeResult(IMPORTANCE_SCHEMA)

        def eval(self, model_name=None, model=None, importance_type=None):
            from ..operators.importance import IMPORTANCE_TYPES
            kind = importance_type or "gain"
            if kind not in IMPORTANCE_TYPES:
                raise ValueError(f"invalid importance_type {kind!r}; choose one of: {', '.join(sorted(IMPORTANCE_TYPES))}")
            m = _model(known, model_name, model, "value")
            features = np.array([f for f in m.nodes["feature_idx"]], np.int64)
            inner = features >= 0
            what = np.ones(inner.sum()) if kind == "weight" else np.array(m.nodes["cover" if "cover" in kind else "gain"], float)[inner]
            total = np.bincount(features[inner], weights=what, minlength=len(m.meta.feature_names))
            count = np.bincount(features[inner], minlength=len(m.meta.feature_names))
            value = total if kind == "weight" or kind.startswith("total") else np.where(count > 0, total / np.maximum(count, 1), 0.0)
            for rank, f in enumerate(np.argsort(-value, kind="stable")):
                yield m.meta.feature_names[f], float(value[f]), rank + 1

    return FeatureImportance


def register_functions(spark: SparkSession, models: list[str] | None = None, root: str | None = None) -> None:
    """Register the table functions in this session. ``models`` of the registry at ``root`` (by default all that are there
    now) can be called by ``model_name``; call again after models come or go. A ``model`` value needs no registry."""
    ensure_session(spark)
    if models is None:
        models = [r["model_name"] for r in registry.list_models(spark, root).select("model_name").collect()]
    known = {name: registry.load(spark, name, root).to_bytes() for name in models}
    for name, make in (("predict", predict_function), ("explain", explain_function), ("feature_importance", importance_function)):
        spark.udtf.register(name, udtf(make(known)))
