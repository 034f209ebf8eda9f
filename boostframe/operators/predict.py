"""``predict``: label / probabilities / margin / leaf ids, one narrow ``mapInArrow`` pass.

The model travels to executors once as a broadcast of flat numpy arrays; each Arrow batch is scored
by one vectorised routing loop over all trees. No shuffle; works on streaming DataFrames too.
"""

from __future__ import annotations

import re
import warnings
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..functions import kernel as K
from ..model import FORMAT_VERSION, Model
from ..plans.binning import encode_features
from ..plans.features import check_feature_types, positional, quoted, require_features
from ..schemas import CLASSIFICATION
from .common import proba_names, resolve_model


class Scorer:
    """Executor-side scoring of Arrow batches (picklable; arrays built once per task)."""

    def __init__(self, model: Model):
        self.meta = model.meta
        self.infos = model.feature_infos()
        self.linear = model.meta.booster == "gblinear"
        self.forest = None if self.linear else model.forest()
        self.base = np.asarray(model.meta.base_margin, dtype=np.float64)
        self.K = int(model.meta.n_groups)
        if self.linear:
            self.W = np.asarray(model.meta.linear_weights, dtype=np.float64).reshape(len(self.infos), self.K)
            self.B = np.asarray(model.meta.linear_bias, dtype=np.float64)

    def matrix(self, batch: pa.RecordBatch) -> np.ndarray:
        """Feature matrix of a batch that has its features by position (f0, f1, ...) or, lacking these, by name."""
        places = [f"f{j}" for j in range(len(self.infos))]
        if not set(places) <= set(batch.schema.names):
            batch = pa.RecordBatch.from_arrays([batch.column(n) for n in self.meta.feature_names], names=places)
        return encode_features(batch, self.infos, value_space=True)

    def margins(self, X: np.ndarray) -> np.ndarray:
        if self.linear:
            return self.base[None, :] + self.B[None, :] + np.nan_to_num(X, nan=0.0) @ self.W
        return K.margins(self.forest, X, self.base, self.K)

    def proba(self, M: np.ndarray) -> np.ndarray:
        obj = self.meta.objective
        if obj.startswith("binary:"):
            p1 = (M[:, 0] > 0).astype(np.float64) if obj == "binary:hinge" else K.sigmoid(M[:, 0])
            return np.column_stack([1.0 - p1, p1])
        return K.softmax(M)

    def codes(self, M: np.ndarray) -> np.ndarray:
        if self.meta.objective.startswith("binary:"):
            return (M[:, 0] > 0).astype(np.int64)
        return np.argmax(M, axis=1).astype(np.int64)

    def values(self, M: np.ndarray) -> np.ndarray:
        """Regression predictions, in the units of the target."""
        return K.link(self.meta.objective, M[:, 0])

    def leaves(self, X: np.ndarray) -> np.ndarray:
        idx = K.route(self.forest, X)
        return (idx - self.forest.offsets[None, :]).astype(np.int32)


def label_arrow_type(model: Model) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(_label_spark_type(model))


def _label_spark_type(model: Model) -> T.DataType:
    """The type of the labels, from its name (without a session: table functions ask for it in a process of their own)."""
    plain = (T.StringType(), T.LongType(), T.IntegerType(), T.ShortType(), T.ByteType(), T.DoubleType(), T.FloatType(),
             T.BooleanType(), T.DateType(), T.TimestampType())
    name = model.meta.label_type or "bigint"
    digits = re.fullmatch(r"decimal\((\d+),(\d+)\)", name)
    if digits:
        return T.DecimalType(int(digits[1]), int(digits[2]))
    return next((t for t in plain if t.simpleString() == name), None) or T._parse_datatype_string(name)


def output_schema(df: DataFrame, model: Model, id_col: str, with_proba: bool, output_margin: bool,
                  pred_leaf: bool) -> T.StructType:
    fields = []
    if id_col:
        fields.append(df.schema[id_col])
    if pred_leaf:
        fields.append(T.StructField("leaf", T.ArrayType(T.IntegerType(), False), False))
    elif output_margin:
        fields.append(T.StructField("margin", T.DoubleType(), False))
    elif model.meta.task == CLASSIFICATION:
        fields.append(T.StructField("prediction", _label_spark_type(model), False))
    else:
        fields.append(T.StructField("prediction", T.DoubleType(), False))
    if with_proba and model.meta.task == CLASSIFICATION:
        fields += [T.StructField(n, T.DoubleType(), False) for n in proba_names(model.meta.classes)]
    return T.StructType(fields)


def check_modes(with_proba: bool, output_margin: bool, pred_leaf: bool) -> None:
    if (with_proba and output_margin) or (with_proba and pred_leaf) or (output_margin and pred_leaf):
        raise ValueError("with_proba, output_margin and pred_leaf are mutually exclusive; choose one")


def predict(df: DataFrame, model_name: str = "", model: Any = None, id: str = "", with_proba: bool = False,
            output_margin: bool = False, pred_leaf: bool = False, root: str | None = None) -> DataFrame:
    """``[id] + prediction`` (or ``margin`` / ``leaf``) ``[+ proba_<label>…]`` for every input row."""
    check_modes(with_proba, output_margin, pred_leaf)
    spark = df.sparkSession
    m = resolve_model(spark, model_name, model, prefer="name", root=root)
    if m.meta.format_version != FORMAT_VERSION:
        warnings.warn(f"model {(model_name or '<value>')!r} was fitted with format {m.meta.format_version}, "
                      f"this build is {FORMAT_VERSION}; predictions may differ", stacklevel=2)
    if id and id not in df.columns:
        raise ValueError(f"id column {id!r} not found in input; columns: {', '.join(df.columns)}")
    if pred_leaf and m.meta.booster == "gblinear":
        raise ValueError("pred_leaf needs a tree booster; this model is gblinear")
    feats = m.meta.feature_names
    require_features(df, feats)
    check_feature_types(df, feats, m.meta.categorical or [False] * len(feats))
    schema = output_schema(df, m, id, with_proba, output_margin, pred_leaf)
    arrow_schema = _arrow_schema(schema)
    bc = _broadcast(spark, Scorer(m))
    is_cls = m.meta.task == CLASSIFICATION
    classes = m.meta.classes
    label_type = label_arrow_type(m) if is_cls else None
    cols = ([quoted(id).alias("__id")] if id else []) + positional(feats)

    def kernel(batches):
        sc: Scorer = bc.value
        labels = None
        for batch in batches:
            X = sc.matrix(batch)
            out = []
            if id:
                out.append(batch.column("__id"))
            if pred_leaf:
                L = sc.leaves(X)
                out.append(pa.ListArray.from_arrays(
                    pa.array(np.arange(0, L.size + 1, max(L.shape[1], 1)) if L.shape[1] else
                             np.zeros(L.shape[0] + 1, dtype=np.int64), pa.int32()),
                    pa.array(L.ravel(), pa.int32())))
                M = None
            else:
                M = sc.margins(X)
                if output_margin:
                    out.append(pa.array(M.max(axis=1) if M.shape[1] > 1 else M[:, 0], pa.float64()))
                elif is_cls:
                    if labels is None:
                        labels = pa.array(classes).cast(label_type)
                    out.append(labels.take(pa.array(sc.codes(M))))
                else:
                    out.append(pa.array(sc.values(M), pa.float64()))
            if with_proba and is_cls:
                Pm = sc.proba(M if M is not None else sc.margins(X))
                out += [pa.array(Pm[:, j], pa.float64()) for j in range(Pm.shape[1])]
            yield pa.RecordBatch.from_arrays(out, schema=arrow_schema)

    return df.select(*cols).mapInArrow(kernel, schema)


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


class _Local:
    def __init__(self, value):
        self.value = value


def _broadcast(spark, value):
    """Ship read-only model arrays once per executor (falls back to the closure without a SparkContext)."""
    try:
        return spark.sparkContext.broadcast(value)
    except Exception:
        return _Local(value)
