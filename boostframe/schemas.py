"""Fixed output schemas of the public operators (nullable flags kept)."""

from __future__ import annotations

from pyspark.sql import types as T


CLASSIFICATION = "classification"
REGRESSION = "regression"

def _schema(required: dict[str, T.DataType], optional: tuple[str, ...] = ()) -> T.StructType:
    return T.StructType([T.StructField(name, kind, name in optional) for name, kind in required.items()])


_S, _L, _I, _D, _B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BinaryType()

# Column names, types and nullability of the results.
# fit: what was trained, on how much, how well it fits its own rows, and the model itself
FIT_SCHEMA = _schema({"model_name": _S, "estimator": _S, "task": _S, "n_samples": _L, "n_features": _L, "n_classes": _L, "train_score": _D,
                      "features": T.ArrayType(_S, False), "model": _B}, ("n_classes", "train_score"))
# list_models and model_info: the registry's entries without their trees
MODEL_INFO_SCHEMA = _schema({"model_name": _S, "estimator": _S, "task": _S, "target": _S, "n_features": _L, "n_samples": _L, "n_classes": _L,
                             "train_score": _D, "format_version": _S, "created_at": _S, "features": T.ArrayType(_S, True)},
                            ("n_classes", "train_score", "format_version", "created_at", "features"))
# drop_model: whether there was something to delete
DROP_SCHEMA = _schema({"model_name": _S, "dropped": T.BooleanType()})
# cross_val_score: folds count from 0
CV_SCORE_SCHEMA = _schema({"fold": _L, "score": _D})
# feature_importance and permutation_importance: rank 1 matters most
IMPORTANCE_SCHEMA = _schema({"feature": _S, "importance": _D, "rank": _I})
PERM_SCHEMA = _schema({"feature": _S, "importance_mean": _D, "importance_std": _D, "rank": _I})
# partial_dependence: class is null unless there is one curve per class
PD_SCHEMA = _schema({"feature_value": _D, "class": _L, "partial_dependence": _D}, ("class",))
# searches: a row per combination; only the best one carries its model, refitted on all rows
SEARCH_SCHEMA = _schema({"estimator": _S, "params": _S, "mean_test_score": _D, "std_test_score": _D, "rank": _L, "model": _B}, ("model",))

# One row per tree node; every interpretation operator is computed from this table.
NODE_SCHEMA = T.StructType([
    T.StructField("tree_id", T.IntegerType(), False),
    T.StructField("class_id", T.IntegerType(), False),
    T.StructField("node_id", T.IntegerType(), False),
    T.StructField("feature", T.StringType(), True),
    T.StructField("threshold", T.DoubleType(), True),
    T.StructField("left_cats", T.ArrayType(T.StringType()), True),
    T.StructField("default_left", T.BooleanType(), True),
    T.StructField("left_id", T.IntegerType(), True),
    T.StructField("right_id", T.IntegerType(), True),
    T.StructField("gain", T.DoubleType(), True),
    T.StructField("cover", T.DoubleType(), False),
    T.StructField("leaf_value", T.DoubleType(), True),
    T.StructField("tree_weight", T.DoubleType(), False),
])


def label_type_for(target_type: T.DataType) -> T.DataType:
    """Decoded class label type: strings stay strings, integers become BIGINT, others keep their type."""
    if isinstance(target_type, (T.StringType, T.CharType, T.VarcharType)):
        return T.StringType()
    if isinstance(target_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return T.LongType()
    return target_type
