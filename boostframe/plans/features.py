"""Column roles, feature typing and argument checks (driver side, from ``df.schema`` only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
                 T.BooleanType, T.DecimalType)
STRING_TYPES = (T.StringType, T.CharType, T.VarcharType)


def quoted(name: str) -> Column:
    """The column of this very name, whatever signs it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def positional(names: list[str]) -> list[Column]:
    """Features under the names f0, f1, ... that batches know them by, so no name of theirs meets one of ours."""
    return [quoted(name).alias(f"f{j}") for j, name in enumerate(names)]


def is_categorical_type(dtype: T.DataType) -> bool:
    return isinstance(dtype, STRING_TYPES)


def is_numeric_type(dtype: T.DataType) -> bool:
    return isinstance(dtype, NUMERIC_TYPES)


def feature_columns(df: DataFrame, target: str = "", id_col: str = "") -> list[str]:
    """Every column except ``target`` and ``id`` is a feature (schema order)."""
    roles = {name: role for role, name in (("target", target), ("id", id_col)) if name}
    for name in roles.keys() - set(df.columns):
        raise ValueError(f"the {roles[name]} column {name!r} is not among {df.columns}")
    return [name for name in df.columns if name not in roles]


def categorical_mask(df: DataFrame, features: list[str]) -> list[bool]:
    """Per feature: True for string (categorical), False for numeric; anything else is refused."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    mask = []
    for name in features:
        dtype = fields[name]
        if is_categorical_type(dtype):
            mask.append(True)
        elif is_numeric_type(dtype):
            mask.append(False)
        else:
            raise ValueError(
                f"feature column {name!r} has type {dtype.simpleString()}, which is neither numeric nor a "
                "categorical (string) column; drop it or cast it before fitting")
    return mask


def require_features(df: DataFrame, features: list[str]) -> None:
    """Alignment by name: order is irrelevant, extras ignored, all missing ones listed in one error."""
    absent = sorted(set(features).difference(df.columns), key=features.index)
    if absent:
        raise ValueError(f"feature column(s) {absent} are not present in the input, which has {df.columns}; "
                         f"the model was fitted on {features}")


def check_feature_types(df: DataFrame, features: list[str], categorical: list[bool]) -> None:
    fields = {f.name: f.dataType for f in df.schema.fields}
    for name, cat in zip(features, categorical):
        dtype = fields[name]
        if cat and not is_categorical_type(dtype):
            raise ValueError(f"feature {name!r} was categorical (string) at fit but is {dtype.simpleString()} now")
        if not cat and not is_numeric_type(dtype):
            raise ValueError(f"feature {name!r} was numeric at fit but is {dtype.simpleString()} now")
