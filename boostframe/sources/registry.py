"""Model registry on any Hadoop file system: ``<root>/<name>/{meta,nodes,blob}``.

``meta`` is one JSON line (cheap to read for ``list_models``), ``nodes`` the node table as Parquet,
``blob`` the self-contained model value. The root comes from the ``boostframe.models.dir`` session
setting, else ``./models``.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import Model
from ..schemas import DROP_SCHEMA, MODEL_INFO_SCHEMA, NODE_SCHEMA

ROOT_CONF = "boostframe.models.dir"
_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9_-]*(?:\.[A-Za-z0-9_-]+)*\.?")

_META_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("estimator", T.StringType()),
    T.StructField("task", T.StringType()), T.StructField("target", T.StringType()),
    T.StructField("n_features", T.LongType()), T.StructField("n_samples", T.LongType()),
    T.StructField("classes", T.ArrayType(T.StringType())), T.StructField("train_score", T.DoubleType()),
    T.StructField("format_version", T.StringType()), T.StructField("created_at", T.StringType()),
    T.StructField("feature_names", T.ArrayType(T.StringType())),
])


def validate_name(name: str) -> str:
    """Names are runs of letters, digits, ``_`` and ``-``, joined by single dots; the first character is no sign."""
    if not _NAME.fullmatch(name or ""):
        raise ValueError(f"invalid model name {name!r}: letters and digits, then also '_', '-' and single dots between them")
    return name


def root_dir(spark: SparkSession, root: str | None = None) -> str:
    if root:
        return root.rstrip("/")
    path = spark.conf.get(ROOT_CONF, None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"give root= or set {ROOT_CONF} to a folder that the driver and all executors share")
        path = "models"
    return path.rstrip("/")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, name: str, root: str | None = None) -> bool:
    validate_name(name)
    fs, p = _fs(spark, f"{root_dir(spark, root)}/{name}/blob")
    return bool(fs.exists(p))


def save(spark: SparkSession, model: Model, name: str, root: str | None = None) -> None:
    """Store the model under ``<root>/<name>``. All parts are written aside; an older model is renamed aside, the new one
    takes its place by a rename, and only then the older one goes, so a crash in between loses neither."""
    validate_name(name)
    final = f"{root_dir(spark, root)}/{name}"
    base = f"{root_dir(spark, root)}/_writing-{uuid.uuid4().hex}"
    meta = asdict(model.meta)
    meta["name"] = name
    classes = meta.get("classes")
    meta_row = {k: meta.get(k) for k in _META_SCHEMA.fieldNames()}
    meta_row["classes"] = [json.dumps(c) if not isinstance(c, str) else c for c in classes] if classes else None
    spark.createDataFrame([meta_row], _META_SCHEMA).coalesce(1).write.json(f"{base}/meta")
    spark.createDataFrame(model.node_rows(), NODE_SCHEMA).coalesce(1).write.parquet(f"{base}/nodes")
    blob_schema = T.StructType([T.StructField("model", T.BinaryType(), False)])
    spark.createDataFrame([(bytearray(model.to_bytes()),)], blob_schema).coalesce(1).write.parquet(f"{base}/blob")
    fs, new = _fs(spark, base)
    place, aside = _fs(spark, final)[1], _fs(spark, f"{base}-before")[1]
    replaced = bool(fs.exists(place)) and bool(fs.rename(place, aside))
    if not fs.rename(new, place):
        if replaced:
            fs.rename(aside, place)
        raise OSError(f"could not move {base} to {final}")
    if replaced:
        fs.delete(aside, True)


def load(spark: SparkSession, name: str, root: str | None = None) -> Model:
    validate_name(name)
    if not exists(spark, name, root):
        raise ValueError(f"model {name!r} not found in registry {root_dir(spark, root)!r}")
    row = spark.read.parquet(f"{root_dir(spark, root)}/{name}/blob").first()
    return Model.from_bytes(row["model"])


def _info_frame(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("name").alias("model_name"), "estimator", "task", "target", "n_features", "n_samples",
        F.when(F.col("task") == "classification", F.size("classes").cast("long")).alias("n_classes"),
        "train_score", "format_version", "created_at", F.col("feature_names").alias("features"))


def list_models(spark: SparkSession, root: str | None = None) -> DataFrame:
    """One row per readable stored model, sorted by name; empty when the root does not exist."""
    base = root_dir(spark, root)
    fs, p = _fs(spark, base)
    if not fs.exists(p):
        return spark.createDataFrame([], MODEL_INFO_SCHEMA)
    pattern = f"{base}/[A-Za-z0-9]*/meta"
    if not fs.globStatus(_fs(spark, pattern)[1]):
        return spark.createDataFrame([], MODEL_INFO_SCHEMA)
    raw = (spark.read.schema(_META_SCHEMA).option("mode", "DROPMALFORMED").json(pattern)
           .where(F.col("name").isNotNull()))
    return _conform(_info_frame(raw).orderBy("model_name"), MODEL_INFO_SCHEMA)


def model_info(spark: SparkSession, name: str, root: str | None = None) -> DataFrame:
    """Same columns as ``list_models``; zero rows when the model does not exist."""
    validate_name(name)
    base = f"{root_dir(spark, root)}/{name}/meta"
    fs, p = _fs(spark, base)
    if not fs.exists(p):
        return spark.createDataFrame([], MODEL_INFO_SCHEMA)
    return _conform(_info_frame(spark.read.schema(_META_SCHEMA).json(base)), MODEL_INFO_SCHEMA)


def drop_model(spark: SparkSession, name: str, root: str | None = None) -> DataFrame:
    """``(model_name, dropped)``; idempotent."""
    validate_name(name)
    fs, p = _fs(spark, f"{root_dir(spark, root)}/{name}")
    dropped = bool(fs.exists(p)) and bool(fs.delete(p, True))
    return spark.createDataFrame([(name, dropped)], DROP_SCHEMA)


def _conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
