"""Scoring a stream: ``predict`` is a stateless ``mapInArrow``, so it runs unchanged on ``readStream``."""

from __future__ import annotations

import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from ..operators.predict import predict


def predict_stream(stream: DataFrame, model_name: str = "", model: Any = None, id: str = "",
                   with_proba: bool = False, output_margin: bool = False, root: str | None = None) -> DataFrame:
    """Streaming DataFrame of predictions (same columns as ``predict``)."""
    if not stream.isStreaming:
        raise ValueError("predict_stream expects a streaming DataFrame (spark.readStream…)")
    return predict(stream, model_name=model_name, model=model, id=id, with_proba=with_proba,
                   output_margin=output_margin, root=root)


def score_files_once(spark: SparkSession, source: str, model: Any, id: str, work_dir: str, **options: Any) -> DataFrame:
    """Score the Parquet file or folder ``source`` as a file stream (``availableNow``) and return what the stream wrote.

    Each call has a checkpoint and an output folder of its own below ``work_dir``, so no run meets another's rows."""
    run = f"{work_dir.rstrip('/')}/stream-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(source)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path)
    reader = spark.readStream.schema(spark.read.parquet(source).schema)
    stream = (reader.parquet(source) if found.isDirectory()
              else reader.option("pathGlobFilter", path.getName()).parquet(path.getParent().toString()))
    scored = predict_stream(stream, model=model, id=id, **options)
    q = (scored.writeStream.format("parquet").option("checkpointLocation", f"{run}/checkpoint")
         .outputMode("append").trigger(availableNow=True).start(f"{run}/out"))
    q.awaitTermination()
    return spark.read.schema(scored.schema).parquet(f"{run}/out")
