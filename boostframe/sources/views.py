"""Results as SQL views: what takes no table argument is a view, what takes one is published under a name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import registry


def register_views(spark: SparkSession, root: str | None = None) -> None:
    """``SELECT * FROM list_models`` shows the registry as it is now; call again after models come or go."""
    registry.list_models(spark, root).createOrReplaceTempView("list_models")


def publish(df: DataFrame, name: str) -> DataFrame:
    """Any result (labelled table, predictions, contributions, scores) under ``name`` in SQL; it is computed when queried."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
