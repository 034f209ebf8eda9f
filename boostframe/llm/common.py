"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from boostframe.memory import releasing  # noqa: F401
from boostframe.session import ensure_checkpoint_dir, ensure_session

#: Words are runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WHITE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder that driver and executors share; it goes when the session ends."""
    path = f"{ensure_checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}/{name}"
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path).getParent()
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


def cut(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here, and later plans see its true size."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def arrow_schema(ddl: str):
    """The Arrow schema of Spark columns, for batches made in tasks (where no session exists)."""
    return to_arrow_schema(StructType.fromDDL(ddl))


def prepare(spark: SparkSession) -> None:
    ensure_session(spark)


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components of an undirected edge list, as (node, component) with the smallest node of each.

    Alternating stars: every round hangs the larger neighbours of a node, then its smaller ones, on the smallest
    neighbour, until nothing moves; the number of rounds grows with the logarithm of the longest chain. A node's
    neighbours are never gathered: each step is a grouped minimum (combined before the shuffle) and a join that
    adaptive execution can split. Only nodes with an edge to another node are returned; null ends are ignored.
    """
    x, y = F.col(a), F.col(b)
    edges = (edges.where(x != y).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct())
    edges = cut(edges, "edges")
    mark = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_003)).first()
        if mark == tuple(now) or not now[0]:
            break
        mark = tuple(now)
        low = (edges.select(F.col("v").alias("n"), F.col("v").alias("m"))
               .union(edges.select("u", "v")).groupBy("n").agg(F.min("m").alias("m")))
        large = edges.join(low, F.col("v") == F.col("n")).select("u", F.col("m").alias("v")).distinct()
        low = large.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m"))
        small = large.join(low, F.col("u") == F.col("n")).select("u", "v", "m")
        edges = cut(small.select("u", F.col("m").alias("v"))
                    .union(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct(),
                    "edges")
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.union(edges.select("v", "v")).distinct()
