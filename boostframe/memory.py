"""Memory of the Python workers: bounded Arrow batches, and what a task frees goes back to the machine."""

from __future__ import annotations

import ctypes
import re

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import SparkSession

#: Bytes of an Arrow batch that Spark hands to Python: rows of the packed training state are blocks of many rows.
BATCH_BYTES = 4 << 20
#: From so many rows on, the training state is kept on disk: it would fill an executor's heap, and is read in order.
DISK_ROWS = 5_000_000
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Ask Spark for batches of at most `BATCH_BYTES`, unless the session has a smaller limit of its own."""
    now = re.fullmatch(r"(\d+)\s*([kmgt]?)b?", spark.conf.get(_BATCH_CONF, str(64 << 20)).strip().lower())
    size = int(now[1]) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[now[2]] if now else 0
    if not 0 < size <= BATCH_BYTES:
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))


def storage(rows: int) -> StorageLevel:
    """Where a training state of ``rows`` rows is kept between passes."""
    return StorageLevel.DISK_ONLY if rows >= DISK_ROWS else StorageLevel.MEMORY_AND_DISK


def releasing(kernel):
    """A ``mapInArrow`` function that hands freed memory back to the machine when its task ends: Python workers live on
    between tasks and stages, beside a heap that grows meanwhile."""
    def run(batches):
        try:
            yield from kernel(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)        # where the C library has it
            if trim:
                trim(0)
    return run
