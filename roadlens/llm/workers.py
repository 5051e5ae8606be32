"""Memory of Python workers: Arrow batches of a bounded size, and giving back what a task held."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa
from pyspark.sql import SparkSession

_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession, size: int = 4 << 20) -> None:
    """Arrow batches of at most about ``size`` bytes from now on in this session.

    Batches are bounded by rows otherwise, so long texts make large ones on both sides of the pipe. A
    smaller bound of the session stays.
    """
    known = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_BYTES))
    if known <= 0 or known > size:
        spark.conf.set(_BYTES, str(size))


def give_back() -> None:
    """Return freed memory to the machine; workers go on to other stages.

    Python and the C library otherwise keep what a task has freed.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library
