"""Memory of the processes that run tasks one after another."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import SparkSession

# Texts go to Python tasks in batches of about this many bytes.
BATCH_BYTES = 4 << 20
_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def give_back() -> None:
    """Return to the system what earlier tasks of this process have freed; without glibc only what Arrow holds."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library gives memory back in its own way


def returned(task: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """A task that gives its memory back when it ends, all it held included: its process idles while the JVM joins and writes."""

    @wraps(task)
    def run(*args, **options) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(*args, **options)
        finally:
            give_back()

    return run


def small_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes too, unless the session has a bound of its own; Spark's default lets 10,000 long texts
    be one batch, held by the JVM and by Python at once, and the JVM keeps such buffers."""
    if spark.conf.get(_LIMIT, None) is None:
        spark.conf.set(_LIMIT, BATCH_BYTES)
