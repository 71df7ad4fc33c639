"""What Python workers of the executors are handed at once, and what they do when a task ends."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import SparkSession

ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows that a step hands to Python at once: texts are long, and what is in flight counts twice, there and in the JVM.
BATCH_ROWS = 2000


def small_batches(spark: SparkSession) -> None:
    """Lowers the session's rows of an Arrow batch to BATCH_ROWS, if they are more; results do not depend on it."""
    rows = int(spark.conf.get(ARROW_ROWS))
    if rows <= 0 or rows > BATCH_ROWS:
        spark.conf.set(ARROW_ROWS, str(BATCH_ROWS))


#: glibc's numbers for how much freed memory a process holds on to, and from which size on an array is mapped by itself.
_TRIM_THRESHOLD, _MMAP_THRESHOLD = -1, -3


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], keep: int = 0) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, whose worker gives freed memory back to the system when the task ends: workers wait for more tasks, and
    what they hold counts against their executor. ``keep``: bytes of freed memory that a worker holds on to while its tasks run, for
steps that make and drop large arrays all the time. Made on the driver, where it also sees to small batches."""
    session = SparkSession.getActiveSession()
    if session is not None:
        small_batches(session)

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        libc = ctypes.CDLL(None)
        if keep and hasattr(libc, "mallopt"):
            libc.mallopt(_MMAP_THRESHOLD, 32 << 20)
            libc.mallopt(_TRIM_THRESHOLD, keep)
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(libc, "malloc_trim", None)  # of glibc
            if trim is not None:
                trim(0)

    return tidied
