"""What Python workers need to run the functions of this folder."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

#: Rows of a batch that goes to Python, where the session has the default.
BATCH_ROWS = 2_000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: What drops a cache of this worker.
CACHES: list[Callable[[], None]] = []
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def with_package(spark: SparkSession) -> SparkSession:
    """Let the workers find this package where it lies, whatever folder the driver was started in, and get rows in
    batches of a size for texts.

    On a cluster whose machines do not share that place, ship the package with ``--py-files`` as usual.
    """
    environment = spark.sparkContext.environment
    if spark.conf.get(_BATCH) == "10000":  # the default; texts are wide, and a batch is held more than once
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    known = environment.get("PYTHONPATH", "")
    if ROOT not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join([*filter(None, [known]), ROOT])
    return spark


def release_memory() -> None:
    """Give what is free back to the machine: a worker lives on after its task, beside stages that need the room."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)  # only some C libraries have it
    except (AttributeError, OSError):
        pass


def pieces(batches: Iterator[pa.RecordBatch], text: str, most: int = 1 << 20, keep: bool = False) -> Iterator[pa.RecordBatch]:
    """The batches in parts whose texts have about ``most`` bytes together, so that little of a batch is
    taken apart at a time; a longer text is a part of its own.

    Unless ``keep`` is set, what earlier work has cached in this worker is dropped first.
    """
    for clear in () if keep else CACHES:
        clear()
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends, at = np.cumsum(sizes), 0
        while at < batch.num_rows:
            base = int(ends[at - 1]) if at else 0
            end = max(at + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(at, end - at)
            at = end
    release_memory()
