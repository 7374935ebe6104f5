"""Intermediate results on the folder all executors share.

A step that must not be computed twice (its row numbering depends on sampled
range bounds, say) is written once and read back.  The files survive the loss of
any executor and are columnar, so later steps still prune columns.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


#: Paths written inside each open :func:`scratch`, the innermost last.
_SCRATCH: ContextVar[tuple[list[str], ...]] = ContextVar("scratch", default=())


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``.

    Where none is set, a session that runs on this machine alone uses a temporary folder; on a cluster that
    would be a different folder on every machine, so it is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="shelfcast-"))
        current = spark.sparkContext.getCheckpointDir()
    return current.rstrip("/")


def fresh_path(spark: SparkSession, label: str, lasting: bool = False) -> str:
    """A path in the shared folder nobody has used yet, under the application's own folder.

    ``lasting`` says that it outlives the innermost :func:`scratch`, though not one around that.
    """
    path = f"{shared_folder(spark)}/shelfcast/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    open_ = _SCRATCH.get()[:-1] if lasting else _SCRATCH.get()
    if open_:
        open_[-1].append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediate results that are written inside are removed at the end.

    For work that leaves nothing lazy behind, such as a load: frames made from those files cannot be read any more.
    """
    made: list[str] = []
    token = _SCRATCH.set((*_SCRATCH.get(), made))
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        for path in made:
            there = spark._jvm.org.apache.hadoop.fs.Path(path)
            there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let go of the shuffle files that nothing refers to any more.

    Spark removes them once the driver's collector has found their owners dead, which may be never on a driver with little
    to collect; until then a shuffle stays on the disks beside the table that was written from it.
    """
    spark._jvm.System.gc()


def written_table(
    df: DataFrame, label: str, partition_by: Sequence[str] = (), lasting: bool = False, compression: str | None = None,
    release: bool = False,
) -> DataFrame:
    """Write ``df`` to the shared folder and return a frame that reads it back.

    The files last as long as the frames made from them, unless :func:`scratch` says otherwise; once the application has
    ended, its folder can be removed.  ``lasting`` as in :func:`fresh_path`.  ``release`` frees the shuffles behind a large
    table as soon as it is written.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label, lasting)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer = writer.option("compression", compression) if compression else writer
    writer.parquet(path)
    if release:
        release_shuffles(spark)
    return spark.read.schema(df.schema).parquet(path)
