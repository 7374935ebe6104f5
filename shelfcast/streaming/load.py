"""Loading files as they arrive, each exactly once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from shelfcast.operators.joins import drop_existing, require_unique
from shelfcast.shared import scratch, written_table
from shelfcast.sources.registry import Dataset
from shelfcast.sources.warehouse import Warehouse


def arriving_rows(spark, dataset: Dataset, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """The dataset's files in ``folder`` as a stream, under the table's names."""
    reader = spark.readStream.schema(dataset.file_schema).option("header", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return dataset.to_table(reader.csv(folder))


def land_stream(rows: DataFrame, target: str, progress: str) -> StreamingQuery:
    """Append what has arrived to a parquet folder; the sink's log makes each file count once."""
    return (
        rows.writeStream.format("parquet").outputMode("append")
        .option("path", target).option("checkpointLocation", progress)
        .trigger(availableNow=True).start()
    )


def table_sink(warehouse: Warehouse, dataset: Dataset, stream: str) -> Callable[[DataFrame, int], None]:
    """What to do with each batch of a stream: append the rows whose keys are not stored.

    The batch's number is stored in the step that makes its rows visible, so a batch that is delivered again after a crash
    is known by it and nothing is read.  Stored keys are searched only if the batch reaches below the largest one, and
    then only in the range of its own.
    """
    keys = list(dataset.keys)

    def add(batch: DataFrame, number: int) -> None:
        there = Warehouse(batch.sparkSession, warehouse.database)  # the stream has a session of its own
        if number <= there.last_batch(dataset.name, stream):
            return
        with scratch(batch.sparkSession):
            rows = written_table(batch, "batch")
            newer = there.all_newer(rows, dataset.name, keys[0])
            fresh = written_table((rows if newer else drop_existing(rows, there.current(dataset.name), keys)).distinct(), "batch-rows")
            require_unique(fresh, keys)
            there.append(fresh, dataset.name, mark=keys[0], batch=(stream, number))

    return add


def load_stream(rows: DataFrame, warehouse: Warehouse, dataset: Dataset, progress: str) -> StreamingQuery:
    """Append what has arrived to a stored table.

    A batch that is delivered again after a crash adds nothing; a file sent twice counts once; two different rows under
    one key are an error.
    """
    warehouse.create(dataset)
    return (
        rows.writeStream.foreachBatch(table_sink(warehouse, dataset, progress)).option("checkpointLocation", progress)
        .trigger(availableNow=True).start()
    )
