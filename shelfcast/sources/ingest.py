"""Incremental loading: only rows that are not stored yet, appended as a whole."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.operators.joins import drop_existing
from shelfcast.operators.ordering import first_rows
from shelfcast.shared import scratch, written_table
from shelfcast.sources.delimited import read_delimited, read_rows_after
from shelfcast.sources.registry import DATASETS, LOAD_ORDER, Dataset, borrowed_schema
from shelfcast.sources.warehouse import Warehouse


def newer_than(last: Mapping[str, Any], keys: Sequence[str], every_key: bool = False) -> Column:
    """Rows after ``last`` in the order of the keys.

    ``every_key`` asks each key to be greater on its own, which passes over later rows that
    share a leading key with the last one.
    """
    if every_key:
        condition = F.lit(True)
        for key in keys:
            condition = condition & (F.col(key) > F.lit(last[key]))
        return condition
    condition, tied = F.lit(False), F.lit(True)
    for key in keys:
        condition = condition | (tied & (F.col(key) > F.lit(last[key])))
        tied = tied & (F.col(key) == F.lit(last[key]))
    return condition


def newer_rows(rows: DataFrame, stored: DataFrame, keys: Sequence[str], every_key: bool = False) -> DataFrame:
    """Rows after the newest stored one; all of them when nothing is stored."""
    last = first_rows(stored.select(*keys), [F.col(k).desc() for k in keys], 1).first()
    return rows if last is None else rows.filter(newer_than(last.asDict(), keys, every_key))


def above_high_water(rows: DataFrame, stored: DataFrame, key: str, none_stored: int = -1) -> DataFrame:
    """Rows whose key exceeds the largest stored one, looked up by the same job."""
    highest = stored.agg(F.coalesce(F.max(key), F.lit(none_stored)).alias("highest"))
    return rows.filter(F.col(key) > highest.select("highest").scalar())


def row_number_above(rows: DataFrame, threshold: int, number: str = "row_number") -> DataFrame:
    return rows.filter(F.col(number) > threshold)


def new_rows(
    warehouse: Warehouse, dataset: Dataset, path: str, by: str = "keys", sep: str = ","
) -> DataFrame:
    """Rows of the file that the table lacks, under the table's names.

    ``by="keys"`` compares keys and is right whatever the order of the file (rows above the largest stored key are new
    without a look at the stored ones); ``by="position"`` skips
    as many rows as are stored, for files that only ever grow at the end; ``by="newer"`` takes rows
    after the newest stored key.
    """
    stored = warehouse.current(dataset.name)
    schema = borrowed_schema(stored, dataset.to_file_names)
    if by == "position":
        return dataset.to_table(read_rows_after(warehouse.spark, path, schema, stored.count(), sep=sep))
    rows = dataset.to_table(read_delimited(warehouse.spark, path, schema, sep=sep))
    if by == "keys":
        rows = written_table(rows, "arrived")  # parsed once, read for its range, its size and its rows
        if warehouse.all_newer(rows, dataset.name, dataset.keys[0]):
            return rows
        above = warehouse.above_mark(dataset.name, dataset.keys[0])
        if above is None:
            return drop_existing(rows, stored, dataset.keys)
        return drop_existing(rows.filter(~above), stored, dataset.keys).unionByName(rows.filter(above))
    if by == "newer":
        return newer_rows(rows, stored, dataset.keys)
    raise ValueError(f"unknown way to find new rows: {by!r}")


def load_new_rows(warehouse: Warehouse, dataset: Dataset, path: str, by: str = "keys", sep: str = ",") -> None:
    """Append the file's new rows; running it again adds nothing.

    Two new rows under one key are an error, as they would be for a table with that primary key.
    """
    warehouse.create(dataset)
    with scratch(warehouse.spark):
        warehouse.append(new_rows(warehouse, dataset, path, by, sep), dataset.name, mark=dataset.keys[0], unique=dataset.keys)


def load_all(warehouse: Warehouse, folder: str, by: str = "keys", names: Sequence[str] = LOAD_ORDER) -> None:
    """Load every dataset whose files lie in ``folder``, parents first."""
    for name in names:
        dataset = DATASETS[name]
        load_new_rows(warehouse, dataset, f"{folder}/{dataset.file}", by)
