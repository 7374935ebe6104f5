"""Delimited text: typed scans, and scans by line position.

A line's position follows from where its block starts in the file and its place
within the block, both known to the scan.  How files are cut into blocks is planned
anew for each job, so one scan is stored, and both the counts per block and the lines
are read from it; the lines themselves are neither shuffled nor sent to Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.operators.joins import attach, require_unique
from shelfcast.operators.ordering import dense_position
from shelfcast.shared import written_table


def read_delimited(
    spark: SparkSession, path: str, schema: T.StructType, condition: str | Column | None = None, sep: str = ","
) -> DataFrame:
    """A file with a header under a given schema; ``condition`` reaches the scan."""
    rows = spark.read.schema(schema).option("header", True).option("sep", sep).csv(path)
    return rows if condition is None else rows.filter(condition)


def numbered_lines(spark: SparkSession, path: str, skip_headers: bool = False) -> DataFrame:
    """Each line as ``value`` with its 0-based ``line_number`` over all files in path order.

    ``skip_headers`` leaves out the first line of every file and does not count it.
    """
    place = F.monotonically_increasing_id()
    scanned = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        place.alias("_seat"),
    )
    lines = written_table(scanned, "lines")
    blocks = lines.groupBy("_file", "_block").agg(
        F.min("_seat").alias("_first"), F.count(F.lit(1)).alias("_lines")
    )
    first_block = F.min("_block").over(W.partitionBy("_file")) == F.col("_block")
    header = F.when(first_block, 1).otherwise(0) if skip_headers else F.lit(0)
    earlier = W.orderBy("_file", "_block").rowsBetween(W.unboundedPreceding, -1)
    # one row per input block: a listing of the files, not of their lines
    key = F.xxhash64("_file", "_block")
    starts = blocks.withColumn("_header", header).select(
        key.alias("_key"), "_first", "_header",
        F.coalesce(F.sum(F.col("_lines") - F.col("_header")).over(earlier), F.lit(0)).alias("_start"),
    )
    in_block = F.col("_seat") - F.col("_first") - F.col("_header")
    starts = written_table(starts, "block-starts")
    require_unique(starts, ["_key"])
    keyed = lines.select("value", "_seat", key.alias("_key"))
    numbered = attach(keyed, starts, ["_key"], "left")  # 40 bytes a block, so they can be sent around
    return numbered.filter(in_block >= 0).select(
        (F.col("_start") + in_block).alias("line_number"), "value"
    )


def lines_after(spark: SparkSession, path: str, skip: int) -> DataFrame:
    """Lines from position ``skip`` on, the header counting as position 0."""
    lines = spark.read.text(path) if skip == 0 else (
        numbered_lines(spark, path).filter(F.col("line_number") >= skip).select("value")
    )
    return lines


def number_in_front(numbered: DataFrame, sep: str = ",") -> DataFrame:
    """Lines with their number as a first field."""
    return numbered.select(F.concat_ws(sep, F.col("line_number").cast("string"), "value").alias("value"))


def numbered_lines_after(spark: SparkSession, path: str, skip: int, sep: str = ",") -> DataFrame:
    """Numbered lines from ``skip`` on, filtered before any field is parsed."""
    return number_in_front(numbered_lines(spark, path).filter(F.col("line_number") >= skip), sep)


def parse_lines(lines: DataFrame, schema: T.StructType, sep: str = ",", value: str = "value") -> DataFrame:
    """Fields of each line under the schema; other columns of ``lines`` stay in front."""
    kept = [c for c in lines.columns if c != value]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return (
        lines.filter(F.length(value) > 0)
        .select(*kept, F.from_csv(F.col(value), ddl, {"sep": sep}).alias("_fields"))
        .select(*kept, "_fields.*")
    )


def read_rows_after(
    spark: SparkSession, path: str, schema: T.StructType, skip: int, number: str | None = None, sep: str = ","
) -> DataFrame:
    """Data rows from position ``skip`` on, headers apart; ``number`` names a column for the position."""
    lines = numbered_lines(spark, path, skip_headers=True).filter(F.col("line_number") >= skip)
    rows = parse_lines(lines, schema, sep)
    return rows.withColumnRenamed("line_number", number) if number else rows.drop("line_number")


def add_position(df: DataFrame, order: list[str], name: str = "row_number") -> DataFrame:
    """A positional index for any table that has an order."""
    return dense_position(df, order, name)
