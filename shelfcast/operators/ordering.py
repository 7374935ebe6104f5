"""Order without a partition key.

A window with no partition clause pulls the table into one task.  Here the rows
are range-partitioned, written once in order, and numbered from their place in
the file set: one shuffle, equal tasks, whatever the key distribution.  Windows
over neighbouring rows then run on buckets of consecutive positions.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfcast.shared import written_table

TOP_ROWS = 100_000
BUCKET_ROWS = 50_000
MAX_BUCKETS = 1_000_000
_SEAT_BITS = 33  # monotonically_increasing_id keeps the row's index within its partition in the low 33 bits


def _columns(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def newest_first(keys: Sequence[str]) -> list[Column]:
    """Descending order over several keys."""
    return [F.col(k).desc() for k in keys]


def _written_in_order(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """``df`` written in order, with ``_chunk`` and ``_seat``: which partition a row was in, and where."""
    by = _columns(order)
    return _written_with_seats(df.repartitionByRange(*by).sortWithinPartitions(*by))


def _written_with_seats(ordered: DataFrame) -> DataFrame:
    number = F.monotonically_increasing_id()
    stored = written_table(ordered.withColumn("_number", number), "in-order", compression="zstd", release=True)
    return stored.withColumns({
        "_chunk": F.shiftright("_number", _SEAT_BITS),
        "_seat": F.col("_number").bitwiseAND(F.lit((1 << _SEAT_BITS) - 1)),
    }).drop("_number")


def _chunk_starts(stored: DataFrame, amount: Column) -> DataFrame:
    """Total of ``amount`` in all earlier chunks.

    One row per shuffle partition, which bounds the window below and lets the result be broadcast.
    """
    before = W.orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    return (
        stored.groupBy("_chunk").agg(F.sum(amount).alias("_amount"))
        .select("_chunk", F.coalesce(F.sum("_amount").over(before), F.lit(0)).alias("_start"))
    )


def dense_position(df: DataFrame, order: Sequence[str | Column], name: str = "position") -> DataFrame:
    """Add the 0-based place of each row in ``order``, which must be unique to be well defined."""
    columns = [c for c in df.columns if c != name]
    stored = _written_in_order(df.select(*columns), order)
    return _placed(stored, _chunk_starts(stored, F.lit(1)), columns, name)


def _placed(stored: DataFrame, starts: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    return stored.join(F.broadcast(starts), "_chunk").select(
        *columns, (F.col("_start") + F.col("_seat")).cast("long").alias(name)
    )


def grouped_in_order(df: DataFrame, keys: Sequence[str], amounts: Sequence[Column], name: str = "position") -> DataFrame:
    """A row per group of ``keys`` with its ``amounts`` and its 0-based place in the order of the keys, stored.

    Rows are range-partitioned by the keys, so a group is whole in one partition, and grouping, sorting and numbering need
    no shuffle but that one.  For groups that are small: a group's rows all meet in one task, which holds only its amounts.
    """
    groups = df.repartitionByRange(*keys).groupBy(*keys).agg(*amounts)
    stored = _written_with_seats(groups.sortWithinPartitions(*keys))
    starts = written_table(_chunk_starts(stored, F.lit(1)), "chunk-starts")
    return _placed(stored, starts, groups.columns, name)


def running_total(df: DataFrame, order: Sequence[str | Column], amount: str, name: str) -> DataFrame:
    """Add the total of ``amount`` over this row and all rows before it in ``order``."""
    stored = _written_in_order(df, order)
    starts = _chunk_starts(stored, F.col(amount))
    inside = W.partitionBy("_chunk").orderBy("_seat").rowsBetween(W.unboundedPreceding, 0)
    local = stored.withColumn("_local", F.sum(amount).over(inside))
    return local.join(F.broadcast(starts), "_chunk").select(
        *df.columns, (F.col("_start") + F.col("_local")).alias(name)
    )


def first_rows(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    """The first ``n`` rows in order; a short list is a top-n, a long one goes by position and stays spread."""
    if n <= TOP_ROWS:
        return df.orderBy(*_columns(order)).limit(n)
    return dense_position(df, order, "_place").filter(F.col("_place") < n).orderBy("_place").drop("_place")


def last_rows(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """The last ``n`` rows by ``keys``, oldest first."""
    return first_rows(df, newest_first(keys), n).orderBy(*keys)


def row_slice(df: DataFrame, order: Sequence[str | Column], start: int, stop: int) -> DataFrame:
    """Rows from place ``start`` up to but without ``stop``."""
    placed = dense_position(df, order, "_place")
    return placed.filter((F.col("_place") >= start) & (F.col("_place") < stop)).drop("_place")


def position_between(df: DataFrame, column: str, start: int, stop: int) -> DataFrame:
    """Rows whose stored row number lies in ``[start, stop)``."""
    return df.filter((F.col(column) >= start) & (F.col(column) < stop))


def bucket_of(position: str, bucket_rows: int) -> Column:
    return F.floor(F.col(position) / F.lit(bucket_rows))


def bounded_bucket_rows(df: DataFrame, position: str) -> int:
    """Rows per bucket such that there are at most ``MAX_BUCKETS`` buckets, from the last position."""
    last = df.agg(F.max(position)).first()[0] or 0
    return max(BUCKET_ROWS, -(-(last + 1) // MAX_BUCKETS))


def with_overlap(df: DataFrame, position: str, bucket_rows: int, reach: int, ahead: bool = False) -> DataFrame:
    """Add ``_bucket`` and repeat each bucket's last ``reach`` rows at the head of the next (``_extra``).

    ``ahead`` also repeats its first rows at the end of the bucket before.  A window inside a bucket
    then sees ``reach`` rows beyond its edge, so one balanced shuffle serves every lag.
    """
    bucket_rows = max(bucket_rows, reach)  # the rows repeated come from one bucket
    home, place = bucket_of(position, bucket_rows), F.col(position) % bucket_rows
    own = F.struct(home.alias("_bucket"), F.lit(False).alias("_extra"))
    copies = [(F.struct((home + 1).alias("_bucket"), F.lit(True).alias("_extra")), place >= bucket_rows - reach)]
    if ahead:
        copies.append((F.struct((home - 1).alias("_bucket"), F.lit(True).alias("_extra")), (place < reach) & (home > 0)))
    # an array per case: filtering one by a function would leave the compiled path for every row
    targets = F.array(own)
    for some in (copies[:1], copies[1:], copies) if ahead else (copies,):
        targets = F.when(reduce(lambda a, b: a & b, [needed for _, needed in some]), F.array(own, *[c for c, _ in some])).otherwise(targets)
    return df.select("*", F.inline(targets))
