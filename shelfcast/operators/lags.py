"""Lag features: earlier rows of the same table, or the same series on earlier days."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.operators.fill import carried_values, fill_along
from shelfcast.operators.joins import attach
from shelfcast.operators.ordering import BUCKET_ROWS, MAX_BUCKETS, bucket_of, with_overlap

#: Types whose values come to the driver and go back as they were.
_PLAIN = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.StringType, T.BooleanType)


def lag_columns(
    df: DataFrame,
    columns: Sequence[str],
    steps: Sequence[int],
    position: str,
    group: Sequence[str] = (),
    head_from_first: bool | Sequence[str] = False,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Add ``<column>_lag_<k>``: the value ``k`` rows earlier by ``position`` (within ``group``).

    Rows without a row that far back get null, or with ``head_from_first`` (for all or some columns)
    the value of the first row, provided the series is longer than ``k``.
    """
    steps = list(steps)
    headed = set(columns if head_from_first is True else head_from_first or ())
    spread = with_overlap(df, position, bucket_rows, max(steps), ahead=bool(headed))
    series = W.partitionBy("_bucket", *group)
    order = series.orderBy(position)
    # where there is no row that far back, the series itself starts in this bucket, so the bucket's first row is the
    # series' first; columns are lagged one by one, so that those nobody reads are neither shuffled nor lagged
    seen = F.count(F.lit(1)).over(series)
    earlier = {}
    for k in steps:
        there = F.lag(F.lit(True), k).over(order)
        for c in columns:
            back = F.lag(F.col(c), k).over(order)
            head = F.when(there.isNotNull(), back).otherwise(F.when(seen > k, F.first(c).over(order)))
            earlier[f"{c}_lag_{k}"] = head if c in headed else back
    return spread.withColumns(earlier).filter(~F.col("_extra")).select(*df.columns, *earlier)


def rolling_window(
    df: DataFrame,
    window_size: int,
    position: str,
    columns: Sequence[str] | None = None,
    group: Sequence[str] = (),
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Put the ``window_size - 1`` preceding rows beside every row.

    Each column is shifted and then filled from below, so leading rows repeat the first known
    values and real gaps take the next value.  ``row_was_lagg_backfilled`` marks the first
    ``window_size`` rows.  Without ``group`` the window runs through the whole table.
    """
    columns = [c for c in (columns or df.columns) if c != position and c not in group]
    steps = range(1, window_size)
    gaps = df.agg(
        F.coalesce(F.max(position), F.lit(0)).alias("_last"),
        *[F.max(F.col(c).isNull().cast("int")).alias(c) for c in columns],
    ).first()
    whole = [c for c in columns if not gaps[c]]  # nothing to fill but the head of the series
    out = lag_columns(df, columns, steps, position, group, whole, bucket_rows)
    shifted = [f"{c}_lag_{k}" for k in steps for c in columns if gaps[c]]
    if shifted:
        size = max(bucket_rows, -(-(gaps["_last"] + 1) // MAX_BUCKETS))
        out = fill_along(out, shifted, position, backward=True, group=group, bucket_rows=size)
    return out.select(
        *df.columns,
        (F.col(position) < window_size).alias("row_was_lagg_backfilled"),
        *[f"{c}_lag_{k}" for k in steps for c in columns],
    )


@dataclass
class SeriesEnds:
    """What a bucket cannot know of the whole series: the last position, which columns have gaps, the first row's values, and
    of a column with gaps the first known value and its position.  Values of other types than plain ones are left out."""

    last: int
    holed: list[str]
    first: dict[str, Any]
    known: dict[str, tuple[Any, int | None]]


def series_ends(df: DataFrame, columns: Sequence[str], position: str, gapless: Sequence[str] = ()) -> SeriesEnds:
    """The ends of a series, from one aggregate and its first row; in the columns ``gapless`` a null is a value like any other."""
    place, plain = F.col(position), [c for c in columns if isinstance(df.schema[c].dataType, _PLAIN)]
    watched = [c for c in columns if c not in gapless]
    seen = {c: F.when(F.col(c).isNotNull(), place) for c in watched}
    row = df.agg(
        F.coalesce(F.max(place), F.lit(-1)).alias("_last"),
        *[F.max(F.col(c).isNull()).alias(f"_holed_{c}") for c in watched],
        *[F.min(seen[c]).alias(f"_at_{c}") for c in watched],
        *[F.min_by(c, seen[c]).alias(f"_known_{c}") for c in watched if c in plain],
    ).first()
    head = df.filter(place == 0).select(*plain).first()  # texts in the aggregate would take it off the hashed path
    holed = [c for c in watched if row[f"_holed_{c}"]]
    return SeriesEnds(
        row["_last"], holed, {c: head and head[c] for c in plain}, {c: (row[f"_known_{c}"], row[f"_at_{c}"]) for c in holed if c in plain}
    )


def filled_lags(
    df: DataFrame, columns: Sequence[str], steps: Sequence[int], position: str, ends: SeriesEnds, bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """Add ``<column>_lag_<k>`` of one series, a shift that is then filled from below: see :func:`rolling_window`.

    Rows are shuffled and sorted once.  Where there are gaps, it is from the last of a bucket to its first, which is the order
    of both: first each row of a column with gaps gets its next known value and that value's position, then these are
    shifted, and a lag takes the value if the shifted column still reaches that far.  Columns are lagged one by one, so
    that those nobody reads are neither shuffled nor lagged.
    """
    steps = list(steps)
    size = max(bucket_rows, max(steps), -(-(ends.last + 1) // MAX_BUCKETS))
    place = F.col(position)
    spread = with_overlap(df, position, size, max(steps))
    bucket = W.partitionBy("_bucket")
    upwards = bucket.orderBy(place.desc())
    # without gaps rows stay in their order: a tree's fit draws the rows it splits by from partition and place
    order, back = (upwards, F.lead) if ends.holed else (bucket.orderBy(place), F.lag)
    first = {c: F.lit(v).cast(df.schema[c].dataType) for c, v in ends.first.items()}
    if ends.holed:
        known = {f"_next_{c}": F.col(c) for c in ends.holed} | {f"_at_{c}": F.when(F.col(c).isNotNull(), place) for c in ends.holed}
        for c, (value, at) in ends.known.items():
            first |= {f"_next_{c}": F.lit(value).cast(df.schema[c].dataType), f"_at_{c}": F.lit(at).cast("long")}
        so_far = upwards.rowsBetween(W.unboundedPreceding, 0)
        stepped = df.select(place, *ends.holed).withColumns(known | {"_bucket": bucket_of(position, size), "_step": -place})
        carried = carried_values(stepped, list(known), backward=True)
        spread = spread.withColumns(known)
        spread = spread.withColumns({f"_near_{n}": F.last(n, ignorenulls=True).over(so_far) for n in known})
        spread = attach(spread, carried, ["_bucket"], "left").withColumns({n: F.coalesce(f"_near_{n}", f"_far_{n}") for n in known})

    def shifted(name: str, k: int) -> Column:
        # the first k rows take the first row's value
        end = F.last if ends.holed else F.first
        head = first[name] if name in first else end(name).over(order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
        return F.when(place >= k, back(name, k).over(order)).otherwise(head if ends.last >= k else F.lit(None))

    earlier = {
        f"{c}_lag_{k}": F.when(shifted(f"_at_{c}", k) <= ends.last - k, shifted(f"_next_{c}", k)) if c in ends.holed else shifted(c, k)
        for k in steps for c in columns
    }
    return spread.withColumns(earlier).filter(~F.col("_extra")).select(*df.columns, *earlier)


def lead_time_lags(
    df: DataFrame, column: str, lags: int, lead_time: int, position: str, group: Sequence[str] = ()
) -> DataFrame:
    """Lags of one column from ``lead_time`` rows back, ``lags`` of them."""
    return lag_columns(df, [column], range(lead_time, lead_time + lags), position, group)


def supervised_frame(
    df: DataFrame, column: str, back: int, position: str, group: Sequence[str] = ()
) -> DataFrame:
    """One series as training rows: its value and the ``back`` values before it."""
    lagged = lag_columns(df, [column], range(1, back + 1), position, group)
    return lagged.select(position, *group, *[f"{column}_lag_{k}" for k in range(back, 0, -1)], column)


def calendar_lags(
    df: DataFrame, value: str, shifts: Mapping[str, tuple[int, str]], keys: Sequence[str], date: str = "date"
) -> DataFrame:
    """The series' own value a day, week, month or year earlier; missing days stay null.

    ``shifts`` maps a column name to ``(count, unit)``.  ``keys`` and ``date`` must identify a row, so a series has
    a row per date at most and all shifts come from one sort of it; a month before the 31st is the last of the month.
    """
    series = ", ".join(f"`{k}`" for k in keys)

    def then(count: int, unit: str) -> Column:
        far = f"INTERVAL {int(count)} {unit.upper()} PRECEDING"
        return F.expr(
            f"CASE WHEN `{date}` IS NOT NULL THEN max(`{value}`) OVER (PARTITION BY {series} ORDER BY `{date}`"
            f" RANGE BETWEEN {far} AND {far}) END"
        )

    return df.select("*", *[then(count, unit).alias(name) for name, (count, unit) in shifts.items()])
