"""Filling gaps: constants with a flag, and last/next known values along an order."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfcast.operators.joins import attach
from shelfcast.operators.ordering import bounded_bucket_rows, bucket_of
from shelfcast.shared import written_table


def fill_with_flag(df: DataFrame, column: str, flag: str, value: float = 0) -> DataFrame:
    """Replace nulls by ``value`` and remember where that happened."""
    kind = df.schema[column].dataType
    return df.withColumns({
        flag: F.col(column).isNull(),
        column: F.coalesce(F.col(column), F.lit(value).cast(kind)),
    })


def fill_along(
    df: DataFrame,
    columns: Sequence[str],
    position: str,
    backward: bool = False,
    group: Sequence[str] = (),
    bucket_rows: int | None = None,
) -> DataFrame:
    """Give nulls the last known value before them (or, ``backward``, the next one after them).

    ``position`` is a dense row number; with ``group`` it must follow the group keys, so that each
    group is one run of positions.  Nulls are filled inside buckets of consecutive rows first; what
    enters a bucket from its neighbours is one small row per bucket, and the number of buckets is bounded.
    """
    bucket_rows = bucket_rows or bounded_bucket_rows(df, position)
    sign = -1 if backward else 1
    stepped = df.withColumns({"_bucket": bucket_of(position, bucket_rows), "_step": F.col(position) * sign})
    inside = W.partitionBy("_bucket", *group).orderBy("_step").rowsBetween(W.unboundedPreceding, 0)
    local = stepped.withColumns({f"_near_{c}": F.last(c, ignorenulls=True).over(inside) for c in columns})

    joined = attach(local, carried_values(stepped, columns, backward, group), ["_bucket"], "left")
    same_group = reduce(
        lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_group_{g}")) for g in group], F.lit(True)
    )
    filled = {
        c: F.coalesce(F.col(f"_near_{c}"), F.when(same_group, F.col(f"_far_{c}"))) for c in columns
    }
    return joined.select(*[filled[c].alias(c) if c in filled else F.col(c) for c in df.columns])


def carried_values(stepped: DataFrame, columns: Sequence[str], backward: bool, group: Sequence[str] = ()) -> DataFrame:
    """``_far_<column>``: what enters each ``_bucket`` from its neighbours, stored; a row per bucket at most."""
    # what each bucket hands on: its last known value per group that reaches the bucket's far edge
    edges = stepped.groupBy("_bucket", *group).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_step"))).alias(c) for c in columns]
    )
    sign = -1 if backward else 1
    earlier = (
        W.partitionBy(*group).orderBy(F.col("_bucket") * sign).rowsBetween(W.unboundedPreceding, -1)
    )
    carried = edges.select(
        "_bucket",
        *[F.col(g).alias(f"_group_{g}") for g in group],
        *[F.last(c, ignorenulls=True).over(earlier).alias(f"_far_{c}") for c in columns],
    )
    # a run of positions crosses a bucket's edge for one group only: at most one row per bucket is left
    carried = carried.filter(reduce(lambda a, b: a | b, [F.col(f"_far_{c}").isNotNull() for c in columns]))
    return written_table(carried, "carried")


def fill_by_calendar(
    facts: DataFrame, series: DataFrame, value: str, key: str = "date", every_date: bool = False
) -> DataFrame:
    """Join a sparse daily series and close its gaps: last known value, else the next one.

    The fill runs on the distinct dates of the facts.  A date column has at most 3.7 million
    values, so that calendar is small whatever the facts weigh; filling the joined rows in date
    order would give the same values.  ``every_date`` says that the series has just these dates, once each.
    """
    calendar = series.select(key, value) if every_date else attach(facts.select(key).distinct(), series.select(key, value), [key])
    ahead = W.orderBy(key).rowsBetween(W.unboundedPreceding, 0)
    back = W.orderBy(F.col(key).desc()).rowsBetween(W.unboundedPreceding, 0)
    filled = calendar.select(
        key,
        F.coalesce(
            F.last(value, ignorenulls=True).over(ahead), F.last(value, ignorenulls=True).over(back)
        ).alias(value),
    )
    return attach(facts, written_table(filled, "calendar"), [key])
