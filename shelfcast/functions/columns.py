"""Projections and small numeric expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FLOATING = (T.FloatType, T.DoubleType)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by an old-to-new map; names that do not occur are passed over."""
    return df.withColumnsRenamed(dict(names))


def rename_back(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Undo :func:`rename` with the same map."""
    return df.withColumnsRenamed({new: old for old, new in names.items()})


def in_order(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly these columns in this order; a missing one is an error."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns to order are missing: {missing}")
    return df.select(*[quoted(c) for c in columns])


def quoted(name: str) -> Column:
    """A top-level column by its exact name, whatever characters that has."""
    return F.col("`" + name.replace("`", "``") + "`")


def choose_columns(
    df: DataFrame, keep: Sequence[str], rest: str = "drop"
) -> DataFrame:
    """Listed columns first; the others are dropped, passed on behind them, or refused."""
    others = [c for c in df.columns if c not in keep]
    if rest == "drop":
        return in_order(df, keep)
    if rest == "pass":
        return in_order(df, [*keep, *others])
    if rest == "refuse":
        if others:
            raise ValueError(f"unhandled columns: {others}; name them, if only to pass them on")
        return in_order(df, keep)
    raise ValueError(f"unknown treatment of the remaining columns: {rest!r}")


def nan_as_null(df: DataFrame) -> DataFrame:
    """Turn NaN into null, so that aggregates leave it out."""
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, _FLOATING)]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None)) for c in floating}) if floating else df


def round_floating(df: DataFrame, decimals: int, columns: Sequence[str] | None = None) -> DataFrame:
    """Round float columns, half up; leave every other type alone."""
    floating = [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, _FLOATING) and (columns is None or f.name in columns)
    ]
    return df.withColumns({c: F.round(c, decimals) for c in floating}) if floating else df


def for_display(df: DataFrame, decimals: int = 1) -> DataFrame:
    """Spaces for underscores in the names, floats rounded."""
    rounded = round_floating(df, decimals)
    return rounded.toDF(*[c.replace("_", " ") for c in rounded.columns])


def flag_as_number(flag: Column) -> Column:
    return flag.cast("int")


def flag_as_text(flag: Column) -> Column:
    """``True`` or ``False``, capitalised."""
    return F.initcap(flag.cast("string"))


def as_text(df: DataFrame, column: str) -> Column:
    """A category as text; flags read ``True`` and ``False``."""
    if isinstance(df.schema[column].dataType, T.BooleanType):
        return flag_as_text(F.col(column))
    return F.col(column).cast("string")


def on_promotion(count: Column) -> Column:
    """Whether any product is on promotion."""
    return count > 0


def difference(value: Column, other: Column) -> tuple[Column, Column]:
    """A difference and its size."""
    return value - other, F.abs(value - other)


def first_of_vector(vector: Column, kind: str | T.DataType) -> Column:
    """First element of an ML vector; NaN, which assembling makes of null, becomes null again."""
    return F.nanvl(vector_to_array(vector)[0], F.lit(None)).cast(kind)


def vector_as_array(vector: Column) -> Column:
    return vector_to_array(vector)
