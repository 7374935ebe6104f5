"""Column profiles.

Distinct counts and modes come from one table of value counts, built with one
map-side combined aggregation over the unpivoted columns; exact percentiles from
brackets around them, so that only the values near a percentile are moved.  No
value list of a column is ever gathered in one place.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.functions.columns import nan_as_null, round_floating
from shelfcast.operators.ordering import dense_position, first_rows, running_total
from shelfcast.shared import written_table

QUARTILES = (0.25, 0.5, 0.75)
#: Parts of the rows by which the sketch of a percentile may be off.
ACCURACY = 10_000
_CATEGORICAL = (T.StringType, T.BooleanType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def categorical_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _CATEGORICAL)]


def long_form(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per cell: ``variable``, and its value as ``number`` or, where a double cannot hold it, as ``text``.

    Wide integers have both: the text tells them apart, the number orders them.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    cells = []
    for c in columns:
        numeric = isinstance(kinds[c], T.NumericType)
        exact = numeric and not isinstance(kinds[c], (T.LongType, T.DecimalType))
        number = F.col(c).cast("double") if numeric else F.lit(None).cast("double")
        text = F.lit(None).cast("string") if exact else F.col(c).cast("string")
        cells.append(F.struct(text.alias("text"), number.alias("number")).alias(c))
    return df.select(*cells).unpivot([], list(columns), "variable", "cell").select("variable", "cell.text", "cell.number")


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How often each value of each column occurs, nulls included: ``variable, text, number, n``."""
    return long_form(nan_as_null(df), columns).groupBy("variable", "text", "number").agg(F.count(F.lit(1)).alias("n"))


def _counted(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return written_table(value_counts(df, columns), "value-counts")


def _basics(counts: DataFrame) -> DataFrame:
    known = F.col("text").isNotNull() | F.col("number").isNotNull()
    return counts.groupBy("variable").agg(
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("nulls"),
        F.count_if(known).alias("unique"),
        F.sum("n").alias("total_rows"),
    )


def approximate_basics(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """As the exact counts, with distinct values estimated in one pass that shuffles sketches only."""
    wide = nan_as_null(df).agg(*[
        F.struct(
            F.count_if(F.col(c).isNull()).alias("nulls"),
            F.approx_count_distinct(c).alias("unique"),
            F.count(F.lit(1)).alias("total_rows"),
        ).alias(c)
        for c in columns
    ])
    return wide.unpivot([], list(columns), "variable", "_b").select("variable", "_b.*")


def _per_column(df: DataFrame, rows: DataFrame, name: str = "variable") -> DataFrame:
    """Add the type of each column to a frame with one row per column."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    mapping = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])
    return rows.withColumn("type", F.element_at(mapping, F.col(name)))


def describe_basics(
    df: DataFrame,
    examples: int = 0,
    order: Sequence[str] = (),
    columns: Sequence[str] | None = None,
    approximate: bool = False,
) -> DataFrame:
    """Type, nulls, distinct values (nulls apart) and rows of each column, with first values as examples.

    ``approximate`` estimates the distinct values, which spares shuffling every distinct value.
    """
    columns = list(columns or df.columns)
    basics = approximate_basics(df, columns) if approximate else _basics(_counted(df, columns))
    described = _per_column(df, basics)
    if examples:
        texts = [F.col(c).cast("string").alias(c) for c in columns]
        shown = first_rows(df.select(F.struct(*order).alias("_place"), *texts), ["_place"], examples)
        placed = dense_position(shown, ["_place", *columns], "_at").drop("_place")
        listed = placed.unpivot(["_at"], columns, "variable", "text").groupBy("variable").agg(
            *[F.max(F.when(F.col("_at") == i, F.col("text"))).alias(f"example_{i}") for i in range(examples)]
        )
        described = described.join(listed, "variable", "left")
    shown_first = [f"example_{i}" for i in range(examples)]
    return described.select("variable", *shown_first, "type", "nulls", "unique", "total_rows")


def describe_categoricals(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """:func:`describe_basics` of text and flag columns with the commonest value; ties go to the first value."""
    columns = list(columns or categorical_columns(df))
    counts = _counted(df, columns)
    known = F.col("text").isNotNull()
    commonest = counts.groupBy("variable").agg(
        F.min_by("text", F.when(known, F.struct(-F.col("n"), F.col("text")))).alias("most_common"),
        F.max(F.when(known, F.col("n"))).alias("freq_of_most_common"),
    )
    basics = _per_column(df, _basics(counts))
    return basics.join(F.broadcast(commonest), "variable").select(  # one row per column
        "variable", "type", "nulls", "unique", "total_rows", "most_common", "freq_of_most_common"
    )


def _inside(column: Column, brackets: Sequence[tuple[float, float]]) -> Column:
    return reduce(lambda a, b: a | b, [column.between(low, high) for low, high in brackets], F.lit(False))


def percentiles(
    df: DataFrame, columns: Sequence[str], fractions: Sequence[float] = QUARTILES, accuracy: int = ACCURACY
) -> DataFrame:
    """Exact percentiles per variable, linear between neighbours: ``variable, fraction, value``; none for an empty column.

    Selection by brackets, all columns at once: a sketch gives each percentile a lower and an upper value, a second pass
    counts exactly what lies below and up to them, and only the values inside a bracket, some of ``accuracy`` parts of the
    rows, are shuffled and put in order.  A bracket that the exact counts show to miss its rank becomes the whole column.
    """
    fractions = [float(f) for f in fractions]
    numbers = nan_as_null(df.select(*[F.col(c).cast("double").alias(c) for c in columns]))
    # a percentile's rank may be off by one part; the two marks lie two parts beside it
    marks = [min(max(f + side * 2 / accuracy, 0.0), 1.0) for f in fractions for side in (-1, 1)]
    sketch = numbers.agg(*[
        F.struct(F.count(c).alias("n"), F.min(c).alias("low"), F.max(c).alias("high"), F.percentile_approx(c, marks, accuracy).alias("at")).alias(c)
        for c in columns
    ]).first()
    wanted = [(c, f, sketch[c]["at"][2 * i], sketch[c]["at"][2 * i + 1]) for c in columns if sketch[c]["n"] for i, f in enumerate(fractions)]
    schema = "variable string, fraction double, value double"
    if not wanted:
        return df.sparkSession.createDataFrame([], schema)
    counted = numbers.agg(*[
        F.struct(F.count_if(F.col(c) < low).alias("below"), F.count_if(F.col(c) <= high).alias("upto")).alias(f"_{k}")
        for k, (c, _, low, high) in enumerate(wanted)
    ]).first()
    known, open_ = [], []
    for k, (c, f, low, high) in enumerate(wanted):
        place, below = f * (sketch[c]["n"] - 1), counted[f"_{k}"]["below"]
        if not (below <= math.floor(place) and math.ceil(place) < counted[f"_{k}"]["upto"]):
            low, high, below = sketch[c]["low"], sketch[c]["high"], 0
        if low == high:
            known.append((c, f, low))
        else:
            open_.append((c, f, low, high, below, place))
    found = df.sparkSession.createDataFrame(known, schema)
    if not open_:
        return found
    own = {c: [(x[2], x[3]) for x in open_ if x[0] == c] for c in columns}
    cells = numbers.select(*[F.when(_inside(F.col(c), own[c]), F.col(c)).alias(c) for c in columns if own[c]])
    cells = cells.unpivot([], cells.columns, "variable", "number").filter("number IS NOT NULL")
    values = cells.groupBy("variable", "number").agg(F.count(F.lit(1)).alias("n"))
    asked = df.sparkSession.createDataFrame(
        open_, "variable string, fraction double, _low double, _high double, _below bigint, _place double"
    )  # columns times fractions
    held = values.join(F.broadcast(asked), "variable").filter(F.col("number").between(F.col("_low"), F.col("_high")))
    ranked = running_total(held, ["variable", "fraction", "number"], "n", "_upto")
    before = ranked.groupBy("variable", "fraction").agg(F.min(F.col("_upto") - F.col("n")).alias("_before"))
    ranked = ranked.join(F.broadcast(before), ["variable", "fraction"])  # a row per column and fraction
    last = F.col("_below") + F.col("_upto") - F.col("_before")
    first = last - F.col("n")
    low = (first <= F.floor("_place")) & (F.floor("_place") < last)
    high = (first <= F.ceil("_place")) & (F.ceil("_place") < last)
    sorted_out = ranked.filter(low | high).groupBy("variable", "fraction", "_place").agg(F.min("number").alias("_low"), F.max("number").alias("_high"))
    between = F.col("_low") + (F.col("_high") - F.col("_low")) * (F.col("_place") - F.floor("_place"))
    return found.unionByName(sorted_out.select("variable", "fraction", between.alias("value")))


def _percentile_columns(df: DataFrame, columns: Sequence[str], fractions: Sequence[float]) -> DataFrame:
    found = percentiles(df, columns, fractions)
    return found.groupBy("variable").agg(*[
        F.max(F.when(F.col("fraction") == f, F.col("value"))).alias(f"{f * 100:g}%") for f in fractions
    ])


_MOMENTS = {"count": F.count, "min": F.min, "max": F.max, "mean": F.avg, "std": F.stddev_samp}


def _moments(df: DataFrame, columns: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Plain aggregates of each column, one row per column, from one pass."""
    wide = nan_as_null(df).agg(*[
        F.struct(*[_MOMENTS[n](c).cast("long" if n == "count" else "double").alias(n) for n in names]).alias(c)
        for c in columns
    ])
    return wide.unpivot([], list(columns), "variable", "_m").select("variable", "_m.*")


def describe_numericals(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    decimals: int = 2,
    include_percentiles: bool = False,
    include_additional_examples: bool = False,
    order: str | None = None,
) -> DataFrame:
    """Type, nulls, distinct values, rows, maximum, mean and sample deviation of each numeric column.

    On request also the quartiles, and the first and last value by ``order``.
    """
    columns = list(columns or numeric_columns(df))
    described = _per_column(df, _basics(value_counts(df, columns))).withColumnRenamed("type", "dtype")
    extra: list[str] = []
    if include_additional_examples:
        if order is None:
            raise ValueError("first and last values need an order column")
        ends = df.agg(*[
            F.struct(
                F.min_by(c, order).cast("double").alias("first_value"),
                F.max_by(c, order).cast("double").alias("last_value"),
            ).alias(c)
            for c in columns
        ]).unpivot([], columns, "variable", "_e").select("variable", "_e.*")
        described = described.join(F.broadcast(ends), "variable")
        extra += ["first_value", "last_value"]
    if include_percentiles:
        quartiles = _percentile_columns(df, columns, QUARTILES)
        described = described.join(F.broadcast(quartiles), "variable", "left")
        extra += ["25%", "50%", "75%"]
    described = described.join(F.broadcast(_moments(df, columns, ["max", "mean", "std"])), "variable")
    shown = described.select(
        "variable", "dtype", "nulls", "unique", "total_rows", *extra, "max", "mean", "std"
    )
    return round_floating(shown, decimals, ["25%", "50%", "75%", "mean", "std"])


def describe_numerical_variable(df: DataFrame, column: str, **options) -> DataFrame:
    """:func:`describe_numericals` of one column."""
    return describe_numericals(df, [column], **options)


def describe_table(df: DataFrame, decimals: int = 2) -> dict[str, DataFrame]:
    """Both profiles of a table."""
    return {"categorical": describe_categoricals(df), "numerical": describe_numericals(df, decimals=decimals)}


def summarize(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, deviation, minimum, exact quartiles and maximum of each numeric column."""
    columns = list(columns or numeric_columns(df))
    quartiles = _percentile_columns(df, columns, QUARTILES)
    basics = _moments(df, columns, ["count", "mean", "std", "min", "max"])
    return basics.join(F.broadcast(quartiles), "variable", "left").select(
        "variable", "count", "mean", "std", "min", "25%", "50%", "75%", "max"
    )


def distinct_combinations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def combination_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How often each combination occurs."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def column_range(df: DataFrame, column: str) -> DataFrame:
    """Minimum, mean and maximum of a column."""
    clean = nan_as_null(df.select(column))
    return clean.agg(*[
        f(column).alias(f"{name}_{column}") for name, f in (("min", F.min), ("mean", F.avg), ("max", F.max))
    ])
