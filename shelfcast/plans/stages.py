"""Steps of an ML pipeline.  Fitted steps hold bounds or category lists and apply them as expressions."""

from __future__ import annotations

import importlib
import json
from collections.abc import Callable, Sequence
from typing import Any

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import Imputer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.columns import as_text, first_of_vector, nan_as_null, quoted, vector_as_array

MAX_CATEGORIES = 2_000


class _Columns(Params):
    columns = Param(Params._dummy(), "columns", "the columns this step works on", TypeConverters.toListString)

    def __init__(self) -> None:
        super().__init__()

    def getColumns(self) -> list[str]:
        return self.getOrDefault(self.columns)


class ColumnSelector(Transformer, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Keeps the listed columns."""

    @keyword_only
    def __init__(self, *, columns: Sequence[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.select(*self.getColumns())


class ColumnDropper(Transformer, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Drops the listed columns."""

    @keyword_only
    def __init__(self, *, columns: Sequence[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.drop(*self.getColumns())


class VectorFirstValue(Transformer, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Replaces vectors by their first element, each cast to its own type."""

    kinds = Param(Params._dummy(), "kinds", "one Spark type per column", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, columns: Sequence[str] | None = None, kinds: Sequence[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        pairs = zip(self.getColumns(), self.getOrDefault(self.kinds))
        return dataset.withColumns({c: first_of_vector(F.col(c), kind) for c, kind in pairs})


class VectorToArray(Transformer, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Replaces vectors by arrays, which every file format can hold."""

    @keyword_only
    def __init__(self, *, columns: Sequence[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumns({c: vector_as_array(F.col(c)) for c in self.getColumns()})


class FunctionStep(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Applies a module-level function of a DataFrame; arguments must be plain JSON values."""

    function = Param(Params._dummy(), "function", "module:function", TypeConverters.toString)
    arguments = Param(Params._dummy(), "arguments", "keyword arguments as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, function: str | None = None, arguments: str = "{}"):
        super().__init__()
        self._setDefault(arguments="{}")
        self._set(**self._input_kwargs)

    @classmethod
    def of(cls, function: Callable[..., DataFrame], **arguments: Any) -> FunctionStep:
        return cls(function=f"{function.__module__}:{function.__qualname__}", arguments=json.dumps(arguments))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        module, name = self.getOrDefault(self.function).split(":")
        function = getattr(importlib.import_module(module), name)
        return function(dataset, **json.loads(self.getOrDefault(self.arguments)))


def scaled(column: Column, low: float | None, high: float | None, constant: float) -> Column:
    """A value's place between the bounds; nulls stay null, and a constant column gets ``constant``."""
    if low is None or high is None:
        return F.lit(None).cast("double")
    if low == high:
        return F.when(column.isNotNull(), F.lit(float(constant)))
    return (column - F.lit(low)) / F.lit(high - low)


class _ScaleParams(_Columns):
    suffix = Param(Params._dummy(), "suffix", "added to the name; empty scales in place", TypeConverters.toString)
    constant = Param(Params._dummy(), "constant", "value given to a constant column", TypeConverters.toFloat)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(suffix="", constant=0.5)


class MinMaxColumnsModel(Model, _ScaleParams, DefaultParamsReadable, DefaultParamsWritable):
    """Bounds found by :class:`MinMaxColumns`."""

    bounds = Param(Params._dummy(), "bounds", "low and high per column as JSON", TypeConverters.toString)

    def __init__(self) -> None:
        super().__init__()

    def getBounds(self) -> dict[str, tuple[float | None, float | None]]:
        return {c: tuple(pair) for c, pair in json.loads(self.getOrDefault(self.bounds)).items()}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        bounds = self.getBounds()
        suffix, constant = self.getOrDefault(self.suffix), self.getOrDefault(self.constant)
        return dataset.withColumns({
            f"{c}{suffix}": scaled(F.nanvl(F.col(c).cast("double"), F.lit(None)), *bounds[c], constant)
            for c in self.getColumns()
        })


class MinMaxColumns(Estimator, _ScaleParams, DefaultParamsReadable, DefaultParamsWritable):
    """Min-max scaling to [0, 1] by bounds learned from the fitted rows, without ML vectors."""

    @keyword_only
    def __init__(self, *, columns: Sequence[str] | None = None, suffix: str = "", constant: float = 0.5):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> MinMaxColumnsModel:
        numbers = nan_as_null(dataset.select(*[F.col(c).cast("double") for c in self.getColumns()]))
        row = numbers.agg(*[F.struct(F.min(c), F.max(c)).alias(c) for c in self.getColumns()]).first()
        model = self._copyValues(MinMaxColumnsModel())
        return model._set(bounds=json.dumps({c: list(row[c]) for c in self.getColumns()}))


def mean_imputer(columns: Sequence[str], outputs: Sequence[str], missing: float = -1.0) -> Imputer:
    """Replaces nulls and ``missing`` by the mean of the other values; for a constant use ``fillna``."""
    return Imputer(inputCols=list(columns), outputCols=list(outputs), missingValue=missing, strategy="mean")


def known_categories(df: DataFrame, columns: Sequence[str], limit: int = MAX_CATEGORIES) -> dict[str, list[str]]:
    """The distinct values of each column as text, sorted; they become columns, so their number is limited.

    One pass over the rows.  More values than ``limit`` is an error: nothing is left out silently.
    """
    cells = df.select(*[as_text(df, c).alias(c) for c in columns])
    pairs = cells.unpivot([], list(columns), "variable", "value").filter(F.col("value").isNotNull()).distinct()
    rows = pairs.limit(limit * len(columns) + 1).collect()
    found: dict[str, list[str]] = {c: [] for c in columns}
    for row in rows:
        found[row["variable"]].append(row["value"])
    wide = [c for c in columns if len(found[c]) > limit]
    if wide or len(rows) > limit * len(columns):
        raise ValueError(f"more than {limit} categories in {wide or list(columns)}; index such columns instead")
    return {c: sorted(values) for c, values in found.items()}


def indicator_columns(text: str, name: str, categories: Sequence[str], mark_null: bool, end: str = "") -> list[Column]:
    """0/1 columns ``<name>_<category>`` of a text column, and ``<name>_nan`` on request; ``end`` closes every name.

    One SQL expression per column: with hundreds of categories, building them call by call takes seconds.
    """
    def named(expression: str, suffix: str) -> Column:
        return F.expr(expression).alias(f"{name}_{suffix}{end}")

    columns = [named(f"CAST(`{text}` <=> {sql_text(c)} AS INT)", c) for c in categories]
    if mark_null:
        if "nan" in categories:
            raise ValueError(f"{name} has a category named as the mark of nulls, nan")
        columns.append(named(f"CAST(`{text}` IS NULL AS INT)", "nan"))
    return columns


def sql_text(value: str) -> str:
    """A text as an SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


class OneHotColumnsModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Category lists found by :class:`OneHotColumns`; a category not seen then gives zeros."""

    categories = Param(Params._dummy(), "categories", "values per column as JSON", TypeConverters.toString)
    inPlace = Param(Params._dummy(), "inPlace", "put indicators where the column was", TypeConverters.toBoolean)
    nullIndicator = Param(Params._dummy(), "nullIndicator", "what the null column holds", TypeConverters.toBoolean)

    def __init__(self) -> None:
        super().__init__()

    def getCategories(self) -> dict[str, list[str]]:
        return json.loads(self.getOrDefault(self.categories))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        categories = self.getCategories()
        marks = self.getOrDefault(self.nullIndicator)
        encoded = {c: indicator_columns(f"_text_{c}", c, categories[c], marks) for c in self.getColumns()}
        texts = dataset.withColumns({f"_text_{c}": as_text(dataset, c) for c in encoded})
        if self.getOrDefault(self.inPlace):
            return texts.select(*[x for c in dataset.columns for x in encoded.get(c, [quoted(c)])])
        kept = [quoted(c) for c in dataset.columns if c not in encoded]
        return texts.select(*kept, *[x for c in self.getColumns() for x in encoded[c]])


class OneHotColumns(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """One-hot encoding into named 0/1 columns, with the categories of the fitted rows.

    ``inPlace`` puts them where the column was and marks nulls in ``<column>_nan``; otherwise they
    follow the other columns, and ``<column>_nan`` appears, always 0, where nulls were seen.
    """

    inPlace = Param(Params._dummy(), "inPlace", "put indicators where the column was", TypeConverters.toBoolean)
    limit = Param(Params._dummy(), "limit", "most categories a column may have", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, columns: Sequence[str] | None = None, inPlace: bool = False, limit: int = MAX_CATEGORIES):
        super().__init__()
        self._setDefault(inPlace=False, limit=MAX_CATEGORIES)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> OneHotColumnsModel:
        columns, in_place = self.getColumns(), self.getOrDefault(self.inPlace)
        found = known_categories(dataset, columns, self.getOrDefault(self.limit))
        if not in_place:
            holed = dataset.agg(*[F.max(F.col(c).isNull()).alias(c) for c in columns]).first()
            # a category list may hold null; no value ever equals it
            taken = [c for c, values in found.items() if holed[c] and "nan" in values]
            if taken:
                raise ValueError(f"{taken} have a category named as the mark of nulls, nan")
            found = {c: values + ["nan"] if holed[c] else values for c, values in found.items()}
        model = self._copyValues(OneHotColumnsModel())
        return model._set(categories=json.dumps(found), inPlace=in_place, nullIndicator=in_place)


def fill_numbers(df: DataFrame, columns: Sequence[str], value: float = -1.0) -> DataFrame:
    """The columns as doubles, nulls replaced, for models that take no gaps."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(float(value))) for c in columns})


def prefix(model: PipelineModel | Pipeline, steps: int) -> PipelineModel | Pipeline:
    """The first steps of a pipeline, to look at what they make."""
    if isinstance(model, PipelineModel):
        return PipelineModel(model.stages[:steps])
    return Pipeline(stages=model.getStages()[:steps])
