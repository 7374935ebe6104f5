"""Categories by number, for any count of them: the fitted dictionary is a stored table, not a list on the driver.

A dictionary has a row per category (``variable``, ``value``, ``number``), the most frequent first, ties by value.
Applying it is one pass over the rows: the small columns' dictionaries are broadcast together, after a single measure
taken when they were fitted, and only a dictionary beyond the limit is joined by shuffle.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import OneHotEncoder
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.columns import as_text
from shelfcast.operators.joins import BROADCAST_BYTES, attach
from shelfcast.operators.ordering import dense_position
from shelfcast.shared import written_table

DICTIONARY = "variable string, value string, number bigint"
#: Bytes beside the text that a row of a broadcast dictionary takes.
_ROW_BYTES = 48


class TableModelWriter(MLWriter):
    """Writes a model's parameters as usual and its table beside them, by the executors."""

    def __init__(self, instance: Any):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        if self.instance.table is not None:
            self.instance.table.write.parquet(f"{path}/table")


class TableModelReader(MLReader):
    def __init__(self, kind: type):
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> Any:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.kind()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        if model.has_table():
            model.table = self.sparkSession.read.schema(self.kind.TABLE).parquet(f"{path}/table")
        return model


class TableModel(MLWritable, MLReadable):
    """A model with a DataFrame ``table`` of schema ``TABLE`` among its state."""

    TABLE = DICTIONARY
    table: DataFrame | None = None

    def has_table(self) -> bool:
        return True

    def write(self) -> TableModelWriter:
        return TableModelWriter(self)

    @classmethod
    def read(cls) -> TableModelReader:
        return TableModelReader(cls)


def category_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``variable``, ``value``, ``_n``: how often each category of each column occurs, in one pass; nulls are left out."""
    cells = df.select(*by, *[as_text(df, c).alias(c) for c in columns])
    rows = cells.unpivot(list(by), list(columns), "variable", "value").filter(F.col("value").isNotNull())
    return rows.groupBy(*by, "variable", "value").agg(F.count(F.lit(1)).alias("_n"))


def numbered(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counts of categories to a dictionary, by one distributed sort; with ``by`` to one of each group, in one sort too."""
    order = [*by, "variable", F.col("_n").desc(), "value"]
    placed = written_table(dense_position(counts, order, "_at"), "category-places")
    starts = placed.groupBy(*by, "variable").agg(F.min("_at").alias("_start"))  # a row per column and group
    found = placed.join(F.broadcast(starts), [*by, "variable"])
    return written_table(found.select(*by, "variable", "value", (F.col("_at") - F.col("_start")).alias("number")), "category-index")


def category_index(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``variable``, ``value``, ``number``: the categories of each column as text, by falling frequency, ties by value.

    Counted in one pass and numbered in one distributed sort, so the count of categories is not limited.
    """
    return numbered(category_counts(df, columns))


def dictionary_sizes(index: DataFrame) -> dict[str, tuple[int, int]]:
    """Per column how many categories it has and what they weigh: a row per column comes to the driver."""
    weighed = index.groupBy("variable").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("value") + F.lit(_ROW_BYTES)).alias("bytes")
    )
    return {r["variable"]: (r["n"], r["bytes"]) for r in weighed.collect()}


def numbers_of(index: DataFrame, texts: Mapping[str, str | None]) -> dict[str, int | None]:
    """The number of one category of each column; none for a null and for an unseen one."""
    asked = [(F.col("variable") == c) & (F.col("value") == t) for c, t in texts.items() if t is not None]
    found = index.filter(reduce(lambda a, b: a | b, asked, F.lit(False))).collect()  # a row per column at most
    return dict.fromkeys(texts) | {r["variable"]: r["number"] for r in found}


def replace_by_number(
    rows: DataFrame, index: DataFrame, sizes: Mapping[str, tuple[int, int]], columns: Sequence[str], broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """``rows`` with the texts in ``columns`` replaced by their numbers; null for a null and for an unseen category.

    The dictionaries that fit into ``broadcast_bytes`` together, the smallest first, meet the rows where they are; each
    of the others is attached by shuffle, with hot categories cut into pieces.
    """
    left, here = broadcast_bytes, []
    for c in sorted(columns, key=lambda c: sizes.get(c, (0, 0))[1]):
        left -= sizes.get(c, (0, 0))[1]
        if left >= 0:
            here.append(c)
    out = rows
    for c in columns:
        own = index.filter(F.col("variable") == c).select(F.col("value").alias(c), F.col("number").alias("_number"))
        if c in here:
            out = out.join(F.broadcast(own), c, "left")
        else:
            out = attach(out, own, [c])
        out = out.drop(c).withColumnRenamed("_number", c)
    return out.select(*rows.columns)


class _IndexParams(Params):
    columns = Param(Params._dummy(), "columns", "the category columns", TypeConverters.toListString)
    suffix = Param(Params._dummy(), "suffix", "added to a column's name for its output", TypeConverters.toString)
    sizes = Param(Params._dummy(), "sizes", "categories and bytes per column as JSON", TypeConverters.toString)
    vectors = Param(Params._dummy(), "vectors", "sparse indicator vectors instead of numbers", TypeConverters.toBoolean)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(suffix="_index", sizes="{}", vectors=False)

    def getColumns(self) -> list[str]:
        return self.getOrDefault(self.columns)


class IndexColumnsModel(Model, _IndexParams, TableModel):
    """The dictionary found by :class:`IndexColumns`."""

    def __init__(self) -> None:
        super().__init__()

    def getSizes(self) -> dict[str, tuple[int, int]]:
        return {c: tuple(s) for c, s in json.loads(self.getOrDefault(self.sizes)).items()}

    def slots(self) -> dict[str, int]:
        """Length of each column's vector: a slot per category, then one for null, then one for any unseen category."""
        sizes = self.getSizes()
        return {c: sizes.get(c, (0, 0))[0] + 2 for c in self.getColumns()}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        columns, suffix, slots = self.getColumns(), self.getOrDefault(self.suffix), self.slots()
        outputs = {c: f"{c}{suffix}" for c in columns}
        texts = dataset.withColumns({f"_text_{c}": as_text(dataset, c) for c in columns})
        index = self.table.withColumn("variable", F.concat(F.lit("_text_"), "variable"))
        sizes = {f"_text_{c}": s for c, s in self.getSizes().items()}
        known = replace_by_number(texts, index, sizes, list(sizes) or [f"_text_{c}" for c in columns])
        if not self.getOrDefault(self.vectors):
            return known.withColumns({outputs[c]: F.col(f"_text_{c}").cast("long") for c in columns}).drop(*[f"_text_{c}" for c in columns])
        slot = {
            f"_text_{c}": F.coalesce(F.col(f"_text_{c}").cast("long"), F.when(as_text(dataset, c).isNull(), F.lit(slots[c] - 2)).otherwise(F.lit(slots[c] - 1)))
            for c in columns
        }
        encoder = OneHotEncoder(inputCols=list(slot), outputCols=list(outputs.values()), dropLast=False)
        widest = dataset.sparkSession.createDataFrame([tuple(float(slots[c] - 1) for c in columns)], [f"_text_{c}" for c in columns])
        placed = known.withColumns({name: column.cast("double") for name, column in slot.items()})
        return encoder.fit(widest).transform(placed).drop(*slot)


class IndexColumns(Estimator, _IndexParams, MLWritable, MLReadable):
    """Numbers categories by falling frequency, ties by value, or gives them slots of a sparse vector; any count of them.

    A null and a category that the fitted rows did not have are null as numbers; as vectors each has a slot of its own
    behind the known ones.  Flags read ``True`` and ``False``.
    """

    @keyword_only
    def __init__(self, *, columns: Sequence[str] | None = None, suffix: str = "_index", vectors: bool = False):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> IndexColumnsModel:
        model = self._copyValues(IndexColumnsModel())
        model.table = category_index(dataset, self.getColumns())
        return model._set(sizes=json.dumps(dictionary_sizes(model.table)))

    def write(self) -> DefaultParamsWriter:
        return DefaultParamsWriter(self)

    @classmethod
    def read(cls) -> DefaultParamsReader:
        return DefaultParamsReader(cls)
