"""Ordered folds: one column on one table instead of copies of it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.operators.joins import referenced_rows


@dataclass
class TrainTestSplit:
    """Training and test rows of one fold, and what to call them."""

    table: str
    kind: str
    fold: int | str
    train: DataFrame
    test: DataFrame

    def name_of(self, part: str) -> str:
        """``<table>_<kind>_<part>_<fold>``, for part ``train`` or ``test``."""
        return f"{self.table}_{self.kind}_{part}_{self.fold}"


def sequential_parts(df: DataFrame, number: str, parts: int, name: str = "part") -> DataFrame:
    """Cut by stored row number into parts of ``count // parts`` rows; the rest is left out."""
    size = df.count() // parts
    if size == 0:
        return df.withColumn(name, F.lit(0)).filter(F.lit(False))
    part = F.floor(F.col(number) / size).cast("int")
    return df.filter((F.col(number) >= 0) & (F.col(number) < size * parts)).withColumn(name, part)


def fold_of(position: Column, rows: int, folds: int) -> Column:
    """Contiguous folds over all rows; the first ``rows % folds`` hold one row more."""
    size, longer = divmod(rows, folds)
    border = longer * (size + 1)
    late = F.lit(longer) + F.floor((position - border) / max(size, 1))
    return F.when(position < border, F.floor(position / (size + 1))).otherwise(late).cast("int")


def ordered_folds(df: DataFrame, position: str, folds: int, name: str = "fold") -> DataFrame:
    """Every row's test fold by dense position."""
    return df.withColumn(name, fold_of(F.col(position), df.count(), folds))


def time_series_blocks(rows: int, folds: int) -> tuple[int, int]:
    """Length of a test block, and where the first one starts."""
    block = rows // (folds + 1)
    return block, rows - folds * block


def time_series_folds(df: DataFrame, position: str, folds: int, name: str = "fold") -> DataFrame:
    """The last ``folds`` equal blocks as test folds 0, 1, ...; rows before them get fold -1."""
    block, start = time_series_blocks(df.count(), folds)
    fold = F.floor((F.col(position) - start) / max(block, 1)).cast("int")
    return df.withColumn(name, F.when(F.col(position) < start, F.lit(-1)).otherwise(fold))


def in_train(fold_column: str, fold: int, growing: bool) -> Column:
    """Whether a row trains fold ``fold``: all other rows, or only earlier ones when ``growing``."""
    return F.col(fold_column) < fold if growing else F.col(fold_column) != fold


def membership(df: DataFrame, folds: int, fold_column: str = "fold", growing: bool = False) -> DataFrame:
    """Each row once per fold it takes part in: ``in_fold`` and ``side`` (train or test)."""
    own = F.col(fold_column)
    ids = F.sequence(F.greatest(own, F.lit(0)), F.lit(folds - 1)) if growing else F.sequence(F.lit(0), F.lit(folds - 1))
    return df.withColumn("in_fold", F.explode(ids)).withColumn(
        "side", F.when(F.col("in_fold") == own, "test").otherwise("train")
    )


def split_on(
    df: DataFrame, fold: int, table: str, kind: str = "kfold", fold_column: str = "fold", growing: bool = False
) -> TrainTestSplit:
    """One fold as two filtered views of the table."""
    return TrainTestSplit(
        table, kind, fold,
        df.filter(in_train(fold_column, fold, growing)).drop(fold_column),
        df.filter(F.col(fold_column) == fold).drop(fold_column),
    )


def kfold_splits(df: DataFrame, number: str, folds: int, table: str) -> list[TrainTestSplit]:
    """Fold ``i``: part ``i`` tests, all other parts train."""
    parts = sequential_parts(df, number, folds, "_part")
    return [split_on(parts, i, table, "kfold", "_part") for i in range(folds)]


def linked_split(
    dimension: DataFrame, dimension_table: str, split: TrainTestSplit, matching: Mapping[str, str], **options
) -> TrainTestSplit:
    """The dimension rows each side of a fact split refers to; ``matching`` is dimension to fact column."""
    return TrainTestSplit(
        dimension_table, split.kind, split.fold,
        referenced_rows(dimension, split.train, matching, **options),
        referenced_rows(dimension, split.test, matching, **options),
    )


def hold_out(df: DataFrame, position: str, share: float = 0.2, name: str = "is_test") -> DataFrame:
    """Mark the last ``ceil(share * rows)`` rows."""
    rows = df.count()
    exact = Fraction(share).limit_denominator(10**9)  # what was meant by 0.2 or 1 / 3
    tested = -(-rows * exact.numerator // exact.denominator)
    return df.withColumn(name, F.col(position) >= rows - tested)


def fold_identifiers(splits: Sequence[TrainTestSplit]) -> list[str]:
    return [split.name_of(part) for split in splits for part in ("train", "test")]
