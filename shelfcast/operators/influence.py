"""Which categories move a measure: averages by category and key-influencer tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.columns import as_text, difference, nan_as_null
from shelfcast.functions.texts import labelled
from shelfcast.operators.joins import stack_rows
from shelfcast.shared import written_table

AGGREGATES = {
    "mean": F.avg, "sum": F.sum, "min": F.min, "max": F.max, "count": F.count, "std": F.stddev_samp,
}


def mean_by_category(
    df: DataFrame, category: str | tuple[str, str], target: str, reference_line: bool = False
) -> DataFrame:
    """Mean of the target per category, sorted; a ``(label, order)`` pair sorts labels by ``order``.

    ``reference_line`` adds the mean of the category means.
    """
    label, order = (category, category) if isinstance(category, str) else category
    name = f"avg_{target}"
    means = (
        nan_as_null(df).filter(F.col(label).isNotNull()).groupBy(label)
        .agg(F.avg(target).alias(name), F.min(order).alias("_order"))
    )
    if reference_line:
        means = grand_mean(means, name)
    return means.orderBy("_order", label).drop("_order")


def means_by_categories(df: DataFrame, categories: Sequence[str], targets: Sequence[str]) -> DataFrame:
    """:func:`mean_by_category` of all pairs from one pass: ``category_variable, category, target, average``."""
    long = _by_category(nan_as_null(df), categories, targets)
    means = long.groupBy("influencer_variable", "category").agg(*[F.avg(t).alias(t) for t in targets])
    return (
        means.unpivot(["influencer_variable", "category"], list(targets), "target", "average")
        .withColumnRenamed("influencer_variable", "category_variable")
        .orderBy("target", "category_variable", "category")
    )


def _by_category(df: DataFrame, categories: Sequence[str], targets: Sequence[str]) -> DataFrame:
    """One row per row and category column; rows whose category is null fall out."""
    texts = [as_text(df, c).alias(f"_as_text_{c}") for c in categories]
    names = F.create_map(*[F.lit(x) for c in categories for x in (f"_as_text_{c}", c)])
    return (
        df.select(*targets, *texts)
        .unpivot(list(targets), [f"_as_text_{c}" for c in categories], "_column", "category")
        .filter(F.col("category").isNotNull())
        .select(*targets, F.element_at(names, F.col("_column")).alias("influencer_variable"), "category")
    )


def _name(target: str, agg: str) -> str:
    return f"{agg}_{target}"


def _compared(grouped: DataFrame, name: str) -> DataFrame:
    """Compare each category with the plain mean of its variable's other categories.

    The totals are one row per variable, so no window over a variable's categories is needed.
    """
    grouped = written_table(grouped, "influence")
    totals = grouped.groupBy("influencer_variable").agg(
        F.sum(name).alias("_total"), F.count(name).alias("_known")
    )
    own = F.coalesce(F.col(name), F.lit(0))
    known = F.col("_known") - F.col(name).isNotNull().cast("int")
    others = f"{name}_of_others"
    gap, size = difference(F.col(name), F.col(others))
    return (
        grouped.join(F.broadcast(totals), "influencer_variable")  # one row per category column
        .withColumn(others, (F.col("_total") - own) / F.nullif(known, F.lit(0)))
        .select(
            labelled(F.col("influencer_variable"), F.col("category")).alias("influencer"),
            "influencer_variable",
            "category",
            name,
            others,
            gap.alias(f"diff_with_{others}"),
            size.alias(f"abs_diff_with_{others}"),
        )
    )


def _grouped(df: DataFrame, categories: Sequence[str], target: str, agg: str) -> DataFrame:
    name = _name(target, agg)
    long = _by_category(nan_as_null(df), categories, [target])
    return long.groupBy("influencer_variable", "category").agg(AGGREGATES[agg](target).alias(name))


def influence_table(
    df: DataFrame, category: str, target: str, agg: str = "mean", name_columns: bool = True
) -> DataFrame:
    """How far each category of one column is from the mean of the other categories.

    Without ``name_columns`` the category keeps its column's name and the label columns are left out.
    """
    table = _compared(_grouped(df, [category], target, agg), _name(target, agg))
    if name_columns:
        return table
    return table.drop("influencer", "influencer_variable").withColumnRenamed("category", category)


def _largest_first(table: DataFrame, column: str) -> DataFrame:
    return table.orderBy(F.col(column).desc(), "influencer_variable", "category")


def key_influencers(df: DataFrame, categories: Sequence[str], target: str, agg: str = "mean") -> DataFrame:
    """:func:`influence_table` of several columns in one pass, largest difference first."""
    name = _name(target, agg)
    return _largest_first(_compared(_grouped(df, categories, target, agg), name), f"diff_with_{name}_of_others")


def stacked_influence(tables: Sequence[DataFrame], target: str, agg: str = "mean") -> DataFrame:
    """Influence tables of single columns put together, largest difference first."""
    return _largest_first(stack_rows(*tables), f"diff_with_{_name(target, agg)}_of_others")


def influencers_with_sign(table: DataFrame, target: str, agg: str = "mean", negative: bool = False) -> DataFrame:
    """The categories below the others, or those above."""
    gap: Column = F.col(f"diff_with_{_name(target, agg)}_of_others")
    return table.filter(gap < 0 if negative else gap > 0)


def influence_by_variable(table: DataFrame, target: str, agg: str = "mean") -> DataFrame:
    """Smallest, mean and largest distance of each variable's categories; a high mean is a strong variable."""
    size = f"abs_diff_with_{_name(target, agg)}_of_others"
    return table.groupBy("influencer_variable").agg(
        *[AGGREGATES[a](size).alias(f"{size} {a}") for a in ("min", "mean", "max")]
    )


def strongest_category(table: DataFrame, target: str, agg: str = "mean") -> DataFrame:
    """The category furthest from the others in each variable; ties go to the first category."""
    size = F.col(f"abs_diff_with_{_name(target, agg)}_of_others")
    others = [F.col(c) for c in table.columns if c != "influencer_variable"]
    best = table.groupBy("influencer_variable").agg(
        F.min_by(F.struct(*others), F.struct(-F.coalesce(size, F.lit(-1.0)), F.col("category"))).alias("_best")
    )
    return best.select("influencer_variable", "_best.*").select(*table.columns)


def grand_mean(means: DataFrame, name: str) -> DataFrame:
    """Add the mean of a column over all rows as a column."""
    return means.withColumn(f"grand_{name}", means.agg(F.avg(name).alias("grand")).select("grand").scalar())
