"""From the star schema to a model's feature table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.columns import as_text, choose_columns, in_order, on_promotion, rename
from shelfcast.functions.dates import parse_date, replace_date, sales_date_features
from shelfcast.functions.texts import refine_special_days
from shelfcast.operators.fill import fill_by_calendar, fill_with_flag
from shelfcast.operators.joins import attach, stack_rows
from shelfcast.operators.lags import filled_lags, series_ends
from shelfcast.operators.ordering import BUCKET_ROWS, dense_position, first_rows
from shelfcast.operators.splits import in_train
from shelfcast.plans.indexing import category_counts, category_index, dictionary_sizes, numbered, numbers_of, replace_by_number
from shelfcast.plans.stages import MinMaxColumns, indicator_columns, known_categories, scaled
from shelfcast.shared import scratch, written_table

Star = dict[str, DataFrame]  # sales (or rows to score), stores, oil, transactions, special_days

# Column names of the feature table, and which columns are scaled or encoded.
CLEAR_NAMES: dict[str, dict[str, str]] = {
    "sales": {"family": "product_family", "onpromotion": "products_of_family_on_promotion"},
    "oil": {"dcoilwtico": "oil_price"},
    "stores": {"type": "store_type", "cluster": "store_cluster", "city": "store_city", "state": "store_state"},
    "transactions": {"transactions": "all_products_transactions"},
    "special_days": {
        "type": "day_type", "locale": "special_day_locale_type", "locale_name": "special_day_locale",
        "description": "special_day_reason", "transferred": "special_day_transferred",
    },
}
SALES_BASICS_NAMES = {
    "date": "date_of_sales", "family": "product_family", "store_nbr": "store_id", "sales": "total_sales_of_day",
    "onpromotion": "products_of_family_are_on_promotion_as_number",
}
PRESENTATION_ORDER = (
    "store_nbr", "store_city", "store_state", "store_type", "store_cluster",
    "days_since_start", "day_of_week", "day_of_month", "is_15th", "is_last_day_of_month", "day_of_year",
    "day_type", "special_day_reason", "special_day_offset", "special_day_transferred",
    "special_day_locale_type", "special_day_locale",
    "oil_price", "all_products_transactions", "product_family", "products_of_family_on_promotion", "sales",
)
CATEGORIES = (
    "store_nbr", "store_cluster", "product_family", "store_city", "store_state", "store_type", "day_type",
    "special_day_locale_type", "special_day_locale", "special_day_reason", "special_day_transferred",
)
SCALED = ("oil_price", "all_products_transactions")
EVERYTHING = (None, "all", "full")


def load_star(tables: Mapping[str, DataFrame], length: int | str | None = None, drop_sales: bool = True) -> Star:
    """The facts with their side tables; ``length`` keeps the first rows by id."""
    facts = tables["sales"]
    if length not in EVERYTHING:
        facts = first_rows(facts, ["id"], int(length))
    if drop_sales:
        facts = drop_target(facts)
    return {"sales": facts, **{t: tables[t] for t in CLEAR_NAMES if t != "sales"}}


def rows_to_score(tables: Mapping[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """The rows to score and the sample answer beside them."""
    return tables["test"], tables["sample_submission"]


def drop_target(df: DataFrame, target: str = "sales") -> DataFrame:
    return df.drop(target)


def clear_names(star: Star) -> Star:
    """Names that stay clear after the tables are joined."""
    return {table: rename(df, CLEAR_NAMES[table]) for table, df in star.items()}


def merge_sources(
    star: Star,
    merge_oil: bool = True,
    merge_stores: bool = True,
    merge_transactions: bool = True,
    merge_special_days: bool = True,
    match_locale: bool = False,
    celebrated_only: bool = False,
    refine_days: bool = False,
) -> DataFrame:
    """Join the side tables onto the facts; several special days on a date repeat its facts.

    By default a special day belongs to every row of its date.  ``match_locale`` limits regional days
    to stores of the state and local ones to stores of the city; ``celebrated_only`` leaves out
    holidays that were moved to another date.  ``refine_days`` brings the reasons to their canonical
    form before the join, once per special day and not once per fact.
    """
    facts = star["sales"]
    if merge_oil:
        facts = attach(facts, star["oil"], ["date"])
    if merge_stores:
        facts = attach(facts, star["stores"], ["store_nbr"])
    if merge_transactions:
        facts = attach(facts, star["transactions"], ["date", "store_nbr"])
    if merge_special_days:
        days, reaches = star["special_days"], None
        if celebrated_only:
            days = days.filter(~F.coalesce(F.col("special_day_transferred"), F.lit(False)))
        if match_locale:
            kind, place = F.col("special_day_locale_type"), F.col("special_day_locale")
            reaches = (
                (kind == "National")
                | ((kind == "Regional") & (place == F.col("store_state")))
                | ((kind == "Local") & (place == F.col("store_city")))
            )
        if refine_days:
            days = refine_special_days(days)
        facts = attach(facts, days, ["date"], also=reaches)
        if refine_days:
            facts = facts.fillna({"special_day_offset": 0})
    return facts


def merged_features(star: Star, **switches: bool) -> DataFrame:
    """Rename, then join everything that is not switched off."""
    return merge_sources(clear_names(star), **switches)


def fill_oil(df: DataFrame, price: str = "oil_price", date: str = "date") -> DataFrame:
    """Close the gaps of a daily price that is already on the rows: last known value, else the next."""
    # one pass over the rows: the series has all their dates, and a price without a date belongs to no day
    priced = F.when(F.col(date).isNotNull(), F.max(price)).alias(price)
    series = written_table(df.groupBy(date).agg(priced), "daily-prices")
    filled = fill_by_calendar(df.drop(price), series, price, date, every_date=True)
    return filled.select(*df.columns)


def fill_transactions(df: DataFrame) -> DataFrame:
    return fill_with_flag(df, "all_products_transactions", "all_transactions_filled")


def filled_features(star: Star) -> DataFrame:
    """All sources joined with gaps closed: the table the feature steps start from.

    The oil price is filled on its calendar before it meets the facts, which saves the facts a sort.
    """
    named = clear_names(star)
    merged = merge_sources(named, merge_oil=False)
    return fill_transactions(fill_by_calendar(merged, named["oil"], "oil_price"))


def presentation(df: DataFrame) -> DataFrame:
    """Columns in the order people read them."""
    return in_order(df, PRESENTATION_ORDER)


def rename_sales_basics(df: DataFrame) -> DataFrame:
    return rename(df, SALES_BASICS_NAMES)


def parse_sale_dates(df: DataFrame, date: str = "date_of_sales") -> DataFrame:
    return df.withColumn(date, parse_date(F.col(date).cast("string")))


def sales_basics(df: DataFrame) -> DataFrame:
    """The sales table for exploration: clear names, real dates, date features."""
    return sales_date_features(parse_sale_dates(rename_sales_basics(df)))


def promotion_flag(df: DataFrame) -> DataFrame:
    """Whether products of the family are on promotion, as text."""
    flag = on_promotion(F.col("products_of_family_are_on_promotion_as_number"))
    return df.withColumn("products_of_family_are_on_promotion", F.initcap(flag.cast("string")))


def first_date(df: DataFrame, date: str = "date") -> str:
    """The origin of day numbers; fitted on training rows and reused on others."""
    return str(df.agg(F.min(date)).first()[0])


EVENT_ORDER = (
    "id", "day_type", "special_day_locale_type", "special_day_locale", "special_day_reason",
    "special_day_offset", "special_day_transferred",
)


@dataclass
class PreparationFit:
    """What preparation learns from training rows."""

    origin: str
    bounds: dict[str, tuple[float | None, float | None]]
    categories: dict[str, list[str]] | None = None
    #: variable, value, number: a row per category, most frequent first; null where columns are named
    index: DataFrame | None = None
    #: per column the number of categories and the bytes of its dictionary
    sizes: dict[str, tuple[int, int]] = field(default_factory=dict)


@dataclass
class Preparation:
    """Merged rows to model input: gaps, special days, date parts, scaling, categories, lags.

    A category becomes ``<column>_index``, its number in :func:`category_index`, for any count of categories; null
    and unseen ones are null.  With ``named`` it becomes 0/1 columns instead, which limits their number.

    ``fit`` learns the first date, the bounds and the categories; ``transform`` applies them to any
    rows.  Rows are lagged while they are still narrow and encoded afterwards: an indicator of an
    earlier category equals the earlier indicator, and far fewer columns are shuffled.

    A lag is a shift that is then filled from below, as :func:`shelfcast.operators.lags.rolling_window` does it: leading
    rows and gaps take the next known value of the shifted column.  A missing category is a value like any other.
    """

    window_size: int = 3
    categories: Sequence[str] = CATEGORIES
    scaled: Sequence[str] = SCALED
    target: str = "sales"
    constant: float = 0.5
    named: bool = False
    bucket_rows: int = BUCKET_ROWS
    order: Sequence[str] = field(default=EVENT_ORDER)

    def filled(self, merged: DataFrame) -> DataFrame:
        rows = fill_transactions(fill_oil(merged))
        return rows if "special_day_offset" in rows.columns else refine_special_days(rows)

    def fit(self, merged: DataFrame) -> PreparationFit:
        needed = dict.fromkeys(["date", *self.scaled, *self.categories])
        with scratch(merged.sparkSession):  # only the dictionary lasts
            rows = written_table(self.filled(merged).select(*needed), "fitted-rows")
            bounds = MinMaxColumns(columns=list(self.scaled)).fit(rows).getBounds()
            if self.named:
                return PreparationFit(first_date(rows), bounds, known_categories(rows, self.categories))
            index = written_table(category_index(rows, self.categories), "category-index", lasting=True)
            return PreparationFit(first_date(rows), bounds, index=index, sizes=dictionary_sizes(index))

    def fit_folds(self, merged: DataFrame, folds: Sequence[int], fold_column: str = "fold", growing: bool = False) -> dict[int, PreparationFit]:
        """The fit of each fold's training rows, all from one pass over the rows.

        Bounds, first dates and category counts are taken per fold; a training side's are those of its folds together.
        Closing gaps repeats known prices, so it changes no bound, and a missing number of transactions counts as 0.
        """
        rows = merged if "special_day_offset" in merged.columns else refine_special_days(merged)
        rows = written_table(fill_transactions(rows).select(*dict.fromkeys([fold_column, "date", *self.scaled, *self.categories])), "fitted-rows")
        numbers = {c: F.nanvl(F.col(c).cast("double"), F.lit(None)) for c in self.scaled}
        bounds = rows.groupBy(fold_column).agg(
            F.min("date").alias("_origin"), *[f(x).alias(f"_{f.__name__}_{c}") for c, x in numbers.items() for f in (F.min, F.max)]
        ).collect()  # a row per fold
        counts = written_table(category_counts(rows, self.categories, [fold_column]), "category-counts")
        trained = [counts.filter(in_train(fold_column, f, growing)).withColumn("_side", F.lit(f).cast("int")) for f in folds]
        summed = stack_rows(*trained).groupBy("_side", "variable", "value").agg(F.sum("_n").alias("_n"))
        index = numbered(summed, ["_side"])
        weighed = index.groupBy("_side", "variable").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("value") + 48).alias("bytes")).collect()

        def ends(part: list, c: str) -> tuple[float | None, float | None]:
            low, high = ([r[f"_{f}_{c}"] for r in part if r[f"_{f}_{c}"] is not None] for f in ("min", "max"))
            return (min(low), max(high)) if low else (None, None)

        found = {}
        for f in folds:
            part = [r for r in bounds if (r[fold_column] < f if growing else r[fold_column] != f)]
            dates = [r["_origin"] for r in part if r["_origin"] is not None]
            found[f] = PreparationFit(
                str(min(dates)) if dates else "1970-01-01", {c: ends(part, c) for c in self.scaled},
                index=index.filter(F.col("_side") == f).drop("_side"),
                sizes={r["variable"]: (r["n"], r["bytes"]) for r in weighed if r["_side"] == f},
            )
        return found

    def transform(self, merged: DataFrame, fitted: PreparationFit) -> DataFrame:
        rows = replace_date(self.filled(merged), F.lit(fitted.origin).cast("date"))
        values = [c for c in rows.columns if c != "id"]
        steps = range(1, self.window_size)
        rest = [c for c in values if c not in self.scaled and c not in self.categories and c != self.target]
        targets = [c for c in (self.target,) if c in values]
        texts = {c: as_text(rows, c) for c in self.categories}
        if steps:
            rows = dense_position(rows.withColumns(texts), self.order, "_place")
            rows = self._lagged(rows, values, steps, fitted)
            lag_flag = [(F.col("_place") < self.window_size).alias("row_was_lagg_backfilled")]
        else:
            rows, lag_flag = self._indexed(rows.withColumns(texts), fitted), []
        return rows.select(
            "id", *targets, *self._encoded("", rest, fitted), *lag_flag,
            *[x for k in steps for x in self._encoded(f"_lag_{k}", rest + targets, fitted)],
        )

    def _lagged(self, rows: DataFrame, values: Sequence[str], steps: Sequence[int], fitted: PreparationFit) -> DataFrame:
        """``rows`` with the lags of ``values``, categories as numbers."""
        ends = series_ends(rows, values, "_place", gapless=self.categories)
        if not self.named:
            ends.first |= numbers_of(fitted.index, {c: ends.first[c] for c in self.categories})
        return filled_lags(self._indexed(rows, fitted), values, steps, "_place", ends, self.bucket_rows)

    def _indexed(self, rows: DataFrame, fitted: PreparationFit) -> DataFrame:
        """The texts of the categories replaced by their numbers, all in one pass."""
        return rows if self.named else replace_by_number(rows, fitted.index, fitted.sizes, self.categories)

    def _encoded(self, end: str, rest: Sequence[str], fitted: PreparationFit) -> list[Column]:
        numbers = [
            scaled(F.col(f"{c}{end}"), *fitted.bounds[c], self.constant).alias(f"{c}{end}") for c in self.scaled
        ]
        indicators = [F.col(f"{c}{end}").alias(f"{c}_index{end}") for c in self.categories] if not self.named else [
            x for c in self.categories
            for x in indicator_columns(f"{c}{end}", c, fitted.categories[c], False, end)
        ]
        return numbers + indicators + [F.col(f"{c}{end}") for c in rest]


def use_columns(df: DataFrame, columns: Sequence[str], rest: str = "drop") -> DataFrame:
    """Restrict a model's input to some columns; see :func:`choose_columns`."""
    return choose_columns(df, columns, rest)
