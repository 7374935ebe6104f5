"""Aggregations, profiles, influence tables, sorts and limits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions.columns import rename
from shelfcast.functions.dates import sales_date_features
from shelfcast.operators.influence import (
    grand_mean, influence_by_variable, influence_table, key_influencers, mean_by_category, means_by_categories,
    strongest_category,
)
from shelfcast.operators.ordering import last_rows, newest_first, row_slice
from shelfcast.operators.profile import (
    column_range, combination_counts, describe_basics, describe_categoricals, describe_numerical_variable,
    describe_numericals, describe_table, distinct_combinations, summarize,
)
from shelfcast.plans.features import SALES_BASICS_NAMES, merged_features
from shelfcast.plans.models import daily_totals
from shelfcast.queries import query
from shelfcast.queries.views import ALL, MERGED, OIL, SALES, SPECIAL_DAYS, STORES, given, sql, star, table


def _sales(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "sales")


def _dated_sales(spark: SparkSession, folder: str) -> DataFrame:
    """The sales under their exploration names with day features; promotions serve as an exact measure."""
    return sales_date_features(rename(_sales(spark, folder), SALES_BASICS_NAMES))


PROMOTED = "products_of_family_are_on_promotion_as_number"
DATED = """dated AS (
  SELECT id, date, store_nbr, family, onpromotion, dayname(date) AS weekday, isodow(date) - 1 AS weekday_number,
    day(date) AS month_day, CASE WHEN last_day(date) = date THEN 'True' ELSE 'False' END AS month_end FROM sales)"""


def _rounded(df: DataFrame, decimals: int = 6) -> DataFrame:
    kinds = dict(df.dtypes)
    return df.select(*[F.round(F.col(f"`{c}`"), decimals).alias(c) if kinds[c] == "double" else F.col(f"`{c}`") for c in df.columns])


@query("e01_mean_by_category", sql(SALES, DATED, """
  SELECT family AS product_family, ROUND(AVG(onpromotion), 6) AS avg_products_of_family_are_on_promotion_as_number
  FROM dated GROUP BY 1"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(mean_by_category(_dated_sales(spark, folder), "product_family", PROMOTED))


@query("e01_mean_by_ordered_label", sql(SALES, DATED, """
  SELECT weekday AS day_of_week_of_sales, ROUND(AVG(onpromotion), 6) AS avg_products_of_family_are_on_promotion_as_number
  FROM dated GROUP BY 1"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    pair = ("day_of_week_of_sales", "day_of_week_of_sales_as_number")
    return _rounded(mean_by_category(_dated_sales(spark, folder), pair, PROMOTED))


@query("e02_means_by_all_categories", sql(SALES, DATED, """cells AS (
    SELECT 'store_id' AS category_variable, CAST(store_nbr AS VARCHAR) AS category, id, onpromotion FROM dated
    UNION ALL SELECT 'day_of_week_of_sales', weekday, id, onpromotion FROM dated
    UNION ALL SELECT 'day_of_month_of_sales', CAST(month_day AS VARCHAR), id, onpromotion FROM dated
    UNION ALL SELECT 'is_day_of_sales_last_day_of_month', month_end, id, onpromotion FROM dated)""", """
  SELECT category_variable, category, 'id' AS target, ROUND(AVG(id), 4) AS average FROM cells GROUP BY 1, 2
  UNION ALL SELECT category_variable, category, 'products_of_family_are_on_promotion_as_number',
    ROUND(AVG(onpromotion), 4) FROM cells GROUP BY 1, 2"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    categories = [
        "store_id", "day_of_week_of_sales", "day_of_month_of_sales", "is_day_of_sales_last_day_of_month",
    ]
    return _rounded(means_by_categories(_dated_sales(spark, folder), categories, ["id", PROMOTED]), 4)


@query("e03_daily_totals", sql(SALES, "SELECT date, ROUND(SUM(sales), 2) AS sales FROM sales GROUP BY date"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(daily_totals(_sales(spark, folder)), 2)


@query("e04_column_range", sql(OIL, """
  SELECT MIN(dcoilwtico) AS min_dcoilwtico, ROUND(AVG(dcoilwtico), 3) AS mean_dcoilwtico,
    MAX(dcoilwtico) AS max_dcoilwtico FROM oil"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(column_range(table(spark, folder, "oil"), "dcoilwtico"), 3)


def _influence_sql(cells: str, agg: str, name: str) -> str:
    return f"""cells AS ({cells}),
agg AS (SELECT influencer_variable, category, {agg} AS own FROM cells WHERE category IS NOT NULL GROUP BY 1, 2),
compared AS (
  SELECT influencer_variable || ' = ' || category AS influencer, influencer_variable, category, own AS {name},
    (SELECT AVG(b.own) FROM agg b WHERE b.influencer_variable = a.influencer_variable AND b.category <> a.category)
      AS others FROM agg a)"""


FAMILY_CELLS = "SELECT 'family' AS influencer_variable, family AS category, onpromotion AS measure FROM sales"
THREE_CELLS = """SELECT 'weekday' AS influencer_variable, weekday AS category, onpromotion AS measure FROM dated
  UNION ALL SELECT 'month_day', CAST(month_day AS VARCHAR), onpromotion FROM dated
  UNION ALL SELECT 'family', family, onpromotion FROM dated"""
FULL = """SELECT influencer, influencer_variable, category, ROUND({n}, 6) AS {n}, ROUND(others, 6) AS {n}_of_others,
  ROUND({n} - others, 6) AS diff_with_{n}_of_others, ROUND(ABS({n} - others), 6) AS abs_diff_with_{n}_of_others
  FROM compared"""


def _day_columns(spark: SparkSession, folder: str) -> DataFrame:
    return _sales(spark, folder).select(
        "family", "onpromotion", F.date_format("date", "EEEE").alias("weekday"), F.dayofmonth("date").alias("month_day")
    )


@query("e05_influence_of_a_category", sql(
    SALES, _influence_sql(FAMILY_CELLS, "AVG(measure)", "mean_onpromotion"), FULL.format(n="mean_onpromotion")))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(influence_table(_sales(spark, folder), "family", "onpromotion"))


@query("e05_influence_on_totals", sql(
    SALES, _influence_sql(FAMILY_CELLS, "SUM(measure)", "sum_onpromotion"),
    """SELECT category AS family, CAST(sum_onpromotion AS BIGINT) AS sum_onpromotion, ROUND(others, 6) AS sum_onpromotion_of_others,
      ROUND(sum_onpromotion - others, 6) AS diff_with_sum_onpromotion_of_others,
      ROUND(ABS(sum_onpromotion - others), 6) AS abs_diff_with_sum_onpromotion_of_others FROM compared"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(influence_table(_sales(spark, folder), "family", "onpromotion", "sum", name_columns=False))


@query("e06_key_influencers", sql(
    SALES, DATED, _influence_sql(THREE_CELLS, "AVG(measure)", "mean_onpromotion"), FULL.format(n="mean_onpromotion")))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(key_influencers(_day_columns(spark, folder), ["weekday", "month_day", "family"], "onpromotion"))


@query("e07_influence_by_variable", sql(
    SALES, DATED, _influence_sql(THREE_CELLS, "AVG(measure)", "mean_onpromotion"), """
  SELECT influencer_variable,
    ROUND(MIN(ABS(mean_onpromotion - others)), 6) AS "abs_diff_with_mean_onpromotion_of_others min",
    ROUND(AVG(ABS(mean_onpromotion - others)), 6) AS "abs_diff_with_mean_onpromotion_of_others mean",
    ROUND(MAX(ABS(mean_onpromotion - others)), 6) AS "abs_diff_with_mean_onpromotion_of_others max"
  FROM compared GROUP BY 1"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    found = key_influencers(_day_columns(spark, folder), ["weekday", "month_day", "family"], "onpromotion")
    return _rounded(influence_by_variable(found, "onpromotion"))


@query("g06_strongest_category", sql(
    SALES, DATED, _influence_sql(THREE_CELLS, "AVG(measure)", "mean_onpromotion"),
    FULL.format(n="mean_onpromotion") + """
  QUALIFY row_number() OVER (PARTITION BY influencer_variable ORDER BY abs(mean_onpromotion - others) DESC, category) = 1"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    found = key_influencers(_day_columns(spark, folder), ["weekday", "month_day", "family"], "onpromotion")
    return _rounded(strongest_category(found, "onpromotion"))


def _basics_sql(source: str, kinds: dict[str, str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS variable, '{kind}' AS type, COUNT(*) - COUNT({c}) AS nulls, COUNT(DISTINCT {c}) AS \"unique\", "
        f"COUNT(*) AS total_rows FROM {source}"
        for c, kind in kinds.items()
    )


SALES_KINDS = {
    "id": "bigint", "date": "date", "store_nbr": "int", "family": "string", "sales": "double", "onpromotion": "int",
}


@query("e08_describe_basics", sql(SALES, _basics_sql("sales", SALES_KINDS)))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return describe_basics(_sales(spark, folder))


@query("e08_describe_with_examples", sql(SPECIAL_DAYS, """
  ordered AS (SELECT * FROM special_days ORDER BY date, description, locale_name, type LIMIT 2),
  numbered AS (SELECT *, row_number() OVER (ORDER BY date, description, locale_name, type) - 1 AS n FROM ordered)""".strip(),
    " UNION ALL ".join(
        f"""SELECT '{c}' AS variable, (SELECT CAST({c} AS VARCHAR) FROM numbered WHERE n = 0) AS example_0,
        (SELECT CAST({c} AS VARCHAR) FROM numbered WHERE n = 1) AS example_1, '{k}' AS type,
        COUNT(*) - COUNT({c}) AS nulls, COUNT(DISTINCT {c}) AS "unique", COUNT(*) AS total_rows FROM special_days"""
        for c, k in {"date": "date", "type": "string", "locale_name": "string", "transferred": "boolean"}.items()
    )))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return describe_basics(
        table(spark, folder, "special_days"), 2, ["date", "description", "locale_name", "type"],
        ["date", "type", "locale_name", "transferred"],
    )


def _categoricals_sql(source: str, kinds: dict[str, str]) -> str:
    return "\nUNION ALL ".join(
        f"""SELECT '{c}' AS variable, '{kind}' AS type, COUNT(*) - COUNT({c}) AS nulls, COUNT(DISTINCT {c}) AS "unique",
        COUNT(*) AS total_rows,
        (SELECT CAST({c} AS VARCHAR) FROM {source} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY COUNT(*) DESC, CAST({c} AS VARCHAR) LIMIT 1)
          AS most_common,
        (SELECT COUNT(*) FROM {source} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY COUNT(*) DESC LIMIT 1) AS freq_of_most_common
        FROM {source}"""
        for c, kind in kinds.items()
    )


MERGED_TEXTS = {
    "product_family": "string", "store_city": "string", "store_state": "string", "store_type": "string",
    "day_type": "string", "special_day_locale_type": "string", "special_day_locale": "string",
    "special_day_reason": "string", "special_day_transferred": "boolean",
}


@query("e09_describe_categoricals", sql(*ALL, MERGED, _categoricals_sql("merged", MERGED_TEXTS)))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return describe_categoricals(merged_features(star(spark, folder)))


def _numericals_sql(source: str, kinds: dict[str, str], decimals: int, more: str = "", order: str = "id") -> str:
    return "\nUNION ALL ".join(
        f"""SELECT '{c}' AS variable, '{kind}' AS dtype, COUNT(*) - COUNT({c}) AS nulls,
        COUNT(DISTINCT {c}) AS "unique", COUNT(*) AS total_rows, {more.format(c=c, d=decimals, o=order)}
        CAST(MAX({c}) AS DOUBLE) AS max, ROUND(AVG({c}), {decimals}) AS mean, ROUND(STDDEV_SAMP({c}), {decimals}) AS std
        FROM {source}"""
        for c, kind in kinds.items()
    )


QUARTILE_SQL = "".join(
    f'ROUND(quantile_cont(CAST({{c}} AS DOUBLE), {q / 100}), {{d}}) AS "{q}%", ' for q in (25, 50, 75)
)
ENDS_SQL = (
    "CAST(arg_min({c}, {o}) AS DOUBLE) AS first_value, CAST(arg_max({c}, {o}) AS DOUBLE) AS last_value, "
)
NUMBER_KINDS = {"id": "bigint", "store_nbr": "int", "sales": "double", "onpromotion": "int"}
MERGED_NUMBERS = {
    "id": "bigint", "store_nbr": "int", "sales": "double", "products_of_family_on_promotion": "int",
    "oil_price": "double", "store_cluster": "int", "all_products_transactions": "int",
}


@query("e10_describe_numericals", sql(SALES, _numericals_sql("sales", NUMBER_KINDS, 3, ENDS_SQL + QUARTILE_SQL)))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return describe_numericals(
        _sales(spark, folder), decimals=3, include_percentiles=True, include_additional_examples=True, order="id"
    )


@query("e10_describe_one_column", sql(OIL, _numericals_sql("oil", {"dcoilwtico": "double"}, 3, QUARTILE_SQL)))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return describe_numerical_variable(table(spark, folder, "oil"), "dcoilwtico", decimals=3, include_percentiles=True)


@query("e11_describe_table_categorical", sql(*ALL, MERGED, _categoricals_sql("merged", MERGED_TEXTS)))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return describe_table(merged_features(star(spark, folder)))["categorical"]


@query("e11_describe_table_numerical", sql(*ALL, MERGED, _numericals_sql("merged", MERGED_NUMBERS, 3)))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return describe_table(merged_features(star(spark, folder)), decimals=3)["numerical"]


@query("e12_summarize", sql("\nUNION ALL ".join(
    f"""SELECT '{c}' AS variable, COUNT({c}) AS count, ROUND(AVG({c}), 3) AS mean, ROUND(STDDEV_SAMP({c}), 3) AS std,
    ROUND(CAST(MIN({c}) AS DOUBLE), 3) AS min, ROUND(quantile_cont(CAST({c} AS DOUBLE), 0.25), 3) AS "25%",
    ROUND(quantile_cont(CAST({c} AS DOUBLE), 0.5), 3) AS "50%", ROUND(quantile_cont(CAST({c} AS DOUBLE), 0.75), 3) AS "75%",
    ROUND(CAST(MAX({c}) AS DOUBLE), 3) AS max FROM lineitem"""
    for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
)))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(summarize(given(spark, folder, "lineitem")), 3)


@query("e13_distinct_combinations", sql(STORES, "SELECT DISTINCT type, cluster FROM stores"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return distinct_combinations(table(spark, folder, "stores"), ["type", "cluster"])


@query("e14_combination_counts", sql(SALES, "SELECT family, store_nbr, COUNT(*) AS n FROM sales GROUP BY 1, 2"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return combination_counts(_sales(spark, folder), ["family", "store_nbr"])


@query("e15_row_count", sql(SALES, "SELECT COUNT(*) AS rows FROM sales"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _sales(spark, folder).agg(F.count(F.lit(1)).alias("rows"))


@query("e16_first_date", sql(SALES, "SELECT MIN(date) AS first_date FROM sales"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _sales(spark, folder).agg(F.min("date").alias("first_date"))


@query("f10_grand_mean", sql(SALES, DATED, """
  SELECT weekday, ROUND(AVG(onpromotion), 6) AS avg_onpromotion,
    ROUND((SELECT AVG(m) FROM (SELECT AVG(onpromotion) AS m FROM dated GROUP BY weekday)), 6) AS grand_avg_onpromotion
  FROM dated GROUP BY weekday"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    days = _day_columns(spark, folder)
    means = days.groupBy("weekday").agg(F.avg("onpromotion").alias("avg_onpromotion"))
    return _rounded(grand_mean(means, "avg_onpromotion"))


@query("f10_reference_line", sql(SALES, """
  SELECT family, ROUND(AVG(onpromotion), 6) AS avg_onpromotion,
    ROUND((SELECT AVG(m) FROM (SELECT AVG(onpromotion) AS m FROM sales GROUP BY family)), 6) AS grand_avg_onpromotion
  FROM sales GROUP BY family"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(mean_by_category(_sales(spark, folder), "family", "onpromotion", reference_line=True))


@query("g01_newest_first", sql(SALES, "SELECT date, store_nbr, family, sales FROM sales ORDER BY date DESC, store_nbr DESC, family DESC"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _sales(spark, folder).select("date", "store_nbr", "family", "sales").orderBy(
        *newest_first(["date", "store_nbr", "family"])
    )


@query("g02_sorted_by_category", sql(SALES, """
  SELECT family, MAX(sales) AS most FROM sales GROUP BY family ORDER BY most DESC, family"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    most = _sales(spark, folder).groupBy("family").agg(F.max("sales").alias("most"))
    return most.orderBy(F.col("most").desc(), "family")


@query("g04_last_rows_by_date", sql(OIL, "SELECT * FROM (SELECT * FROM oil ORDER BY date DESC LIMIT 5) ORDER BY date"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return last_rows(table(spark, folder, "oil"), ["date"], 5)


@query("g05_row_slice", sql("""
  SELECT * EXCLUDE (p) FROM (SELECT o_orderkey, o_orderdate, o_totalprice,
    row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS p FROM orders) WHERE p >= 500 AND p < 1200"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    orders = given(spark, folder, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return row_slice(orders, ["o_orderdate", "o_orderkey"], 500, 1200)
