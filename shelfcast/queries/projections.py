"""Projections, filters and scalar functions."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions.columns import (
    choose_columns, difference, flag_as_number, flag_as_text, for_display, on_promotion, rename, rename_back,
    round_floating,
)
from shelfcast.functions.dates import (
    absolute_day, circular, days_since, is_fifteenth, is_month_end, parse_date, replace_date, sales_date_features,
    weekday_name,
)
from shelfcast.functions.texts import canonical_reason, day_offset, labelled, refine_special_days
from shelfcast.operators.fill import fill_with_flag
from shelfcast.operators.influence import influence_table, influencers_with_sign
from shelfcast.operators.ordering import position_between
from shelfcast.plans.features import (
    CLEAR_NAMES, drop_target, filled_features, first_date, merged_features, presentation,
    promotion_flag, rename_sales_basics, sales_basics,
)
from shelfcast.plans.stages import ColumnDropper, ColumnSelector, VectorFirstValue, VectorToArray
from shelfcast.queries import query
from shelfcast.queries.views import (
    ALL, FILLED, MERGED, OIL, SALES, SPECIAL_DAYS, STORES, TRANSACTIONS, sql, star, table,
)
from shelfcast.sources.ingest import above_high_water, newer_rows, newer_than, row_number_above
from shelfcast.sources.registry import DATASETS

FACT = DATASETS["sales_agg_by_date_store_productfamily"]


def _sales(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "sales")


@query("b01_select_columns", sql(SALES, "SELECT date, family, sales FROM sales"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return ColumnSelector(columns=["date", "family", "sales"]).transform(_sales(spark, folder))


@query("b02_drop_columns", sql(SALES, "SELECT id, date, store_nbr, family FROM sales"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return drop_target(ColumnDropper(columns=["onpromotion"]).transform(_sales(spark, folder)))


@query("b03_rename_by_map", sql(SALES, SPECIAL_DAYS, """
  SELECT date, type AS day_type, locale AS special_day_locale_type, locale_name AS special_day_locale,
    description AS special_day_reason, transferred AS special_day_transferred FROM special_days"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return rename(table(spark, folder, "special_days"), CLEAR_NAMES["special_days"])


@query("b03_rename_round_trip", sql(SALES, "SELECT * FROM sales"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    stored = rename_back(_sales(spark, folder), FACT.to_file_names)
    return rename(stored, FACT.to_file_names)


@query("b04_presentation_order", sql(*ALL, MERGED, FILLED, """
  SELECT store_nbr, store_city, store_state, store_type, store_cluster,
    CAST(date - (SELECT MIN(date) FROM sales) AS INT) AS days_since_start,
    CAST(isodow(date) - 1 AS INT) AS day_of_week, CAST(day(date) AS INT) AS day_of_month,
    CAST(day(date) = 15 AS INT) AS is_15th, CAST(last_day(date) = date AS INT) AS is_last_day_of_month,
    CAST(dayofyear(date) AS INT) AS day_of_year, day_type,
    CASE WHEN special_day_reason LIKE 'Fundacion%' THEN 'Fundacion'
      WHEN special_day_reason LIKE 'Independencia%' THEN 'Independencia'
      WHEN regexp_matches(special_day_reason, '[-+][0-9]+$') THEN regexp_replace(special_day_reason, '[-+][0-9]+$', '')
      WHEN special_day_reason LIKE '%Mundial de futbol Brasil%' THEN 'Mundial de futbol Brasil'
      ELSE special_day_reason END AS special_day_reason,
    COALESCE(TRY_CAST(regexp_extract(special_day_reason, '([-+][0-9]+)$', 1) AS INT), 0) AS special_day_offset,
    special_day_transferred, special_day_locale_type, special_day_locale, oil_price, all_products_transactions,
    product_family, products_of_family_on_promotion, sales
  FROM filled"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    filled = refine_special_days(filled_features(star(spark, folder)))
    origin = F.lit(first_date(_sales(spark, folder))).cast("date")
    return presentation(replace_date(filled, origin))


@query("b05_derived_column", sql(OIL, "SELECT date, dcoilwtico, dcoilwtico * 2 AS double_of_oil_price FROM oil"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "oil").withColumns({"double_of_oil_price": F.col("dcoilwtico") * 2})


@query("b06_text_to_date", sql(SALES, "SELECT id, date FROM sales"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    texts = _sales(spark, folder).select("id", F.date_format("date", "yyyy-MM-dd").alias("date"))
    return texts.withColumn("date", parse_date(F.col("date")))


@query("b07_first_of_vector", sql(OIL, "SELECT date, dcoilwtico, CAST(dcoilwtico AS FLOAT) AS price FROM oil"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    assembler = VectorAssembler(inputCols=["dcoilwtico"], outputCol="price", handleInvalid="keep")
    vectors = assembler.transform(table(spark, folder, "oil"))
    return VectorFirstValue(columns=["price"], kinds=["float"]).transform(vectors)


@query("b08_vector_to_array", sql(SALES, """
  SELECT id, CAST(onpromotion AS DOUBLE) AS first_part, sales AS second_part, CAST(2 AS INT) AS length FROM sales"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    assembler = VectorAssembler(inputCols=["onpromotion", "sales"], outputCol="parts")
    vectors = assembler.transform(_sales(spark, folder)).select("id", "parts")
    arrays = VectorToArray(columns=["parts"]).transform(vectors)
    return arrays.select(
        "id", F.col("parts")[0].alias("first_part"), F.col("parts")[1].alias("second_part"), F.size("parts").alias("length")
    )


@query("b09_flag_forms", sql(SALES, """
  SELECT id, CAST(last_day(date) = date AS INT) AS as_number,
    CASE WHEN last_day(date) = date THEN 'True' ELSE 'False' END AS as_text FROM sales"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    flag = F.last_day("date") == F.col("date")
    return _sales(spark, folder).select("id", flag_as_number(flag).alias("as_number"), flag_as_text(flag).alias("as_text"))


@query("b10_choose_columns", sql(SALES, "SELECT store_nbr, onpromotion, id, date, family, sales FROM sales"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return choose_columns(_sales(spark, folder), ["store_nbr", "onpromotion"], rest="pass")


@query("b11_display_form", sql(SALES, """
  SELECT id, date, store_nbr AS "store nbr", family, ROUND(sales, 1) AS sales, onpromotion FROM sales"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return for_display(_sales(spark, folder), 1)


@query("c01_newer_than_last", sql(TRANSACTIONS, """
  SELECT t.* FROM transactions t, (SELECT date, store_nbr FROM transactions WHERE date < DATE '1999-06-01'
    ORDER BY date DESC, store_nbr DESC LIMIT 1) last
  WHERE t.date > last.date OR (t.date = last.date AND t.store_nbr > last.store_nbr)"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "transactions")
    return newer_rows(rows, rows.filter("date < DATE '1999-06-01'"), ["date", "store_nbr"])


@query("c01_newer_on_every_key", sql(TRANSACTIONS, """
  SELECT * FROM transactions WHERE date > DATE '1999-05-31' AND store_nbr > 4"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "transactions")
    last = {"date": "1999-05-31", "store_nbr": 4}
    return rows.filter(newer_than(last, ["date", "store_nbr"], every_key=True))


@query("c02_row_number_above", sql(SALES, "SELECT id AS row_number, date, sales FROM sales WHERE id > 2500"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = _sales(spark, folder).select(F.col("id").alias("row_number"), "date", "sales")
    return row_number_above(rows, 2500)


@query("c03_high_water_mark", sql(SALES, """
  SELECT * FROM sales WHERE id > COALESCE((SELECT MAX(id) FROM sales WHERE date < DATE '1999-01-01'), -1)"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = _sales(spark, folder)
    return above_high_water(rows, rows.filter("date < DATE '1999-01-01'"), "id")


@query("c03_high_water_of_nothing", sql(SALES, "SELECT id, sales FROM sales"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = _sales(spark, folder).select("id", "sales")
    return above_high_water(rows, rows.filter("id < 0"), "id")


@query("c04_row_number_range", sql(SALES, "SELECT * FROM sales WHERE id >= 1000 AND id < 3000"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return position_between(_sales(spark, folder), "id", 1000, 3000)


@query("c05_null_rows", sql(OIL, "SELECT date, dcoilwtico FROM oil WHERE dcoilwtico IS NULL"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "oil").filter(F.col("dcoilwtico").isNull())


INFLUENCE_BY_FAMILY = """agg AS (
  SELECT family AS category, AVG(onpromotion) AS own FROM sales GROUP BY family),
compared AS (
  SELECT a.category, a.own, (SELECT AVG(b.own) FROM agg b WHERE b.category <> a.category) AS others FROM agg a)"""


@query("c06_positive_influence", sql(SALES, INFLUENCE_BY_FAMILY, """
  SELECT category, ROUND(own - others, 6) AS diff FROM compared WHERE own - others > 0"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    influence = influence_table(_sales(spark, folder), "family", "onpromotion")
    above = influencers_with_sign(influence, "onpromotion")
    return above.select("category", F.round("diff_with_mean_onpromotion_of_others", 6).alias("diff"))


@query("c06_negative_influence", sql(SALES, INFLUENCE_BY_FAMILY, """
  SELECT category, ROUND(own - others, 6) AS diff FROM compared WHERE own - others < 0"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    influence = influence_table(_sales(spark, folder), "family", "onpromotion")
    below = influencers_with_sign(influence, "onpromotion", negative=True)
    return below.select("category", F.round("diff_with_mean_onpromotion_of_others", 6).alias("diff"))


def _dated(name: str, column: str, expression: str, make) -> None:
    """A query that adds one date feature to the sales."""

    @query(name, sql(SALES, f"SELECT id, {expression} AS {column} FROM sales"))
    def _(spark: SparkSession, folder: str) -> DataFrame:
        return _sales(spark, folder).select("id", make(F.col("date")).alias(column))


_dated("i02_day_of_year", "day_of_year", "CAST(dayofyear(date) AS INT)", F.dayofyear)
_dated("i03_day_of_month", "day_of_month", "CAST(day(date) AS INT)", F.dayofmonth)
_dated("i04_day_of_week", "day_of_week", "CAST(isodow(date) - 1 AS INT)", F.weekday)
_dated("i05_is_fifteenth", "is_15th", "CAST(day(date) = 15 AS INT)", is_fifteenth)
_dated("i06_is_month_end", "is_last_day_of_month", "CAST(last_day(date) = date AS INT)", is_month_end)
_dated("i07_weekday_name", "weekday", "dayname(date)", weekday_name)
_dated("i09_absolute_day", "absolute_day_number", "CAST(date - DATE '1970-01-01' AS INT)", absolute_day)


@query("i01_days_since_start", sql(SALES, """
  SELECT id, CAST(date - (SELECT MIN(date) FROM sales) AS INT) AS days_since_start FROM sales"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = _sales(spark, folder)
    origin = rows.agg(F.min("date").alias("origin")).select("origin").scalar()
    return rows.select("id", days_since(F.col("date"), origin).alias("days_since_start"))


@query("i08_replace_date", sql(SALES, """
  SELECT id, store_nbr, family, sales, onpromotion,
    CAST(date - (SELECT MIN(date) FROM sales) AS INT) AS days_since_start, CAST(dayofyear(date) AS INT) AS day_of_year,
    CAST(day(date) AS INT) AS day_of_month, CAST(isodow(date) - 1 AS INT) AS day_of_week,
    CAST(day(date) = 15 AS INT) AS is_15th, CAST(last_day(date) = date AS INT) AS is_last_day_of_month FROM sales"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = _sales(spark, folder)
    return replace_date(rows, F.lit(first_date(rows)).cast("date"))


@query("i08_sales_date_features", sql(SALES, """
  SELECT id, date AS date_of_sales, CAST(dayofyear(date) AS INT) AS day_of_year_of_sales,
    CAST(day(date) AS INT) AS day_of_month_of_sales,
    CAST(last_day(date) = date AS INT) AS is_day_of_sales_last_day_of_month_number,
    CASE WHEN last_day(date) = date THEN 'True' ELSE 'False' END AS is_day_of_sales_last_day_of_month,
    CAST(isodow(date) - 1 AS INT) AS day_of_week_of_sales_as_number, dayname(date) AS day_of_week_of_sales FROM sales"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return sales_date_features(_sales(spark, folder).select("id", F.col("date").alias("date_of_sales")))


@query("i10_day_offset", sql(SPECIAL_DAYS, r"""
  SELECT date, description, COALESCE(TRY_CAST(regexp_extract(description, '([-+][0-9]+)$', 1) AS INT), 0) AS day_offset
  FROM special_days"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "special_days").select(
        "date", "description", day_offset(F.col("description")).alias("day_offset")
    )


@query("i11_canonical_reason", sql(SPECIAL_DAYS, r"""
  SELECT date, description,
    CASE WHEN starts_with(description, 'Fundacion') THEN 'Fundacion'
      WHEN starts_with(description, 'Independencia') THEN 'Independencia'
      WHEN starts_with(description, 'Provincializacion') THEN 'Provincializacion'
      WHEN starts_with(description, 'Cantonizacion') THEN 'Cantonizacion'
      WHEN starts_with(description, 'Translado') THEN 'Translado'
      WHEN regexp_extract(description, '([-+][0-9]+)$', 1) <> ''
        THEN replace(description, regexp_extract(description, '([-+][0-9]+)$', 1), '')
      WHEN contains(description, 'Mundial de futbol Brasil') THEN 'Mundial de futbol Brasil'
      ELSE description END AS reason
  FROM special_days"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "special_days").select(
        "date", "description", canonical_reason(F.col("description")).alias("reason")
    )


@query("i12_fill_with_flag", sql(SALES, STORES, TRANSACTIONS, """
  SELECT s.id, COALESCE(t.transactions, 0) AS transactions, t.transactions IS NULL AS filled
  FROM sales s LEFT JOIN transactions t ON s.date = t.date AND s.store_nbr = t.store_nbr"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    merged = merged_features(
        star(spark, folder), merge_oil=False, merge_stores=False, merge_special_days=False
    ).select("id", F.col("all_products_transactions").alias("transactions"))
    return fill_with_flag(merged, "transactions", "filled")


@query("i13_round_floating", sql(SALES, "SELECT id, ROUND(sales / 7, 3) AS share, onpromotion FROM sales"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return round_floating(_sales(spark, folder).select("id", (F.col("sales") / 7).alias("share"), "onpromotion"), 3)


@query("i14_difference", sql(OIL, """
  SELECT date, dcoilwtico - 300000 AS gap, ABS(dcoilwtico - 300000) AS size FROM oil"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    gap, size = difference(F.col("dcoilwtico"), F.lit(300000))
    return table(spark, folder, "oil").select("date", gap.alias("gap"), size.alias("size"))


@query("i15_label", sql(STORES, "SELECT store_nbr, 'cluster = ' || cluster AS label FROM stores"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "stores").select("store_nbr", labelled(F.lit("cluster"), F.col("cluster")).alias("label"))


@query("i16_on_promotion", sql(SALES, """
  SELECT id, onpromotion > 0 AS promoted, CASE WHEN onpromotion > 0 THEN 'True' ELSE 'False' END AS as_text FROM sales"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    flagged = promotion_flag(rename_sales_basics(_sales(spark, folder)))
    return flagged.select(
        "id", on_promotion(F.col("products_of_family_are_on_promotion_as_number")).alias("promoted"),
        F.col("products_of_family_are_on_promotion").alias("as_text"),
    )


@query("i17_circular_day", sql(SALES, """
  SELECT id, ROUND(SIN((isodow(date) - 1) * 2 * PI() / 7), 9) AS week_sin,
    ROUND(COS((isodow(date) - 1) * 2 * PI() / 7), 9) AS week_cos,
    ROUND(SIN(day(date) * 2 * PI() / 31), 9) AS month_sin, ROUND(COS(day(date) * 2 * PI() / 31), 9) AS month_cos
  FROM sales"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    week, month = circular(F.weekday("date"), 7), circular(F.dayofmonth("date"), 31)
    parts = dict(zip(("week_sin", "week_cos", "month_sin", "month_cos"), (*week, *month)))
    return _sales(spark, folder).select("id", *[F.round(c, 9).alias(n) for n, c in parts.items()])


@query("j12_sales_basics", sql(SALES, """
  SELECT id, date AS date_of_sales, store_nbr AS store_id, family AS product_family, sales AS total_sales_of_day,
    onpromotion AS products_of_family_are_on_promotion_as_number, CAST(dayofyear(date) AS INT) AS day_of_year_of_sales,
    CAST(day(date) AS INT) AS day_of_month_of_sales,
    CAST(last_day(date) = date AS INT) AS is_day_of_sales_last_day_of_month_number,
    CASE WHEN last_day(date) = date THEN 'True' ELSE 'False' END AS is_day_of_sales_last_day_of_month,
    CAST(isodow(date) - 1 AS INT) AS day_of_week_of_sales_as_number, dayname(date) AS day_of_week_of_sales FROM sales"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return sales_basics(_sales(spark, folder))

