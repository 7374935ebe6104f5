"""Joins, set operations and keyed updates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.operators.influence import influence_table, stacked_influence
from shelfcast.operators.joins import attach, drop_existing, referenced_rows, stack_rows, update_columns
from shelfcast.operators.splits import kfold_splits, linked_split
from shelfcast.plans.features import clear_names, filled_features, merge_sources, merged_features
from shelfcast.queries import query
from shelfcast.queries.views import (
    ALL, FILLED, MERGED, OIL, SALES, SPECIAL_DAYS, STORES, TRANSACTIONS, sql, star, table,
)
from shelfcast.sources.registry import DATASETS
from shelfcast.sources.warehouse import Warehouse


@query("d01_oil_by_date", sql(SALES, OIL, "SELECT sales.*, dcoilwtico FROM sales LEFT JOIN oil USING (date)"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return attach(table(spark, folder, "sales"), table(spark, folder, "oil"), ["date"])


@query("d02_store_attributes", sql(SALES, STORES, """
  SELECT sales.*, city, state, type, cluster FROM sales LEFT JOIN stores USING (store_nbr)"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return attach(table(spark, folder, "sales"), table(spark, folder, "stores"), ["store_nbr"])


@query("d03_transactions", sql(SALES, TRANSACTIONS, """
  SELECT sales.*, transactions FROM sales LEFT JOIN transactions USING (date, store_nbr)"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return attach(table(spark, folder, "sales"), table(spark, folder, "transactions"), ["date", "store_nbr"])


@query("d03_transactions_shuffled", sql(SALES, TRANSACTIONS, """
  SELECT sales.*, transactions FROM sales LEFT JOIN transactions USING (date, store_nbr)"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return attach(
        table(spark, folder, "sales"), table(spark, folder, "transactions"), ["date", "store_nbr"],
        broadcast_bytes=0, hot_rows=3,
    )


@query("d04_special_days", sql(SALES, SPECIAL_DAYS, """
  SELECT sales.*, type, locale, locale_name, description, transferred FROM sales LEFT JOIN special_days USING (date)"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return attach(table(spark, folder, "sales"), table(spark, folder, "special_days"), ["date"])


@query("d04_special_days_of_the_place", sql(SALES, STORES, SPECIAL_DAYS, """
  SELECT s.id, s.store_nbr, d.type AS day_type, d.locale AS special_day_locale_type, d.locale_name AS special_day_locale
  FROM sales s LEFT JOIN stores st ON s.store_nbr = st.store_nbr
  LEFT JOIN special_days d ON s.date = d.date AND NOT d.transferred AND (d.locale = 'National'
    OR (d.locale = 'Regional' AND d.locale_name = st.state) OR (d.locale = 'Local' AND d.locale_name = st.city))"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    merged = merged_features(
        star(spark, folder), merge_oil=False, merge_transactions=False, match_locale=True, celebrated_only=True
    )
    return merged.select("id", "store_nbr", "day_type", "special_day_locale_type", "special_day_locale")


@query("d05_all_sources", sql(*ALL, MERGED, "SELECT * FROM merged"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return merged_features(star(spark, folder))


@query("d05_some_sources", sql(SALES, STORES, """
  SELECT s.id, s.date, s.store_nbr, s.family AS product_family, s.sales,
    s.onpromotion AS products_of_family_on_promotion, st.city AS store_city, st.state AS store_state,
    st.type AS store_type, st.cluster AS store_cluster
  FROM sales s LEFT JOIN stores st ON s.store_nbr = st.store_nbr"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    named = clear_names(star(spark, folder))
    return merge_sources(named, merge_oil=False, merge_transactions=False, merge_special_days=False)


@query("d05_all_sources_filled", sql(*ALL, MERGED, FILLED, "SELECT * FROM filled"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return filled_features(star(spark, folder))


@query("d06_rows_not_stored", sql(TRANSACTIONS, "SELECT * FROM transactions WHERE date >= DATE '1999-06-01'"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "transactions")
    return drop_existing(rows, rows.filter("date < DATE '1999-06-01'"), ["date", "store_nbr"])


@query("d07_referenced_rows", sql(TRANSACTIONS, SALES, """
  SELECT * FROM transactions WHERE date IN (SELECT date FROM sales WHERE onpromotion > 1)
    AND store_nbr IN (SELECT store_nbr FROM sales WHERE onpromotion > 1)"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    promoted = table(spark, folder, "sales").filter("onpromotion > 1")
    return referenced_rows(table(spark, folder, "transactions"), promoted, {"date": "date", "store_nbr": "store_nbr"})


@query("d07_referenced_combinations", sql(TRANSACTIONS, SALES, """
  SELECT * FROM transactions WHERE EXISTS (SELECT 1 FROM sales
    WHERE sales.date = transactions.date AND sales.store_nbr = transactions.store_nbr AND onpromotion > 1)"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    promoted = table(spark, folder, "sales").filter("onpromotion > 1")
    return referenced_rows(
        table(spark, folder, "transactions"), promoted, {"date": "date", "store_nbr": "store_nbr"}, tuple_match=True
    )


@query("d08_linked_dimension", sql(SALES, OIL, """parted AS (
  SELECT date, id // ((SELECT COUNT(*) FROM sales) // 5) AS part FROM sales)""", """
  SELECT oil.*, side FROM oil JOIN (
    SELECT DISTINCT date, 'test' AS side FROM parted WHERE part = 2
    UNION ALL SELECT DISTINCT date, 'train' FROM parted WHERE part <> 2 AND part < 5) USING (date)"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    split = kfold_splits(table(spark, folder, "sales"), "id", 5, "sales")[2]
    linked = linked_split(table(spark, folder, "oil"), "oil", split, {"date": "date"})
    return stack_rows(
        linked.test.withColumn("side", F.lit("test")), linked.train.withColumn("side", F.lit("train"))
    )


@query("d09_update_by_key", sql(SALES, OIL, """
  SELECT date, CASE WHEN day(date) > 10 THEN NULL WHEN day(date) > 5 THEN 1.5 ELSE dcoilwtico END AS dcoilwtico
  FROM oil"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    prices = table(spark, folder, "oil")
    values = prices.filter("day(date) > 5").select(
        "date", F.when(F.dayofmonth("date") <= 10, F.lit(1.5)).alias("dcoilwtico")
    )
    strangers = values.select(F.date_add("date", 100_000).alias("date"), "dcoilwtico")
    return update_columns(prices, values.unionByName(strangers), ["date"], ["dcoilwtico"])


@query("d09_update_stored_table", sql(TRANSACTIONS, """
  SELECT date, store_nbr AS store_id, CASE WHEN transactions > 1 THEN transactions * 10 ELSE transactions END
    AS transactions_count FROM transactions"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    trade = DATASETS["transactions_agg_by_date_store"]
    warehouse = Warehouse(spark)
    warehouse.create(trade)
    warehouse.append(trade.to_table(table(spark, folder, "transactions")), trade.name)
    values = warehouse.current(trade.name).filter("transactions_count > 1").withColumn(
        "transactions_count", F.col("transactions_count") * 10
    )
    warehouse.update_columns(trade.name, values, trade.keys, ["transactions_count"])
    return warehouse.current(trade.name)


@query("d09_update_beside", sql(SALES, """
  SELECT id, date, store_nbr, CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN -sales ELSE sales END AS sales,
    CASE WHEN id % 5 = 0 THEN onpromotion + 1 ELSE onpromotion END AS onpromotion,
    CASE WHEN id % 3 < 2 THEN id * 2 END AS twice FROM sales"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = Warehouse(spark)
    facts = table(spark, folder, "sales").select("id", "date", "store_nbr", "sales", "onpromotion")
    warehouse.save(facts, "facts", buckets=8, bucket_by=["id"])
    values = facts.filter("id % 3 < 2").select(
        "id", F.when(F.col("id") % 3 == 1, -F.col("sales")).alias("sales"), (F.col("id") * 2).alias("twice")
    )
    warehouse.update_beside("facts", values, ["id"], ["sales", "twice"], 8)
    more = facts.filter("id % 5 = 0").select("id", (F.col("onpromotion") + 1).alias("onpromotion"))
    warehouse.update_beside("facts", more, ["id"], ["onpromotion"], 8)
    return warehouse.current("facts")


@query("h01_union_of_many", sql(SALES, """
  SELECT id, sales FROM sales WHERE onpromotion = 0 UNION ALL SELECT id, sales FROM sales WHERE onpromotion >= 0
  UNION ALL SELECT id, sales FROM sales WHERE store_nbr = 1"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "sales")
    chosen = [rows.filter(c) for c in ("onpromotion = 0", "onpromotion >= 0", "store_nbr = 1")]
    return stack_rows(*[c.select("id", "sales") for c in chosen])


INFLUENCE = """cells AS (
  SELECT 'family' AS influencer_variable, family AS category, onpromotion FROM sales
  UNION ALL SELECT 'store_nbr', CAST(store_nbr AS VARCHAR), onpromotion FROM sales),
agg AS (SELECT influencer_variable, category, AVG(onpromotion) AS own FROM cells GROUP BY 1, 2),
compared AS (SELECT *, (SELECT AVG(b.own) FROM agg b
  WHERE b.influencer_variable = a.influencer_variable AND b.category <> a.category) AS others FROM agg a)"""


@query("h02_stacked_influence", sql(SALES, INFLUENCE, """
  SELECT influencer_variable || ' = ' || category AS influencer, ROUND(own - others, 6) AS diff FROM compared"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "sales")
    tables = [influence_table(rows, c, "onpromotion") for c in ("family", "store_nbr")]
    stacked = stacked_influence(tables, "onpromotion")
    return stacked.select("influencer", F.round("diff_with_mean_onpromotion_of_others", 6).alias("diff"))


@query("h03_side_by_side", sql(SALES, """
  SELECT id, sales, CAST(family = 'ECONOMY' AS INT) AS is_economy, CAST(family = 'SMALL' AS INT) AS is_small FROM sales"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    indicators = {f"is_{n.lower()}": (F.col("family") == n).cast("int") for n in ("ECONOMY", "SMALL")}
    return table(spark, folder, "sales").select("id", "sales", "family").withColumns(indicators).drop("family")
