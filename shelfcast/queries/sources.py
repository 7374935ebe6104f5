"""Sources, sinks and schema."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.functions.columns import rename_back
from shelfcast.operators.joins import attach
from shelfcast.operators.ordering import first_rows
from shelfcast.plans.features import drop_target, load_star, rows_to_score
from shelfcast.queries import query
from shelfcast.queries.views import OIL, SALES, STORES, TRANSACTIONS, given, sql, star, table
from shelfcast.shared import fresh_path
from shelfcast.sources.delimited import (
    add_position, lines_after, numbered_lines, numbered_lines_after, parse_lines, read_delimited, read_rows_after,
)
from shelfcast.sources.registry import DATASETS, Dataset, borrowed_schema
from shelfcast.sources.warehouse import Warehouse, literal_rows, with_missing_columns

FACT = DATASETS["sales_agg_by_date_store_productfamily"]
TRADE = DATASETS["transactions_agg_by_date_store"]
OIL_PRICES = DATASETS["oil_price_by_date"]
SKIPPED = 1_000

AS_STORED = "id, date, store_nbr AS store_id, family AS product_family, sales AS sales_total, " \
    "onpromotion AS products_of_family_on_promotion_count"


def as_file(df: DataFrame, order: str, label: str = "delimited") -> str:
    """Write as delimited files with headers, rows in order over the files; returns the folder."""
    path = fresh_path(df.sparkSession, label)
    df.repartitionByRange(order).sortWithinPartitions(order).write.option("header", True).csv(path)
    return path


def stored_fact(sales: DataFrame) -> DataFrame:
    """The fact under its table's names."""
    return rename_back(sales, FACT.to_file_names).select(*FACT.columns)


def stored_as(dataset: Dataset, rows: DataFrame) -> DataFrame:
    return dataset.to_table(rows)


@query("a01_delimited_scan", sql(SALES, "SELECT id, date, store_nbr, family, sales, onpromotion FROM sales"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    path = as_file(table(spark, folder, "sales"), "id")
    return read_delimited(spark, path, FACT.file_schema)


@query("a02_filtered_scan", sql(SALES, "SELECT * FROM sales WHERE store_nbr = 7 AND onpromotion > 0"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    path = as_file(table(spark, folder, "sales"), "id")
    return read_delimited(spark, path, FACT.file_schema, "store_nbr = 7 AND onpromotion > 0")


@query("a03_skip_first_lines", sql(SALES, f"SELECT * FROM sales WHERE id >= {SKIPPED}"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    path = as_file(table(spark, folder, "sales"), "id")
    return read_rows_after(spark, path, FACT.file_schema, SKIPPED)


@query("a03_skip_lines_of_text", sql(SALES, f"SELECT CAST(id AS VARCHAR) AS value FROM sales WHERE id >= {SKIPPED}"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "lines")
    ids = table(spark, folder, "sales").select("id").repartitionByRange("id").sortWithinPartitions("id")
    ids.select(F.col("id").cast("string").alias("value")).write.text(path)
    return lines_after(spark, path, SKIPPED)


@query("a04_numbered_lines", sql(SALES, "SELECT id AS line_number, 'row ' || id || ' ' || family AS value FROM sales"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "lines")
    rows = table(spark, folder, "sales").repartitionByRange("id").sortWithinPartitions("id")
    rows.select(F.concat(F.lit("row "), F.col("id").cast("string"), F.lit(" "), "family").alias("value")).write.text(path)
    return numbered_lines(spark, path)


@query(
    "a05_numbered_lines_after",
    sql(SALES, f"SELECT id AS line_number, id, family, onpromotion FROM sales WHERE id >= {SKIPPED}"),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "lines")
    rows = table(spark, folder, "sales").select("id", "family", "onpromotion")
    rows.repartitionByRange("id").sortWithinPartitions("id").write.csv(path)
    numbered = numbered_lines_after(spark, path, SKIPPED)
    schema = T.StructType.fromDDL("line_number bigint, id bigint, family string, onpromotion int")
    return parse_lines(numbered, schema)


@query("a06_positional_index", sql("""
  SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS row_number FROM orders"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    orders = given(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return add_position(orders, ["o_orderdate", "o_orderkey"])


@query("a07_current_table", sql(STORES, "SELECT store_nbr AS id, city, state, type, cluster FROM stores"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = Warehouse(spark)
    warehouse.save(stored_as(DATASETS["stores"], table(spark, folder, "stores")), "stores")
    return warehouse.current("stores")


@query("a07_table_query", sql(STORES, "SELECT state, COUNT(*) AS stores FROM stores WHERE cluster > 3 GROUP BY state"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = Warehouse(spark)
    warehouse.save(stored_as(DATASETS["stores"], table(spark, folder, "stores")), "stores")
    return warehouse.query("SELECT state, COUNT(*) AS stores FROM {stores} WHERE cluster > 3 GROUP BY state")


@query("a08_newest_row", sql(TRANSACTIONS, """
  SELECT date, store_nbr AS store_id, transactions AS transactions_count FROM transactions
  ORDER BY date DESC, store_nbr DESC LIMIT 1"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = Warehouse(spark)
    warehouse.save(stored_as(TRADE, table(spark, folder, "transactions")), TRADE.name)
    return warehouse.last_entry(TRADE.name, TRADE.keys)


@query("a09_borrowed_schema", sql(OIL, "SELECT date, dcoilwtico FROM oil"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    prices = table(spark, folder, "oil")
    warehouse = Warehouse(spark)
    warehouse.create(OIL_PRICES)
    schema = borrowed_schema(warehouse.current(OIL_PRICES.name), OIL_PRICES.to_file_names)
    return read_delimited(spark, as_file(prices, "date"), schema)


@query("a10_append", sql(SALES, f"SELECT {AS_STORED} FROM sales"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    facts = stored_fact(table(spark, folder, "sales"))
    warehouse = Warehouse(spark)
    warehouse.create(FACT)
    warehouse.append(facts.filter("store_id <= 5"), FACT.name)
    warehouse.append(facts.filter("store_id > 5"), FACT.name)
    return warehouse.current(FACT.name)


@query("a11_overwrite", sql(SALES, f"SELECT {AS_STORED} FROM sales WHERE onpromotion > 0"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    facts = stored_fact(table(spark, folder, "sales"))
    warehouse = Warehouse(spark)
    warehouse.save(facts, FACT.name)
    warehouse.save(warehouse.current(FACT.name).filter("products_of_family_on_promotion_count > 0"), FACT.name)
    return warehouse.current(FACT.name)


@query("a12_save_new", sql(OIL, "SELECT date, dcoilwtico AS oil_price FROM oil"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = Warehouse(spark)
    warehouse.save_new(stored_as(OIL_PRICES, table(spark, folder, "oil")), OIL_PRICES.name)
    return warehouse.current(OIL_PRICES.name)


@query("a13_literal_rows", sql(
    STORES, "names(type, title) AS (VALUES ('A', 'flagship'), ('B', 'large'), ('C', 'medium'), ('D', 'small'))",
    "SELECT store_nbr, title FROM stores JOIN names USING (type)",
))
def _(spark: SparkSession, folder: str) -> DataFrame:
    names = literal_rows(
        spark, [("A", "flagship"), ("B", "large"), ("C", "medium"), ("D", "small")], "type string, title string"
    )
    return table(spark, folder, "stores").join(F.broadcast(names), "type").select("store_nbr", "title")  # four rows


@query("a14_star_first_rows", sql(SALES, "SELECT id, date, store_nbr, family, onpromotion FROM sales WHERE id < 5000"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return load_star(star(spark, folder), 5000)["sales"]


@query("a14_star_everything", sql(SALES, "SELECT * FROM sales"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return load_star(star(spark, folder), "all", drop_sales=False)["sales"]


@query("a14_rows_to_score", sql(SALES, """
  SELECT id, date, store_nbr, family, onpromotion, CAST(0 AS DOUBLE) AS sales FROM sales
  WHERE date IN (SELECT DISTINCT date FROM sales ORDER BY date DESC LIMIT 16)"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    sales = table(spark, folder, "sales")
    last = F.broadcast(sales.select("date").distinct().orderBy(F.col("date").desc()).limit(16))
    late = sales.join(last, "date", "left_semi")
    tables = {"test": drop_target(late), "sample_submission": late.select("id", F.lit(0.0).alias("sales"))}
    asked, answer = rows_to_score(tables)
    return attach(asked, answer, ["id"], hot_rows=None).select("id", "date", "store_nbr", "family", "onpromotion", "sales")


@query("a15_month_partition", sql(SALES, """
  SELECT id, date, sales, CAST(year(date) * 100 + month(date) AS INT) AS month
  FROM sales WHERE year(date) = 1998 AND month(date) BETWEEN 3 AND 5"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    facts = table(spark, folder, "sales").select(
        "id", "date", "sales", (F.year("date") * 100 + F.month("date")).cast("int").alias("month")
    )
    warehouse = Warehouse(spark)
    warehouse.save(facts.repartition("month", F.pmod("id", F.lit(8))), "by_month", partition_by=["month"])
    return warehouse.current("by_month").filter("month BETWEEN 199803 AND 199805")


@query("a16_declared_table", sql(TRANSACTIONS, """
  SELECT date, store_nbr AS store_id, transactions AS transactions_count FROM transactions"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = Warehouse(spark)
    for dataset in DATASETS.values():
        warehouse.create(dataset)
        warehouse.create(dataset)  # a second time changes nothing
    warehouse.append(stored_as(TRADE, table(spark, folder, "transactions")), TRADE.name)
    return warehouse.current(TRADE.name)


@query("a17_add_missing_columns", sql(OIL, """
  SELECT date, dcoilwtico AS oil_price, CAST(NULL AS FLOAT) AS oil_price_scaled, CAST(NULL AS INT) AS rank FROM oil"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = Warehouse(spark)
    warehouse.save(stored_as(OIL_PRICES, table(spark, folder, "oil")), OIL_PRICES.name)
    warehouse.add_columns(OIL_PRICES.name, {"oil_price": "double", "oil_price_scaled": "float"})
    return with_missing_columns(warehouse.current(OIL_PRICES.name), {"date": "date", "rank": "int"})


@query("a18_temporary_view", sql(OIL, "SELECT date, dcoilwtico * 2 AS doubled FROM oil WHERE dcoilwtico IS NOT NULL"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = Warehouse(spark)
    warehouse.save(stored_as(OIL_PRICES, table(spark, folder, "oil")), OIL_PRICES.name)
    view = f"oil_prices_{uuid.uuid4().hex}"
    warehouse.as_view(OIL_PRICES.name, view)
    doubled = spark.sql(f"SELECT date, oil_price * 2 AS doubled FROM {view} WHERE oil_price IS NOT NULL")
    spark.catalog.dropTempView(view)  # the query has been resolved
    return doubled


@query("g03_first_rows", sql(SALES, "SELECT * FROM sales ORDER BY sales DESC, id LIMIT 100"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return first_rows(table(spark, folder, "sales"), [F.col("sales").desc(), "id"], 100)
