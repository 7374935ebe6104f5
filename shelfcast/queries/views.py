"""The retail tables every query starts from, derived from the given order and part tables.

A line's supplier plays the store, its part type the product family, its ship
date the sales date.  Each table is computed by Spark once per session, folder and state of
its files and stored, as it would be in a warehouse; queries read it from there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.operators.joins import attach
from shelfcast.operators.ordering import grouped_in_order
from shelfcast.shared import scratch, written_table

_STORED: dict[tuple, DataFrame] = {}
_GIVEN = ("part", "lineitem", "nation", "region", "supplier", "orders")


def given(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _files_state(spark: SparkSession, folder: str) -> tuple:
    """Size and time of the given tables, which change when their files do."""
    state = []
    for name in _GIVEN:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}.parquet")
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        state.append((files.getContentSummary(path).getLength(), files.getFileStatus(path).getModificationTime()))
    return tuple(state)


def _sales(spark: SparkSession, folder: str) -> DataFrame:
    parts = given(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    lines = given(spark, folder, "lineitem").select(
        "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_discount"
    )
    sold = attach(lines, parts, ["l_partkey"], "inner").select(
        F.to_date("l_shipdate").alias("date"),
        F.col("l_suppkey").cast("int").alias("store_nbr"),
        F.col("p_type").alias("family"),
        "l_extendedprice",
        F.when(F.col("l_discount") > 0.05, 1).otherwise(0).alias("promoted"),
    )
    amounts = [F.round(F.sum("l_extendedprice"), 2).alias("sales"), F.sum("promoted").cast("int").alias("onpromotion")]
    return grouped_in_order(sold, ["date", "store_nbr", "family"], amounts, "id").select(
        "id", "date", "store_nbr", "family", "sales", "onpromotion"
    )


def _stores(spark: SparkSession, folder: str) -> DataFrame:
    nations = given(spark, folder, "nation")
    regions = given(spark, folder, "region")
    key = F.col("s_suppkey")
    suppliers = given(spark, folder, "supplier").select("s_suppkey", F.col("s_nationkey").alias("n_nationkey"))
    placed = attach(suppliers, nations, ["n_nationkey"], "inner").withColumnRenamed("n_regionkey", "r_regionkey")
    return attach(placed, regions, ["r_regionkey"], "inner").select(
        key.cast("int").alias("store_nbr"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        F.get(F.array(*[F.lit(x) for x in "ABCDE"]), (key % 5).cast("int")).alias("type"),
        (key % 17 + 1).cast("int").alias("cluster"),
    )


def _transactions(spark: SparkSession, folder: str) -> DataFrame:
    lines = given(spark, folder, "lineitem").select("l_orderkey", "l_suppkey", "l_shipdate")
    return (
        lines.filter((F.col("l_suppkey") + F.dayofmonth("l_shipdate")) % 10 != 0)
        .groupBy(F.to_date("l_shipdate").alias("date"), F.col("l_suppkey").cast("int").alias("store_nbr"))
        .agg(F.count_distinct("l_orderkey").cast("int").alias("transactions"))
    )


def _oil(spark: SparkSession, folder: str) -> DataFrame:
    orders = given(spark, folder, "orders")
    priced = orders.groupBy(F.to_date("o_orderdate").alias("date")).agg(F.max("o_totalprice").alias("price"))
    return priced.filter(~(F.dayofmonth("date") % 7).isin(5, 6)).select(
        "date", F.when(F.dayofmonth("date") != 1, F.col("price")).alias("dcoilwtico")
    )


def _special_days(spark: SparkSession, folder: str) -> DataFrame:
    k, place = F.col("o_orderkey"), F.col("n_name")
    orders = given(spark, folder, "orders").filter(F.dayofmonth("o_orderdate") % 5 == 0)
    # a calendar: every fifth day has one event per kind of place at most, however many orders there are
    events = orders.groupBy(F.to_date("o_orderdate").alias("date"), k % 3).agg(F.min("o_orderkey").alias("o_orderkey"))
    dated = events.select("date", "o_orderkey", (k % 25).cast("int").alias("n_nationkey"))
    named = attach(dated, given(spark, folder, "nation").select("n_nationkey", "n_name"), ["n_nationkey"], "inner")

    def pick(values: list[str], number: Column) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), number.cast("int"))

    reasons = F.array(
        F.concat(F.lit("Fundacion de "), place),
        F.concat(F.lit("Terremoto Manabi+"), (k % 30 + 1).cast("string")),
        F.concat(F.lit("Navidad-"), (k % 4 + 1).cast("string")),
        F.concat(F.lit("Mundial de futbol Brasil: "), place),
        F.concat(F.lit("Independencia de "), place),
        F.concat(F.lit("Traslado "), place),
        F.lit("Black Friday"),
    )
    return named.select(
        "date",
        pick(["Holiday", "Event", "Additional", "Bridge", "Work Day"], k % 5).alias("type"),
        pick(["National", "Regional", "Local"], k % 3).alias("locale"),
        place.alias("locale_name"),
        F.get(reasons, (k % 7).cast("int")).alias("description"),
        (k % 11 == 0).alias("transferred"),
    ).distinct()


_MAKERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "sales": _sales, "stores": _stores, "transactions": _transactions, "oil": _oil, "special_days": _special_days,
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of sales, stores, transactions, oil and special_days."""
    place = (spark.sparkContext.applicationId, folder.rstrip("/"), _files_state(spark, folder), name)
    if place not in _STORED:
        with scratch(spark):  # sales are numbered from a stored copy; filters on a stored number reach the scan
            _STORED[place] = written_table(_MAKERS[name](spark, folder), name, lasting=True)
    return _STORED[place]


def star(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: table(spark, folder, name) for name in _MAKERS}


# The same tables for the SQL side, as common table expressions.
SALES = """base_sales AS (
  SELECT CAST(l_shipdate AS DATE) AS date, CAST(l_suppkey AS INT) AS store_nbr, p_type AS family,
    ROUND(SUM(l_extendedprice), 2) AS sales,
    CAST(SUM(CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END) AS INT) AS onpromotion
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3),
sales AS (
  SELECT CAST(row_number() OVER (ORDER BY date, store_nbr, family) - 1 AS BIGINT) AS id, * FROM base_sales)"""
STORES = """stores AS (
  SELECT CAST(s_suppkey AS INT) AS store_nbr, n_name AS city, r_name AS state,
    CASE s_suppkey % 5 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' WHEN 3 THEN 'D' ELSE 'E' END AS type,
    CAST(s_suppkey % 17 + 1 AS INT) AS cluster
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
TRANSACTIONS = """transactions AS (
  SELECT CAST(l_shipdate AS DATE) AS date, CAST(l_suppkey AS INT) AS store_nbr,
    CAST(COUNT(DISTINCT l_orderkey) AS INT) AS transactions
  FROM lineitem WHERE (l_suppkey + EXTRACT(DAY FROM l_shipdate)) % 10 <> 0 GROUP BY 1, 2)"""
OIL = """oil AS (
  SELECT date, CASE WHEN EXTRACT(DAY FROM date) = 1 THEN NULL ELSE price END AS dcoilwtico
  FROM (SELECT CAST(o_orderdate AS DATE) AS date, MAX(o_totalprice) AS price FROM orders GROUP BY 1) o
  WHERE EXTRACT(DAY FROM date) % 7 NOT IN (5, 6))"""
SPECIAL_DAYS = """special_days AS (
  SELECT DISTINCT date,
    CASE k % 5 WHEN 0 THEN 'Holiday' WHEN 1 THEN 'Event' WHEN 2 THEN 'Additional' WHEN 3 THEN 'Bridge'
      ELSE 'Work Day' END AS type,
    CASE k % 3 WHEN 0 THEN 'National' WHEN 1 THEN 'Regional' ELSE 'Local' END AS locale, n_name AS locale_name,
    CASE k % 7 WHEN 0 THEN 'Fundacion de ' || n_name
      WHEN 1 THEN 'Terremoto Manabi+' || CAST(k % 30 + 1 AS VARCHAR)
      WHEN 2 THEN 'Navidad-' || CAST(k % 4 + 1 AS VARCHAR)
      WHEN 3 THEN 'Mundial de futbol Brasil: ' || n_name
      WHEN 4 THEN 'Independencia de ' || n_name
      WHEN 5 THEN 'Traslado ' || n_name ELSE 'Black Friday' END AS description,
    k % 11 = 0 AS transferred
  FROM (SELECT CAST(o_orderdate AS DATE) AS date, MIN(o_orderkey) AS k, CAST(MIN(o_orderkey) % 25 AS INT) AS nk
        FROM orders WHERE EXTRACT(DAY FROM o_orderdate) % 5 = 0 GROUP BY 1, o_orderkey % 3) e JOIN nation ON n_nationkey = nk)"""
# All joined, with gaps closed row by row over the joined rows.
MERGED = """merged AS (
  SELECT s.id, s.date, s.store_nbr, s.family AS product_family, s.sales, s.onpromotion AS products_of_family_on_promotion,
    o.dcoilwtico AS oil_price, st.city AS store_city, st.state AS store_state, st.type AS store_type,
    st.cluster AS store_cluster, t.transactions AS all_products_transactions, d.type AS day_type,
    d.locale AS special_day_locale_type, d.locale_name AS special_day_locale,
    d.description AS special_day_reason, d.transferred AS special_day_transferred
  FROM sales s LEFT JOIN oil o ON s.date = o.date LEFT JOIN stores st ON s.store_nbr = st.store_nbr
  LEFT JOIN transactions t ON s.date = t.date AND s.store_nbr = t.store_nbr
  LEFT JOIN special_days d ON s.date = d.date)"""
FILLED = """filled AS (
  SELECT * EXCLUDE (oil_price, all_products_transactions),
    COALESCE(
      LAST_VALUE(oil_price IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
      FIRST_VALUE(oil_price IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
    ) AS oil_price,
    COALESCE(all_products_transactions, 0) AS all_products_transactions,
    all_products_transactions IS NULL AS all_transactions_filled
  FROM merged)"""
ALL = (SALES, STORES, TRANSACTIONS, OIL, SPECIAL_DAYS)


def sql(*parts: str) -> str:
    """A query over the listed table expressions; the last part is the query itself."""
    *tables, body = parts
    return f"WITH {', '.join(tables)}\n{body.strip()}" if tables else body.strip()
