"""Incremental loading, feature groups on stored tables, file streams."""

from __future__ import annotations

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions.dates import date_parts
from shelfcast.operators.joins import stack_rows
from shelfcast.operators.ordering import dense_position
from shelfcast.operators.splits import ordered_folds
from shelfcast.plans.folds import store_folds, stored_split
from shelfcast.plans.groups import CountedIndex, FeatureGroup, engineer_all, get_features, oil_price_group, store_group
from shelfcast.queries import query
from shelfcast.queries.views import ALL, OIL, SALES, STORES, TRANSACTIONS, sql, star, table
from shelfcast.shared import fresh_path
from shelfcast.sources.ingest import load_all, load_new_rows, new_rows
from shelfcast.sources.registry import DATASETS, LOAD_ORDER
from shelfcast.sources.warehouse import Warehouse
from shelfcast.streaming.load import arriving_rows, land_stream, load_stream

FACT = DATASETS["sales_agg_by_date_store_productfamily"]
TRADE = DATASETS["transactions_agg_by_date_store"]
OIL_PRICES = DATASETS["oil_price_by_date"]
STORED_FACT = "id, date, store_nbr AS store_id, family AS product_family, sales AS sales_total, " \
    "onpromotion AS products_of_family_on_promotion_count"
CUT = "1999-06-01"
EARLY = f"date < DATE '{CUT}'"


def _file(df: DataFrame, order: list[str], path: str | None = None, mode: str = "errorifexists") -> str:
    path = path or fresh_path(df.sparkSession, "arrived")
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.write.mode(mode).option("header", True).csv(path)
    return path


def _folder_of_files(spark: SparkSession, folder: str) -> str:
    """All five files as they would arrive, rows in any order."""
    root = fresh_path(spark, "dataset")
    tables = star(spark, folder)
    named = {
        "stores": "stores", "oil_price_by_date": "oil", FACT.name: "sales", "events_by_date": "special_days",
        TRADE.name: "transactions",
    }
    for dataset, name in named.items():
        tables[name].write.option("header", True).csv(f"{root}/{DATASETS[dataset].file}")
    return root


@query("l01_registry_tables", sql(*ALL, """
  SELECT 'stores' AS dataset, COUNT(*) AS rows, 'id' AS keys FROM stores
  UNION ALL SELECT 'oil_price_by_date', COUNT(*), 'date' FROM oil
  UNION ALL SELECT 'sales_agg_by_date_store_productfamily', COUNT(*), 'id' FROM sales
  UNION ALL SELECT 'events_by_date', COUNT(*), 'date,type,locale,locale_name,description,was_transferred' FROM special_days
  UNION ALL SELECT 'transactions_agg_by_date_store', COUNT(*), 'date,store_id' FROM transactions"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = Warehouse(spark)
    load_all(warehouse, _folder_of_files(spark, folder))
    return stack_rows(*[
        warehouse.current(name).agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("dataset"), "rows", F.lit(",".join(DATASETS[name].keys)).alias("keys")
        )
        for name in LOAD_ORDER
    ])


def _half_loaded(spark: SparkSession, folder: str) -> tuple[Warehouse, str]:
    """A warehouse holding the early sales, and the file with all of them."""
    sales = table(spark, folder, "sales")
    warehouse = Warehouse(spark)
    load_new_rows(warehouse, FACT, _file(sales.filter(EARLY), ["id"]))
    return warehouse, _file(sales, ["id"])


@query("l02_new_rows_by_key", sql(SALES, f"SELECT {STORED_FACT} FROM sales WHERE NOT {EARLY}"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    warehouse, path = _half_loaded(spark, folder)
    return new_rows(warehouse, FACT, path)


@query("l02_new_rows_by_position", sql(SALES, f"SELECT {STORED_FACT} FROM sales WHERE NOT {EARLY}"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    warehouse, path = _half_loaded(spark, folder)
    return new_rows(warehouse, FACT, path, by="position")


@query("l03_load_new_rows", sql(SALES, f"SELECT {STORED_FACT} FROM sales"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    warehouse, path = _half_loaded(spark, folder)
    load_new_rows(warehouse, FACT, path)
    load_new_rows(warehouse, FACT, path)  # nothing is left to add
    return warehouse.current(FACT.name)


@query("l03_load_newer_rows", sql(TRANSACTIONS, """
  SELECT date, store_nbr AS store_id, transactions AS transactions_count FROM transactions"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "transactions")
    warehouse = Warehouse(spark)
    load_new_rows(warehouse, TRADE, _file(rows.filter(EARLY), ["date", "store_nbr"]), by="newer")
    path = _file(rows, ["date", "store_nbr"])
    for _ in range(2):
        load_new_rows(warehouse, TRADE, path, by="newer")
    return warehouse.current(TRADE.name)


@query("l04_load_all", sql(*ALL, """
  SELECT s.id, st.city, o.dcoilwtico AS oil_price, t.transactions AS transactions_count
  FROM sales s JOIN stores st ON st.store_nbr = s.store_nbr LEFT JOIN oil o ON o.date = s.date
  LEFT JOIN transactions t ON t.date = s.date AND t.store_nbr = s.store_nbr"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = Warehouse(spark)
    files = _folder_of_files(spark, folder)
    load_all(warehouse, files)
    load_all(warehouse, files)
    facts, stores = warehouse.current(FACT.name), warehouse.current("stores").withColumnRenamed("id", "store_id")
    joined = facts.join(stores, "store_id").join(warehouse.current(OIL_PRICES.name), "date", "left")
    joined = joined.join(warehouse.current(TRADE.name), ["date", "store_id"], "left")
    return joined.select("id", "city", "oil_price", "transactions_count")


SCALED_OIL = """CAST((dcoilwtico - (SELECT MIN(dcoilwtico) FROM oil))
    / ((SELECT MAX(dcoilwtico) FROM oil) - (SELECT MIN(dcoilwtico) FROM oil)) AS FLOAT) AS oil_price_scaled_0_to_1"""


def _with_oil(spark: SparkSession, folder: str, early: bool = False) -> Warehouse:
    warehouse = Warehouse(spark)
    warehouse.create(OIL_PRICES)
    rows = OIL_PRICES.to_table(table(spark, folder, "oil"))
    warehouse.append(rows.filter(EARLY) if early else rows, OIL_PRICES.name)
    return warehouse


@query("l05_make_features", sql(OIL, f"SELECT date, dcoilwtico AS oil_price, {SCALED_OIL} FROM oil"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = _with_oil(spark, folder)
    return oil_price_group().make(warehouse.current(OIL_PRICES.name))


@query("l06_engineered_and_stored", sql(OIL, f"SELECT date, dcoilwtico AS oil_price, {SCALED_OIL} FROM oil"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = _with_oil(spark, folder)
    warehouse.save(DATASETS["stores"].to_table(table(spark, folder, "stores")), "stores")
    engineer_all(warehouse, [oil_price_group(), store_group()])
    return warehouse.current(OIL_PRICES.name)


@query("l06_engineered_and_split", sql(OIL, f"""engineered AS (SELECT date, dcoilwtico AS oil_price, {SCALED_OIL} FROM oil),
placed AS (SELECT *, row_number() OVER (ORDER BY date) - 1 AS p, COUNT(*) OVER () AS n FROM engineered),
folded AS (
  SELECT *, CASE WHEN p < (n % 4) * (n // 4 + 1) THEN p // (n // 4 + 1)
    ELSE n % 4 + (p - (n % 4) * (n // 4 + 1)) // (n // 4) END AS fold FROM placed)""", """
  SELECT date, oil_price, oil_price_scaled_0_to_1, CAST(f AS INT) AS in_fold, CASE WHEN fold = f THEN 'test' ELSE 'train' END AS side
  FROM folded, range(4) r(f)"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = _with_oil(spark, folder)
    engineer_all(warehouse, [oil_price_group()])
    placed = dense_position(warehouse.current(OIL_PRICES.name), ["date"], "place")
    store_folds(warehouse, ordered_folds(placed, "place", 4).drop("place"), OIL_PRICES.name, 4)
    splits = [stored_split(warehouse, OIL_PRICES.name, fold) for fold in range(4)]
    return stack_rows(*[
        getattr(split, side).withColumns({"in_fold": F.lit(split.fold), "side": F.lit(side)})
        for split in splits for side in ("train", "test")
    ])


@query("l06_engineered_stores", sql(STORES, """
  SELECT store_nbr AS id, city, state, type, cluster,
    CAST((SELECT COUNT(*) FROM (SELECT type AS t, COUNT(*) AS n FROM stores GROUP BY type) o
      WHERE (o.n, s.type) > ((SELECT COUNT(*) FROM stores x WHERE x.type = s.type), o.t)) AS INT) AS type_numeric
  FROM stores s"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = Warehouse(spark)
    warehouse.save(DATASETS["stores"].to_table(table(spark, folder, "stores")), "stores")
    engineer_all(warehouse, [store_group()])
    return warehouse.current("stores").select("id", "city", "state", "type", "cluster", "type_numeric")


@query("l07_file_stream", sql(TRANSACTIONS, """
  SELECT date, store_nbr AS store_id, transactions AS transactions_count FROM transactions"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    arrivals, target, progress = (fresh_path(spark, x) for x in ("arrivals", "landed", "progress"))
    rows = table(spark, folder, "transactions")
    for part in (rows.filter(EARLY), rows.filter(f"NOT {EARLY}")):
        _file(part, ["date", "store_nbr"], arrivals, "append")
        land_stream(arriving_rows(spark, TRADE, arrivals), target, progress).awaitTermination()
    return spark.read.schema(TRADE.schema).parquet(target)


@query("l07_file_stream_into_table", sql(TRANSACTIONS, """
  SELECT date, store_nbr AS store_id, transactions AS transactions_count FROM transactions"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    arrivals, progress = fresh_path(spark, "arrivals"), fresh_path(spark, "progress")
    warehouse = Warehouse(spark)
    rows = table(spark, folder, "transactions")
    for part in (rows.filter(EARLY), rows):  # the second delivery repeats the first
        _file(part, ["date", "store_nbr"], arrivals, "append")
        load_stream(arriving_rows(spark, TRADE, arrivals), warehouse, TRADE, progress).awaitTermination()
    return warehouse.current(TRADE.name)


@query("l08_refit_when_rows_arrive", sql(OIL, f"SELECT date, dcoilwtico AS oil_price, {SCALED_OIL} FROM oil"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = _with_oil(spark, folder, early=True)
    group = oil_price_group()
    group.engineer_and_store(warehouse)
    added = OIL_PRICES.to_table(table(spark, folder, "oil").filter(f"NOT {EARLY}"))
    warehouse.append(added, OIL_PRICES.name)
    group.refresh(warehouse, added)
    return warehouse.current(OIL_PRICES.name)


@query("l08_counts_grow_with_batches", sql(SALES, "placed AS (SELECT id, store_nbr, family, date FROM sales)", """stores_n AS (
  SELECT store_nbr AS s, row_number() OVER (ORDER BY COUNT(*) DESC, store_nbr::VARCHAR) - 1 AS i FROM placed GROUP BY 1),
families_n AS (SELECT family AS f, row_number() OVER (ORDER BY COUNT(*) DESC, family) - 1 AS i FROM placed GROUP BY 1)""", """
  SELECT id, store_nbr, family, date, s.i AS store_nbr_numeric, f.i AS family_numeric
  FROM placed JOIN stores_n s ON store_nbr = s.s JOIN families_n f ON family = f.f"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "sales").select("id", "store_nbr", "family", "date")
    warehouse = Warehouse(spark)
    index = CountedIndex("indexed_sales", ("store_nbr", "family"), ("id",))
    index.start(warehouse, rows.filter("date < DATE '1995-01-01'"))
    index.add(warehouse, rows.filter(f"date >= DATE '1995-01-01' AND {EARLY}"))
    index.add(warehouse, rows.filter(f"NOT {EARLY}"))
    return warehouse.current("indexed_sales")


@query("l08_transform_new_rows_only", sql(OIL, """
  SELECT date, dcoilwtico AS oil_price, dcoilwtico * 2 AS double_of_oil_price FROM oil"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = _with_oil(spark, folder, early=True)
    name = OIL_PRICES.name
    doubled = SQLTransformer(statement="SELECT date, oil_price * 2 AS double_of_oil_price FROM __THIS__")
    group = FeatureGroup((doubled,), {"double_of_oil_price": "double"}, ("date",), name, name, needs_all_rows=False)
    group.engineer_and_store(warehouse)
    added = OIL_PRICES.to_table(table(spark, folder, "oil").filter(f"NOT {EARLY}"))
    warehouse.append(added, name)
    group.refresh(warehouse, added)
    return warehouse.current(name)


@query("l09_features_by_name", sql(OIL, f"""
  SELECT date, oil_price_scaled_0_to_1, dayofyear(date)::INT AS day_of_year, (isodow(date) - 1)::INT AS day_of_week
  FROM (SELECT date, {SCALED_OIL} FROM oil)"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = _with_oil(spark, folder)
    oil_price_group().engineer_and_store(warehouse)
    parts = date_parts(F.col("date"))
    makers = {n: (lambda df, n=n: df.withColumn(n, parts[n])) for n in ("day_of_year", "day_of_week")}
    names = ["oil_price_scaled_0_to_1", "day_of_year", "day_of_week"]
    return get_features(warehouse, OIL_PRICES.name, names, makers, keys=["date"])
