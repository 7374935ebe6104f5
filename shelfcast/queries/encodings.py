"""Fitted feature transforms and the feature table."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions.columns import choose_columns
from shelfcast.operators.joins import attach, stack_rows
from shelfcast.plans.features import CATEGORIES, SCALED, Preparation, merged_features, parse_sale_dates, rename_sales_basics
from shelfcast.plans.groups import frequency_index, oil_price_group, store_group
from shelfcast.plans.indexing import IndexColumns
from shelfcast.plans.preparation import PrepareFeatures
from shelfcast.plans.stages import (
    ColumnDropper, ColumnSelector, FunctionStep, MinMaxColumns, OneHotColumns, VectorToArray, mean_imputer, prefix,
)
from shelfcast.queries import query
from shelfcast.queries.views import ALL, FILLED, MERGED, OIL, SALES, SPECIAL_DAYS, STORES, sql, star, table
from shelfcast.shared import fresh_path, written_table
from shelfcast.sources.registry import DATASETS

EARLY = "date < DATE '1999-06-01'"
FAMILIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
DAY_TYPES = ("Additional", "Bridge", "Event", "Holiday", "Work Day")
STORE_TYPES = ("A", "B", "C", "D", "E")


def _scaled_sql(column: str, source: str, condition: str = "TRUE") -> str:
    low, high = (f"(SELECT {f}({column}) FROM {source} WHERE {condition})" for f in ("MIN", "MAX"))
    return f"({column} - {low}) / ({high} - {low})"


@query("j01_assemble_vector", sql(OIL, "SELECT date, dcoilwtico AS price, day(date)::DOUBLE AS day FROM oil"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "oil").withColumn("day", F.dayofmonth("date"))
    assembler = VectorAssembler(inputCols=["dcoilwtico", "day"], outputCol="parts", handleInvalid="keep")
    made = assembler.transform(rows).select("date", vector_to_array("parts").alias("parts"))
    return made.select("date", *[F.nanvl(F.col("parts")[i], F.lit(None)).alias(n) for i, n in enumerate(("price", "day"))])


@query("j02_min_max_fit_and_apply", sql(OIL, f"""
  SELECT date, dcoilwtico, {_scaled_sql('dcoilwtico', 'oil', EARLY)} AS dcoilwtico_normalized FROM oil"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "oil")
    model = MinMaxColumns(columns=["dcoilwtico"], suffix="_normalized").fit(rows.filter(EARLY))
    return model.transform(rows)


@query("j02_min_max_constant", sql(OIL, "SELECT date, CASE WHEN dcoilwtico IS NOT NULL THEN 0.5::DOUBLE END AS same FROM oil"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "oil").select("date", F.when(F.col("dcoilwtico").isNotNull(), 7.0).alias("same"))
    return MinMaxColumns(columns=["same"]).fit(rows).transform(rows)


@query("j03_impute_mean", sql(OIL, """
  SELECT date, ROUND(CASE WHEN p IS NULL OR p = -1 THEN (SELECT AVG(CASE WHEN day(date) <> 2 THEN dcoilwtico END) FROM oil)
    ELSE p END, 3) AS imputed FROM (SELECT date, CASE WHEN day(date) = 2 THEN -1 ELSE dcoilwtico END AS p FROM oil)"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    price = F.when(F.dayofmonth("date") == 2, -1.0).otherwise(F.col("dcoilwtico"))
    rows = table(spark, folder, "oil").select("date", price.alias("price"))
    imputed = mean_imputer(["price"], ["imputed"]).fit(rows).transform(rows)
    return imputed.select("date", F.round("imputed", 3).alias("imputed"))


INDEXED = """ranked AS (
  SELECT {c} AS category, row_number() OVER (ORDER BY COUNT(*) DESC, {c}) - 1 AS i FROM {t} GROUP BY {c})"""


@query("j04_frequency_index", sql(STORES, INDEXED.format(c="city", t="stores"), """
  SELECT store_nbr, city, i::DOUBLE AS city_numeric FROM stores JOIN ranked ON city = category"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "stores").select("store_nbr", "city")
    return StringIndexer(inputCol="city", outputCol="city_numeric").fit(rows).transform(rows)


@query("j04_frequency_index_at_scale", sql(SPECIAL_DAYS, INDEXED.format(c="description", t="special_days"), """
  SELECT date, description, i AS reason_number FROM special_days JOIN ranked ON description = category"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "special_days").select("date", "description")
    return frequency_index(rows, "description", "reason_number")


@query("j05_one_hot_vector", sql(SALES, INDEXED.format(c="family", t="sales"), """
  SELECT id, array_to_string([(x = i)::INT FOR x IN range(0, (SELECT COUNT(*) FROM ranked) - 1)], ',') AS family_ohe
  FROM sales JOIN ranked ON family = category"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "sales").select("id", "family")
    stages = [
        StringIndexer(inputCol="family", outputCol="family_numeric"),
        OneHotEncoder(inputCol="family_numeric", outputCol="family_ohe"),
        VectorToArray(columns=["family_ohe"]),
        ColumnDropper(columns=["family", "family_numeric"]),
    ]
    return _arrays_as_text(Pipeline(stages=stages).fit(rows).transform(rows))


def _arrays_as_text(df: DataFrame) -> DataFrame:
    """Arrays of 0 and 1 as comma-separated text, a form every engine can compare."""
    arrays = [c for c, kind in df.dtypes if kind.startswith("array")]
    return df.withColumns({
        c: F.array_join(F.transform(c, lambda x: x.cast("int").cast("string")), ",") for c in arrays
    })


def _indicators_sql(column: str, values: tuple[str, ...], source: str | None = None, end: str = "") -> str:
    return ", ".join(
        f"COALESCE(({source or column} = '{v}')::INT, 0) AS \"{column}_{v}{end}\"" for v in values
    )


@query("j06_one_hot_in_place", sql(SALES, SPECIAL_DAYS, f"""
  SELECT s.id, {_indicators_sql('day_type', DAY_TYPES, 'd.type')}, (d.type IS NULL)::INT AS day_type_nan, s.sales
  FROM sales s LEFT JOIN special_days d ON s.date = d.date"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    merged = merged_features(star(spark, folder), merge_oil=False, merge_stores=False, merge_transactions=False)
    rows = merged.select("id", "day_type", "sales")
    return OneHotColumns(columns=["day_type"], inPlace=True).fit(rows).transform(rows)


@query("j07_one_hot_fitted", sql(SALES, SPECIAL_DAYS, f"""
  SELECT s.id, {_indicators_sql('family', FAMILIES[:4], 's.family')}, {_indicators_sql('day_type', DAY_TYPES, 'd.type')},
    0 AS day_type_nan FROM sales s LEFT JOIN special_days d ON s.date = d.date"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    merged = merged_features(star(spark, folder), merge_oil=False, merge_stores=False, merge_transactions=False)
    rows = merged.select("id", F.col("product_family").alias("family"), "day_type")
    known = rows.filter("family < 'Q'")  # the other families are unseen when it is applied
    return OneHotColumns(columns=["family", "day_type"]).fit(known).transform(rows)


@query("j08_oil_feature_group", sql(OIL, f"""
  SELECT date, dcoilwtico AS oil_price, CAST({_scaled_sql('dcoilwtico', 'oil')} AS FLOAT) AS oil_price_scaled_0_to_1 FROM oil"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return oil_price_group().make(DATASETS["oil_price_by_date"].to_table(table(spark, folder, "oil")))


def _store_columns_sql() -> str:
    ranked = ", ".join(
        f"{c}_ranked AS (SELECT {c} AS v, row_number() OVER (ORDER BY COUNT(*) DESC, {c}::VARCHAR) - 1 AS i "
        f"FROM stores GROUP BY {c})" for c in ("city", "state", "type", "cluster")
    )
    columns = ", ".join(
        f"{c}_r.i AS {c}_numeric, "
        f"array_to_string([(x = {c}_r.i)::INT FOR x IN range(0, (SELECT COUNT(*) FROM {c}_ranked) - 1)], ',') AS {c}_ohe" for c in ("city", "state", "type", "cluster")
    )
    joins = " ".join(f"JOIN {c}_ranked {c}_r ON s.{c} = {c}_r.v" for c in ("city", "state", "type", "cluster"))
    return sql(STORES, ranked, f"SELECT store_nbr AS id, city, state, type, cluster, {columns} FROM stores s {joins}")


@query("j09_store_feature_group", _store_columns_sql())
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _arrays_as_text(store_group().make(DATASETS["stores"].to_table(table(spark, folder, "stores"))))


PREPARED = r"""prepared AS (
  SELECT id, sales, date, store_nbr, store_type, store_city, store_state, store_cluster, product_family, day_type,
    special_day_locale_type, special_day_locale, special_day_transferred, oil_price, all_products_transactions,
    all_transactions_filled, products_of_family_on_promotion,
    CASE WHEN starts_with(special_day_reason, 'Fundacion') THEN 'Fundacion'
      WHEN starts_with(special_day_reason, 'Independencia') THEN 'Independencia'
      WHEN regexp_extract(special_day_reason, '([-+][0-9]+)$', 1) <> ''
        THEN replace(special_day_reason, regexp_extract(special_day_reason, '([-+][0-9]+)$', 1), '')
      WHEN contains(special_day_reason, 'Mundial de futbol Brasil') THEN 'Mundial de futbol Brasil'
      ELSE special_day_reason END AS special_day_reason,
    COALESCE(TRY_CAST(regexp_extract(special_day_reason, '([-+][0-9]+)$', 1) AS INT), 0) AS special_day_offset
  FROM filled),
placed AS (SELECT *, row_number() OVER (ORDER BY id, day_type NULLS FIRST, special_day_locale_type NULLS FIRST,
    special_day_locale NULLS FIRST, special_day_reason NULLS FIRST, special_day_offset,
    special_day_transferred NULLS FIRST) - 1 AS place FROM prepared),
encoded AS (SELECT id, place, sales, {scaled},
  {indicators}, all_transactions_filled, special_day_offset,
  (date - (SELECT MIN(date) FROM placed))::INT AS days_since_start, products_of_family_on_promotion FROM placed)""".replace(
    "{scaled}", f"{_scaled_sql('oil_price', 'placed')} AS oil_price, "
    f"{_scaled_sql('all_products_transactions', 'placed')} AS all_products_transactions"
).replace(
    "{indicators}", ", ".join([
        _indicators_sql("product_family", FAMILIES), _indicators_sql("store_type", STORE_TYPES),
        _indicators_sql("day_type", DAY_TYPES),
    ])
)
LAGGED = [
    "oil_price", "all_products_transactions", "all_transactions_filled", "special_day_offset", "days_since_start",
    "products_of_family_on_promotion", "sales",
    *[f"product_family_{v}" for v in FAMILIES], *[f"store_type_{v}" for v in STORE_TYPES],
    *[f"day_type_{v}" for v in DAY_TYPES],
]


@query("j10_named_indicators", sql(*ALL, MERGED, FILLED, PREPARED, f"""
  SELECT * EXCLUDE (place), place < 3 AS row_was_lagg_backfilled, {', '.join(
    f'COALESCE(LAG("{c}", {k}) OVER (ORDER BY place), FIRST_VALUE("{c}") OVER (ORDER BY place)) AS "{c}_lag_{k}"'
    for k in (1, 2) for c in LAGGED)} FROM encoded"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    merged = written_table(merged_features(star(spark, folder), refine_days=True), "merged")
    preparation = Preparation(window_size=3, categories=("product_family", "store_type", "day_type"), named=True)
    made = preparation.transform(merged, preparation.fit(merged))
    shown = ["id", "sales", "row_was_lagg_backfilled"]
    shown += [c for c in LAGGED if c != "sales"] + [f"{c}_lag_{k}" for k in (1, 2) for c in LAGGED]
    return choose_columns(made, shown)


#: Columns of the full feature table that are neither scaled nor a category, and their SQL over ``placed``.
DATED = {
    "days_since_start": "(date - {origin})::INT", "day_of_year": "dayofyear(date)::INT", "day_of_month": "day(date)::INT",
    "day_of_week": "(isodow(date) - 1)::INT", "is_15th": "(day(date) = 15)::INT", "is_last_day_of_month": "(date = last_day(date))::INT",
}
TEXT_SQL = {c: f"{c}::VARCHAR" for c in CATEGORIES} | {
    "special_day_transferred": "CASE special_day_transferred WHEN TRUE THEN 'True' WHEN FALSE THEN 'False' END"
}
PLAIN = (*SCALED, "all_transactions_filled", "special_day_offset", *DATED, "products_of_family_on_promotion", "sales")


def prepared_sql(window: int, fitted: str = "TRUE", gaps: bool = False) -> str:
    """The full feature table as table expression ``features``, fitted on the rows of ``placed`` with condition ``fitted``."""
    holes = """gapped AS (SELECT * REPLACE (
      CASE WHEN id % 53 < 2 OR id >= (SELECT MAX(id) FROM placed) - 1 THEN NULL ELSE sales END AS sales,
      CASE WHEN id % 41 = 3 THEN NULL ELSE products_of_family_on_promotion END AS products_of_family_on_promotion) FROM placed)"""
    source = "gapped" if gaps else "placed"
    known = f"known AS (SELECT * FROM {source} WHERE {fitted})"
    numbers = [
        f"{c}_numbers AS (SELECT {t} AS v, row_number() OVER (ORDER BY COUNT(*) DESC, {t}) - 1 AS i FROM known WHERE {c} IS NOT NULL GROUP BY 1)"
        for c, t in TEXT_SQL.items()
    ]
    scales = ", ".join(f"{_scaled_sql(c, 'known')} AS {c}" for c in SCALED)
    dated = ", ".join(f"{x.format(origin='(SELECT MIN(date) FROM known)')} AS {c}" for c, x in DATED.items())
    coded = ", ".join(f"{c}_numbers.i AS {c}_index" for c in CATEGORIES)
    joins = " ".join(f"LEFT JOIN {c}_numbers ON {t} = {c}_numbers.v" for c, t in TEXT_SQL.items())
    rows = f"""coded AS (SELECT place, id, sales, {scales}, {coded}, all_transactions_filled, special_day_offset, {dated},
      products_of_family_on_promotion FROM {source} {joins})"""
    steps = range(1, window)
    shifted = ", ".join(
        [f'LAG("{c}", {k}) OVER (ORDER BY place) AS "{c}_lag_{k}"' for k in steps for c in PLAIN]
        + [f'CASE WHEN place < {k} THEN FIRST_VALUE({c}_index) OVER (ORDER BY place) ELSE LAG({c}_index, {k}) OVER (ORDER BY place) END'
           f' AS {c}_index_lag_{k}' for k in steps for c in CATEGORIES]
    )
    filled = ", ".join(
        f'FIRST_VALUE("{c}_lag_{k}" IGNORE NULLS) OVER (ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS "{c}_lag_{k}"'
        for k in steps for c in PLAIN
    )
    return ",\n".join([
        *([holes] if gaps else []), known, *numbers, rows, f"shifted AS (SELECT *, {shifted} FROM coded)",
        f"features AS (SELECT * REPLACE ({filled}), place < {window} AS row_was_lagg_backfilled FROM shifted)",
    ])


def with_gaps(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The star with gaps in the sales and the promotions, some of them at its two ends."""
    facts = tables["sales"]
    last = facts.agg(F.max("id").alias("last")).select("last").scalar()
    gap = (F.col("id") % 53 < 2) | (F.col("id") >= last - 1)
    holed = {"sales": F.when(~gap, F.col("sales")), "onpromotion": F.when(F.col("id") % 41 != 3, F.col("onpromotion"))}
    return tables | {"sales": facts.withColumns(holed)}


@query("j10_feature_table", sql(*ALL, MERGED, FILLED, PREPARED, prepared_sql(3, gaps=True), "SELECT * EXCLUDE (place) FROM features"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    merged = written_table(merged_features(with_gaps(star(spark, folder)), refine_days=True), "merged", compression="zstd", release=True)
    return PrepareFeatures(windowSize=3).fit(merged).transform(merged)


@query("j10_saved_preparation", sql(*ALL, MERGED, FILLED, PREPARED, prepared_sql(2, EARLY), """
  SELECT * EXCLUDE (place, row_was_lagg_backfilled) FROM features"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    merged = written_table(merged_features(star(spark, folder), refine_days=True), "merged")
    steps = Pipeline(stages=[PrepareFeatures(windowSize=2), ColumnDropper(columns=["row_was_lagg_backfilled"])])
    path = fresh_path(spark, "preparation")
    steps.fit(merged.filter(EARLY)).write().save(path)
    return PipelineModel.load(path).transform(merged)


def _slots_sql(columns: dict[str, str], source: str, known: str) -> str:
    """Sparse vectors as text: a slot per category, one for null, one for a category that the fitted rows lack."""
    numbers = [
        f"{c}_numbers AS (SELECT {t} AS v, row_number() OVER (ORDER BY COUNT(*) DESC, {t}) - 1 AS i FROM {source} WHERE {known} AND {t} IS NOT NULL GROUP BY 1)"
        for c, t in columns.items()
    ]
    size = {c: f"(SELECT COUNT(*) + 2 FROM {c}_numbers)" for c in columns}
    shown = ", ".join(
        f"'(' || {size[c]} || ',[' || COALESCE({c}_numbers.i, {size[c]} - CASE WHEN {t} IS NULL THEN 2 ELSE 1 END) || '],[1.0])' AS {c}_vector"
        for c, t in columns.items()
    )
    joins = " ".join(f"LEFT JOIN {c}_numbers ON {t} = {c}_numbers.v" for c, t in columns.items())
    return ", ".join(numbers) + f" SELECT id, {shown} FROM {source} {joins}"


@query("j07_sparse_indicators", "WITH " + ", ".join([*ALL, MERGED]) + ", " + _slots_sql(
    {"store_nbr": "store_nbr::VARCHAR", "product_family": "product_family", "day_type": "day_type"}, "merged", EARLY + " AND store_nbr % 7 <> 3"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["store_nbr", "product_family", "day_type"]
    merged = written_table(merged_features(star(spark, folder)).select("id", "date", *columns), "merged")
    known = merged.filter(EARLY).filter("store_nbr % 7 <> 3")  # the other stores are unseen when it is applied
    made = IndexColumns(columns=columns, suffix="_vector", vectors=True).fit(known).transform(merged)
    return made.select("id", *[F.col(f"{c}_vector").cast("string").alias(f"{c}_vector") for c in columns])


def _category_totals_sql() -> str:
    """How many rows hold each category, and how many follow one that does."""
    texts = {c: f"{c}::VARCHAR" for c in CATEGORIES}
    texts["special_day_transferred"] = "CASE special_day_transferred WHEN TRUE THEN 'True' WHEN FALSE THEN 'False' END"
    rows = "shifted AS (SELECT place, COALESCE(LAG(place) OVER (ORDER BY place), 0) AS before FROM placed)"
    now = [
        f"SELECT '{c}_' || {t} AS feature, COUNT(*)::BIGINT AS total FROM placed WHERE {c} IS NOT NULL GROUP BY {t}"
        for c, t in texts.items()
    ]
    then = [
        f"SELECT '{c}_' || {t} || '_lag_1' AS feature, COUNT(*)::BIGINT AS total FROM shifted s "
        f"JOIN placed p ON p.place = s.before WHERE {c} IS NOT NULL GROUP BY {t}"
        for c, t in texts.items()
    ]
    return sql(*ALL, MERGED, FILLED, PREPARED, rows, " UNION ALL ".join(now + then))


@query("j10_feature_table_in_full", _category_totals_sql())
def _(spark: SparkSession, folder: str) -> DataFrame:
    merged = written_table(merged_features(star(spark, folder), refine_days=True), "merged")
    preparation = Preparation(window_size=2)
    fitted = preparation.fit(merged)
    made = preparation.transform(merged, fitted)
    sides = [
        made.select(*[F.col(f"{c}_index{end}").alias(c) for c in CATEGORIES])
        .unpivot([], list(CATEGORIES), "variable", "number").withColumn("end", F.lit(end)) for end in ("", "_lag_1")
    ]
    totals = stack_rows(*sides).filter("number IS NOT NULL").groupBy("variable", "number", "end").agg(F.count(F.lit(1)).alias("total"))
    named = attach(totals, fitted.index, ["variable", "number"])
    return named.select(F.concat("variable", F.lit("_"), "value", "end").alias("feature"), "total")


@query("j11_rename_and_merge", sql(*ALL, MERGED, "SELECT * FROM merged"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return merged_features(star(spark, folder))


BASICS_SQL = """SELECT id, date AS date_of_sales, store_nbr AS store_id, sales AS total_sales_of_day FROM sales"""


@query("j13_nested_steps", sql(SALES, BASICS_SQL))
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "sales")
    naming = Pipeline(stages=[FunctionStep.of(rename_sales_basics), FunctionStep.of(parse_sale_dates)])
    chosen = ColumnSelector(columns=["id", "date_of_sales", "store_id", "total_sales_of_day"])
    return Pipeline(stages=[naming, chosen]).fit(rows).transform(rows)


@query("j14_first_steps", sql(SALES, f"""
  SELECT id, {_indicators_sql('family', FAMILIES)}, onpromotion FROM sales"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "sales").select("id", "family", "onpromotion")
    stages = [
        OneHotColumns(columns=["family"]), MinMaxColumns(columns=["onpromotion"]),
        ColumnDropper(columns=["id"]),
    ]
    return prefix(Pipeline(stages=stages).fit(rows), 1).transform(rows)
