"""Splits, models and evaluation."""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions.dates import days_since
from shelfcast.operators.joins import stack_rows
from shelfcast.operators.ordering import dense_position, row_slice
from shelfcast.operators.splits import (
    fold_identifiers, hold_out, kfold_splits, linked_split, membership, ordered_folds, sequential_parts,
    time_series_folds,
)
from shelfcast.plans.features import CATEGORIES, SCALED, Preparation, merged_features
from shelfcast.plans.folds import store_fold_features, store_folds, stored_split
from shelfcast.plans.groups import fold_features, oil_price_group
from shelfcast.plans.models import (
    actual_and_predicted, average_scores, boosted_trees, coefficients, cross_validate, daily_baseline, daily_totals,
    fit_prepared, fold_predictions, linear_model, out_of_fold, predict, score_rows, scores, search, search_pipeline, validate_outside, with_residual,
)
from shelfcast.plans.preparation import PrepareFeatures
from shelfcast.plans.stages import FunctionStep, fill_numbers
from shelfcast.queries import query
from shelfcast.queries.encodings import PLAIN, PREPARED, TEXT_SQL
from shelfcast.queries.views import ALL, FILLED, MERGED, OIL, SALES, sql, star, table
from shelfcast.shared import written_table
from shelfcast.sources.registry import DATASETS
from shelfcast.sources.warehouse import Warehouse

SIZE = "(SELECT COUNT(*) FROM sales)"
FOLDED = f"""counted AS (SELECT COUNT(*) // 5 AS q, COUNT(*) % 5 AS r FROM sales),
folded AS (SELECT s.*, CAST(CASE WHEN id < r * (q + 1) THEN id // (q + 1) ELSE r + (id - r * (q + 1)) // q END AS INT)
  AS fold FROM sales s, counted)"""
TIMED = f"""counted AS (SELECT COUNT(*) // 6 AS b, COUNT(*) - 5 * (COUNT(*) // 6) AS first FROM sales),
folded AS (SELECT s.*, CAST(CASE WHEN id < first THEN -1 ELSE (id - first) // b END AS INT) AS fold FROM sales s, counted)"""


def _sales(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "sales")


@query("k01_sequential_parts", sql(SALES, f"""
  SELECT *, CAST(id // ({SIZE} // 7) AS INT) AS part FROM sales WHERE id < 7 * ({SIZE} // 7)"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return sequential_parts(_sales(spark, folder), "id", 7)


@query("k02_kfold", sql(SALES, f"""parted AS (
  SELECT id, CAST(id // ({SIZE} // 5) AS INT) AS part FROM sales WHERE id < 5 * ({SIZE} // 5))""", """
  SELECT id, f AS fold, CASE WHEN part = f THEN 'test' ELSE 'train' END AS side FROM parted, range(5) r(f)"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    made = []
    for split in kfold_splits(_sales(spark, folder).select("id"), "id", 5, "sales"):
        for side in ("train", "test"):
            made.append(getattr(split, side).withColumns({"fold": F.lit(split.fold).cast("long"), "side": F.lit(side)}))
    return stack_rows(*made)


@query("k03_split_names", sql(SALES, f"""parted AS (
  SELECT id, CAST(id // ({SIZE} // 3) AS INT) AS part FROM sales WHERE id < 3 * ({SIZE} // 3))""", """
  SELECT 'sales_kfold_' || CASE WHEN part = f THEN 'test' ELSE 'train' END || '_' || f AS name, COUNT(*) AS rows
  FROM parted, range(3) r(f) GROUP BY 1"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    splits = kfold_splits(_sales(spark, folder).select("id"), "id", 3, "sales")
    sides = [side for split in splits for side in (split.train, split.test)]
    counted = zip(fold_identifiers(splits), sides)
    return stack_rows(*[s.agg(F.count(F.lit(1)).alias("rows")).withColumn("name", F.lit(n)) for n, s in counted])


@query("k04_stored_folds", sql(SALES, FOLDED, """
  SELECT id, sales, CASE WHEN fold = 3 THEN 'test' ELSE 'train' END AS side FROM folded"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = Warehouse(spark)
    rows = ordered_folds(_sales(spark, folder), "id", 5).select("id", "sales", "fold")
    store_folds(warehouse, rows, "sales", 5)
    split = stored_split(warehouse, "sales", 3)
    return stack_rows(split.train.withColumn("side", F.lit("train")), split.test.withColumn("side", F.lit("test")))


@query("k05_features_per_fold", sql(SALES, OIL, f"""parted AS (
  SELECT DISTINCT date, CAST(id // ({SIZE} // 3) AS INT) AS part FROM sales WHERE id < 3 * ({SIZE} // 3)),
sided AS (SELECT DISTINCT o.date, o.dcoilwtico AS oil_price, CAST(f AS INT) AS fold,
    CASE WHEN part = f THEN 'test' ELSE 'train' END AS side FROM oil o JOIN parted p ON o.date = p.date, range(3) r(f)),
bounds AS (SELECT fold, MIN(oil_price) AS low, MAX(oil_price) AS high FROM sided WHERE side = 'train' GROUP BY fold)""", """
  SELECT date, oil_price, CAST((oil_price - low) / (high - low) AS FLOAT) AS oil_price_scaled_0_to_1, fold, side
  FROM sided JOIN bounds USING (fold)"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    prices = DATASETS["oil_price_by_date"].to_table(table(spark, folder, "oil"))
    splits = kfold_splits(_sales(spark, folder).select("id", "date"), "id", 3, "sales")
    linked = [linked_split(prices, "oil", split, {"date": "date"}) for split in splits]
    return fold_features(oil_price_group(), linked)


@query("k05_stored_fold_features", sql(SALES, OIL, f"""parted AS (
  SELECT DISTINCT date, CAST(id // ({SIZE} // 3) AS INT) AS part FROM sales WHERE id < 3 * ({SIZE} // 3)),
sided AS (SELECT DISTINCT o.date, o.dcoilwtico AS oil_price, CAST(f AS INT) AS fold,
    CASE WHEN part = f THEN 'test' ELSE 'train' END AS side FROM oil o JOIN parted p ON o.date = p.date, range(3) r(f)),
bounds AS (SELECT fold, MIN(oil_price) AS low, MAX(oil_price) AS high FROM sided WHERE side = 'train' GROUP BY fold)""", """
  SELECT date, oil_price, CAST((oil_price - low) / (high - low) AS FLOAT) AS oil_price_scaled_0_to_1, fold, side
  FROM sided JOIN bounds USING (fold) WHERE fold < 2"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    warehouse, group = Warehouse(spark), oil_price_group()
    prices = DATASETS["oil_price_by_date"].to_table(table(spark, folder, "oil"))
    splits = kfold_splits(_sales(spark, folder).select("id", "date"), "id", 3, "sales")[:2]
    linked = [linked_split(prices, "oil", split, {"date": "date"}) for split in splits]
    unfinished = replace(linked[1], train=linked[1].train.filter("day(date) = 2"), test=linked[1].test.limit(0))
    for split in (linked[0], unfinished, linked[1]):  # the second fold is stored twice
        store_fold_features(warehouse, group, split)
    bound = [(split.fold, part, group.bound_to(split, part).target) for split in linked for part in ("train", "test")]
    return stack_rows(*[
        warehouse.current(name).withColumns({"fold": F.lit(fold), "side": F.lit(part)}) for fold, part, name in bound
    ])


@query("k06_ordered_folds", sql(SALES, FOLDED, "SELECT id, fold FROM folded"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return ordered_folds(_sales(spark, folder).select("id"), "id", 5)


@query("k07_time_series_folds", sql(SALES, TIMED, """
  SELECT id, CAST(f AS INT) AS in_fold, CASE WHEN fold = f THEN 'test' ELSE 'train' END AS side
  FROM folded, range(5) r(f) WHERE fold <= f"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = time_series_folds(_sales(spark, folder).select("id"), "id", 5)
    return membership(rows, 5, growing=True).drop("fold")


@query("k08_hold_out", sql(SALES, f"SELECT id, id >= {SIZE} - CEIL(0.2 * {SIZE}) AS is_test FROM sales"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return hold_out(_sales(spark, folder).select("id"), "id")


DAILY = """daily AS (SELECT row_number() OVER (ORDER BY date) - 1 AS day, date, SUM(sales) AS total FROM sales GROUP BY date),
dayed AS (SELECT s.id, s.date, s.sales, s.onpromotion, (s.date - (SELECT MIN(date) FROM sales))::INT AS day FROM sales s)"""


def _dayed(spark: SparkSession, folder: str) -> DataFrame:
    rows = _sales(spark, folder)
    origin = rows.agg(F.min("date").alias("origin")).select("origin").scalar()
    return rows.select("id", "date", "sales", "onpromotion", days_since(F.col("date"), origin).alias("day"))


SCORE_SQL = """ROUND(1 - SUM((sales - prediction) ^ 2) / (VAR_POP(sales) * COUNT(*)), 6) AS r2,
  ROUND(SQRT(AVG((sales - prediction) ^ 2)), 3) AS rmse, ROUND(-AVG((sales - prediction) ^ 2) / 1e6, 4) AS neg_mean_squared_error"""


def _shown_scores(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "r2": F.round("r2", 6), "rmse": F.round("rmse", 3),
        "neg_mean_squared_error": F.round(F.col("neg_mean_squared_error") / 1e6, 4),
    })


@query("k09_outer_validation", sql(SALES, DAILY, f"""cut AS (SELECT 3 * ({SIZE} // 5) AS first, 4 * ({SIZE} // 5) AS last),
fit AS (SELECT regr_slope(sales, day) AS a, regr_intercept(sales, day) AS b FROM dayed, cut WHERE id < first),
predicted AS (SELECT sales, a * day + b AS prediction FROM dayed, fit, cut WHERE id >= first AND id < last)""",
    f"SELECT {SCORE_SQL} FROM predicted"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Fitted on the first three fifths of the table, validated on the slice behind them."""
    rows = _dayed(spark, folder)
    fifth = rows.count() // 5
    inner, outer = row_slice(rows, ["id"], 0, 3 * fifth), row_slice(rows, ["id"], 3 * fifth, 4 * fifth)
    return _shown_scores(validate_outside(linear_model(["day"], "sales"), inner, outer, "sales"))


@query("k09_outer_validation_of_all_rows", sql(SALES, DAILY, f"""cut AS (
  SELECT {SIZE} - CEIL(0.2 * {SIZE}) AS first),
fit AS (SELECT regr_slope(sales, day) AS a, regr_intercept(sales, day) AS b FROM dayed, cut WHERE id < first),
predicted AS (SELECT sales, a * day + b AS prediction FROM dayed, fit, cut WHERE id >= first)""",
    f"SELECT {SCORE_SQL} FROM predicted"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = _dayed(spark, folder)
    size = rows.count()  # ids are positions
    first = size - -(-size // 5)
    inner, outer = rows.filter(F.col("id") < first), rows.filter(F.col("id") >= first)
    return _shown_scores(validate_outside(linear_model(["day"], "sales"), inner, outer, "sales"))


@query("k10_linear_regression", sql(SALES, DAILY, """
  SELECT ROUND(regr_intercept(total, day), 4) AS intercept, ROUND(regr_slope(total, day), 6) AS slope FROM daily"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    days = dense_position(daily_totals(_sales(spark, folder)), ["date"], "day")
    found = coefficients(linear_model(["day"], "sales").fit(days))
    values = [(round(found["intercept"], 4), round(found["coefficients"][0], 6))]
    return spark.createDataFrame(values, "intercept double, slope double")


def _all_features(window: int) -> list[str]:
    """Every column that preparation makes but the row's key, its label and the mark of its window."""
    now = [*SCALED, *[f"{c}_index" for c in CATEGORIES], *[c for c in PLAIN if c not in (*SCALED, "sales")]]
    return now + [f"{c}_lag_{k}" for k in range(1, window) for c in (*now, "sales")]


def _prepared_trees(window: int, **params: int) -> Pipeline:
    """Preparation, gaps marked, boosted trees on all features."""
    features = _all_features(window)
    trees = boosted_trees(features, "sales", **params).getStages()
    return Pipeline(stages=[PrepareFeatures(windowSize=window), FunctionStep.of(fill_numbers, columns=features), *trees])


@query("k11_boosted_trees")
def _(spark: SparkSession, folder: str) -> DataFrame:
    merged = written_table(merged_features(star(spark, folder), refine_days=True), "merged", compression="zstd", release=True)
    model, made = fit_prepared(_prepared_trees(2, maxIter=5, maxDepth=3), merged)
    return predict(PipelineModel(model.stages[1:]), made).select("id", "sales", "prediction")


LINE = """fit AS (SELECT regr_slope(sales, day) AS a, regr_intercept(sales, day) AS b FROM dayed),
predicted AS (SELECT id, sales, a * day + b AS prediction FROM dayed, fit)"""


@query("k12_scores", sql(SALES, DAILY, LINE, f"SELECT {SCORE_SQL} FROM predicted"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = _dayed(spark, folder)
    model = linear_model(["day"], "sales").fit(rows)
    return _shown_scores(scores(predict(model, rows), "sales"))


CROSS = """fits AS (SELECT CAST(f AS INT) AS in_fold, regr_slope(sales, day) AS a, regr_intercept(sales, day) AS b
  FROM rows_in_folds, range(5) r(f) WHERE {train} GROUP BY f),
predicted AS (SELECT id, date, in_fold, CASE WHEN fold = in_fold THEN 'test' ELSE 'train' END AS side, sales,
  a * day + b AS prediction FROM rows_in_folds, fits WHERE fold = in_fold OR {again})"""
KFOLD = FOLDED.replace("FROM sales s, counted", "FROM dayed s, counted").replace("folded AS", "rows_in_folds AS") + ",\n" + \
    CROSS.format(train="fold <> f", again="fold <> in_fold")
GROWING = TIMED.replace("FROM sales s, counted", "FROM dayed s, counted").replace("folded AS", "rows_in_folds AS") + ",\n" + \
    CROSS.format(train="fold < f", again="fold < in_fold")


@query("k13_cross_validation", sql(SALES, DAILY, KFOLD, f"SELECT in_fold, side, {SCORE_SQL} FROM predicted GROUP BY 1, 2"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = ordered_folds(_dayed(spark, folder), "id", 5)
    return _shown_scores(cross_validate(linear_model(["day"], "sales"), rows, "sales", range(5)))


@query("k13_growing_validation", sql(SALES, DAILY, GROWING, f"SELECT in_fold, side, {SCORE_SQL} FROM predicted GROUP BY 1, 2"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = time_series_folds(_dayed(spark, folder), "id", 5)
    return _shown_scores(cross_validate(linear_model(["day"], "sales"), rows, "sales", range(5), growing=True))


@query("k13_average_scores", sql(SALES, DAILY, KFOLD, f"""
  per_fold AS (SELECT side, 1 - SUM((sales - prediction) ^ 2) / (VAR_POP(sales) * COUNT(*)) AS r2,
    SQRT(AVG((sales - prediction) ^ 2)) AS rmse, -AVG((sales - prediction) ^ 2) AS mse FROM predicted GROUP BY in_fold, side)""",
    """SELECT side, ROUND(AVG(r2), 6) AS avg_r2, ROUND(AVG(rmse), 3) AS avg_rmse,
    ROUND(AVG(mse) / 1e6, 4) AS avg_neg_mean_squared_error FROM per_fold GROUP BY side"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = ordered_folds(_dayed(spark, folder), "id", 5)
    averages = average_scores(cross_validate(linear_model(["day"], "sales"), rows, "sales", range(5)))
    return averages.select(
        "side", F.round("avg_r2", 6).alias("avg_r2"), F.round("avg_rmse", 3).alias("avg_rmse"),
        F.round(F.col("avg_neg_mean_squared_error") / 1e6, 4).alias("avg_neg_mean_squared_error"),
    )


def _folded_star(spark: SparkSession, folder: str, folds: int) -> DataFrame:
    """The merged rows, each with the fold of its sale."""
    tables = star(spark, folder)
    return merged_features(tables | {"sales": ordered_folds(tables["sales"], "id", folds)}, refine_days=True)


def _folded_sql(folds: int) -> str:
    """``parted``: the prepared rows in order, with the fold of their sale."""
    return f"""sizes AS (SELECT COUNT(*) // {folds} AS q, COUNT(*) % {folds} AS r FROM sales),
parted AS (SELECT p.*, CAST(CASE WHEN id < r * (q + 1) THEN id // (q + 1) ELSE r + (id - r * (q + 1)) // q END AS INT) AS fold
  FROM placed p, sizes)"""


@query("k13_fold_dictionaries", sql(*ALL, MERGED, FILLED, PREPARED, _folded_sql(5), "cells AS (" + " UNION ALL ".join(
    f"SELECT fold, '{c}' AS variable, {t} AS value FROM parted" for c, t in TEXT_SQL.items()) + ")", """
  SELECT CAST(f AS INT) AS fold, variable, value,
    row_number() OVER (PARTITION BY f, variable ORDER BY COUNT(*) DESC, value) - 1 AS number
  FROM cells, range(5) r(f) WHERE fold <> f AND value IS NOT NULL GROUP BY f, variable, value"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    found = Preparation().fit_folds(_folded_star(spark, folder, 5), range(5))
    return stack_rows(*[fit.index.withColumn("fold", F.lit(f).cast("int")) for f, fit in found.items()])


@query("k13_fold_bounds", sql(*ALL, MERGED, FILLED, PREPARED, _folded_sql(5), """
  SELECT CAST(f AS INT) AS fold, CAST(MIN(date) AS VARCHAR) AS origin, MIN(oil_price) AS oil_low, MAX(oil_price) AS oil_high,
    MIN(all_products_transactions)::DOUBLE AS transactions_low, MAX(all_products_transactions)::DOUBLE AS transactions_high
  FROM parted, range(5) r(f) WHERE fold < f GROUP BY f"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    found = Preparation().fit_folds(_folded_star(spark, folder, 5), range(1, 5), growing=True)
    rows = [(f, fit.origin, *fit.bounds["oil_price"], *fit.bounds["all_products_transactions"]) for f, fit in found.items()]
    return spark.createDataFrame(rows, "fold int, origin string, oil_low double, oil_high double, transactions_low double, transactions_high double")


def _prepared_line() -> Pipeline:
    """A line on the sales of the row before, after the whole preparation."""
    return Pipeline(stages=[PrepareFeatures(windowSize=2), *linear_model(["sales_lag_1"], "sales").getStages()])


def _lagged_folds_sql(folds: int, slope: str = "regr_slope(sales, x)", start: str = "regr_intercept(sales, x)") -> str:
    """``lined``: both sides of every fold, each lagged for itself, with the prediction of the fold's line."""
    return f"""sided AS (SELECT id, place, sales, CAST(f AS INT) AS in_fold, CASE WHEN fold = f THEN 'test' ELSE 'train' END AS side
  FROM parted, range({folds}) r(f)),
lagging AS (SELECT *, COALESCE(LAG(sales) OVER w, sales) AS x FROM sided WINDOW w AS (PARTITION BY in_fold, side ORDER BY place)),
fits AS (SELECT in_fold, {slope} AS a, {start} AS b FROM lagging WHERE side = 'train' GROUP BY 1),
lined AS (SELECT id, sales, in_fold, side, a * x + b AS prediction FROM lagging JOIN fits USING (in_fold))"""


@query("k13_prepared_validation", sql(*ALL, MERGED, FILLED, PREPARED, _folded_sql(3), _lagged_folds_sql(3),
    f"SELECT in_fold, side, {SCORE_SQL} FROM lined GROUP BY 1, 2"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _shown_scores(cross_validate(_prepared_line(), _folded_star(spark, folder, 3), "sales", range(3)))


@query("k14_prepared_out_of_fold", sql(*ALL, MERGED, FILLED, PREPARED, _folded_sql(3), _lagged_folds_sql(3), """
  SELECT id, sales, ROUND(prediction, 3) AS prediction FROM lined WHERE side = 'test'"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    predicted = out_of_fold(_prepared_line(), _folded_star(spark, folder, 3), range(3))
    return predicted.select("id", "sales", F.round("prediction", 3).alias("prediction"))


@query("k17_search_over_preparation", sql(*ALL, MERGED, FILLED, PREPARED, _folded_sql(2), _lagged_folds_sql(2),
    _lagged_folds_sql(2, "SUM(x * sales) / SUM(x * x)", "0").replace("sided AS", "sided_0 AS").replace("FROM sided ", "FROM sided_0 ")
    .replace("lagging", "lagging_0").replace("fits", "fits_0").replace("lined AS", "lined_0 AS"), """
  scored AS (SELECT 'True' AS intercept, in_fold, -AVG((sales - prediction) ^ 2) AS s FROM lined WHERE side = 'test' GROUP BY 2
    UNION ALL SELECT 'False', in_fold, -AVG((sales - prediction) ^ 2) FROM lined_0 WHERE side = 'test' GROUP BY 2),
  trials AS (SELECT CAST(w AS VARCHAR) AS "0_windowSize", intercept AS "2_fitIntercept", AVG(s) AS mean, COUNT(*) AS folds
    FROM scored, range(2, 4) r(w) GROUP BY ALL)""", """
  SELECT "0_windowSize", "2_fitIntercept", ROUND(mean / 1e6, 4) AS mean_neg_mean_squared_error, folds,
    row_number() OVER (ORDER BY ROUND(mean, 2) DESC, "0_windowSize", "2_fitIntercept" DESC) = 1 AS is_best FROM trials"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    steps = _prepared_line()
    prepare, _, line = steps.getStages()
    grid = {prepare.windowSize: [2, 3], line.fitIntercept: [True, False]}
    _, trials = search_pipeline(steps, grid, _folded_star(spark, folder, 2), "sales", range(2))
    return trials.withColumn("mean_neg_mean_squared_error", F.round(F.col("mean_neg_mean_squared_error") / 1e6, 4))


@query("k14_out_of_fold", sql(SALES, DAILY, KFOLD, """
  SELECT id, sales, ROUND(prediction, 3) AS prediction FROM predicted WHERE side = 'test'"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = ordered_folds(_dayed(spark, folder), "id", 5)
    predicted = out_of_fold(linear_model(["day"], "sales"), rows, range(5))
    return predicted.select("id", "sales", F.round("prediction", 3).alias("prediction"))


@query("k14_out_of_growing_folds", sql(SALES, DAILY, GROWING, """
  SELECT id, sales, ROUND(prediction, 3) AS prediction FROM predicted WHERE side = 'test'"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = time_series_folds(_dayed(spark, folder), "id", 5)
    predicted = out_of_fold(linear_model(["day"], "sales"), rows, range(5), growing=True)
    return predicted.select("id", "sales", F.round("prediction", 3).alias("prediction"))


@query("k15_actual_and_predicted", sql(SALES, DAILY, GROWING, """
  SELECT id, date, in_fold, side, sales AS actual, ROUND(prediction, 3) AS prediction FROM predicted"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = time_series_folds(_dayed(spark, folder), "id", 5)
    predicted = fold_predictions(linear_model(["day"], "sales"), rows, range(5), growing=True)
    shown = actual_and_predicted(predicted, "sales", ["id", "date"])
    return shown.withColumn("prediction", F.round("prediction", 3))


@query("k16_residual", sql(SALES, DAILY, LINE, "SELECT id, ROUND(sales - prediction, 3) AS residual FROM predicted"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = _dayed(spark, folder)
    model = linear_model(["day"], "sales").fit(rows)
    return with_residual(predict(model, rows), "sales").select("id", F.round("residual", 3).alias("residual"))


@query("k17_search")
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = ordered_folds(_dayed(spark, folder), "id", 3)
    grid = {"fitIntercept": [True, False], "standardization": [True, False]}
    return search(["day", "onpromotion"], "sales", rows, 3, grid)[1]


@query("k18_score_future_rows", sql(SALES, DAILY, """
  cut AS (SELECT MAX(date) - 16 AS last FROM sales),
  fit AS (SELECT regr_slope(sales, day) AS a, regr_intercept(sales, day) AS b FROM dayed, cut WHERE date <= last)""", """
  SELECT id, ROUND(a * day + b, 3) AS sales FROM dayed, cut, fit WHERE date > last"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = _dayed(spark, folder)
    last = rows.agg(F.date_sub(F.max("date"), 16).alias("last")).select("last").scalar()
    model = linear_model(["day"], "sales").fit(rows.filter(F.col("date") <= last))
    future = rows.filter(F.col("date") > last).drop("sales")
    return score_rows(model, future).withColumn("sales", F.round("sales", 3))


@query("k18_prepared_features_model")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Trees on all prepared features of the rows up to the last sixteen days, applied to these."""
    merged = written_table(merged_features(star(spark, folder), refine_days=True), "merged", compression="zstd", release=True)
    last = merged.agg(F.date_sub(F.max("date"), 16).alias("last")).select("last").scalar()
    model = _prepared_trees(2, maxIter=10, maxDepth=4).fit(merged.filter(F.col("date") <= last))
    return score_rows(model, merged.filter(F.col("date") > last))


@query("k19_daily_baseline", sql(SALES, DAILY, """
  parted AS (SELECT day, total, day >= (SELECT COUNT(*) - CEIL(0.2 * COUNT(*)) FROM daily) AS is_test FROM daily),
  fit AS (SELECT regr_slope(total, day) AS a, regr_intercept(total, day) AS b FROM parted WHERE NOT is_test)""", """
  SELECT day AS days_since_start, ROUND(total, 2) AS sales, is_test, ROUND(a * day + b, 3) AS prediction FROM parted, fit"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    found = daily_baseline(_sales(spark, folder))
    return found.withColumns({"sales": F.round("sales", 2), "prediction": F.round("prediction", 3)})
