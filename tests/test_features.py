from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from shelfcast.functions.columns import for_display
from shelfcast.operators.splits import (
    fold_identifiers, hold_out, kfold_splits, linked_split, membership, ordered_folds, sequential_parts,
    time_series_folds,
)
from shelfcast.plans.features import Preparation, load_star, merged_features
from shelfcast.plans.folds import store_folds, stored_split
from shelfcast.plans.groups import frequency_index, get_features, oil_price_group, store_group
from shelfcast.plans.models import (
    boosted_trees, cross_validate, linear_model, out_of_fold, predict, score_rows, scores, search, with_residual,
)
from shelfcast.plans.stages import (
    ColumnDropper, ColumnSelector, FunctionStep, MinMaxColumns, OneHotColumns, VectorFirstValue, known_categories,
    mean_imputer, prefix,
)
from shelfcast.queries.views import star
from shelfcast.shared import fresh_path
from shelfcast.sources.registry import DATASETS
from shelfcast.sources.warehouse import Warehouse
from tests.conftest import rows


def test_min_max_of_the_sample(spark):
    df = spark.createDataFrame([(1, 0, 1), (2, 10, 0), (3, 5, 1)], "id int, hour int, clicked int")
    model = MinMaxColumns(columns=["hour"], suffix="_norm").fit(df)
    assert rows(model.transform(df), "id", "hour_norm") == [(1, 0.0), (2, 1.0), (3, 0.5)]
    later = spark.createDataFrame([(20,), (None,)], "hour int")
    assert rows(model.transform(later), "hour_norm") == [(None,), (2.0,)]


def test_min_max_of_a_constant_and_of_nothing(spark):
    df = spark.createDataFrame([(4.0, None), (4.0, None), (float("nan"), None)], "c double, n double")
    assert rows(MinMaxColumns(columns=["c", "n"]).fit(df).transform(df)) == [(None, None), (0.5, None), (0.5, None)]
    zero = MinMaxColumns(columns=["c"], constant=0.0).fit(df).transform(df)
    assert rows(zero, "c") == [(None,), (0.0,), (0.0,)]


def test_imputer_takes_the_mean_of_the_rest(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (-1.0,), (None,)], "x double")
    assert rows(mean_imputer(["x"], ["y"]).fit(df).transform(df), "y") == [(1.0,), (2.0,), (2.0,), (3.0,)]


def test_one_hot_in_place(spark):
    df = spark.createDataFrame([(1, "b", 2), (2, None, 3), (3, "a.x'`", 4)], "i int, c string, z int")
    made = OneHotColumns(columns=["c"], inPlace=True).fit(df).transform(df)
    assert made.columns == ["i", "c_a.x'`", "c_b", "c_nan", "z"]
    assert rows(made) == [(1, 0, 1, 0, 2), (2, 0, 0, 1, 3), (3, 1, 0, 0, 4)]


def test_one_hot_of_unseen_values_is_zero(spark):
    seen = spark.createDataFrame([("a", True), ("b", None)], "c string, f boolean")
    unseen = spark.createDataFrame([("q", False), (None, None), ("a", True)], "c string, f boolean")
    made = OneHotColumns(columns=["c", "f"]).fit(seen).transform(unseen)
    assert made.columns == ["c_a", "c_b", "f_True", "f_nan"]
    assert rows(made) == [(0, 0, 0, 0), (0, 0, 0, 0), (1, 0, 1, 0)]


def test_too_many_categories_are_an_error(spark):
    df = spark.range(10).select(F.col("id").cast("string").alias("c"), F.lit("x").alias("d"))
    assert len(known_categories(df, ["c", "d"], 10)["c"]) == 10
    for limit in (9, 5, 3):
        with pytest.raises(ValueError, match="categories"):
            known_categories(df, ["c", "d"], limit)


def test_frequency_index(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",), (None,)], "c string")
    assert rows(frequency_index(df, "c", "n")) == [(None, None), ("a", 1), ("b", 0), ("b", 0), ("c", 2)]


def test_pipelines_are_saved_nested_and_cut(spark):
    df = spark.createDataFrame([(1, "a", 3.0), (2, "b", 5.0)], "i int, c string, x double")
    inner = Pipeline(stages=[OneHotColumns(columns=["c"]), MinMaxColumns(columns=["x"])])
    stages = [ColumnSelector(columns=["i", "c", "x"]), inner, FunctionStep.of(for_display, decimals=2), ColumnDropper(columns=["i"])]
    model = Pipeline(stages=stages).fit(df)
    path = fresh_path(spark, "model")
    model.save(path)
    loaded = PipelineModel.load(path)
    assert rows(loaded.transform(df)) == rows(model.transform(df)) == [(0.0, 1, 0), (1.0, 0, 1)]
    assert model.transform(df).columns == ["x", "c a", "c b"]
    assert prefix(model, 2).transform(df).columns == ["i", "x", "c_a", "c_b"]
    assert len(prefix(Pipeline(stages=stages), 1).getStages()) == 1
    assert VectorFirstValue(columns=["v"], kinds=["int"]).getColumns() == ["v"]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(n=st.integers(1, 40), k=st.integers(1, 9))
def test_folds_are_the_textbook_ones(spark, n, k):
    df = spark.range(n).withColumnRenamed("id", "p")
    sizes = [n // k + (1 if i < n % k else 0) for i in range(k)]
    expected = [i for i, size in enumerate(sizes) for _ in range(size)]
    assert [r[0] for r in ordered_folds(df, "p", k).orderBy("p").select("fold").collect()] == expected


@pytest.mark.parametrize(("n", "k"), [(20, 3), (23, 5), (6, 5)])
def test_growing_folds(spark, n, k):
    df = time_series_folds(spark.range(n).withColumnRenamed("id", "p"), "p", k)
    block = n // (k + 1)
    parts = membership(df, k, growing=True).collect()
    for i in range(k):
        start = n - (k - i) * block
        assert sorted(r["p"] for r in parts if r["in_fold"] == i and r["side"] == "test") == list(range(start, start + block))
        assert sorted(r["p"] for r in parts if r["in_fold"] == i and r["side"] == "train") == list(range(start))


def test_parts_leave_the_rest_out(spark):
    df = spark.range(11).withColumnRenamed("id", "p")
    assert [r["part"] for r in sequential_parts(df, "p", 3).orderBy("p").collect()] == [0] * 3 + [1] * 3 + [2] * 3
    assert sequential_parts(df, "p", 20).count() == 0
    assert [r["is_test"] for r in hold_out(df, "p").orderBy("p").collect()] == [False] * 8 + [True] * 3
    splits = kfold_splits(df, "p", 3, "sales")
    assert fold_identifiers(splits)[:2] == ["sales_kfold_train_0", "sales_kfold_test_0"]
    for split in splits:
        train, test = rows(split.train), rows(split.test)
        assert not set(train) & set(test) and len(train) == 6 and len(test) == 3
    linked = linked_split(spark.createDataFrame([(0,), (5,), (50,)], "day int"), "days", splits[0], {"day": "p"})
    assert (rows(linked.train), rows(linked.test), linked.name_of("test")) == ([(5,)], [(0,)], "days_kfold_test_0")


def test_stored_folds(spark):
    warehouse = Warehouse(spark)
    df = ordered_folds(spark.range(10).withColumnRenamed("id", "p"), "p", 3)
    for _ in range(2):
        store_folds(warehouse, df, "t", 3)
    split = stored_split(warehouse, "t", 1)
    assert rows(split.test) == [(4,), (5,), (6,)] and len(rows(split.train)) == 7


def test_groups_fit_on_training_rows_only(spark):
    df = spark.sql("SELECT DATE'2020-01-01' + CAST(id AS INT) AS date, CAST(id AS DOUBLE) AS oil_price, id AS p FROM range(9)")
    split = kfold_splits(df, "p", 3, "oil")[2]
    made = oil_price_group().make_split(split)
    assert max(r[0] for r in rows(made.train, "oil_price_scaled_0_to_1")) == 1.0
    assert min(r[0] for r in rows(made.test, "oil_price_scaled_0_to_1")) > 1.0
    assert oil_price_group().bound_to(split).target == "oil_price_by_date_kfold_train_2"


def test_groups_are_stored_and_looked_up(spark, small):
    warehouse = Warehouse(spark)
    stores = DATASETS["stores"].to_table(star(spark, small)["stores"])
    warehouse.save(stores, "stores")
    store_group().engineer_and_store(warehouse)
    kinds = dict(warehouse.current("stores").dtypes)
    assert kinds["city_numeric"] == "int" and kinds["type_ohe"] == "array<double>"
    makers = {"twice": lambda df: df.withColumn("twice", F.col("cluster") * 2)}
    assert get_features(warehouse, "stores", ["city_numeric", "twice"], makers, ["id"]).columns == ["id", "city_numeric", "twice"]
    with pytest.raises(KeyError):
        get_features(warehouse, "stores", ["thrice"], makers)


def test_preparation_fits_once_and_applies_elsewhere(spark, small):
    merged = merged_features(star(spark, small))
    early, late = merged.filter("date < DATE'1999-06-01'"), merged.filter("date >= DATE'1999-06-01'")
    preparation = Preparation(window_size=2, categories=("product_family", "store_type"), bucket_rows=500)
    fitted = preparation.fit(early)
    first, second = preparation.transform(early, fitted), preparation.transform(late, fitted)
    assert first.columns == second.columns and second.count() == late.count()
    assert first.agg(F.min("oil_price"), F.max("oil_price")).first()[:] == (0.0, 1.0)
    assert second.agg(F.min("days_since_start")).first()[0] > 1000
    plain = Preparation(window_size=1, categories=("store_type",)).transform(early, fitted)
    assert not [c for c in plain.columns if "_lag_" in c or "backfilled" in c]
    wide = Preparation(window_size=2, categories=("product_family", "store_type"), bucket_rows=10**6)
    assert rows(wide.transform(late, fitted)) == rows(second)


def test_preparation_takes_any_number_of_categories(spark, small):
    merged = merged_features(star(spark, small)).withColumn("store_nbr", (F.col("id") % 2500).cast("int"))
    preparation = Preparation(window_size=2, categories=("store_nbr", "day_type"))
    fitted = preparation.fit(merged)
    made = preparation.transform(merged, fitted)
    assert made.count() == merged.count()
    index = {r.number: int(r.value) for r in fitted.index.filter("variable = 'store_nbr'").collect()}
    assert sorted(index) == list(range(2500))
    for r in made.select("id", "store_nbr_index", "store_nbr_index_lag_1").collect():
        assert index[r[1]] == r[0] % 2500
        assert r[0] == 0 or index[r[2]] in (r[0] % 2500, (r[0] - 1) % 2500)


def test_load_star(spark, small):
    tables = star(spark, small)
    assert "sales" not in load_star(tables, 10)["sales"].columns and load_star(tables, 10)["sales"].count() == 10
    assert load_star(tables, "full", drop_sales=False)["sales"].count() == tables["sales"].count()


@pytest.fixture(scope="module")
def line(spark):
    return spark.range(60).selectExpr("id AS p", "CAST(id AS DOUBLE) AS x", "2 * id + 1.0D AS y", "id % 2 AS odd")


def test_a_line_is_found_in_every_fold(line):
    per_fold = cross_validate(linear_model(["x"], "y"), ordered_folds(line, "p", 4), "y", range(4)).collect()
    assert len(per_fold) == 8 and all(r["r2"] == pytest.approx(1) and r["rmse"] == pytest.approx(0, abs=1e-6) for r in per_fold)
    model = linear_model(["x"], "y").fit(line)
    assert with_residual(predict(model, line), "y").filter("abs(residual) > 1e-6").count() == 0
    assert score_rows(model, line.drop("y"), "p", "y").columns == ["p", "y"]


def test_growing_folds_leave_the_first_rows_unpredicted(line):
    predicted = out_of_fold(linear_model(["x"], "y"), time_series_folds(line, "p", 5), range(5), growing=True)
    assert predicted.count() == 50 and predicted.agg(F.min("p")).first()[0] == 10


def test_scores_equal_their_definition(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 4.0)], "y double, prediction double")
    row = scores(df, "y").first()
    assert row["r2"] == pytest.approx(1 - 2 / 8) and row["neg_mean_squared_error"] == pytest.approx(-2 / 3)
    assert scores(df.filter("y = 1"), "y").first()["r2"] is None


def test_search_and_trees(line):
    fitted, trials = search(["x"], "y", ordered_folds(line, "p", 3), 3, {"fitIntercept": [True, False]})
    best = trials.filter("is_best").first()
    assert best["fitIntercept"] == "True" and trials.count() == 2
    assert predict(fitted.bestModel, line).count() == 60
    model = boosted_trees(["x", "odd"], "y", maxIter=3, maxDepth=2).fit(line)
    assert scores(predict(model, line), "y").first()["r2"] > 0.5


def test_hold_out_shares_are_exact(spark):
    frame = spark.range(3000)
    assert hold_out(frame, "id", 1 / 3).filter("is_test").count() == 1000
    assert hold_out(frame, "id", 0.2).filter("is_test").count() == 600


def test_a_category_named_like_the_null_mark_is_refused(spark):
    frame = spark.createDataFrame([("nan",), (None,)], "c string")
    for in_place in (True, False):
        with pytest.raises(ValueError):
            OneHotColumns(columns=["c"], inPlace=in_place).fit(frame).transform(frame)


def test_one_trial_is_the_best(spark):
    frame = spark.range(60).select((F.col("id") * 2.0).alias("y"), F.col("id").cast("double").alias("x"), (F.col("id") % 2).cast("int").alias("fold"))
    _, trials = search(["x"], "y", frame, 2, {"standardization": [True, False]})
    assert trials.filter("is_best").count() == 1
