"""Preparation as an estimator, categories without a limit, validation and search over whole pipelines."""

from __future__ import annotations

import os

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from shelfcast.operators.lags import rolling_window
from shelfcast.operators.splits import in_train, ordered_folds
from shelfcast.plans.features import Preparation, merged_features
from shelfcast.plans.indexing import IndexColumns, IndexColumnsModel, replace_by_number
from shelfcast.plans.models import Trials, boosted_trees, cross_validate, fit_stored, fold_models, linear_model, predict, scores, search_pipeline
from shelfcast.plans.preparation import PrepareFeatures, PrepareFeaturesModel
from shelfcast.plans.stages import ColumnDropper, FunctionStep, fill_numbers, prefix
from shelfcast.queries.encodings import with_gaps
from shelfcast.queries.views import star
from shelfcast.shared import fresh_path, written_table
from tests.conftest import rows


@pytest.fixture(scope="module")
def merged(spark, small):
    return written_table(merged_features(star(spark, small), refine_days=True), "merged")


def test_preparation_stands_in_a_pipeline_is_cut_saved_and_loaded(spark, merged):
    early, late = merged.filter("date < DATE'1996-06-01'"), merged.filter("date >= DATE'1996-06-01'")
    steps = Pipeline(stages=[PrepareFeatures(windowSize=2, constant=0.25, bucketRows=700), ColumnDropper(columns=["id"])])
    unfitted = fresh_path(spark, "steps")
    steps.write().save(unfitted)
    model = Pipeline.load(unfitted).fit(early)
    assert model.stages[0].preparation() == Preparation(window_size=2, constant=0.25, bucket_rows=700, order=list(Preparation().order),
                                                        categories=list(Preparation().categories), scaled=list(Preparation().scaled))
    path = fresh_path(spark, "model")
    model.write().save(path)
    loaded = PipelineModel.load(path)
    assert isinstance(loaded.stages[0], PrepareFeaturesModel)
    assert rows(loaded.transform(late)) == rows(model.transform(late))
    assert rows(loaded.stages[0].table) == rows(model.stages[0].table)
    assert "id" in prefix(model, 1).transform(late).columns and "id" not in model.transform(late).columns
    first = Preparation(window_size=2, constant=0.25, bucket_rows=700)
    assert rows(first.transform(late, first.fit(early)).drop("id")) == rows(loaded.transform(late))


def plain_lags(values, k):
    """A shift, then each gap takes the next known value of the shifted column."""
    shifted = [None] * min(k, len(values)) + values[: max(len(values) - k, 0)]
    for i in range(len(shifted) - 2, -1, -1):
        if shifted[i] is None:
            shifted[i] = shifted[i + 1]
    return shifted


@pytest.mark.parametrize("values", [[5.0, None, 7.0, 9.0], [None, None, 1.0, None], [3.0], [None, 2.0], [None] * 4, [1.0, None, None, None, 4.0, None]])
def test_lags_over_gaps_are_those_of_the_rolling_window(spark, values):
    days = [(i, f"2020-01-{i + 1:02}", v, float(i), i) for i, v in enumerate(values)]
    frame = spark.createDataFrame(days, "id bigint, date string, sales double, oil_price double, all_products_transactions int")
    frame = frame.withColumns({"date": F.to_date("date"), "special_day_offset": F.lit(0), "day_type": F.lit("x")})
    for rows_in_bucket in (2, 50_000):
        preparation = Preparation(window_size=4, categories=("day_type",), order=("id",), bucket_rows=rows_in_bucket)
        made = preparation.transform(frame, preparation.fit(frame)).orderBy("id").collect()
        other = rolling_window(frame.select("id", "sales"), 4, "id", bucket_rows=rows_in_bucket).orderBy("id").collect()
        for k in (1, 2, 3):
            expected = plain_lags(values, k)
            assert [r[f"sales_lag_{k}"] for r in made] == expected
            assert [r[f"sales_lag_{k}"] for r in other] == expected


def test_a_missing_category_stays_missing_in_its_lag(spark, small):
    merged = merged_features(with_gaps(star(spark, small)), refine_days=True)
    made = PrepareFeatures(windowSize=2).fit(merged).transform(merged)
    assert made.filter("day_type_index_lag_1 IS NULL").count() > 1000
    assert made.filter("sales IS NULL").count() > 100
    assert made.filter("sales_lag_1 IS NULL").count() <= 2  # the shifted column ends in a gap


def test_fits_of_all_folds_in_one_pass_are_the_fits_of_each(spark, small):
    tables = star(spark, small)
    parted = merged_features(tables | {"sales": ordered_folds(tables["sales"], "id", 4)}, refine_days=True)
    for growing in (False, True):
        folds = range(1, 4)
        found = Preparation().fit_folds(parted, folds, growing=growing)
        for f in folds:
            alone = Preparation().fit(parted.filter(in_train("fold", f, growing)).drop("fold"))
            assert (found[f].origin, found[f].bounds, found[f].sizes) == (alone.origin, alone.bounds, alone.sizes)
            assert rows(found[f].index.select("variable", "value", "number")) == rows(alone.index)


def test_ten_thousand_categories_as_sparse_slots(spark):
    frame = spark.range(30_000).select(
        F.when(F.col("id") % 11 > 0, F.concat(F.lit("c"), F.col("id") % 10_000)).alias("c"), (F.col("id") % 2 == 0).alias("f"), "id"
    )
    model = IndexColumns(columns=["c", "f"], suffix="_v", vectors=True).fit(frame)
    path = fresh_path(spark, "index")
    model.write().save(path)
    loaded = IndexColumnsModel.load(path)
    assert loaded.slots() == {"c": 10_002, "f": 4}
    other = spark.createDataFrame([("c17", True, 1), (None, None, 2), ("new", False, 3)], "c string, f boolean, id bigint")
    number = {r["value"]: r["number"] for r in model.table.filter("variable = 'c'").collect()}
    made = {r["id"]: r for r in loaded.transform(other).collect()}
    assert made[1]["c_v"].indices.tolist() == [number["c17"]] and made[1]["c_v"].size == 10_002
    assert made[2]["c_v"].indices.tolist() == [10_000] and made[3]["c_v"].indices.tolist() == [10_001]
    assert made[2]["f_v"].indices.tolist() == [2] and made[1]["f_v"].toArray().sum() == 1
    assert loaded.transform(other).columns == ["c", "f", "id", "c_v", "f_v"]
    assert loaded.transform(frame).filter("c_v IS NULL").count() == 0


def test_numbers_by_broadcast_and_by_shuffle_are_the_same(spark):
    frame = spark.range(500).select("id", (F.col("id") % 7).cast("string").alias("a"), F.when(F.col("id") % 3 > 0, (F.col("id") % 50).cast("string")).alias("b"))
    model = IndexColumns(columns=["a", "b"]).fit(frame)
    sizes = model.getSizes()
    made = [rows(replace_by_number(frame, model.table, sizes, ["a", "b"], limit)) for limit in (0, sizes["a"][1], 1 << 20)]
    assert made[0] == made[1] == made[2]
    assert rows(model.transform(frame), "id", "a_index", "b_index") == made[0]


@pytest.fixture(scope="module")
def folded(spark):
    frame = spark.range(90).select(F.col("id").alias("p"), (F.col("id") % 9).cast("double").alias("x"), (F.col("id") * 1.0).alias("z"))
    return ordered_folds(frame.withColumn("y", F.col("x") * 2 + F.when(F.col("p") % 2 == 0, 0.5).otherwise(-0.5)), "p", 3)


def test_search_shares_what_trials_have_in_common(spark, folded, monkeypatch):
    from pyspark.ml.feature import MinMaxScaler, VectorAssembler

    fits = []
    for kind in (MinMaxScaler, LinearRegression):
        monkeypatch.setattr(kind, "_fit", lambda self, rows, own=kind._fit, name=kind.__name__: fits.append(name) or own(self, rows))
    assembler = VectorAssembler(inputCols=["x"], outputCol="v")
    scaler = MinMaxScaler(inputCol="v", outputCol="_features")
    line = LinearRegression(featuresCol="_features", labelCol="y", solver="normal")
    grid = {assembler.inputCols: [["z"], ["x"]], line.fitIntercept: [True, False]}
    won, trials = search_pipeline(Pipeline(stages=[assembler, scaler, line]), grid, folded, "y", range(3))
    assert fits.count("MinMaxScaler") == 2 * 3 + 1 and fits.count("LinearRegression") == 4 * 3 + 1
    best = trials.filter("is_best").collect()
    assert len(best) == 1 and best[0]["0_inputCols"] == "['x']" and best[0]["folds"] == 3
    means = {(r["0_inputCols"], r["2_fitIntercept"]): r["mean_neg_mean_squared_error"] for r in trials.collect()}
    for columns in (["z"], ["x"]):
        alone = cross_validate(linear_model(columns, "y"), folded, "y", range(3)).filter("side = 'test'")
        assert means[str(columns), "True"] == pytest.approx(alone.agg(F.avg("neg_mean_squared_error")).first()[0])
    assert scores(won.transform(folded), "y").first()["r2"] > 0.99


def test_prepared_folds_fit_the_rest_on_what_was_stored(spark, small):
    tables = star(spark, small)
    parted = written_table(merged_features(tables | {"sales": ordered_folds(tables["sales"], "id", 2)}, refine_days=True), "folds", ["fold"])
    steps = Pipeline(stages=[PrepareFeatures(windowSize=2), *linear_model(["sales_lag_1"], "sales").getStages()])
    for fold, model, made in fold_models(steps, parted, range(2)):
        alone = steps.fit(parted.filter(F.col("fold") != fold).drop("fold"))
        assert model.stages[-1].coefficients[0] == pytest.approx(alone.stages[-1].coefficients[0])
        assert "fold_lag_1" not in made.columns
    trials = Trials(steps.getStages(), parted, range(2))
    trials.sides(0, 2, {})
    trials.sides(0, 2, {steps.getStages()[2].fitIntercept: False})
    assert sorted(k[1] for k in trials.nodes) == [0, 1, 2, 2]


def test_one_tree_of_one_split_is_the_best_split(spark):
    points = [(float(x), float(y)) for x, y in [(1, 3), (2, 4), (3, 3), (4, 9), (5, 11), (6, 10)]]
    frame = spark.createDataFrame(points, "x double, y double")
    made = {r["x"]: r["prediction"] for r in predict(boosted_trees(["x"], "y", maxIter=1, maxDepth=1).fit(frame), frame).collect()}

    def loss(cut):
        sides = [[y for x, y in points if (x <= cut) == left] for left in (True, False)]
        return sum(sum((y - sum(s) / len(s)) ** 2 for y in s) for s in sides)

    cut = min([1, 2, 3, 4, 5], key=loss)
    for x, _ in points:
        side = [y for u, y in points if (u <= cut) == (x <= cut)]
        assert made[x] == pytest.approx(sum(side) / len(side))


def test_gaps_are_marked_for_trees(spark):
    frame = spark.createDataFrame([(None, 1), (2.5, None)], "a double, b int")
    assert rows(FunctionStep.of(fill_numbers, columns=["a", "b"]).transform(frame)) == [(-1.0, 1.0), (2.5, -1.0)]


def test_a_batch_is_added_to_stored_counts(spark):
    from shelfcast.plans.groups import CountedIndex
    from shelfcast.sources.warehouse import Warehouse

    def rows_of(ids, values):
        return spark.createDataFrame(list(zip(ids, values)), "id bigint, c string")

    warehouse, index = Warehouse(spark), CountedIndex("t", ("c",), ("id",), buckets=2)
    first = rows_of(range(6), ["a", "a", "a", "b", "b", "z"])
    index.start(warehouse, first)
    files = set(warehouse.current("t").inputFiles())
    second = rows_of(range(10, 16), ["z", "z", "z", "new", None, "a"])
    plan = index.merged(warehouse.current(index.counts), second)
    assert "c" not in plan.columns
    index.add(warehouse, second)
    got = {r["id"]: r["c_numeric"] for r in warehouse.current("t").collect()}
    refit = IndexColumns(columns=["c"]).fit(first.union(second)).transform(first.union(second))
    assert got == {r["id"]: r["c_index"] for r in refit.collect()}
    assert files <= set(warehouse.current("t").inputFiles())
    # only rows of categories that moved, and the new rows, have values in the last side table
    last = warehouse._stored("t").sides[-1][0]
    assert {r["id"] for r in spark.table(last).collect()} == {3, 4, 5, *range(10, 16)}


def test_buckets_grow_with_the_rows(spark):
    from shelfcast.plans.groups import CountedIndex
    from shelfcast.sources.warehouse import Warehouse

    warehouse, index = Warehouse(spark), CountedIndex("t", ("c",), ("id",), buckets=2, bucket_rows=10)
    parts = [spark.range(low, high).select("id", (F.col("id") % (7 + k)).cast("string").alias("c")) for k, (low, high) in enumerate([(0, 35), (35, 90), (90, 300)])]
    index.start(warehouse, parts[0])
    assert warehouse.rows_and_buckets("t") == (35, 4)
    index.add(warehouse, parts[1])
    assert warehouse.rows_and_buckets("t") == (90, 4)
    index.add(warehouse, parts[2])  # 300 rows are more than four times those of four buckets
    assert warehouse.rows_and_buckets("t") == (300, 30)
    together = parts[0].union(parts[1]).union(parts[2])
    refit = IndexColumns(columns=["c"]).fit(together).transform(together)
    assert rows(warehouse.current("t"), "id", "c", "c_numeric") == rows(refit, "id", "c", "c_index")


def test_a_pipeline_is_fitted_on_stored_vectors(spark, small, monkeypatch):
    merged = written_table(merged_features(star(spark, small), refine_days=True).limit(300), "merged")
    prepared, transform = [], PrepareFeaturesModel._transform
    monkeypatch.setattr(PrepareFeaturesModel, "_transform", lambda self, rows: prepared.append(1) or transform(self, rows))
    steps = Pipeline(stages=[PrepareFeatures(windowSize=2), *linear_model(["sales_lag_1"], "sales").getStages()])
    model, made = fit_stored(steps, merged, ["id"])
    found = rows(predict(model.stages[-1], made), "id", "prediction")
    assert len(prepared) == 1 and set(made.columns) == {"id", "_features", "sales"}
    wanted = rows(predict(steps.fit(merged), merged), "id", "prediction")
    assert [r[0] for r in found] == [r[0] for r in wanted] and [r[1] for r in found] == pytest.approx([r[1] for r in wanted])


def test_trials_store_what_later_stages_read(spark, small):
    merged = merged_features(star(spark, small), refine_days=True)
    folded = written_table(ordered_folds(merged.limit(200), "id", 2).withColumn("fold", (F.col("id") % 2).cast("int")), "folded")
    stages = [PrepareFeatures(windowSize=2), *linear_model(["sales_lag_1"], "sales").getStages()]
    _, train, test = Trials(stages, folded, range(1), also=["sales"]).sides(0, 0, {})
    assert set(train.columns) == set(test.columns) == {"sales", "sales_lag_1"}
    assert "day_of_week" in Trials(stages, folded, range(1)).sides(0, 0, {})[1].columns


def test_prepared_rows_meet_in_one_shuffle_and_fitted_rows_do_not_stay(spark, small):
    merged = written_table(merged_features(with_gaps(star(spark, small)), refine_days=True).limit(400), "merged")
    before = set(os.listdir(os.path.dirname(fresh_path(spark, "x"))))
    preparation = Preparation(window_size=3)
    fitted = preparation.fit(merged)
    left = set(os.listdir(os.path.dirname(fresh_path(spark, "x")))) - before
    assert {name.rsplit("-", 1)[0] for name in left} == {"category-index"}
    made = preparation.transform(merged, fitted)
    assert made._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(_bucket") == 1


def test_trees_of_the_query_prepare_their_rows_once(spark, small, monkeypatch):
    from shelfcast.queries import load_queries

    prepared, transform = [], PrepareFeaturesModel._transform
    monkeypatch.setattr(PrepareFeaturesModel, "_transform", lambda self, rows: prepared.append(1) or transform(self, rows))
    assert load_queries()["k11_boosted_trees"](spark, small).columns == ["id", "sales", "prediction"]
    assert len(prepared) == 1  # twice before: for the fit, and once more for the prediction
