"""Regression models on ordered folds: fit, score, validate, search."""

from __future__ import annotations

import hashlib
import itertools
import json
from collections.abc import Iterator, Mapping, Sequence
from typing import Any

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.columns import quoted
from shelfcast.operators.joins import stack_rows
from shelfcast.operators.ordering import dense_position
from shelfcast.operators.splits import hold_out, in_train
from shelfcast.shared import written_table


def linear_model(features: Sequence[str], label: str, **params: Any) -> Pipeline:
    """Least squares by the normal equations."""
    return _with_vector(features, LinearRegression(featuresCol="_features", labelCol=label, solver="normal", **params))


def boosted_trees(features: Sequence[str], label: str, seed: int = 42, **params: Any) -> Pipeline:
    return _with_vector(features, GBTRegressor(featuresCol="_features", labelCol=label, seed=seed, **params))


def _with_vector(features: Sequence[str], regressor: Estimator) -> Pipeline:
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="_features"), regressor])


def predict(model: Model, rows: DataFrame) -> DataFrame:
    """The rows with their ``prediction``."""
    return model.transform(rows).drop("_features")


def coefficients(model: Any) -> dict[str, Any]:
    fitted = model.stages[-1]
    return {"intercept": float(fitted.intercept), "coefficients": [float(c) for c in fitted.coefficients]}


def score_columns(label: str, prediction: str = "prediction") -> dict[str, Column]:
    """R2, RMSE and negative mean squared error as aggregates."""
    truth = F.col(label).cast("double")
    squared = F.pow(truth - F.col(prediction), 2)
    error = F.sum(squared)
    spread = F.var_pop(truth) * F.count(truth)
    return {
        "r2": 1 - error / F.nullif(spread, F.lit(0.0)),
        "rmse": F.sqrt(F.avg(squared)),
        "neg_mean_squared_error": -F.avg(squared),
    }


def scores(predictions: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Scores of all predictions, or per group."""
    return predictions.groupBy(*by).agg(*[c.alias(n) for n, c in score_columns(label).items()])


def with_residual(predictions: DataFrame, label: str) -> DataFrame:
    return predictions.withColumn("residual", F.col(label) - F.col("prediction"))


def read_by(stages: Sequence[Any]) -> list[str] | None:
    """The columns that the stages read of their input; ``None`` where a stage does not tell."""
    read, made = {}, set()
    for stage in stages:
        if isinstance(stage, VectorAssembler):
            own, out = stage.getInputCols(), stage.getOutputCol()
        elif isinstance(stage, (LinearRegression, GBTRegressor)):
            own, out = [stage.getFeaturesCol(), stage.getLabelCol()], stage.getPredictionCol()
            own += [stage.getOrDefault(p) for p in stage.params if p.name in ("weightCol", "validationIndicatorCol") and stage.isDefined(p)]
        else:
            return None
        read |= dict.fromkeys(c for c in own if c not in made)
        made.add(out)
    return list(read)


def only_read(rows: DataFrame, stages: Sequence[Any], also: Sequence[str] | None) -> DataFrame:
    """The columns of ``rows`` that the stages or ``also`` name; all where a stage does not tell or ``also`` is None."""
    read = read_by(stages)
    return rows if read is None or also is None else rows.select(*[quoted(c) for c in dict.fromkeys([*also, *read])])


def fit_stored(pipeline: Pipeline, rows: DataFrame, also: Sequence[str] | None = None) -> tuple[PipelineModel, DataFrame]:
    """``pipeline`` fitted on ``rows``, and the rows that its last stage is fitted on, stored.

    A regressor goes through its rows several times; they are prepared and made into vectors once.  What is stored can be
    predicted by the last stage alone; ``also`` restricts it to these columns and those that the last stage reads.
    """
    *before, last = pipeline.getStages()
    fitted = Pipeline(stages=before).fit(rows)
    made = written_table(only_read(fitted.transform(rows), [last], also), "prepared")
    return PipelineModel([*fitted.stages, last.fit(made)]), made


def fit_prepared(pipeline: Pipeline, rows: DataFrame) -> tuple[PipelineModel, DataFrame]:
    """``pipeline`` fitted on ``rows``, and these as its first stage has made them, for the further stages to predict.

    What that stage writes on the way, such as rows in order, is written once for both.
    """
    first, *rest = pipeline.getStages()
    model = first.fit(rows)
    made = model.transform(rows)
    return PipelineModel([model, *Pipeline(stages=rest).fit(made).stages]), made


def fold_models(
    estimator: Estimator, rows: DataFrame, folds: Sequence[int], fold_column: str = "fold", growing: bool = False,
    also: Sequence[str] | None = None,
) -> Iterator[tuple[int, Model, DataFrame]]:
    """Of each fold the model of its training rows, and these as the model's first stage has made them.

    Where a pipeline begins with a stage that can fit all folds in one pass (``fit_folds``), it does; that stage's output
    is stored, so that the rest is fitted on it and the training rows are predicted from it without preparing them again.
    ``also`` restricts what is stored to these columns and those that the rest reads.
    """
    stages = estimator.getStages() if isinstance(estimator, Pipeline) else []
    first = stages[0].fit_folds(rows, folds, fold_column, growing) if stages and hasattr(stages[0], "fit_folds") else {}
    for fold in folds:
        train = rows.filter(in_train(fold_column, fold, growing))
        if fold not in first:
            yield fold, estimator.fit(train), train
            continue
        made = written_table(only_read(first[fold].transform(train.drop(fold_column)), stages[1:], also), "prepared")
        rest = Pipeline(stages=stages[1:]).fit(made)
        yield fold, PipelineModel([first[fold], *rest.stages]), made


def fold_predictions(
    estimator: Estimator,
    rows: DataFrame,
    folds: Sequence[int],
    fold_column: str = "fold",
    growing: bool = False,
    train_too: bool = True,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Fit once per fold and predict its test rows (and training rows), with ``in_fold`` and ``side``.

    Each fit runs over the executors; the rows are computed once and written by fold, so that a side reads its own
    folds only.  A stage that looks at neighbouring rows sees those of the side, as it would if the side were a table.
    ``columns`` names those that are wanted beside the prediction; all by default.
    """
    rows = written_table(rows, "folds", [fold_column])
    made = []
    for fold, model, train in fold_models(estimator, rows, folds, fold_column, growing, columns if train_too else []):
        test = rows.filter(F.col(fold_column) == fold)
        prepared = isinstance(model, PipelineModel) and fold_column not in train.columns
        sides = {"test": predict(model, test.drop(fold_column) if prepared else test)}
        if train_too:
            sides["train"] = predict(PipelineModel(model.stages[1:]) if prepared else model, train)
        if columns is not None:
            sides = {side: part.select(*columns, "prediction") for side, part in sides.items()}
        made += [part.withColumns({"in_fold": F.lit(fold), "side": F.lit(side)}) for side, part in sides.items()]
    return stack_rows(*made)


def cross_validate(
    estimator: Estimator, rows: DataFrame, label: str, folds: Sequence[int], fold_column: str = "fold",
    growing: bool = False,
) -> DataFrame:
    """Train and test scores of every fold: ``in_fold, side, r2, rmse, neg_mean_squared_error``."""
    predicted = fold_predictions(estimator, rows, folds, fold_column, growing, columns=[label])
    return scores(predicted, label, ["in_fold", "side"])


def average_scores(per_fold: DataFrame) -> DataFrame:
    """Mean of each score over the folds, per side."""
    return per_fold.groupBy("side").agg(
        *[F.avg(c).alias(f"avg_{c}") for c in ("r2", "rmse", "neg_mean_squared_error")]
    )


def out_of_fold(
    estimator: Estimator, rows: DataFrame, folds: Sequence[int], fold_column: str = "fold", growing: bool = False
) -> DataFrame:
    """One prediction per row from the model that did not see it.

    Growing folds leave the rows before the first test block without one.
    """
    return fold_predictions(estimator, rows, folds, fold_column, growing, train_too=False).drop("side", "in_fold")


def actual_and_predicted(predictions: DataFrame, label: str, keys: Sequence[str]) -> DataFrame:
    """What a chart of a validation needs."""
    return predictions.select(*keys, "in_fold", "side", F.col(label).alias("actual"), "prediction")


def validate_outside(estimator: Estimator, train: DataFrame, outside: DataFrame, label: str) -> DataFrame:
    """Fit on one slice, score on a later one."""
    return scores(predict(estimator.fit(train), outside), label)


def search(
    features: Sequence[str], label: str, rows: DataFrame, folds: int, grid: Mapping[str, Sequence[Any]],
    fold_column: str = "fold", metric: str = "mse", parallelism: int = 2,
) -> tuple[CrossValidatorModel, DataFrame]:
    """Try every combination on the given folds, keep the one with the best mean score, refit it on all rows.

    Returns the fitted search and its trials: parameters, mean score, whether it won.
    """
    pipeline = linear_model(features, label)
    regressor = pipeline.getStages()[-1]
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(regressor.getParam(name), list(values))
    evaluator = RegressionEvaluator(labelCol=label, metricName=metric)
    validator = CrossValidator(
        estimator=pipeline, estimatorParamMaps=builder.build(), evaluator=evaluator, numFolds=folds,
        foldCol=fold_column, parallelism=parallelism,
    )
    fitted = validator.fit(rows)
    means = fitted.avgMetrics
    best = means.index((max if evaluator.isLargerBetter() else min)(means))  # the first, as the search itself picks
    names = list(grid)
    trials = [
        tuple(str(values[n]) for n in names) + (float(score), place == best)
        for place, (values, score) in enumerate(zip(
            [{p.name: v for p, v in m.items()} for m in fitted.getEstimatorParamMaps()], means
        ))
    ]
    schema = ", ".join([*[f"`{n}` string" for n in names], f"mean_{metric} double", "is_best boolean"])
    return fitted, rows.sparkSession.createDataFrame(trials, schema)


class Trials:
    """Trials over a pipeline's parameters that share what their pipelines have in common.

    The stages of all trials form a graph: a node is a fold, the digest of the parameters of all stages so far, and that
    stage fitted on what the node before it has stored.  Two trials that differ in the regressor only prepare the rows
    once.  A node's rows are stored where another stage follows; the last stage's models are fitted and scored from them.
    With ``also`` only these columns are stored and those that the further stages read in any of the ``combinations``.
    """

    def __init__(
        self, stages: Sequence[Any], rows: DataFrame, folds: Sequence[int], fold_column: str = "fold", growing: bool = False,
        also: Sequence[str] | None = None, combinations: Sequence[Mapping[Param, Any]] = ({},),
    ):
        self.also, self.combinations = also, combinations
        self.stages, self.folds = list(stages), list(folds)
        self.rows = written_table(rows, "folds", [fold_column])
        self.fold_column, self.growing = fold_column, growing
        self.nodes: dict[tuple, tuple[Any, DataFrame, DataFrame]] = {}
        self.first: dict[str, dict[int, Model]] = {}

    def _digest(self, upto: int, params: Mapping[Param, Any]) -> str:
        own = [sorted((p.name, str(params.get(p, stage.getOrDefault(p) if stage.isDefined(p) else None))) for p in stage.params) for stage in self.stages[: upto + 1]]
        return hashlib.sha256(json.dumps([[type(s).__name__, o] for s, o in zip(self.stages, own)]).encode()).hexdigest()

    def _fit(self, fold: int, upto: int, params: Mapping[Param, Any], train: DataFrame) -> Any:
        stage = self.stages[upto]
        if upto == 0 and hasattr(stage, "fit_folds"):
            key = self._digest(0, params)
            if key not in self.first:
                self.first[key] = stage.copy(dict(params)).fit_folds(self.rows, self.folds, self.fold_column, self.growing)
            return self.first[key][fold]
        return stage.copy(dict(params)) if isinstance(stage, Transformer) else stage.fit(train, dict(params))

    def sides(self, fold: int, upto: int, params: Mapping[Param, Any]) -> tuple[Any, DataFrame, DataFrame]:
        """The fitted stage ``upto`` of a trial in a fold, and the training and test rows that it has made."""
        if upto < 0:
            rows, own = self.rows, F.col(self.fold_column)
            return None, rows.filter(in_train(self.fold_column, fold, self.growing)).drop(self.fold_column), rows.filter(own == fold).drop(self.fold_column)
        key = (fold, upto, self._digest(upto, params))
        if key not in self.nodes:
            _, train, test = self.sides(fold, upto - 1, params)
            own = {p: v for p, v in params.items() if self.stages[upto].hasParam(p.name) and p.parent == self.stages[upto].uid}
            model = self._fit(fold, upto, own, train)
            made = [model.transform(part) for part in (train, test)]
            # what a plain column step makes is cheaper made again than stored
            if upto < len(self.stages) - 1 and not isinstance(self.stages[upto], Transformer):
                further = [s.copy(dict(c)) for c in self.combinations for s in self.stages[upto + 1 :]]
                made = [written_table(only_read(part, further, self.also), "trial-stage") for part in made]
            self.nodes[key] = (model, *made)
        return self.nodes[key]


def search_pipeline(
    pipeline: Pipeline, grid: Mapping[Param, Sequence[Any]], rows: DataFrame, label: str, folds: Sequence[int], fold_column: str = "fold",
    growing: bool = False, metric: str = "neg_mean_squared_error",
) -> tuple[PipelineModel, DataFrame]:
    """Try every combination of parameters of any stages on the given folds; the best mean test score wins, the first of equals.

    Returns the pipeline refitted on all rows with the best parameters, and the trials: parameters as text, the mean
    score (higher is better), how many folds it is the mean of, whether it won.  A combination is a column per
    parameter, named ``<stage number>_<parameter>``.
    """
    stages = pipeline.getStages()
    combinations = [dict(zip(grid, values)) for values in itertools.product(*grid.values())]
    trials = Trials(stages, rows, folds, fold_column, growing, [label], combinations)
    place = {p: f"{[s.uid for s in stages].index(p.parent)}_{p.name}" for p in grid}
    means = []
    for params in combinations:
        predicted = [trials.sides(f, len(stages) - 1, params)[2].select(label, "prediction").withColumn("in_fold", F.lit(f)) for f in folds]
        per_fold = scores(stack_rows(*predicted), label, ["in_fold"])
        means.append(per_fold.agg(F.avg(metric), F.count(metric)).first())
    scored = [m[0] for m in means if m[0] is not None]
    # sums of the same numbers in another order may differ in their last digits
    best = next((k for k, m in enumerate(means) if m[0] is not None and m[0] >= max(scored) - 1e-9 * abs(max(scored))), 0)
    table = [
        tuple(str(params[p]) for p in grid) + (means[k][0], means[k][1], k == best) for k, params in enumerate(combinations)
    ]
    schema = ", ".join([*[f"`{place[p]}` string" for p in grid], f"mean_{metric} double", "folds bigint", "is_best boolean"])
    best_pipeline, stored = pipeline.copy(combinations[best]), trials.rows.drop(fold_column)
    prepares = len(stages) > 1 and isinstance(stages[0], Estimator)
    won = fit_stored(best_pipeline, stored, [])[0] if prepares else best_pipeline.fit(stored)
    return won, rows.sparkSession.createDataFrame(table, schema)


def score_rows(model: Model, rows: DataFrame, key: str = "id", name: str = "sales") -> DataFrame:
    """The answer file: key and prediction."""
    return predict(model, rows).select(key, F.col("prediction").alias(name))


def daily_baseline(sales: DataFrame, share: float = 0.2, date: str = "date", target: str = "sales") -> DataFrame:
    """One series, day index to total: a straight line fitted on the first days, predicted for all.

    Days are numbered without gaps; the last ``share`` of them are the test.
    """
    daily = daily_totals(sales, date, target)
    numbered = hold_out(dense_position(daily, [date], "days_since_start"), "days_since_start", share)
    model = linear_model(["days_since_start"], target).fit(numbered.filter(~F.col("is_test")))
    return predict(model, numbered).select("days_since_start", target, "is_test", "prediction")


def daily_totals(sales: DataFrame, date: str = "date", target: str = "sales") -> DataFrame:
    return sales.groupBy(date).agg(F.sum(target).alias(target))
