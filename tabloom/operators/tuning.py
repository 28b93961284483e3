"""Hyperparameter search."""

from __future__ import annotations

import statistics
from collections.abc import Mapping, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.tuning import (
    CrossValidatorModel,
    ParamGridBuilder,
    TrainValidationSplit,
    TrainValidationSplitModel,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions import quoted
from tabloom.operators import fold_sums
from tabloom.operators.preprocessing import with_estimator
from tabloom.operators.scoring import keep_all_rows
from tabloom.operators.split import cached, hash_fold, hash_part, hash_split, training_rows
from tabloom.sources import runlog


def param_grid(model, values: Mapping[str, Sequence[object]]) -> list[dict]:
    """All combinations of the named parameters' values."""

    def add(builder: ParamGridBuilder, item) -> ParamGridBuilder:
        name, choices = item
        return builder.addGrid(model.getParam(name), list(choices))

    return reduce(add, values.items(), ParamGridBuilder()).build()


def _fit_all(model, grid, train, validation, evaluator, preprocessing, parallelism):
    """Scores of all combinations on one split. The preprocessing is fitted once.

    Only where the grid names a parameter of the preprocessing, all of it is fitted each time.
    """
    own = all(p.parent == model.uid for params in grid for p in params)
    if preprocessing is None or not own:
        estimator = with_estimator(preprocessing, model)
        prepared = (train, validation)
    else:
        estimator, fitted = model, preprocessing.fit(train)
        # Outlier filters choose training rows; every held-out row is judged.
        prepared = (fitted.transform(train), keep_all_rows(fitted).transform(validation))
    with cached(*prepared) as (ready, held_out):

        def score(params: dict) -> float:
            return evaluator.evaluate(estimator.fit(ready, params).transform(held_out))

        with ThreadPool(max(1, min(parallelism, len(grid)))) as pool:
            return pool.map(score, grid)


def cross_validate(
    model,
    grid: list[dict],
    data: DataFrame,
    evaluator: Evaluator,
    folds: int = 3,
    preprocessing: Pipeline | None = None,
    fold_key: str | Sequence[str] | None = None,
    parallelism: int = 2,
    seed: int = 42,
) -> CrossValidatorModel:
    """Cross-validation; the preprocessing is fitted inside every fold, once.

    With ``fold_key`` the folds follow the hash of a row key, else a seeded hash of the whole
    row. ``fold_scores`` of the result holds the scores by fold and combination. Where a model
    follows from sums by fold, one pass gives the scores of all folds and combinations.
    """
    whole_row = F.pmod(F.xxhash64(F.lit(seed), *[quoted(c) for c in data.columns]), F.lit(folds))
    fold = whole_row if fold_key is None else hash_fold(fold_key, folds)
    folded = data.withColumn("__fold", fold.cast("int"))
    summed = fold_sums.scores(
        model, grid, folded, evaluator, preprocessing, "__fold", list(range(folds))
    )

    def chosen(scores: list[list[float]]) -> dict:
        means = [statistics.fmean(s) for s in zip(*scores)]
        return grid[best_index(means, evaluator.isLargerBetter())]

    estimator = with_estimator(preprocessing, model)
    if summed is not None:
        scores, fitted = summed, estimator.fit(data, chosen(summed))
    else:
        with training_rows(folded) as rows:
            scores = []
            for i in range(folds):
                rest = rows.filter(F.col("__fold") != i).drop("__fold")
                held_out = rows.filter(F.col("__fold") == i).drop("__fold")
                scores.append(
                    _fit_all(model, grid, rest, held_out, evaluator, preprocessing, parallelism)
                )
            fitted = estimator.fit(rows.drop("__fold"), chosen(scores))
    means = [statistics.fmean(s) for s in zip(*scores)]
    spread = [statistics.pstdev(s) for s in zip(*scores)]
    search = CrossValidatorModel(fitted, means, None, spread)
    search._set(numFolds=folds)
    search.fold_scores = scores
    return search


def train_validation(
    model,
    grid: list[dict],
    data: DataFrame,
    evaluator: Evaluator,
    train_ratio: float = 0.8,
    preprocessing: Pipeline | None = None,
    split_key: str | Sequence[str] | None = None,
    parallelism: int = 2,
    seed: int = 42,
) -> TrainValidationSplitModel:
    """Search on one split; by the hash of ``split_key`` if given, else seeded."""
    estimator = with_estimator(preprocessing, model)
    if split_key is None:
        search = TrainValidationSplit(
            estimator=estimator,
            estimatorParamMaps=grid,
            evaluator=evaluator,
            trainRatio=train_ratio,
            seed=seed,
            parallelism=parallelism,
        )
        with training_rows(data) as rows:
            return search.fit(rows)
    shares = [train_ratio, 1 - train_ratio]
    folded = data.withColumn("__fold", hash_part(split_key, shares))
    summed = fold_sums.scores(model, grid, folded, evaluator, preprocessing, "__fold", [0, 1])
    if summed is not None:
        best = grid[best_index(summed[1], evaluator.isLargerBetter())]
        return TrainValidationSplitModel(estimator.fit(data, best), summed[1])
    with training_rows(data) as rows:
        train, validation = hash_split(rows, split_key, shares)
        scores = _fit_all(model, grid, train, validation, evaluator, preprocessing, parallelism)
        best = grid[best_index(scores, evaluator.isLargerBetter())]
        return TrainValidationSplitModel(estimator.fit(rows, best), scores)


def best_index(scores: Sequence[float], larger: bool) -> int:
    """Position of the best score, the first one on ties; NaN never wins."""
    ranked = [i for i, s in enumerate(scores) if s == s]
    if not ranked:
        raise ValueError("no combination has a score")
    return (max if larger else min)(ranked, key=lambda i: scores[i])


def scores_of(search: CrossValidatorModel | TrainValidationSplitModel) -> list[float]:
    if isinstance(search, CrossValidatorModel):
        return list(search.avgMetrics)
    return list(search.validationMetrics)


def best_score(search, evaluator: Evaluator) -> float:
    scores = scores_of(search)
    return scores[best_index(scores, evaluator.isLargerBetter())]


def grid_results(spark, search, grid: list[dict]) -> DataFrame:
    """``combo, params, metric``: one row per combination of the search."""
    rows = [
        (i, {p.name: str(v) for p, v in params.items()}, float(score))
        for i, (params, score) in enumerate(zip(grid, scores_of(search)))
    ]
    return spark.createDataFrame(rows, "combo int, params map<string,string>, metric double")


def fold_results(spark, search: CrossValidatorModel, grid: list[dict]) -> DataFrame:
    """``combo, fold, params, metric``: one row per combination and fold."""
    rows = [
        (i, fold, {p.name: str(v) for p, v in params.items()}, float(scores[i]))
        for fold, scores in enumerate(search.fold_scores)
        for i, params in enumerate(grid)
    ]
    shape = "combo int, fold int, params map<string,string>, metric double"
    return spark.createDataFrame(rows, shape)


def search_entries(
    spark,
    search,
    grid: list[dict],
    evaluator: Evaluator,
    run_name: str,
    seconds: float,
    experiment: str | None = None,
) -> DataFrame:
    """The search as run-log rows: what was tried, the best score and its parameters."""
    scores = scores_of(search)
    best = best_index(scores, evaluator.isLargerBetter())
    params = {
        "n_combinations": len(grid),
        "metric": evaluator.getMetricName(),
        **{f"best_{p.name}": v for p, v in grid[best].items()},
    }
    if isinstance(search, CrossValidatorModel):
        params["num_folds"] = search.getNumFolds()
    values = {"search_time_seconds": seconds, "best_score": scores[best]}
    # The whole grid: what each combination was, and its score in every fold.
    for i, combo in enumerate(grid):
        params |= {f"combo_{i}_{p.name}": v for p, v in combo.items()}
        values[f"combo_{i}_score"] = scores[i]
        for fold, held in enumerate(getattr(search, "fold_scores", [])):
            values[f"combo_{i}_fold_{fold}"] = held[i]
    return runlog.entries(spark, run_name, params, values, experiment)


def best_combo(results: DataFrame, larger: bool, by: str = "combo", metric: str = "metric"):
    """The best row of a table of scores per combination and fold, folds averaged."""
    average = F.avg(metric)
    scored = results.groupBy(by).agg(average.alias("avg_metric"))
    value = F.col("avg_metric")
    return (
        scored.filter(value.isNotNull() & ~F.isnan(value))
        .orderBy(value.desc() if larger else value.asc(), by)
        .limit(1)
    )
