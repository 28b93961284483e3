"""Estimators by name, and training that fits the preprocessing once."""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions import vector_item
from tabloom.operators import metrics
from tabloom.operators.scoring import keep_all_rows
from tabloom.operators.split import cached, training_rows
from tabloom.sources import runlog
from tabloom.sources.persistence import save_model

ESTIMATORS = {
    "classification": {
        "logistic": LogisticRegression,
        "random_forest": RandomForestClassifier,
        "gbt": GBTClassifier,
        "decision_tree": DecisionTreeClassifier,
        "naive_bayes": NaiveBayes,
        "svm": LinearSVC,
    },
    "regression": {
        "linear": LinearRegression,
        "random_forest": RandomForestRegressor,
        "gbt": GBTRegressor,
        "decision_tree": DecisionTreeRegressor,
    },
}


def positive_score(columns: Sequence[str]) -> Column:
    """What ranks rows by the positive class: its probability, or the raw score without one.

    Raw values of trees are counts of their leaf, and those of naive Bayes are not normalised, so
    they do not compare between rows.
    """
    return vector_item("probability" if "probability" in columns else "rawPrediction", 1)


def _columns_of(estimators: list, data: DataFrame) -> list[str]:
    """The columns of ``data`` that the estimators name in their parameters."""
    named = {
        e.getOrDefault(p)
        for e in estimators
        for p in e.params
        if p.name.endswith("Col") and e.isDefined(p)
    }
    return [c for c in data.columns if c in named]


class Trainer:
    """Trains, evaluates and logs models of one task.

    ``models`` and ``results`` keep the last outcome per model type. With ``run_log`` set
    to a path, every training appends its parameters and metrics there; with ``model_dir``
    it saves the fitted pipelines too.
    """

    def __init__(
        self,
        task: str,
        features_col: str = "features",
        label_col: str = "label",
        prediction_col: str = "prediction",
        run_log: str | None = None,
        model_dir: str | None = None,
    ) -> None:
        if task not in ESTIMATORS:
            raise ValueError(f"unknown task {task!r}, use one of {sorted(ESTIMATORS)}")
        self.task = task
        self.features_col = features_col
        self.label_col = label_col
        self.prediction_col = prediction_col
        self.run_log = run_log
        self.model_dir = model_dir
        self.models: dict[str, PipelineModel] = {}
        self.results: dict[str, dict] = {}

    def get_model(self, model_type: str, **params: object):
        """The estimator of that name; ``params`` win over the trainer's column names."""
        known = ESTIMATORS[self.task]
        if model_type not in known:
            raise ValueError(f"unknown model type {model_type!r}, use one of {sorted(known)}")
        columns = {
            "featuresCol": self.features_col,
            "labelCol": self.label_col,
            "predictionCol": self.prediction_col,
        }
        return known[model_type](**{**columns, **params})

    def train(
        self, model, data: DataFrame, preprocessing: Pipeline | None = None
    ) -> tuple[PipelineModel, float]:
        """The fitted pipeline and the seconds it took."""
        begin = time.monotonic()
        stages = []
        if preprocessing is not None:
            prepared = preprocessing.fit(data)
            stages, data = prepared.stages, prepared.transform(data)
        with training_rows(data.select(*_columns_of([model], data))) as ready:
            fitted = model.fit(ready)
        return PipelineModel(stages=[*stages, fitted]), time.monotonic() - begin

    def metric_table(
        self, predictions: DataFrame, is_binary: bool = True, by: Sequence[str] = ()
    ) -> DataFrame:
        """Every metric of the task in one row, or one row per group of ``by``.

        The curves of a binary task are drawn over the column ``score``.
        """
        columns = (self.label_col, self.prediction_col)
        if self.task == "regression":
            return metrics.regression(predictions, *columns, by=by)
        table = metrics.multiclass(predictions, *columns, by=by)
        if not is_binary:
            return table
        curves = metrics.binary(predictions, self.label_col, "score", by=by)
        if by:
            return curves.join(table, list(by))
        packed = table.select(F.struct(*table.columns)).scalar()
        return curves.withColumn("rest", packed).select(*curves.columns, "rest.*")

    def with_score(self, predictions: DataFrame) -> DataFrame:
        """Label, prediction and the score of the positive class."""
        return predictions.select(
            self.label_col,
            self.prediction_col,
            positive_score(predictions.columns).alias("score"),
        )

    def metrics_of(self, predictions: DataFrame, is_binary: bool = True) -> dict[str, float]:
        """The metrics of one scored table. Its rows are kept while they are counted."""
        if self.task == "classification" and is_binary:
            needed = self.with_score(predictions)
        else:
            needed = predictions.select(self.label_col, self.prediction_col)
        with cached(needed) as kept:
            return self.metric_table(kept, is_binary).first().asDict()

    def _scores(
        self, models: Mapping[str, PipelineModel], data: DataFrame, has_score: bool
    ) -> DataFrame:
        """One row per row of ``data`` and model; every model runs in the same pass."""
        original = data.columns
        results: list[str] = []
        for i, model in enumerate(models.values()):
            parts = [F.col(self.prediction_col)]
            scored = model.transform(data)
            if has_score:
                parts.append(positive_score(scored.columns).alias("score"))
            data = scored.select(
                *original, *results, F.struct(*parts).alias(f"__m{i}")
            )
            results.append(f"__m{i}")
        entries = [
            F.struct(
                F.lit(name).alias("model"),
                F.col(r)[self.prediction_col].alias(self.prediction_col),
                *([F.col(r)["score"].alias("score")] if has_score else []),
            )
            for name, r in zip(models, results)
        ]
        return data.select("split", self.label_col, F.inline(F.array(*entries)))

    def evaluate_many(
        self,
        models: Mapping[str, PipelineModel],
        train: DataFrame,
        test: DataFrame,
        is_binary: bool = True,
    ) -> dict[str, dict[str, dict[str, float]]]:
        """``{model: {train_metrics, test_metrics}}``, all of them counted together."""
        has_score = self.task == "classification" and is_binary
        both = train.withColumn("split", F.lit("train_metrics")).unionByName(
            test.withColumn("split", F.lit("test_metrics"))
        )
        found: dict[str, dict] = {
            name: {"train_metrics": {}, "test_metrics": {}} for name in models
        }
        with cached(self._scores(models, both, has_score)) as kept:
            for row in self.metric_table(kept, is_binary, ["model", "split"]).collect():
                values = row.asDict()
                found[values.pop("model")][values.pop("split")] = values
        return found

    def _record(self, outcomes, train, test, params, experiment, run_names) -> None:
        self.results.update(outcomes)
        saved = {}
        if self.model_dir is not None:
            for name in outcomes:
                saved[name] = {"model_path": f"{self.model_dir}/{run_names[name]}-{uuid.uuid4().hex}"}
                save_model(self.models[name], saved[name]["model_path"])
        if self.run_log is None:
            return
        spark = train.sparkSession
        sizes = {"train_size": train.count(), "test_size": test.count()}
        rows = []
        for name, outcome in outcomes.items():
            values = {"training_time_seconds": outcome["training_time"], **sizes}
            for split in ("train", "test"):
                values |= {f"{split}_{k}": v for k, v in outcome[f"{split}_metrics"].items()}
            entry = {"model_type": name, **params.get(name, {}), **saved.get(name, {})}
            rows.append(runlog.entries(spark, run_names[name], entry, values, experiment))
        runlog.append(reduce(DataFrame.unionByName, rows), self.run_log)

    def train_and_log(
        self,
        model_type: str,
        train: DataFrame,
        test: DataFrame,
        preprocessing: Pipeline | None = None,
        params: Mapping[str, object] | None = None,
        experiment: str | None = None,
        run_name: str | None = None,
        is_binary: bool = True,
    ) -> tuple[PipelineModel, dict, DataFrame]:
        """``(model, result record, test predictions)`` of one model."""
        outcomes = self.train_many(
            [model_type],
            train,
            test,
            preprocessing,
            {model_type: params or {}},
            experiment,
            is_binary,
            {model_type: run_name or model_type},
        )
        model = self.models[model_type]
        return model, outcomes[model_type], keep_all_rows(model).transform(test)

    def train_many(
        self,
        model_types: Sequence[str],
        train: DataFrame,
        test: DataFrame,
        preprocessing: Pipeline | None = None,
        configs: Mapping[str, Mapping[str, object]] | None = None,
        experiment: str | None = None,
        is_binary: bool = True,
        run_names: Mapping[str, str] | None = None,
    ) -> dict[str, dict]:
        """Result records by model type; see ``train_estimators``."""
        configs = configs or {}
        return self.train_estimators(
            {n: self.get_model(n, **configs.get(n, {})) for n in model_types},
            train,
            test,
            preprocessing,
            experiment,
            is_binary,
            params=configs,
            run_names=run_names,
        )

    def train_estimators(
        self,
        estimators: Mapping[str, Estimator],
        train: DataFrame,
        test: DataFrame,
        preprocessing: Pipeline | None = None,
        experiment: str | None = None,
        is_binary: bool = True,
        params: Mapping[str, Mapping[str, object]] | None = None,
        run_names: Mapping[str, str] | None = None,
    ) -> dict[str, dict]:
        """Result records by name.

        All models share one fitted preprocessing, and one pass that scores and counts.
        """
        stages, spent = [], 0.0
        if preprocessing is not None:
            begin = time.monotonic()
            prepared = preprocessing.fit(train)
            spent = time.monotonic() - begin
            stages = prepared.stages
            # Outlier filters choose training rows; every test row is judged.
            train, test = prepared.transform(train), keep_all_rows(prepared).transform(test)
        fitted: dict[str, PipelineModel] = {}
        seconds: dict[str, float] = {}
        needed = _columns_of(list(estimators.values()), train)
        with (
            training_rows(train.select(*needed)) as ready,
            cached(test.select(*needed)) as held_out,
        ):
            for name, estimator in estimators.items():
                begin = time.monotonic()
                fitted[name] = PipelineModel(stages=[estimator.fit(ready)])
                seconds[name] = time.monotonic() - begin
            outcomes = self.evaluate_many(fitted, ready, held_out, is_binary)
            for name, outcome in outcomes.items():
                outcome["model_type"] = name
                outcome["training_time"] = spent + seconds[name]
                self.models[name] = PipelineModel(stages=[*stages, *fitted[name].stages])
            names = {n: (run_names or {}).get(n, n) for n in outcomes}
            self._record(outcomes, ready, held_out, params or {}, experiment, names)
        return outcomes


def best_result(
    results: Mapping[str, Mapping], metric: str = "areaUnderROC"
) -> tuple[str | None, float | None]:
    """The best of some result records by a test metric, and its score."""
    scores = {
        name: record["test_metrics"].get(metric)
        for name, record in results.items()
        if record["test_metrics"].get(metric) is not None
    }
    scores = {name: s for name, s in scores.items() if s == s}
    if not scores:
        return None, None
    pick = max if metrics.larger_is_better(metric) else min
    name = pick(scores, key=scores.get)
    return name, scores[name]
