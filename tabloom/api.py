"""The class-based interface: quality checks, features, pipelines, trainers, tuning.

These classes only name and group what the modules of ``tabloom.operators`` do, for code
that is written against such classes.
"""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.sql import DataFrame, SparkSession

from tabloom.operators import balance, features, metrics, outliers, profile, tuning
from tabloom.operators.models import Trainer, best_result, positive_score
from tabloom.operators.preprocessing import PipelineBuilder, preprocessing_pipeline
from tabloom.operators.scoring import score
from tabloom.operators.split import cached
from tabloom.sources import runlog

__all__ = [
    "ClassificationTrainer",
    "DataBalancer",
    "DataPreprocessor",
    "DataQualityChecker",
    "FeatureEngineer",
    "HyperparameterTuner",
    "ModelComparer",
    "ModelTrainer",
    "OutlierHandler",
    "PipelineBuilder",
    "RegressionTrainer",
    "batch_predict",
    "create_preprocessing_pipeline",
    "display_model_metrics",
    "train_classification_model",
    "tune_model_with_cv",
]


class DataQualityChecker:
    """Quality checks of one table."""

    def __init__(self, df: DataFrame) -> None:
        self.df = df

    def check_missing_values(self) -> DataFrame:
        return profile.missing(self.df)

    def get_statistics(self) -> DataFrame:
        return profile.describe(self.df)

    def check_duplicates(self) -> int:
        return profile.duplicates(self.df).first()["duplicates"]

    def check_cardinality(self, categorical_cols: Sequence[str]) -> dict[str, int]:
        rows = profile.cardinality(self.df, categorical_cols).collect()
        return {row["column"]: row["distinct_values"] for row in rows}

    def generate_quality_report(self, categorical_cols: Sequence[str] | None = None) -> dict:
        """The long report as a dict: a fixed number of passes, however many columns there are."""
        rows = profile.report(self.df, categorical_cols or ()).collect()

        def section(name: str, metric: str) -> dict[str, int]:
            return {
                r["column"]: int(r["value"])
                for r in rows
                if r["section"] == name and r["metric"] == metric
            }

        table = {r["metric"]: int(r["value"]) for r in rows if r["section"] == "table"}
        statistics: dict[str, dict] = {}
        for r in rows:
            if r["section"] == "statistics":
                found = r["value"] if r["text"] is None else r["text"]
                statistics.setdefault(r["column"], {})[r["metric"]] = found
        report = {
            "total_rows": table["total_rows"],
            "total_columns": table["total_columns"],
            "missing_values": section("missing_values", "missing"),
            "duplicates": table["duplicates"],
            "statistics": statistics,
        }
        if categorical_cols:
            report["cardinality"] = section("cardinality", "distinct_values")
        return report


class FeatureEngineer:
    """Derived columns."""

    @staticmethod
    def create_interaction_features(
        df: DataFrame, col1: str, col2: str, operation: str = "multiply"
    ) -> DataFrame:
        return features.interaction(df, col1, col2, operation)

    @staticmethod
    def create_polynomial_features(df: DataFrame, col_name: str, degree: int = 2) -> DataFrame:
        return features.polynomial(df, col_name, degree)

    @staticmethod
    def create_binned_features(
        df: DataFrame, col_name: str, num_bins: int = 5, method: str = "quantile"
    ) -> DataFrame:
        return features.binned(df, col_name, num_bins, method)

    @staticmethod
    def create_aggregation_features(
        df: DataFrame,
        group_col: str,
        agg_col: str,
        agg_functions: Sequence[str] = ("mean", "sum", "count"),
    ) -> DataFrame:
        return features.group_agg(df, group_col, agg_col, agg_functions)


class OutlierHandler:
    """Outliers by the interquartile range."""

    @staticmethod
    def detect_outliers_iqr(df: DataFrame, col_name: str, multiplier: float = 1.5) -> DataFrame:
        return outliers.detect(df, col_name, multiplier)

    @staticmethod
    def cap_outliers(df: DataFrame, col_name: str, multiplier: float = 1.5) -> DataFrame:
        return outliers.cap(df, col_name, multiplier)

    @staticmethod
    def remove_outliers(df: DataFrame, col_name: str, multiplier: float = 1.5) -> DataFrame:
        return outliers.remove(df, col_name, multiplier)


class DataBalancer:
    """Seeded class balancing. Classes in between are kept; see ``balance`` for exact modes."""

    @staticmethod
    def oversample_minority(
        df: DataFrame, label_col: str = "label", ratio: float = 1.0
    ) -> DataFrame:
        return balance.oversample_minority(df, label_col, ratio)

    @staticmethod
    def undersample_majority(
        df: DataFrame, label_col: str = "label", ratio: float = 1.0
    ) -> DataFrame:
        return balance.undersample_majority(df, label_col, ratio)


def create_preprocessing_pipeline(
    numerical_cols: Sequence[str],
    categorical_cols: Sequence[str],
    imputation_strategy: str = "mean",
    scaling_method: str | None = "standard",
) -> Pipeline:
    """Numeric slots first, then the encoded categories."""
    return preprocessing_pipeline(
        numerical_cols, categorical_cols, imputation_strategy, scaling_method
    )


class DataPreprocessor:
    """Encoded categories first, no slot for unknown ones, scaled into ``features``."""

    def __init__(
        self,
        categorical_cols: Sequence[str] | None = None,
        numerical_cols: Sequence[str] | None = None,
        label_col: str = "label",
    ) -> None:
        self.categorical_cols = list(categorical_cols or ())
        self.numerical_cols = list(numerical_cols or ())
        self.label_col = label_col

    def build_pipeline(self) -> Pipeline:
        return preprocessing_pipeline(
            self.numerical_cols,
            self.categorical_cols,
            categorical_first=True,
            encoder_invalid="error",
            assembler_invalid="error",
            assembled="assembled_features",
            scaled="features",
        )


class ModelTrainer(Trainer):
    """A trainer that also takes evaluators from outside."""

    def __init__(
        self,
        features_col: str = "features",
        label_col: str = "label",
        prediction_col: str = "prediction",
        task: str = "classification",
        **places: str | None,
    ) -> None:
        super().__init__(task, features_col, label_col, prediction_col, **places)
        self.task_type = task

    def evaluate(
        self, model: PipelineModel, data: DataFrame, evaluators: Sequence
    ) -> tuple[dict[str, float], DataFrame]:
        """Scores by metric name, and the scored rows. Rows are scored once for all."""
        predictions = model.transform(data)
        with cached(predictions) as kept:
            scores = {e.getMetricName(): e.evaluate(kept) for e in evaluators}
        return scores, predictions

    def train_with_mlflow(
        self,
        model_type: str,
        train_data: DataFrame,
        test_data: DataFrame,
        preprocessing_pipeline: Pipeline | None = None,
        model_params: Mapping[str, object] | None = None,
        experiment_name: str | None = None,
        run_name: str | None = None,
        is_binary: bool = True,
    ) -> tuple[PipelineModel, dict, DataFrame]:
        """Train, evaluate and log. The log is the run table, not a tracking server."""
        return self.train_and_log(
            model_type,
            train_data,
            test_data,
            preprocessing_pipeline,
            model_params,
            experiment_name,
            run_name,
            is_binary,
        )

    def train_multiple_models(
        self,
        model_types: Sequence[str],
        train_data: DataFrame,
        test_data: DataFrame,
        preprocessing_pipeline: Pipeline | None = None,
        model_configs: Mapping[str, Mapping[str, object]] | None = None,
        experiment_name: str | None = None,
        is_binary: bool = True,
    ) -> dict[str, dict]:
        return self.train_many(
            model_types,
            train_data,
            test_data,
            preprocessing_pipeline,
            model_configs,
            experiment_name,
            is_binary,
        )


class ClassificationTrainer(ModelTrainer):
    def __init__(self, **kwargs: str | None) -> None:
        super().__init__(**kwargs, task="classification")

    def get_evaluators(self, is_binary: bool = True) -> list:
        """Evaluators of all metrics; the two curves only for a binary task, and exact."""
        curves = [
            BinaryClassificationEvaluator(labelCol=self.label_col, metricName=m, numBins=0)
            for m in metrics.BINARY_METRICS
        ]
        rest = [
            MulticlassClassificationEvaluator(
                labelCol=self.label_col, predictionCol=self.prediction_col, metricName=m
            )
            for m in metrics.MULTICLASS_METRICS
        ]
        return curves + rest if is_binary else rest


class RegressionTrainer(ModelTrainer):
    def __init__(self, **kwargs: str | None) -> None:
        super().__init__(**kwargs, task="regression")

    def get_evaluators(self) -> list:
        return [
            RegressionEvaluator(
                labelCol=self.label_col, predictionCol=self.prediction_col, metricName=m
            )
            for m in metrics.REGRESSION_METRICS
        ]


class HyperparameterTuner:
    """Searches that are logged to the run table when ``run_log`` names one."""

    def __init__(
        self,
        features_col: str = "features",
        label_col: str = "label",
        *,
        run_log: str | None = None,
    ) -> None:
        self.features_col, self.label_col = features_col, label_col
        self.run_log = run_log

    def create_param_grid(self, model, param_configs: Mapping[str, Sequence]) -> list[dict]:
        return tuning.param_grid(model, param_configs)

    def _logged(self, kind, search, model, param_grid, evaluator, data, begin, experiment):
        if self.run_log is not None:
            name = f"{type(model).__name__}_{kind}"
            spent = time.monotonic() - begin
            rows = tuning.search_entries(
                data.sparkSession, search, param_grid, evaluator, name, spent, experiment
            )
            runlog.append(rows, self.run_log)
        return search

    def tune_with_cross_validation(
        self,
        model,
        param_grid: list[dict],
        train_data: DataFrame,
        evaluator,
        num_folds: int = 3,
        preprocessing_pipeline: Pipeline | None = None,
        experiment_name: str | None = None,
        fold_key: str | None = None,
    ):
        begin = time.monotonic()
        search = tuning.cross_validate(
            model, param_grid, train_data, evaluator, num_folds, preprocessing_pipeline, fold_key
        )
        return self._logged(
            "CV", search, model, param_grid, evaluator, train_data, begin, experiment_name
        )

    def tune_with_train_validation_split(
        self,
        model,
        param_grid: list[dict],
        train_data: DataFrame,
        evaluator,
        train_ratio: float = 0.8,
        preprocessing_pipeline: Pipeline | None = None,
        experiment_name: str | None = None,
        split_key: str | None = None,
    ):
        begin = time.monotonic()
        search = tuning.train_validation(
            model, param_grid, train_data, evaluator, train_ratio, preprocessing_pipeline, split_key
        )
        return self._logged(
            "TVS", search, model, param_grid, evaluator, train_data, begin, experiment_name
        )


class ModelComparer:
    """Comparison of result records."""

    @staticmethod
    def compare_results(results: Mapping[str, Mapping]) -> DataFrame:
        """Print and return a table of all test metrics and training times."""
        names = sorted({m for record in results.values() for m in record["test_metrics"]})
        rows = [
            (name, *(record["test_metrics"].get(m) for m in names), record["training_time"])
            for name, record in results.items()
        ]
        columns = ", ".join(f"`{m}` double" for m in names)
        table = SparkSession.active().createDataFrame(
            rows, f"`Model` string, {columns}, `Training Time (s)` double"
        )
        table.show(truncate=False)
        return table

    @staticmethod
    def get_best_model(
        results: Mapping[str, Mapping], metric: str = "areaUnderROC"
    ) -> tuple[str | None, float | None]:
        return best_result(results, metric)


def train_classification_model(
    model,
    model_name: str,
    train_data: DataFrame,
    test_data: DataFrame,
    preprocessing_pipeline: Pipeline,
    run_log: str | None = None,
) -> tuple[PipelineModel, DataFrame]:
    """Fit and log one binary classifier that is already set up."""
    trainer = ClassificationTrainer(run_log=run_log)
    trainer.train_estimators({model_name: model}, train_data, test_data, preprocessing_pipeline)
    fitted = trainer.models[model_name]
    return fitted, fitted.transform(test_data)


def tune_model_with_cv(
    model,
    param_grid: list[dict],
    train_data: DataFrame,
    preprocessing_pipeline: Pipeline,
    run_log: str | None = None,
):
    """Three-fold search for the largest area under the ROC curve."""
    return HyperparameterTuner(run_log=run_log).tune_with_cross_validation(
        model,
        param_grid,
        train_data,
        BinaryClassificationEvaluator(numBins=0),
        preprocessing_pipeline=preprocessing_pipeline,
    )


def batch_predict(model: PipelineModel, data: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Features, prediction and, where the model has one, probability."""
    return score(model, data, keep)


def display_model_metrics(predictions: Mapping[str, DataFrame], label: str = "label") -> DataFrame:
    """Print and return area under the ROC curve and accuracy of scored tables by model."""
    scored = {
        name: frame.withColumn("score", positive_score(frame.columns))
        for name, frame in predictions.items()
    }
    board = metrics.dashboard(scored, label)
    board.show(truncate=False)
    return board
