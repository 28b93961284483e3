"""Preprocessing as one Spark ML pipeline: impute, index, one-hot, assemble, scale."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import (
    Imputer,
    MinMaxScaler,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.param import TypeConverters
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions import is_missing, quoted
from tabloom.operators.categories import CategoryEncoder, CategoryIndexer
from tabloom.operators.quantiles import order_statistics
from tabloom.operators.stages import Saved, column_param

STRATEGIES = ("mean", "median", "mode")
SCALINGS = ("standard", "minmax", None)


class _MedianParams:
    inputCols = column_param("inputCols", "columns to fill", TypeConverters.toListString)
    outputCols = column_param("outputCols", "filled columns", TypeConverters.toListString)


class MedianImputer(_MedianParams, Saved, Estimator):
    """Fills NULL and NaN with the exact median, which is searched for, never gathered."""

    def _fit(self, df: DataFrame) -> FillModel:
        columns = self.getOrDefault("inputCols")
        found = order_statistics(
            df,
            [quoted(c) for c in columns],
            lambda i, n: [max(1, math.ceil(0.5 * n))],
            [0.5],
        )
        empty = [c for c, stats in zip(columns, found) if not stats]
        if empty:
            raise ValueError(f"no values in {empty}")
        return FillModel(
            inputCols=columns,
            outputCols=self.getOrDefault("outputCols"),
            fills=[stats[0].value for stats in found],
        )


class FillModel(_MedianParams, Saved, Model):
    """Fixed fill value per column; the filled column keeps the input's type."""

    fills = column_param("fills", "fill values", TypeConverters.toListFloat)

    def _transform(self, df: DataFrame) -> DataFrame:
        columns = zip(
            self.getOrDefault("inputCols"),
            self.getOrDefault("outputCols"),
            self.getOrDefault("fills"),
        )
        return df.withColumns(
            {
                target: F.when(is_missing(df, source), F.lit(fill))
                .otherwise(quoted(source))
                .cast(df.schema[source].dataType)
                for source, target, fill in columns
            }
        )


class PipelineBuilder:
    """Collects stages; ``build`` hands out a pipeline with its own list of them.

    An assembler given the raw name of an imputed column takes the imputed one, unless it
    is told to take names literally.
    """

    def __init__(self) -> None:
        self._stages: list = []
        self._imputed: dict[str, str] = {}

    @property
    def stages(self) -> list:
        return list(self._stages)

    def add_imputer(
        self, input_cols: Sequence[str], strategy: str = "mean", relative_error: float = 0.001
    ) -> PipelineBuilder:
        """``{c}`` to ``{c}_imputed``; a median with ``relative_error=0`` is exact."""
        if strategy not in STRATEGIES:
            raise ValueError(f"unknown strategy {strategy!r}, use one of {STRATEGIES}")
        outputs = [f"{c}_imputed" for c in input_cols]
        if strategy == "median" and relative_error == 0:
            imputer = MedianImputer(inputCols=list(input_cols), outputCols=outputs)
        else:
            imputer = Imputer(
                inputCols=list(input_cols),
                outputCols=outputs,
                strategy=strategy,
                relativeError=relative_error,
            )
        self._imputed.update(zip(input_cols, outputs))
        self._stages.append(imputer)
        return self

    def add_string_indexer(
        self, input_cols: Sequence[str], handle_invalid: str = "keep", as_table: bool = False
    ) -> PipelineBuilder:
        """``{c}`` to ``{c}_indexed``, the most frequent value first; one job for all.

        With ``as_table`` the labels are kept as tables and never come to the driver, for
        columns with very many of them; the numbers are the same.
        """
        indexer = CategoryIndexer if as_table else StringIndexer
        self._stages.append(
            indexer(
                inputCols=list(input_cols),
                outputCols=[f"{c}_indexed" for c in input_cols],
                handleInvalid=handle_invalid,
            )
        )
        return self

    def add_one_hot_encoder(
        self, input_cols: Sequence[str], handle_invalid: str = "keep", as_table: bool = False
    ) -> PipelineBuilder:
        """``{c}_indexed`` to ``{c}_encoded``; with ``as_table``, without a name for each slot."""
        encoder = CategoryEncoder if as_table else OneHotEncoder
        self._stages.append(
            encoder(
                inputCols=[f"{c}_indexed" for c in input_cols],
                outputCols=[f"{c}_encoded" for c in input_cols],
                handleInvalid=handle_invalid,
            )
        )
        return self

    def add_vector_assembler(
        self,
        input_cols: Sequence[str],
        output_col: str = "features",
        handle_invalid: str = "keep",
        literal: bool = False,
    ) -> PipelineBuilder:
        names = [c if literal else self._imputed.get(c, c) for c in input_cols]
        self._stages.append(
            VectorAssembler(inputCols=names, outputCol=output_col, handleInvalid=handle_invalid)
        )
        return self

    def add_standard_scaler(
        self,
        input_col: str = "features",
        output_col: str = "scaled_features",
        with_mean: bool = True,
        with_std: bool = True,
    ) -> PipelineBuilder:
        self._stages.append(
            StandardScaler(
                inputCol=input_col, outputCol=output_col, withMean=with_mean, withStd=with_std
            )
        )
        return self

    def add_minmax_scaler(
        self,
        input_col: str = "features",
        output_col: str = "scaled_features",
        min_val: float = 0.0,
        max_val: float = 1.0,
    ) -> PipelineBuilder:
        self._stages.append(
            MinMaxScaler(inputCol=input_col, outputCol=output_col, min=min_val, max=max_val)
        )
        return self

    def add_stage(self, stage) -> PipelineBuilder:
        """Any other stage, such as the outlier and feature stages of this package."""
        self._stages.append(stage)
        return self

    def build(self) -> Pipeline:
        return Pipeline(stages=self.stages)


def preprocessing_pipeline(
    numerical: Sequence[str],
    categorical: Sequence[str],
    imputation: str = "mean",
    scaling: str | None = "standard",
    categorical_first: bool = False,
    encoder_invalid: str = "keep",
    assembler_invalid: str = "keep",
    assembled: str = "features",
    scaled: str = "scaled_features",
    relative_error: float = 0.001,
) -> Pipeline:
    """The standard chain over numeric and categorical columns.

    ``scaling`` is ``standard``, ``minmax`` or None for no scaler.
    """
    if scaling not in SCALINGS:
        raise ValueError(f"unknown scaling {scaling!r}, use one of {SCALINGS}")
    builder = PipelineBuilder()
    if numerical:
        builder.add_imputer(numerical, imputation, relative_error)
    if categorical:
        builder.add_string_indexer(categorical).add_one_hot_encoder(categorical, encoder_invalid)
    encoded = [f"{c}_encoded" for c in categorical]
    parts = [encoded, list(numerical)] if categorical_first else [list(numerical), encoded]
    builder.add_vector_assembler(parts[0] + parts[1], assembled, assembler_invalid)
    if scaling == "standard":
        builder.add_standard_scaler(assembled, scaled)
    elif scaling == "minmax":
        builder.add_minmax_scaler(assembled, scaled)
    return builder.build()


def with_estimator(preprocessing: Pipeline | PipelineModel | None, estimator) -> Pipeline:
    """A pipeline of the preprocessing stages and the estimator after them."""
    if preprocessing is None:
        return Pipeline(stages=[estimator])
    if isinstance(preprocessing, PipelineModel):
        return Pipeline(stages=[*preprocessing.stages, estimator])
    return Pipeline(stages=[*preprocessing.getStages(), estimator])
