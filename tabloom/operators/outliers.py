"""Outliers by the interquartile range: mark, clamp or remove."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.param import TypeConverters
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions import quoted
from tabloom.operators.quantiles import quantiles
from tabloom.operators.stages import Saved, column_param

MODES = ("detect", "cap", "remove")


def iqr_bounds(
    df: DataFrame,
    columns: Sequence[str],
    multiplier: float = 1.5,
    relative_error: float = 0.01,
) -> dict[str, tuple[float, float]]:
    """``column -> (lower, upper)`` for all columns in one search for quartiles."""
    found = quantiles(df, columns, [0.25, 0.75], relative_error)
    bounds = {}
    for column, quartiles in zip(columns, found):
        if not quartiles:
            raise ValueError(f"column {column} has no values")
        q1, q3 = quartiles
        bounds[column] = (q1 - multiplier * (q3 - q1), q3 + multiplier * (q3 - q1))
    return bounds


class _OutlierParams:
    inputCols = column_param("inputCols", "columns to treat", TypeConverters.toListString)
    mode = column_param("mode", "detect, cap or remove")


class IQROutlier(_OutlierParams, Saved, Estimator):
    """Learns the bounds of all columns; the model applies them to any data."""

    multiplier = column_param("multiplier", "width of the fences", TypeConverters.toFloat)
    relativeError = column_param(
        "relativeError", "error of the quartiles, 0 for exact", TypeConverters.toFloat
    )

    def __init__(self, **values: object) -> None:
        defaults = {"mode": "detect", "multiplier": 1.5, "relativeError": 0.01}
        super().__init__(**{**defaults, **values})
        if self.getOrDefault("mode") not in MODES:
            raise ValueError(f"unknown mode {self.getOrDefault('mode')!r}, use one of {MODES}")

    def _fit(self, df: DataFrame) -> IQROutlierModel:
        columns = self.getOrDefault("inputCols")
        bounds = iqr_bounds(
            df, columns, self.getOrDefault("multiplier"), self.getOrDefault("relativeError")
        )
        return IQROutlierModel(
            inputCols=columns,
            mode=self.getOrDefault("mode"),
            lower=[bounds[c][0] for c in columns],
            upper=[bounds[c][1] for c in columns],
        )


class IQROutlierModel(_OutlierParams, Saved, Model):
    """Fixed bounds per column.

    ``detect`` adds ``{c}_is_outlier``, ``cap`` adds ``{c}_capped``, ``remove`` keeps the
    rows inside all bounds. Set ``filterRows`` to false to score every row with a model
    whose training data had its outliers removed.
    """

    lower = column_param("lower", "lower bounds", TypeConverters.toListFloat)
    upper = column_param("upper", "upper bounds", TypeConverters.toListFloat)
    filterRows = column_param("filterRows", "remove rows", TypeConverters.toBoolean)

    def __init__(self, **values: object) -> None:
        super().__init__(**{"filterRows": True, **values})

    def _transform(self, df: DataFrame) -> DataFrame:
        mode = self.getOrDefault("mode")
        fences = [
            (name, quoted(name), F.lit(low), F.lit(high))
            for name, low, high in zip(
                self.getOrDefault("inputCols"),
                self.getOrDefault("lower"),
                self.getOrDefault("upper"),
            )
        ]
        if mode == "detect":
            return df.withColumns(
                {
                    f"{name}_is_outlier": F.when((value < low) | (value > high), 1).otherwise(0)
                    for name, value, low, high in fences
                }
            )
        if mode == "cap":
            return df.withColumns(
                {
                    f"{name}_capped": F.when(value < low, low)
                    .when(value > high, high)
                    .otherwise(value)
                    for name, value, low, high in fences
                }
            )
        if self.getOrDefault("filterRows"):
            for _, value, low, high in fences:
                df = df.filter(value.between(low, high))
        return df


def _apply(df, column, mode, multiplier, relative_error) -> DataFrame:
    columns = [column] if isinstance(column, str) else list(column)
    estimator = IQROutlier(
        inputCols=columns, mode=mode, multiplier=multiplier, relativeError=relative_error
    )
    return estimator.fit(df).transform(df)


def detect(
    df: DataFrame,
    column: str | Sequence[str],
    multiplier: float = 1.5,
    relative_error: float = 0.01,
) -> DataFrame:
    """Add ``{column}_is_outlier``: 1 outside the bounds, else 0 (NULL is 0, NaN is 1)."""
    return _apply(df, column, "detect", multiplier, relative_error)


def cap(
    df: DataFrame,
    column: str | Sequence[str],
    multiplier: float = 1.5,
    relative_error: float = 0.01,
) -> DataFrame:
    """Add ``{column}_capped``: clamped to the bounds (NULL stays, NaN is the upper bound)."""
    return _apply(df, column, "cap", multiplier, relative_error)


def remove(
    df: DataFrame,
    column: str | Sequence[str],
    multiplier: float = 1.5,
    relative_error: float = 0.01,
) -> DataFrame:
    """Keep rows inside the closed bounds; NULL and NaN are dropped."""
    return _apply(df, column, "remove", multiplier, relative_error)
