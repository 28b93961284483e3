"""Applying a fitted pipeline to a table or a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from tabloom.operators.outliers import IQROutlierModel
from tabloom.sources.persistence import load_model

OUTPUTS = ("features", "prediction", "probability")


def keep_all_rows(model: PipelineModel) -> PipelineModel:
    """The same model without the row filter of an outlier stage."""
    return PipelineModel(
        stages=[
            s.copy({s.filterRows: False}) if isinstance(s, IQROutlierModel) else s
            for s in model.stages
        ]
    )


def score(
    model: PipelineModel,
    df: DataFrame,
    keep: Sequence[str] = (),
    outputs: Sequence[str] = OUTPUTS,
) -> DataFrame:
    """The ``keep`` columns and those of ``outputs`` that the model produces.

    Regressors and support vector machines have no probability. ``df`` may be a stream.
    """
    scored = keep_all_rows(model).transform(df)
    added = [c for c in outputs if c in scored.columns and c not in keep]
    return scored.select(*keep, *added)


def predictor(path: str, keep: Sequence[str] = (), outputs: Sequence[str] = OUTPUTS):
    """A saved model as a function for ``df.transform``, for tables and streams.

    The model is loaded once, on the driver; scoring is the model's own expressions.
    """
    model = load_model(path)
    return lambda df: score(model, df, keep, outputs)
