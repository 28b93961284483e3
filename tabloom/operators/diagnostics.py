"""Looking at fitted models: predictions side by side, importance, residuals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from statistics import NormalDist

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.operators import profile
from tabloom.operators.quantiles import interpolated_quantiles


def compare_predictions(
    models: Mapping[str, PipelineModel],
    df: DataFrame,
    keep: Sequence[str],
    prediction: str = "prediction",
) -> DataFrame:
    """The ``keep`` columns and ``{name}_prediction`` of every model, in one pass."""
    original = df.columns
    outputs: list[str] = []
    for name, model in models.items():
        scored = model.transform(df)
        column = f"{name}_prediction"
        df = scored.select(*original, *outputs, F.col(prediction).alias(column))
        outputs.append(column)
    return df.select(*keep, *outputs)


def join_predictions(
    scored: Mapping[str, DataFrame], key: str, prediction: str = "prediction"
) -> DataFrame:
    """Tables scored apart, put side by side on a row key."""
    frames = [
        frame.select(key, F.col(prediction).alias(f"{name}_prediction"))
        for name, frame in scored.items()
    ]
    return reduce(lambda a, b: a.join(b, key), frames)


def _slot_names(transformed: DataFrame, column: str, size: int) -> list[str]:
    attributes = transformed.schema[column].metadata.get("ml_attr", {}).get("attrs", {})
    names = {a["idx"]: a["name"] for kind in attributes.values() for a in kind if "name" in a}
    return [names.get(i, f"{column}_{i}") for i in range(size)]


def feature_importance(
    model: PipelineModel, df: DataFrame, top: int | None = None, by_input: bool = False
) -> DataFrame:
    """``feature, importance`` of a tree model, largest first.

    There is one row per slot of the feature vector, named by the metadata of the assembled
    column; ``by_input`` adds up the slots of each assembled input column.
    """
    importances = model.stages[-1].featureImportances.toArray().tolist()
    assembler = next(s for s in reversed(model.stages) if isinstance(s, VectorAssembler))
    names = _slot_names(model.transform(df), assembler.getOutputCol(), len(importances))
    if by_input:
        inputs = sorted(assembler.getInputCols(), key=len, reverse=True)
        names = [
            next((c for c in inputs if n == c or n.startswith(f"{c}_")), n) for n in names
        ]
    table = (
        df.sparkSession.createDataFrame(
            list(zip(names, importances)), "feature string, importance double"
        )
        .groupBy("feature")
        .agg(F.sum("importance").alias("importance"))
        .orderBy(F.col("importance").desc(), "feature")
    )
    return table if top is None else table.limit(top)


def residuals(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    keep: Sequence[str] = (),
) -> DataFrame:
    """``actual, predicted, residual`` per row, next to the ``keep`` columns."""
    return df.select(
        *keep,
        F.col(label).alias("actual"),
        F.col(prediction).alias("predicted"),
        (F.col(label) - F.col(prediction)).alias("residual"),
    )


def axis_range(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with ``min_value`` and ``max_value`` over all the columns together."""
    lows = [F.min(c) for c in columns]
    highs = [F.max(c) for c in columns]
    low = F.least(*lows) if len(lows) > 1 else lows[0]
    high = F.greatest(*highs) if len(highs) > 1 else highs[0]
    return df.agg(low.alias("min_value"), high.alias("max_value"))


def residual_grid(df: DataFrame, x: str, y: str, x_width: float, y_width: float) -> DataFrame:
    """What a scatter plot shows, as counts ``bx, by, count`` of grid cells."""
    return df.groupBy(
        F.floor(F.col(x) / x_width).alias("bx"), F.floor(F.col(y) / y_width).alias("by")
    ).agg(F.count(F.lit(1)).alias("count"))


def residual_histogram(df: DataFrame, column: str = "residual", bins: int = 50) -> DataFrame:
    return profile.histogram(df, [column], bins)


def plotting_positions(points: int) -> list[tuple[float, float]]:
    """Probabilities and the normal quantiles they belong to."""
    normal = NormalDist()
    grid = [(i - 0.5) / points for i in range(1, points + 1)]
    return [(p, normal.inv_cdf(p)) for p in grid]


def residual_qq(
    df: DataFrame, column: str = "residual", points: int = 99, relative_error: float = 0.0
) -> DataFrame:
    """Normal Q-Q table ``p, theoretical, sample``: exact sample quantiles at fixed points.

    Give a ``relative_error`` for approximate ones.
    """
    spark: SparkSession = df.sparkSession
    positions = plotting_positions(points)
    grid = [p for p, _ in positions]
    if relative_error > 0:
        sample = df.approxQuantile(column, grid, relative_error)
    else:
        sample = interpolated_quantiles(df, [column], grid)[0]
    if not sample:
        raise ValueError(f"column {column} has no values")
    rows = [(p, z, s) for (p, z), s in zip(positions, sample)]
    return spark.createDataFrame(rows, "p double, theoretical double, sample double")


def qq_line(qq: DataFrame) -> DataFrame:
    """Least-squares line through a Q-Q table: ``slope, intercept``."""
    return qq.agg(
        F.regr_slope("sample", "theoretical").alias("slope"),
        F.regr_intercept("sample", "theoretical").alias("intercept"),
    )
