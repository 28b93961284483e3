"""Evaluation of scored tables as relational aggregations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators.ranges import totals_above

MULTICLASS_METRICS = ("accuracy", "f1", "weightedPrecision", "weightedRecall")
BINARY_METRICS = ("areaUnderROC", "areaUnderPR")
REGRESSION_METRICS = ("rmse", "mse", "mae", "r2")
SMALLER_IS_BETTER = ("rmse", "mse", "mae")
# Classes of a confusion matrix, which are its columns.
MOST_CLASSES = 1000


def larger_is_better(metric: str) -> bool:
    return metric.removeprefix("train_").removeprefix("test_") not in SMALLER_IS_BETTER


def binary(
    df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()
) -> DataFrame:
    """``areaUnderROC, areaUnderPR``, exact, by the trapezoid rule over all scores.

    One row, or one per combination of the ``by`` columns. Rows are first summed up per
    distinct score, in the only pass over them. Running totals over the sorted scores are then
    built in ranges of scores, and ranges of ranges where scores are crowded. Labels above 0.5
    are positive. Rows without label or score have no place on a curve and are left out.
    """
    positive = F.when(F.col(label) > 0.5, 1).otherwise(0)
    scored = df.select(
        *by,
        positive.alias("positive"),
        F.col(score).cast("double").alias("score"),
        F.col(label).isNotNull().alias("labelled"),
    ).filter(F.col("labelled") & F.col("score").isNotNull())
    per_score = scored.groupBy(*by, "score").agg(
        F.sum("positive").alias("pos"),
        (F.count(F.lit(1)) - F.sum("positive")).alias("neg"),
    )
    running = totals_above(per_score, "score", {"tp": "pos", "fp": "neg"}, by)
    # True and false positives above the score, and with it.
    pos, neg, tp, fp = (F.col(c) for c in ("pos", "neg", "tp", "fp"))
    precision = (tp + pos) / (tp + fp + pos + neg)
    before = F.try_divide(tp, tp + fp)
    roc_part = neg * (2 * tp + pos) / 2
    pr_part = pos * (precision + F.coalesce(before, precision)) / 2
    positives, negatives = F.sum("pos").cast("double"), F.sum("neg").cast("double")
    return running.groupBy(*by).agg(
        F.try_divide(F.sum(roc_part), positives * negatives).alias("areaUnderROC"),
        F.try_divide(F.sum(pr_part), positives).alias("areaUnderPR"),
    )


def confusion(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    by: Sequence[str] = (),
) -> DataFrame:
    """Long confusion table ``label, prediction, count``, after the ``by`` columns."""
    return df.groupBy(
        *by, F.col(label).alias("label"), F.col(prediction).alias("prediction")
    ).agg(F.count(F.lit(1)).alias("count"))


def confusion_matrix(
    df: DataFrame,
    classes: list | None = None,
    label: str = "label",
    prediction: str = "prediction",
) -> DataFrame:
    """One row per class, one column ``predicted_{class}`` per class.

    Without ``classes``, they are all that occur as label or prediction, and every one has a row
    and a column; more than ``MOST_CLASSES`` are an error, and ``confusion`` lists them as rows.
    With ``classes``, the columns are these, and the rows the classes that are true.
    """
    if classes is None:
        cells = confusion(df, label, prediction)
        named = cells.select(F.col("label").alias("class")).union(cells.select("prediction"))
        found = named.filter("class is not null").distinct()
        classes = sorted(r["class"] for r in found.limit(MOST_CLASSES + 1).collect())
        if len(classes) > MOST_CLASSES:
            raise ValueError(f"more than {MOST_CLASSES} classes; use confusion()")
        table = confusion_matrix(df, classes, label, prediction)
        counts = [
            F.coalesce(F.col(f"`predicted_{c}`"), F.lit(0)).alias(f"predicted_{c}") for c in classes
        ]
        named = found.withColumnRenamed("class", "label")
        return named.join(table, "label", "left").select("label", *counts)
    counts = [
        F.sum(F.when(F.col("prediction") == F.lit(c), F.col("count")).otherwise(0)).alias(
            f"predicted_{c}"
        )
        for c in classes
    ]
    return confusion(df, label, prediction).groupBy("label").agg(*counts)


def _per_class(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``class, tp, support, predicted`` out of a confusion table, by one more grouping."""
    cell = F.col("count")
    hit = F.when(F.col("label") == F.col("prediction"), cell).otherwise(0)
    none = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(
            F.col("label").cast("double").alias("class"),
            hit.cast("bigint").alias("tp"),
            cell.alias("support"),
            none.alias("predicted"),
        ),
        F.struct(
            F.col("prediction").cast("double").alias("class"),
            none.alias("tp"),
            none.alias("support"),
            cell.alias("predicted"),
        ),
    )
    return (
        cells.select(*by, F.inline(sides))
        .groupBy(*by, "class")
        .agg(
            F.sum("tp").alias("tp"),
            F.sum("support").alias("support"),
            F.sum("predicted").alias("predicted"),
        )
    )


def _class_rates(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    tp, support, predicted = F.col("tp"), F.col("support"), F.col("predicted")
    zero = F.lit(0.0)
    return _per_class(cells, by).select(
        *by,
        "class",
        "tp",
        "support",
        F.coalesce(F.try_divide(tp.cast("double"), predicted), zero).alias("precision"),
        F.coalesce(F.try_divide(tp.cast("double"), support), zero).alias("recall"),
        F.coalesce(F.try_divide(2.0 * tp, support + predicted), zero).alias("f1"),
    )


def multiclass(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    by: Sequence[str] = (),
) -> DataFrame:
    """``accuracy, f1, weightedPrecision, weightedRecall``; the weights are supports.

    One row, or one per combination of the ``by`` columns.
    """
    return of_confusion(confusion(df, label, prediction, by), by)


def of_confusion(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The metrics of ``multiclass`` from a table of ``confusion``."""
    rows = F.sum("support")

    def weighted(column: str):
        return F.try_divide(F.sum(F.col(column) * F.col("support")), rows)

    return (
        _class_rates(cells, by)
        .groupBy(*by)
        .agg(
            F.try_divide(F.sum("tp").cast("double"), rows).alias("accuracy"),
            weighted("f1").alias("f1"),
            weighted("precision").alias("weightedPrecision"),
            weighted("recall").alias("weightedRecall"),
        )
    )


def classification_report(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """``class, precision, recall, f1, support`` per class, then accuracy and averages."""
    rates = _class_rates(confusion(df, label, prediction))
    per_class = rates.select(
        F.col("class").cast("string").alias("class"), "precision", "recall", "f1", "support"
    )
    rows = F.sum("support")
    total = rates.agg(
        rows.alias("n"),
        (F.sum("tp") / rows).alias("accuracy"),
        *[F.avg(c).alias(f"macro_{c}") for c in ("precision", "recall", "f1")],
        *[
            (F.sum(F.col(c) * F.col("support")) / rows).alias(f"weighted_{c}")
            for c in ("precision", "recall", "f1")
        ],
    )

    def line(name: str, precision: str, recall: str, f1: str):
        return F.struct(
            F.lit(name).alias("class"),
            F.col(precision).alias("precision"),
            F.col(recall).alias("recall"),
            F.col(f1).alias("f1"),
            F.col("n").alias("support"),
        )

    summary = total.select(
        F.inline(
            F.array(
                line("accuracy", "accuracy", "accuracy", "accuracy"),
                line("macro avg", "macro_precision", "macro_recall", "macro_f1"),
                line("weighted avg", "weighted_precision", "weighted_recall", "weighted_f1"),
            )
        )
    )
    return per_class.unionByName(summary)


def regression(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    by: Sequence[str] = (),
) -> DataFrame:
    """``rmse, mse, mae, r2`` from a single aggregation.

    One row, or one per combination of the ``by`` columns.
    """
    # All of them over the same rows: those with both values.
    whole = df.filter(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    actual = F.col(label).cast("double")
    error = actual - F.col(prediction)
    mse = F.avg(error * error)
    return whole.groupBy(*by).agg(
        F.sqrt(mse).alias("rmse"),
        mse.alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.try_divide(mse, F.var_pop(actual))).alias("r2"),
    )


def stack_models(scored: Mapping[str, DataFrame], columns: Sequence[str]) -> DataFrame:
    """Scored tables one below the other, told apart by ``model``."""
    frames = [
        frame.select(F.lit(name).alias("model"), *columns) for name, frame in scored.items()
    ]
    return reduce(DataFrame.unionByName, frames)


def dashboard(
    scored: Mapping[str, DataFrame],
    label: str = "label",
    prediction: str = "prediction",
    score: str = "score",
) -> DataFrame:
    """One row per model: ``model, areaUnderROC, accuracy``."""
    stacked = stack_models(scored, [label, prediction, score])
    hits = stacked.groupBy("model").agg(
        F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy")
    )
    curves = binary(stacked, label, score, by=["model"])
    return curves.select("model", "areaUnderROC").join(hits, "model")
