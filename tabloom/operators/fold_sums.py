"""Cross-validation from sums by fold: the rows are read once for all folds and combinations.

A linear regression needs no rows, only counts, means and products of features and label. These
are gathered for each fold by one pass, tasks adding up what they read and pairs of sums being
merged; the training part of a fold is the sum of all others, and its error on the held-out fold
follows from that fold's own sums. Multinomial naive Bayes needs the sums of its features by class,
and one more pass in which all combinations score the rows of their held-out fold together.

Where that does not hold (other models, parameters or metrics, a preprocessing that learns from
rows, rows with missing values, very wide features) the functions return None, and the general
search fits every combination on its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Pipeline
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.evaluation import (
    Evaluator,
    MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions import quoted
from tabloom.operators import metrics

# Features whose products the driver and a task hold; entries of the sums by class and fold.
MOST_FEATURES, MOST_SUMS = 500, 2_000_000
_MERGED = 32

_LINE_PARAMS = {"regParam", "elasticNetParam", "fitIntercept", "standardization"}
_BAYES_METRICS = {"f1", "accuracy", "weightedPrecision", "weightedRecall"}
_MOMENTS = "fold int, task int, n double, mean array<double>, products array<double>"


@dataclass(frozen=True)
class Moments:
    """Count, means and centred products of some rows."""

    n: float
    mean: np.ndarray
    products: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        n = self.n + other.n
        if not self.n or not other.n:
            return self if self.n else other
        apart = other.mean - self.mean
        return Moments(
            n,
            self.mean + apart * (other.n / n),
            self.products
            + other.products
            + np.outer(apart, apart) * (self.n * other.n / n),
        )

    @staticmethod
    def of(rows: np.ndarray) -> Moments:
        mean = rows.mean(axis=0)
        centred = rows - mean
        return Moments(float(len(rows)), mean, centred.T @ centred)

    def row(self, fold: int, task: int) -> dict[str, object]:
        return {
            "fold": fold,
            "task": task,
            "n": self.n,
            "mean": self.mean.tolist(),
            "products": self.products.ravel().tolist(),
        }

    @staticmethod
    def from_row(row: Mapping) -> Moments:
        mean = np.array(row["mean"])
        return Moments(row["n"], mean, np.array(row["products"]).reshape(len(mean), len(mean)))


def _batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = [("fold", pa.int32()), ("task", pa.int32()), ("n", pa.float64())]
    lists = [(name, pa.list_(pa.float64())) for name in ("mean", "products")]
    return pa.RecordBatch.from_pylist(rows, pa.schema([*kinds, *lists]))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """Features and label of a batch, a row each."""
    label = batch.column("label").to_numpy(zero_copy_only=False)
    values = batch.column("features").flatten().to_numpy(zero_copy_only=False)
    return np.column_stack([values.reshape(len(label), -1), label])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row of moments for each fold that a task meets."""
    found: dict[int, Moments] = {}
    task = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        task = batch.column("task")[0].as_py()
        folds, rows = batch.column("fold").to_numpy(), _matrix(batch)
        for fold in np.unique(folds):
            moments = Moments.of(rows[folds == fold])
            held = found.get(int(fold))
            found[int(fold)] = moments if held is None else held + moments
    yield _batch([m.row(fold, task) for fold, m in found.items()])


def _merge(table: pa.Table) -> pa.Table:
    rows = table.sort_by("task").to_pylist()
    total = Moments.from_row(rows[0])
    for row in rows[1:]:
        total = total + Moments.from_row(row)
    return pa.Table.from_batches([_batch([total.row(rows[0]["fold"], rows[0]["task"])])])


def moments(rows: DataFrame) -> dict[int, Moments]:
    """Moments of ``features`` (arrays) and ``label`` of every ``fold``.

    Sums of the tasks are merged in groups first, so that no task holds those of all.
    """
    summed = rows.withColumn("task", F.spark_partition_id()).mapInArrow(_summed, _MOMENTS)
    some = summed.groupBy("fold", F.pmod("task", F.lit(_MERGED))).applyInArrow(_merge, _MOMENTS)
    found = some.groupBy("fold").applyInArrow(_merge, _MOMENTS).collect()
    return {r["fold"]: Moments.from_row(r) for r in found}


def line(
    train: Moments, ridge: float, lasso: float, intercept: bool, standardise: bool
) -> tuple[np.ndarray, float] | None:
    """Weights and intercept of least squares with penalties, as Spark weighs them.

    Penalties hold for features and label in units of their deviation; without ``standardise``,
    features keep their own unit. None where a column does not vary.
    """
    d = len(train.mean) - 1
    spread = np.sqrt(np.diag(train.products) / train.n)
    if not (np.isfinite(spread).all() and (spread > 0).all()):
        return None
    about = train.products / train.n
    if not intercept:
        about = about + np.outer(train.mean, train.mean)
    scaled = about / np.outer(spread, spread)
    left, right = scaled[:d, :d], scaled[:d, d]
    unit = np.ones(d) if standardise else 1 / spread[:d]
    l2, l1 = ridge / spread[d] * unit**2, lasso / spread[d] * unit
    if not lasso:
        weights = np.linalg.lstsq(left + np.diag(l2), right, rcond=None)[0]
    else:
        weights = _descend(left, right, l2, l1)
    weights = weights * spread[d] / spread[:d]
    return weights, float(train.mean[d] - train.mean[:d] @ weights) if intercept else 0.0


def _descend(left: np.ndarray, right: np.ndarray, l2: np.ndarray, l1: np.ndarray) -> np.ndarray:
    """Minimum with absolute penalties, one weight after the other until none moves."""
    weights = np.zeros(len(right))
    for _ in range(10_000):
        moved = 0.0
        for j in range(len(right)):
            rest = right[j] - left[j] @ weights + left[j, j] * weights[j]
            new = math.copysign(max(abs(rest) - l1[j], 0.0), rest) / (left[j, j] + l2[j])
            moved, weights[j] = max(moved, abs(new - weights[j])), new
        if moved < 1e-12:
            break
    return weights


def line_error(test: Moments, weights: np.ndarray, intercept: float, metric: str) -> float:
    """The metric of a line on rows of which only the moments are known."""
    signed = np.append(-weights, 1.0)
    off = float(signed @ test.mean - intercept)
    squares = max(0.0, float(signed @ test.products @ signed)) + test.n * off * off
    if metric == "r2":
        return 1 - squares / float(test.products[-1, -1])
    return math.sqrt(squares / test.n) if metric == "rmse" else squares / test.n


def _plain(preprocessing: Pipeline | None) -> bool:
    """Whether the preprocessing learns nothing from rows."""
    stages = [] if preprocessing is None else preprocessing.getStages()
    return not any(isinstance(s, Estimator) for s in stages)


def _same_columns(model, evaluator: Evaluator) -> bool:
    get = evaluator.getOrDefault
    weighed = any(x.hasParam("weightCol") and x.isSet(x.weightCol) for x in (model, evaluator))
    return not weighed and (get("labelCol"), get("predictionCol")) == (
        model.getLabelCol(),
        model.getPredictionCol(),
    )


def _names(grid: Sequence[Mapping]) -> set[str]:
    return {p.name for params in grid for p in params}


def _own(model, grid: Sequence[Mapping]) -> bool:
    return all(p.parent == model.uid for params in grid for p in params)


def _rows(
    model, data: DataFrame, preprocessing: Pipeline | None, fold: str, folds: Sequence[int]
) -> DataFrame:
    if preprocessing is not None:
        # Every fold fits it, as in the general search; no stage learns, so all are the same.
        fitted = [preprocessing.fit(data.filter(quoted(fold) != i)) for i in folds]
        data = fitted[0].transform(data)
    return data.select(
        quoted(fold).cast("int").alias("fold"),
        vector_to_array(quoted(model.getFeaturesCol())).alias("features"),
        quoted(model.getLabelCol()).cast("double").alias("label"),
    )


def _width(rows: DataFrame) -> int:
    first = rows.filter("features is not null").select(F.size("features")).first()
    return 0 if first is None else first[0]


def _filled(rows: DataFrame, width: int) -> DataFrame:
    """Missing values as NaN, which no sum hides."""
    nan = F.lit(math.nan)
    return rows.select(
        "fold",
        F.coalesce("features", F.array_repeat(nan, width)).alias("features"),
        F.coalesce("label", nan).alias("label"),
    )


def _of(model, params: Mapping, name: str) -> object:
    return params.get(model.getParam(name), model.getOrDefault(name))


def line_scores(
    model,
    grid: Sequence[Mapping],
    data: DataFrame,
    evaluator: Evaluator,
    preprocessing: Pipeline | None,
    fold: str,
    folds: Sequence[int],
) -> list[list[float]] | None:
    """Scores by held-out fold and combination of a linear regression, from one pass."""
    fits = (
        isinstance(model, LinearRegression)
        and isinstance(evaluator, RegressionEvaluator)
        and _own(model, grid)
        and _names(grid) <= _LINE_PARAMS
        and model.getOrDefault("loss") == "squaredError"
        and model.getOrDefault("solver") in ("auto", "normal")
        and evaluator.getMetricName() in ("rmse", "mse", "r2")
        and not evaluator.getOrDefault("throughOrigin")
    )
    if not (fits and _plain(preprocessing) and _same_columns(model, evaluator)):
        return None
    rows = _rows(model, data, preprocessing, fold, folds)
    width = _width(rows)
    if not 0 < width <= MOST_FEATURES:
        return None
    found = moments(_filled(rows, width))
    scores = []
    for i in folds:
        train = [m for k, m in found.items() if k != i]
        if i not in found or not train:
            return None
        total = sum(train[1:], train[0])
        held = []
        for params in grid:
            reg, mixed = _of(model, params, "regParam"), _of(model, params, "elasticNetParam")
            intercept = _of(model, params, "fitIntercept")
            fit = line(total, reg * (1 - mixed), reg * mixed, intercept, _of(model, params, "standardization"))
            if fit is None:
                return None
            held.append(line_error(found[i], *fit, evaluator.getMetricName()))
        scores.append(held)
    return scores if all(math.isfinite(s) for row in scores for s in row) else None


def class_sums(rows: DataFrame) -> DataFrame:
    """``fold, label, slot, total``: sums of each feature by fold and class; slot -1 counts rows."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, float], np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            held, folds = _matrix(batch), batch.column("fold").to_numpy()
            for fold, label in set(zip(folds.tolist(), held[:, -1].tolist())):
                mine = held[(folds == fold) & (held[:, -1] == label), :-1]
                sums = np.append(mine.sum(axis=0), float(len(mine)))
                if (mine < 0).any():
                    sums[:] = math.nan  # no counts; the general search tells the user
                found[fold, label] = found.get((fold, label), 0.0) + sums
        for (fold, label), sums in found.items():
            n = len(sums)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([fold] * n, pa.int32()),
                    pa.array([label] * n, pa.float64()),
                    pa.array([*range(n - 1), -1], pa.int32()),
                    pa.array(sums, pa.float64()),
                ],
                names=["fold", "label", "slot", "total"],
            )

    added = rows.mapInArrow(summed, "fold int, label double, slot int, total double")
    return added.groupBy("fold", "label", "slot").agg(F.sum("total").alias("total"))


def bayes_scores(
    model,
    grid: Sequence[Mapping],
    data: DataFrame,
    evaluator: Evaluator,
    preprocessing: Pipeline | None,
    fold: str,
    folds: Sequence[int],
) -> list[list[float]] | None:
    """Scores by held-out fold and combination of multinomial naive Bayes, from two passes."""
    fits = (
        isinstance(model, NaiveBayes)
        and isinstance(evaluator, MulticlassClassificationEvaluator)
        and _own(model, grid)
        and _names(grid) <= {"smoothing"}
        and model.getModelType() == "multinomial"
        and not (model.isDefined("thresholds") and model.isSet("thresholds"))
        and evaluator.getMetricName() in _BAYES_METRICS
    )
    if not (fits and _plain(preprocessing) and _same_columns(model, evaluator)):
        return None
    rows = _rows(model, data, preprocessing, fold, folds)
    width = _width(rows)
    if not 0 < width <= MOST_SUMS:
        return None
    rows = _filled(rows, width)
    found = class_sums(rows).limit(MOST_SUMS + 1).toArrow().to_pydict()
    totals = np.array(found["total"])
    if not 0 < len(totals) <= MOST_SUMS or not np.isfinite(totals).all():
        return None
    labels = sorted(set(found["label"]))
    if labels != [float(i) for i in range(len(labels))]:
        return None
    sums = np.zeros((len(folds), len(labels), width + 1))
    place = {f: i for i, f in enumerate(folds)}
    at = [place[f] for f in found["fold"]]
    sums[at, np.array(found["label"], int), found["slot"]] = totals
    smoothing = [float(_of(model, params, "smoothing")) for params in grid]
    if not all(s > 0 for s in smoothing):
        return None
    rest = sums.sum(axis=0) - sums  # what each held-out fold is trained on
    if (rest[:, :, -1] <= 0).any():
        return None
    # By fold and combination: class priors and log probabilities of features, as Spark smooths.
    prior, theta = [], []
    for s in smoothing:
        counts = rest[:, :, -1]
        prior.append(np.log(counts + s) - np.log(counts.sum(axis=1) + len(labels) * s)[:, None])
        held = rest[:, :, :-1]
        theta.append(np.log(held + s) - np.log(held.sum(axis=2) + width * s)[:, :, None])
    weights = data.sparkSession.sparkContext.broadcast((np.array(prior), np.array(theta)))
    numbers = {f: i for i, f in enumerate(folds)}

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prior, theta = weights.value
        counts: dict[tuple[int, int, float, float], int] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            held, folds = _matrix(batch), batch.column("fold").to_numpy()
            for fold in np.unique(folds):
                mine, i = held[folds == fold], numbers[int(fold)]
                for combo in range(len(prior)):
                    best = np.argmax(mine[:, :-1] @ theta[combo, i].T + prior[combo, i], axis=1)
                    pairs, n = np.unique(np.column_stack([mine[:, -1], best]), axis=0, return_counts=True)
                    for (label, prediction), k in zip(pairs.tolist(), n.tolist()):
                        key = (int(fold), combo, label, prediction)
                        counts[key] = counts.get(key, 0) + k
        keys = list(counts)
        kinds = (pa.int32(), pa.int32(), pa.float64(), pa.float64())
        columns = [pa.array([k[i] for k in keys], kind) for i, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(list(counts.values()), pa.int64())],
            names=["fold", "combo", "label", "prediction", "count"],
        )

    shape = "fold int, combo int, label double, prediction double, count long"
    cells = rows.mapInArrow(scored, shape).groupBy("fold", "combo", "label", "prediction")
    table = metrics.of_confusion(cells.agg(F.sum("count").alias("count")), by=["fold", "combo"])
    by_place = {(r["fold"], r["combo"]): r[evaluator.getMetricName()] for r in table.collect()}
    if any((f, c) not in by_place for f in folds for c in range(len(grid))):
        return None
    return [[by_place[f, c] for c in range(len(grid))] for f in folds]


def scores(
    model,
    grid: Sequence[Mapping],
    data: DataFrame,
    evaluator: Evaluator,
    preprocessing: Pipeline | None,
    fold: str,
    folds: Sequence[int],
) -> list[list[float]] | None:
    """Scores by held-out fold and combination where sums suffice, else None."""
    for found in (line_scores, bayes_scores):
        result = found(model, grid, data, evaluator, preprocessing, fold, folds)
        if result is not None:
            return result
    return None
