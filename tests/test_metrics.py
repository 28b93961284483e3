import math

import numpy as np
import pytest
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.sql import functions as F

from tabloom.operators import diagnostics, metrics


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(3)
    label = rng.integers(0, 2, 2000).astype(float)
    score = np.round(rng.normal(size=2000) + label, 2)
    score[::3] = 0.5  # one score holds a third of the rows
    rows = [(float(y), float(s), float(s > 0.7)) for y, s in zip(label, score)]
    return spark.createDataFrame(rows, "label double, score double, prediction double").repartition(5)


@pytest.mark.parametrize("partitions", ["1", "8", "50"])
def test_curves_agree_with_spark(spark, scored, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = metrics.binary(scored).first()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for metric in metrics.BINARY_METRICS:
        evaluator = BinaryClassificationEvaluator(
            rawPredictionCol="score", metricName=metric, numBins=0
        )
        assert found[metric] == pytest.approx(evaluator.evaluate(scored), abs=1e-12)


def test_curves_of_groups(scored):
    grouped = scored.withColumn("g", F.when(F.col("score") > 0, "x").otherwise("y"))
    found = {r["g"]: r for r in metrics.binary(grouped, by=["g"]).collect()}
    for g in "xy":
        alone = metrics.binary(grouped.filter(F.col("g") == g)).first()
        assert found[g]["areaUnderROC"] == pytest.approx(alone["areaUnderROC"], abs=1e-12)
        assert found[g]["areaUnderPR"] == pytest.approx(alone["areaUnderPR"], abs=1e-12)


def test_curves_of_one_class(spark):
    df = spark.createDataFrame([(1.0, 0.3), (1.0, 0.4)], "label double, score double")
    found = metrics.binary(df).first()
    assert found["areaUnderROC"] is None and found["areaUnderPR"] == 1.0
    empty = metrics.binary(df.limit(0)).first()
    assert empty["areaUnderROC"] is None and empty["areaUnderPR"] is None


def test_curves_skip_rows_without_score(spark):
    rows = [(1.0, 0.9), (0.0, 0.1), (None, 0.5), (1.0, None)]
    df = spark.createDataFrame(rows, "label double, score double")
    assert metrics.binary(df).first()["areaUnderROC"] == 1.0


def test_multiclass_agrees_with_spark(spark):
    rng = np.random.default_rng(4)
    rows = [(float(a), float(b)) for a, b in rng.integers(0, 4, (500, 2)) if b != 3]
    df = spark.createDataFrame(rows, "label double, prediction double")
    found = metrics.multiclass(df).first()
    for metric in metrics.MULTICLASS_METRICS:
        expected = MulticlassClassificationEvaluator(metricName=metric).evaluate(df)
        assert found[metric] == pytest.approx(expected, abs=1e-12)


def test_regression_agrees_with_spark(spark):
    rng = np.random.default_rng(5)
    rows = [(float(a), float(a + b)) for a, b in rng.normal(size=(500, 2))]
    df = spark.createDataFrame(rows, "label double, prediction double")
    found = metrics.regression(df).first()
    for metric in metrics.REGRESSION_METRICS:
        expected = RegressionEvaluator(metricName=metric).evaluate(df)
        assert found[metric] == pytest.approx(expected, abs=1e-9)
    constant = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "label double, prediction double")
    assert metrics.regression(constant).first()["r2"] is None


def test_report_of_a_class_never_predicted(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0)], "label double, prediction double")
    found = {r["class"]: r for r in metrics.classification_report(df).collect()}
    assert found["1.0"]["precision"] == found["1.0"]["f1"] == 0.0
    assert found["0.0"]["precision"] == 0.5 and found["0.0"]["recall"] == 1.0
    assert found["accuracy"]["f1"] == 0.5 and found["macro avg"]["support"] == 2


def test_direction():
    assert metrics.larger_is_better("areaUnderROC") and metrics.larger_is_better("test_r2")
    assert not metrics.larger_is_better("rmse") and not metrics.larger_is_better("test_mae")


def test_qq_of_normal_data_is_a_line(spark):
    df = spark.range(20000).select((F.randn(7) * 3 + 1).alias("residual"))
    line = diagnostics.qq_line(diagnostics.residual_qq(df)).first()
    assert math.isclose(line["slope"], 3, abs_tol=0.15)
    assert math.isclose(line["intercept"], 1, abs_tol=0.15)
    rough = diagnostics.qq_line(diagnostics.residual_qq(df, relative_error=0.001)).first()
    assert math.isclose(rough["slope"], line["slope"], abs_tol=0.1)
    with pytest.raises(ValueError):
        diagnostics.residual_qq(df.limit(0))


def test_axis_range(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, -1.0)], "a double, b double")
    assert tuple(diagnostics.axis_range(df, ["a", "b"]).first()) == (-1.0, 5.0)
    assert tuple(diagnostics.axis_range(df, ["a"]).first()) == (1.0, 2.0)


def test_matrix_of_too_many_classes(spark, monkeypatch):
    df = spark.range(30).select(F.col("id").alias("label"), (F.col("id") % 7).alias("prediction"))
    assert metrics.confusion_matrix(df).count() == 30
    monkeypatch.setattr(metrics, "MOST_CLASSES", 20)
    with pytest.raises(ValueError, match="more than 20 classes"):
        metrics.confusion_matrix(df)
