"""Scores from sums by fold against fitting every combination, and even training rows."""

import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tabloom.operators import fold_sums, split, tuning


@pytest.fixture(scope="module")
def assembled(spark):
    columns = ["a", "b", "c"]
    return Pipeline(stages=[VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="keep")])


@pytest.fixture(scope="module")
def items(spark):
    rng = random.Random(1)
    rows = []
    for i in range(900):
        a, b, c = rng.gauss(1e6, 3), float(rng.randrange(9)), rng.expovariate(1)
        rows.append((i, a, b, c, 3 * a - 50 * b + rng.gauss(0, 4), float(rng.random() < b / 9) + (c > 2)))
    return spark.createDataFrame(rows, "id long, a double, b double, c double, label double, kind double").coalesce(2).cache()


def without_sums(monkeypatch):
    monkeypatch.setattr(fold_sums, "scores", lambda *_: None)


GRIDS = [
    ("rmse", {"regParam": [0.0, 20.0], "fitIntercept": [True, False]}),
    ("r2", {"regParam": [0.5, 5.0], "elasticNetParam": [0.3, 1.0]}),
    ("mse", {"elasticNetParam": [0.0, 0.5], "regParam": [0.7], "standardization": [False], "fitIntercept": [False]}),
]


@pytest.mark.parametrize("metric, values", GRIDS)
def test_lines_from_sums(monkeypatch, items, assembled, metric, values):
    model = LinearRegression(maxIter=500, tol=1e-12)
    grid = tuning.param_grid(model, values)
    # Far from zero, the search that Spark takes for absolute penalties does not settle.
    data = items if "elasticNetParam" not in values else items.withColumn("a", F.col("a") - 999_990)
    evaluator = RegressionEvaluator(metricName=metric)
    options = {"folds": 2, "preprocessing": assembled, "fold_key": "id"}
    found = tuning.cross_validate(model, grid, data, evaluator, **options)
    one = tuning.train_validation(model, grid, data, evaluator, preprocessing=assembled, split_key="id")
    assert fold_sums.scores(model, grid, data.withColumn("f", F.lit(0)), evaluator, assembled, "f", [0]) is None
    without_sums(monkeypatch)
    expected = tuning.cross_validate(model, grid, data, evaluator, **options)
    for a, b in zip(found.fold_scores, expected.fold_scores):
        assert a == pytest.approx(b, rel=2e-4)
    assert found.bestModel.stages[-1].coefficients.toArray() == pytest.approx(
        expected.bestModel.stages[-1].coefficients.toArray(), rel=1e-6
    )
    other = tuning.train_validation(model, grid, data, evaluator, preprocessing=assembled, split_key="id")
    assert one.validationMetrics == pytest.approx(other.validationMetrics, rel=2e-4)


def test_naive_bayes_from_sums(monkeypatch, items, assembled):
    model = NaiveBayes(labelCol="kind")
    grid = tuning.param_grid(model, {"smoothing": [0.1, 50.0]})
    data = items.withColumn("a", F.col("id") % 7 + F.col("kind"))
    options = {"folds": 2, "preprocessing": assembled, "fold_key": "id"}
    for metric in ("f1", "weightedPrecision"):
        evaluator = MulticlassClassificationEvaluator(metricName=metric, labelCol="kind")
        found = tuning.cross_validate(model, grid, data, evaluator, **options)
        with monkeypatch.context() as patch:
            without_sums(patch)
            expected = tuning.cross_validate(model, grid, data, evaluator, **options)
        for a, b in zip(found.fold_scores, expected.fold_scores):
            assert a == pytest.approx(b, rel=1e-9)


def test_one_pass_reads_the_rows(spark, items, assembled, tmp_path):
    """All folds and combinations come from one job over the rows, besides the width of one."""
    items.write.parquet(str(tmp_path / "items"))
    data = spark.read.parquet(str(tmp_path / "items")).withColumn("f", F.col("id") % 3)
    model = LinearRegression()
    grid = tuning.param_grid(model, {"regParam": [0.0, 0.1, 0.2, 0.3], "fitIntercept": [True, False]})
    group = "sums-by-fold"
    spark.sparkContext.setJobGroup(group, "")
    evaluator = RegressionEvaluator(metricName="rmse")
    assert fold_sums.scores(model, grid, data, evaluator, assembled, "f", [0, 1, 2]) is not None
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 1 <= len(jobs) <= 5  # first row, three shuffle steps of the sums


def test_what_sums_cannot_tell_goes_the_long_way(spark, items, assembled):
    folded = items.withColumn("f", (F.col("id") % 2).cast("int"))
    rmse = RegressionEvaluator(metricName="rmse")
    line, none = LinearRegression(), [{}]

    def told(model, grid, data, evaluator, preprocessing=assembled):
        return fold_sums.scores(model, grid, data, evaluator, preprocessing, "f", [0, 1])

    assert told(line, none, folded, rmse) is not None
    scaled = Pipeline(stages=[*assembled.getStages(), StandardScaler(inputCol="features", outputCol="x")])
    for case in (
        (LinearRegression(loss="huber"), none, folded, rmse),
        (LinearRegression(solver="l-bfgs"), none, folded, rmse),
        (LinearRegression(weightCol="b"), none, folded, rmse),
        (line, [{line.maxIter: 3}], folded, rmse),
        (line, none, folded, RegressionEvaluator(metricName="mae")),
        (line, none, folded, RegressionEvaluator(labelCol="kind")),
        (line, none, folded, rmse, scaled),
        (line, none, folded.withColumn("c", F.lit(1.0)), rmse),
        (line, none, folded.withColumn("label", F.when(F.col("id") > 5, F.col("label"))), rmse),
        (line, none, folded.withColumn("c", F.when(F.col("id") > 5, F.col("c"))), rmse),
        (line, none, folded.limit(0), rmse),
        (LogisticRegression(), none, folded, MulticlassClassificationEvaluator()),
        (NaiveBayes(modelType="gaussian"), none, folded, MulticlassClassificationEvaluator()),
        (NaiveBayes(labelCol="kind"), none, folded.withColumn("c", -F.col("c")), MulticlassClassificationEvaluator(labelCol="kind")),
        (NaiveBayes(labelCol="b"), none, folded.filter("b != 3"), MulticlassClassificationEvaluator(labelCol="b")),
    ):
        assert told(*case) is None


def test_training_rows_are_even_and_do_not_follow_files(spark):
    rows = [(i, Vectors.dense([i % 7, 1.0]), None if i % 5 else "s") for i in range(4000)]
    rows += [(1, Vectors.sparse(2, [0], [3.0]), "copy")] * 20_000
    frames = [spark.createDataFrame(rows, ["id", "features", "s"]).repartition(n) for n in (3, 11)]
    laid = []
    for df in frames:
        with split.training_rows(df) as ready:
            parts = ready.withColumn("p", F.spark_partition_id())
            sizes = [r["count"] for r in parts.groupBy("p").count().collect()]
            assert sum(sizes) == len(rows) and len(sizes) == 16 and max(sizes) < 1.3 * min(sizes)
            laid.append([(r.p, r.id, str(r.features), r.s) for r in parts.collect()])
    assert laid[0] == laid[1]
    assert sorted(map(str, frames[0].collect())) == sorted(
        str(r) for r in split.even_rows(frames[1], 5).collect()
    )


def test_partitions_follow_bytes(spark, monkeypatch):
    df = spark.range(1000).select("id", F.lit("x" * 992).alias("s"))
    assert split.training_partitions(df) == split.TRAINING_PARTITIONS
    monkeypatch.setattr(split, "PARTITION_BYTES", 10_000)
    assert split.training_partitions(df) == -(-1000 * (8 + 1000) // 10_000)
    spark.conf.set(split.TRAINING_SETTING, "3")
    try:
        assert split.training_partitions(df) == 3
    finally:
        spark.conf.unset(split.TRAINING_SETTING)
    assert split.training_partitions(df.limit(0)) == split.TRAINING_PARTITIONS


def test_parts_of_a_split(spark):
    df = spark.range(500)
    shares = [0.2, 0.5, 0.3]
    numbered = df.withColumn("part", split.hash_part("id", shares))
    for i, part in enumerate(split.hash_split(df, "id", shares)):
        assert sorted(r.id for r in numbered.filter(F.col("part") == i).collect()) == sorted(r.id for r in part.collect())
