import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tabloom import api
from tabloom.functions import vector_item
from tabloom.operators import diagnostics, tuning
from tabloom.operators.models import ESTIMATORS, Trainer, best_result
from tabloom.operators.outliers import IQROutlier
from tabloom.operators.preprocessing import PipelineBuilder, preprocessing_pipeline
from tabloom.operators.scoring import predictor, score
from tabloom.sources import runlog
from tabloom.sources.persistence import load_model, save_model
from tabloom.streaming import open_stream, score_stream, write_stream


@pytest.fixture(scope="module")
def data(spark):
    """A label and a target that follow x, some noise, a category with gaps."""
    return (
        spark.range(600)
        .select(
            "id",
            (F.col("id") % 60 / 10.0).alias("x"),
            (F.col("id") % 7).cast("double").alias("noise"),
            F.when(F.col("id") % 10 != 0, (F.col("id") % 3).cast("string")).alias("c"),
        )
        .withColumn("label", (F.col("x") + F.col("noise") / 10 > 3).cast("double"))
        .withColumn("target", F.col("x") * 2 + F.col("noise") / 10)
    )


PREPARE = dict(numerical=["x", "noise"], categorical=["c"])


def nonnegative():
    """Scaled without centring, as naive Bayes needs it."""
    builder = PipelineBuilder().add_imputer(PREPARE["numerical"])
    builder.add_string_indexer(["c"]).add_one_hot_encoder(["c"])
    builder.add_vector_assembler(["x", "noise", "c_encoded"])
    return builder.add_standard_scaler(with_mean=False).build()


def test_names(spark):
    for task, known in ESTIMATORS.items():
        trainer = Trainer(task, "f", "l", "p")
        for name in known:
            model = trainer.get_model(name)
            assert (model.getFeaturesCol(), model.getLabelCol(), model.getPredictionCol()) == (
                "f",
                "l",
                "p",
            )
        with pytest.raises(ValueError):
            trainer.get_model("perceptron")
    assert Trainer("regression").get_model("linear", labelCol="y").getLabelCol() == "y"
    with pytest.raises(ValueError):
        Trainer("clustering")


def test_train_many_and_log(spark, data, tmp_path):
    log = str(tmp_path / "log")
    trainer = Trainer(
        "classification", "scaled_features", run_log=log, model_dir=str(tmp_path / "models")
    )
    train, test = data.filter("id % 5 != 0"), data.filter("id % 5 = 0")
    configs = {"random_forest": {"numTrees": 3, "seed": 1}}
    types = ["logistic", "random_forest", "naive_bayes"]
    found = trainer.train_many(
        types, train, test, nonnegative(), configs, "e"
    )
    assert list(found) == types and set(trainer.models) == set(types)
    for record in found.values():
        assert set(record["test_metrics"]) == {
            "areaUnderROC", "areaUnderPR", "accuracy", "f1", "weightedPrecision", "weightedRecall"
        }
        assert record["training_time"] > 0
    assert found["logistic"]["test_metrics"]["areaUnderROC"] > 0.95
    # the metrics of the shared pass are those of the model alone
    alone = trainer.metrics_of(trainer.models["random_forest"].transform(test))
    assert alone == pytest.approx(found["random_forest"]["test_metrics"])

    entries = runlog.read(spark, log)
    assert entries.select("run_id").distinct().count() == 3
    compared = runlog.compare(entries, ["test_areaUnderROC", "train_f1", "test_size"]).collect()
    assert {r["test_size"] for r in compared} == {120.0}
    best = runlog.best(entries, "test_areaUnderROC").first()
    assert best["value"] == max(r["test_metrics"]["areaUnderROC"] for r in found.values())
    path = entries.filter("key = 'model_path' and run_name = 'logistic'").first()["text"]
    again = load_model(path).transform(test).select("id", "prediction")
    first = trainer.models["logistic"].transform(test).select("id", "prediction")
    assert sorted(again.collect()) == sorted(first.collect())


def test_regression_and_residuals(data):
    trainer = api.RegressionTrainer(features_col="features", label_col="target")
    pipeline = PipelineBuilder().add_vector_assembler(["x", "noise"]).build()
    model, record, predictions = trainer.train_with_mlflow("linear", data, data, pipeline)
    assert set(record["test_metrics"]) == {"rmse", "mse", "mae", "r2"}
    assert record["test_metrics"]["r2"] == pytest.approx(1.0)
    assert diagnostics.residuals(predictions, "target").agg(F.max(F.abs("residual"))).first()[0] < 1e-9
    scores, _ = trainer.evaluate(model, data, trainer.get_evaluators())
    assert scores == pytest.approx(record["test_metrics"], abs=1e-9)


def test_binary_only_metrics_are_left_out(data):
    trainer = api.ClassificationTrainer(label_col="noise")
    pipeline = PipelineBuilder().add_vector_assembler(["x", "noise"]).build()
    results = trainer.train_multiple_models(["decision_tree"], data, data, pipeline, is_binary=False)
    assert "areaUnderROC" not in results["decision_tree"]["test_metrics"]
    assert len(trainer.get_evaluators(False)) == 4 and len(trainer.get_evaluators()) == 6
    api.ModelComparer.compare_results(results)


def test_spark_limits_stay_visible(spark, data):
    rows = data.select(F.col("noise").alias("label"), "x")
    pipeline = PipelineBuilder().add_vector_assembler(["x"]).build()
    trainer = Trainer("classification")
    for name in ("gbt", "svm"):
        with pytest.raises(Exception):
            trainer.train(trainer.get_model(name), rows, pipeline)
    negative = data.select("label", (-F.col("x")).alias("x"))
    with pytest.raises(Exception):
        trainer.train(trainer.get_model("naive_bayes"), negative, pipeline)


def test_best_result():
    def record(**values):
        return {"test_metrics": values}

    results = {
        "a": record(areaUnderROC=0.0, rmse=2.0),
        "b": record(areaUnderROC=None, rmse=float("nan")),
        "c": record(areaUnderROC=-1.0, rmse=1.0),
    }
    assert best_result(results) == ("a", 0.0)
    assert best_result(results, "rmse") == ("c", 1.0)
    assert best_result(results, "f1") == (None, None)
    assert api.ModelComparer.get_best_model({"x": record(r2=1), "y": record(r2=1)}, "r2")[0] == "x"


def test_run_log_edges(spark, tmp_path):
    path = str(tmp_path / "log")
    for name, score in [("zero", 0.0), ("none", None), ("nan", float("nan")), ("low", -1.0)]:
        runlog.append(runlog.entries(spark, name, {"p": 1}, {"r2": score, "rmse": score}), path)
    log = runlog.read(spark, path)
    assert runlog.best(log, "r2").first()["run_name"] == "zero"
    assert runlog.best(log, "rmse").first()["run_name"] == "low"
    assert runlog.best(log, "r2", larger=False).first()["run_name"] == "low"
    assert runlog.best(log, "f1").count() == 0


def test_importance_has_slot_names(data):
    trainer = Trainer("classification", "scaled_features")
    forest = trainer.get_model("random_forest", numTrees=5, seed=1)
    model, _ = trainer.train(forest, data, preprocessing_pipeline(**PREPARE))
    slots = diagnostics.feature_importance(model, data).collect()
    assert len(slots) == len(model.stages[-1].featureImportances) == 6
    assert slots[0]["feature"] == "x_imputed"
    assert {"c_encoded_0", "c_encoded_1", "c_encoded_2"} <= {r["feature"] for r in slots}
    inputs = diagnostics.feature_importance(model, data, by_input=True).collect()
    assert {r["feature"] for r in inputs} == {"x_imputed", "noise_imputed", "c_encoded"}
    assert sum(r["importance"] for r in inputs) == pytest.approx(1.0)
    assert diagnostics.feature_importance(model, data, top=2).count() == 2


def test_compare_predictions(data):
    trainer = Trainer("classification")
    pipeline = PipelineBuilder().add_vector_assembler(["x", "noise"]).build()
    models = {
        n: trainer.train(trainer.get_model(n), data, pipeline)[0]
        for n in ("decision_tree", "logistic")
    }
    side = diagnostics.compare_predictions(models, data, ["id"])
    assert side.columns == ["id", "decision_tree_prediction", "logistic_prediction"]
    joined = diagnostics.join_predictions(
        {n: m.transform(data) for n, m in models.items()}, "id"
    )
    assert sorted(side.collect()) == sorted(joined.collect())


def test_scoring_table_and_stream_agree(spark, data, tmp_path):
    data.repartition(3).write.parquet(str(tmp_path / "in"))
    trainer = Trainer("classification")
    builder = PipelineBuilder().add_imputer(["x", "noise"])
    builder.add_stage(IQROutlier(inputCols=["x"], mode="remove", multiplier=0.1, relativeError=0.0))
    pipeline = builder.add_vector_assembler(["x", "noise"]).build()
    model, _ = trainer.train(trainer.get_model("logistic"), data, pipeline)
    assert model.transform(data).count() < 600
    save_model(model, str(tmp_path / "model"))
    scored = score(model, data, ["id"])
    assert scored.columns == ["id", "features", "prediction", "probability"]
    assert scored.count() == 600

    stream = open_stream(spark, str(tmp_path / "in"), data.schema, maxFilesPerTrigger=1)
    result = score_stream(load_model(str(tmp_path / "model")), stream, ["id"])
    query = write_stream(result, str(tmp_path / "out"), str(tmp_path / "progress"))
    query.awaitTermination()
    written = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(written.select("id", "prediction").collect()) == sorted(
        scored.select("id", "prediction").collect()
    )
    # a second run finds nothing new
    write_stream(result, str(tmp_path / "out"), str(tmp_path / "progress")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 600
    with pytest.raises(ValueError):
        score_stream(model, data)

    loaded = predictor(str(tmp_path / "model"), ["id"], ["prediction"])
    assert data.transform(loaded).columns == ["id", "prediction"]
    assert stream.transform(loaded).isStreaming


def test_svm_has_no_probability(data):
    trainer = Trainer("classification")
    pipeline = PipelineBuilder().add_vector_assembler(["x"]).build()
    model, _ = trainer.train(trainer.get_model("svm", maxIter=3), data, pipeline)
    assert score(model, data, ["id"]).columns == ["id", "features", "prediction"]


def test_probabilities_sum_to_one(data):
    trainer = Trainer("classification")
    pipeline = PipelineBuilder().add_vector_assembler(["x"]).build()
    model, _ = trainer.train(trainer.get_model("logistic"), data, pipeline)
    total = vector_item("probability", 0) + vector_item("probability", 1)
    assert score(model, data).filter(F.abs(total - 1) > 1e-9).count() == 0


def test_param_grid():
    model = Trainer("classification").get_model("random_forest")
    grid = tuning.param_grid(model, {"numTrees": [1, 2], "maxDepth": [2, 3, 4]})
    assert len(grid) == 6
    with pytest.raises(AttributeError):
        tuning.param_grid(model, {"depth": [1]})


@pytest.mark.parametrize("key", [None, "id"])
def test_searches(spark, data, tmp_path, key):
    log = str(tmp_path / "log")
    tuner = api.HyperparameterTuner(run_log=log)
    model = Trainer("regression", label_col="target").get_model("linear", solver="normal")
    grid = tuner.create_param_grid(model, {"regParam": [5.0, 0.0]})
    evaluator = RegressionEvaluator(labelCol="target", metricName="rmse")
    pipeline = Pipeline(stages=[VectorAssembler(inputCols=["x", "noise"], outputCol="features")])
    for search in (
        tuner.tune_with_cross_validation(
            model, grid, data, evaluator, 2, pipeline, fold_key=key
        ),
        tuner.tune_with_train_validation_split(
            model, grid, data, evaluator, 0.7, pipeline, split_key=key
        ),
    ):
        assert tuning.best_score(search, evaluator) == min(tuning.scores_of(search))
        assert search.bestModel.stages[-1].getRegParam() == 0.0
        results = tuning.grid_results(spark, search, grid)
        assert tuning.best_combo(results, larger=False).first()["combo"] == 1
        assert results.first()["params"] == {"regParam": "5.0"}
    logged = runlog.read(spark, log)
    assert logged.filter("key = 'best_regParam'").first()["text"] == "0.0"
    assert logged.select("run_name").distinct().count() == 2


def test_best_index():
    assert tuning.best_index([0.1, float("nan"), 0.3, 0.3], True) == 2
    assert tuning.best_index([0.0, 0.2], False) == 0
    with pytest.raises(ValueError):
        tuning.best_index([float("nan")], True)


def test_search_with_larger_is_better(data):
    model = Trainer("classification").get_model("decision_tree")
    grid = tuning.param_grid(model, {"maxDepth": [0, 4]})
    pipeline = PipelineBuilder().add_vector_assembler(["x", "noise"]).build()
    evaluator = BinaryClassificationEvaluator()
    search = tuning.cross_validate(model, grid, data, evaluator, 2, pipeline, "id")
    assert search.bestModel.stages[-1].getMaxDepth() == 4


def test_preprocessing_is_fitted_once_a_fold(data, monkeypatch):
    fits = []
    original = Pipeline._fit
    monkeypatch.setattr(Pipeline, "_fit", lambda self, df: fits.append(1) or original(self, df))
    model = Trainer("regression", label_col="target").get_model("linear", solver="normal")
    grid = tuning.param_grid(model, {"regParam": [5.0, 1.0, 0.0]})
    evaluator = RegressionEvaluator(labelCol="target", metricName="rmse")
    pipeline = Pipeline(stages=[VectorAssembler(inputCols=["x", "noise"], outputCol="features")])
    search = tuning.cross_validate(model, grid, data, evaluator, 3, pipeline, "id")
    assert len(fits) == 3 + 1
    assert [len(s) for s in search.fold_scores] == [3, 3, 3]
