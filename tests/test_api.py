"""The class interface and the sources."""

import pytest
from pyspark.sql import functions as F

from tabloom import api, sources, workspace
from tabloom.sources import runlog


@pytest.fixture(scope="module")
def demo(spark):
    return sources.synthetic(spark, 300)


def test_synthetic(spark, demo):
    assert demo.columns == [
        "id", "feature1", "feature2", "feature3", "feature4", "category", "label"
    ]
    assert dict(demo.dtypes)["label"] == "int" and demo.count() == 300
    assert demo.collect() == sources.synthetic(spark, 300).collect()


def test_quality_report(demo):
    checker = api.DataQualityChecker(demo)
    report = checker.generate_quality_report(["category", "label"])
    assert report["total_rows"] == 300 and report["total_columns"] == 7
    assert report["duplicates"] == checker.check_duplicates() == 0
    assert report["cardinality"] == checker.check_cardinality(["category", "label"])
    assert report["missing_values"] == checker.check_missing_values().first().asDict()
    assert report["statistics"]["id"]["max"] == 299.0
    assert report["statistics"]["category"] == {"count": 300.0, "min": "0", "max": "2"}
    assert "cardinality" not in checker.generate_quality_report()
    assert checker.get_statistics().columns[0] == "summary"


def test_column_names(demo):
    e, o = api.FeatureEngineer, api.OutlierHandler
    df = e.create_interaction_features(demo, "feature1", "feature2")
    df = e.create_polynomial_features(df, "feature1", 3)
    df = e.create_binned_features(df, "feature3", 4)
    df = e.create_aggregation_features(df, "category", "feature4", ["mean"])
    df = o.cap_outliers(o.detect_outliers_iqr(df, "feature4"), "feature4")
    assert set(df.columns) - set(demo.columns) == {
        "feature1_multiply_feature2",
        "feature1_pow_2",
        "feature1_pow_3",
        "feature3_binned",
        "category_feature4_mean",
        "feature4_is_outlier",
        "feature4_capped",
    }
    assert df.count() == 300
    assert o.remove_outliers(demo, "feature4").count() <= 300


def test_balancer(demo):
    up = api.DataBalancer.oversample_minority(demo)
    down = api.DataBalancer.undersample_majority(demo)
    assert down.count() <= 300 <= up.count()


def test_pipelines(demo):
    first = api.create_preprocessing_pipeline(["feature1", "feature2"], ["category"])
    row = first.fit(demo).transform(demo).first()
    assert row["features"].size == row["scaled_features"].size == 6
    preprocessor = api.DataPreprocessor(["category"], ["feature1", "feature2"])
    assert len(preprocessor.build_pipeline().getStages()) == len(
        preprocessor.build_pipeline().getStages()
    )
    row = preprocessor.build_pipeline().fit(demo).transform(demo).first()
    assert row["assembled_features"].size == row["features"].size == 5


def test_builder_example(demo):
    pipeline = (
        api.PipelineBuilder()
        .add_imputer(["feature1", "feature2"], strategy="mean")
        .add_string_indexer(["category"])
        .add_one_hot_encoder(["category"])
        .add_vector_assembler(["feature1", "feature2", "category_encoded"])
        .add_minmax_scaler()
        .build()
    )
    assert pipeline.fit(demo).transform(demo).count() == 300


def test_sources(spark, demo, tmp_path, capsys):
    path = str(tmp_path / "csv")
    demo.select("id", "category", "label").write.option("header", True).csv(path)
    assert dict(sources.load_csv(spark, path).dtypes) == {"id": "int", "category": "int", "label": "int"}
    assert {t for _, t in sources.load_csv(spark, path, infer=False).dtypes} == {"string"}
    typed = sources.load_csv(spark, path, "id bigint, category string, label int")
    assert typed.agg(F.sum("id")).first()[0] == 299 * 150
    demo.createOrReplaceTempView("demo_rows")
    assert tuple(sources.table_shape(sources.load_table(spark, "demo_rows")).first()) == (300, 7)
    sources.preview(demo, 2)
    assert "feature4" in capsys.readouterr().out


def test_format_name_is_handed_on(spark):
    with pytest.raises(Exception, match="no_such_format"):
        sources.load(spark, "no_such_format", "/nowhere")


def test_shared_folder_is_the_sessions(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert workspace.shared_dir(spark) == named
    staged = workspace.stage(spark.range(5), "numbers")
    assert staged.count() == 5
    assert all(f.removeprefix("file://").startswith(named) for f in staged.inputFiles())


def test_tables_stored_on_the_way_are_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workspace, "shared_dir", lambda _: str(tmp_path))
    with workspace.scratch() as keep:
        numbers = workspace.stage(spark.range(5), "numbers")
        with workspace.scratch() as keep_inner:
            inner = keep_inner(numbers.filter("id > 1"), "inner")
        halves = [inner.filter("id < 3"), inner.filter("id > 2")]
        table = workspace.stage_bucketed(halves[0], "dealt", "id", 2, "id", more=halves[1:])
        assert sorted(r.id for r in table.collect()) == [2, 3, 4]
        kept = keep(table.filter("id > 3"), "kept")
    with pytest.raises(ZeroDivisionError), workspace.scratch():
        workspace.stage(spark.range(5), "numbers")
        _ = 1 / 0
    assert [r.id for r in kept.collect()] == [4]
    assert [p.name.split("-")[0] for p in (tmp_path / "tabloom").iterdir()] == ["kept"]
    assert not [t for t in spark.catalog.listTables() if "dealt" in t.name]


def test_notebook_functions(spark, demo, tmp_path):
    log = str(tmp_path / "log")
    prepare = api.DataPreprocessor(["category"], ["feature1", "feature2"]).build_pipeline()
    train, test = demo.filter("id < 240"), demo.filter("id >= 240")
    frames, models = {}, {}
    for name in ("logistic", "decision_tree"):
        estimator = api.ClassificationTrainer().get_model(name)
        models[name], frames[name] = api.train_classification_model(
            estimator, name, train, test, prepare, log
        )
    assert frames["logistic"].count() == 60
    board = {r["model"]: r for r in api.display_model_metrics(frames).collect()}
    assert board["logistic"]["areaUnderROC"] > 0.9
    logged = runlog.compare(runlog.read(spark, log), ["test_areaUnderROC"]).collect()
    found = {r["run_name"]: r["test_areaUnderROC"] for r in logged}
    assert found["decision_tree"] == pytest.approx(board["decision_tree"]["areaUnderROC"])
    assert api.batch_predict(models["logistic"], test).columns == [
        "features", "prediction", "probability"
    ]
    tree = api.ClassificationTrainer().get_model("decision_tree")
    grid = api.HyperparameterTuner().create_param_grid(tree, {"maxDepth": [1, 3]})
    assert len(api.tune_model_with_cv(tree, grid, train, prepare).avgMetrics) == 2
