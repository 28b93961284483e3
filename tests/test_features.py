import math

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from tabloom.operators import features as f
from tabloom.operators import outliers as o
from tabloom.operators import profile
from tabloom.operators.preprocessing import (
    FillModel,
    MedianImputer,
    PipelineBuilder,
    preprocessing_pipeline,
)


def column(df, name):
    return [r[name] for r in df.collect()]


def test_divide(spark):
    df = spark.createDataFrame(
        [(1.0, 0.0), (1.0, None), (None, 2.0), (3.0, 2.0), (1.0, float("nan"))], "a double, b double"
    )
    found = column(f.interaction(df, "a", "b", "divide"), "a_divide_b")
    assert found[:4] == [0.0, 0.0, None, 1.5] and math.isnan(found[4])


def test_unknown_names_raise(spark):
    df = spark.range(3).withColumn("x", F.col("id").cast("double"))
    with pytest.raises(ValueError):
        f.interaction(df, "id", "x", "modulo")
    with pytest.raises(ValueError):
        f.binned(df, "x", method="kmeans")
    with pytest.raises(ValueError):
        f.group_agg(df, "id", "x", ["median"])
    with pytest.raises(ValueError):
        f.group_agg(df, "id", "x", [])
    with pytest.raises(ValueError):
        o.IQROutlier(inputCols=["x"], mode="flag")
    with pytest.raises(ValueError):
        PipelineBuilder().add_imputer(["x"], "max")
    with pytest.raises(ValueError):
        preprocessing_pipeline(["x"], [], scaling="robust")


def test_polynomial(spark):
    df = spark.createDataFrame([(2,), (None,)], "x int")
    found = f.polynomial(df, "x", 4)
    assert found.columns == ["x", "x_pow_2", "x_pow_3", "x_pow_4"]
    assert found.first()["x_pow_4"] == 16.0
    assert f.polynomial(df, "x", 1).columns == ["x"]


@pytest.mark.parametrize("error", [0.0, 0.001])
def test_quantile_bins(spark, error):
    values = [float(v) for v in range(100)] + [None, float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    found = f.binned(df, "x", 5, relative_error=error)
    bins = {r["x"]: r["x_binned"] for r in found.filter(~F.isnan("x")).collect()}
    assert bins[0.0] == 0.0 and bins[99.0] == 4.0
    assert found.filter("x is null").first()["x_binned"] is None
    assert found.filter(F.isnan("x")).first()["x_binned"] == 5.0


def test_quantile_bins_with_equal_cuts(spark):
    df = spark.createDataFrame([(0.0,)] * 90 + [(1.0,)] * 10, "x double")
    for error in (0.0, 0.001):
        found = f.binned(df, "x", 5, relative_error=error).select("x", "x_binned").distinct()
        assert found.count() == 2


def test_equal_width_bins(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)], "x double")
    assert column(f.binned(df, "x", 5, "equal_width"), "x_binned") == [0, 0, 1, 1, 2, 2, 3, 3, 4, 4, 4]
    constant = spark.createDataFrame([(7.0,)] * 3 + [(None,), (float("nan"),)], "x double")
    assert column(f.binned(constant, "x", 5, "equal_width"), "x_binned") == [0, 0, 0, None, 1]
    assert set(column(f.binned(df, "x", 1, "equal_width"), "x_binned")) == {0.0}
    with pytest.raises(ValueError):
        f.binned(constant.filter("x is null"), "x", 5, "equal_width")


def test_group_agg(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", 3.0), ("b", None), (None, 5.0)], "g string, x double"
    ).select("x", "g")
    found = f.group_agg(df, "g", "x", ["mean", "count", "max"])
    assert found.columns == ["g", "x", "g_x_mean", "g_x_count", "g_x_max"]
    rows = {(r["g"], r["x"]): r[2:] for r in found.collect()}
    assert rows["a", 1.0] == (2.0, 2, 3.0)
    assert rows["b", None] == (None, 0, None)
    assert rows[None, 5.0] == (None, None, None)
    safe = f.group_agg(df, "g", "x", ["mean", "count", "max"], null_safe=True)
    assert safe.columns == found.columns
    assert {(r["g"], r["x"]): r[2:] for r in safe.collect()}[None, 5.0] == (5.0, 1, 5.0)


def test_group_agg_learned_on_other_data(spark):
    train = spark.createDataFrame([("a", 1.0), ("a", 3.0)], "g string, x double")
    model = f.GroupAggFeatures(groupCol="g", valueCol="x", functions=["mean"]).fit(train)
    test = spark.createDataFrame([("a", 9.0), ("z", 9.0)], "g string, x double")
    assert {r["g"]: r["g_x_mean"] for r in model.transform(test).collect()} == {"a": 2.0, "z": None}


def test_group_agg_without_broadcast_splits_hot_group(spark):
    """Beyond the broadcast threshold the join is a shuffle, with the same rows."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("g"), F.col("id").alias("x")
    )
    expected = sorted(map(tuple, f.group_agg(df, "g", "x").collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = f.group_agg(df, "g", "x")
        assert sorted(map(tuple, found.collect())) == expected
        assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_group_is_split_at_run_time(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    df = spark.range(0, 60000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("g"), F.col("id").alias("x")
    )
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        found = f.group_agg(df, "g", "x", ["count"])
        assert found.count() == 60000
        rows = found.groupBy("g_x_count").count().collect()
        assert {r["g_x_count"]: r["count"] for r in rows} == {20000: 20000, 1: 40000}
        found.collect()
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_infinite_values_have_no_equal_width(spark):
    df = spark.createDataFrame([(1.0,), (math.inf,)], "x double")
    with pytest.raises(ValueError):
        f.binned(df, "x", 5, "equal_width")
    with pytest.raises(ValueError):
        profile.histogram(df, ["x"])


def test_outliers_with_fixed_bounds(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (1.0,)], "x double")
    bounds = {"inputCols": ["x"], "lower": [0.0], "upper": [3.0]}
    detect = o.IQROutlierModel(mode="detect", **bounds)
    assert column(detect.transform(df), "x_is_outlier") == [1, 0, 0]
    cap = o.IQROutlierModel(mode="cap", **bounds)
    assert column(cap.transform(df), "x_capped") == [3.0, None, 1.0]
    remove = o.IQROutlierModel(mode="remove", **bounds)
    assert column(remove.transform(df), "x") == [1.0]
    assert remove.copy({remove.filterRows: False}).transform(df).count() == 3


def test_outliers_need_values(spark):
    df = spark.createDataFrame([(None,)], "x double")
    with pytest.raises(ValueError):
        o.iqr_bounds(df, ["x"])
    with pytest.raises(ValueError):
        o.iqr_bounds(df, ["x"], relative_error=0.0)


def test_several_columns_at_once(spark):
    df = spark.createDataFrame([(float(v), float(v * v)) for v in range(50)], "x double, y double")
    found = o.detect(df, ["x", "y"], relative_error=0.0)
    assert found.columns == ["x", "y", "x_is_outlier", "y_is_outlier"]
    assert found.filter("y_is_outlier = 1").count() == 0


def test_own_stages_survive_saving(spark, tmp_path):
    df = spark.createDataFrame(
        [("a", 1.0, 10), ("b", 2.0, None), ("a", 50.0, 30), ("b", 3.0, 40)], "g string, x double, i int"
    )
    stages = [
        f.InteractionFeatures(leftCol="x", rightCol="x", operation="add"),
        f.PolynomialFeatures(inputCol="x", degree=3),
        f.EqualWidthBins(inputCol="x", outputCol="x_width", numBins=3),
        f.ExactQuantileBins(inputCol="x", outputCol="x_quantile", numBins=2),
        f.GroupAggFeatures(groupCol="g", valueCol="x", functions=["max"]),
        o.IQROutlier(inputCols=["x"], mode="cap", relativeError=0.0),
        MedianImputer(inputCols=["i"], outputCols=["i_imputed"]),
    ]
    pipeline = Pipeline(stages=stages)
    pipeline.write().overwrite().save(str(tmp_path / "pipeline"))
    assert len(Pipeline.load(str(tmp_path / "pipeline")).getStages()) == len(stages)
    model = pipeline.fit(df)
    model.write().overwrite().save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    expected = model.transform(df)
    found = loaded.transform(df)
    assert found.columns == expected.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


def test_imputer(spark):
    df = spark.createDataFrame(
        [(1, 1.0), (2, None), (4, float("nan")), (None, 4.0)], "i int, x double"
    )

    def filled(strategy, error=0.001):
        pipeline = PipelineBuilder().add_imputer(["i", "x"], strategy, error).build()
        found = pipeline.fit(df).transform(df)
        assert dict(found.dtypes)["i_imputed"] == "int"
        return column(found, "i_imputed")[3], column(found, "x_imputed")[1]

    assert filled("mean") == (2, 2.5)
    assert filled("median", 0) == (2, 1.0)
    assert filled("median") == (2, 1.0)
    assert filled("mode") == (1, 1.0)
    empty = spark.createDataFrame([(None,)], "x double")
    with pytest.raises(ValueError):
        MedianImputer(inputCols=["x"], outputCols=["y"]).fit(empty)
    assert isinstance(MedianImputer(inputCols=["x"], outputCols=["y"]).fit(df), FillModel)


def test_categories(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("b", 2.0), ("c", 3.0), (None, 1.0)], "s string, x double")
    builder = PipelineBuilder().add_string_indexer(["s"])
    found = builder.build().fit(df).transform(df)
    assert column(found, "s_indexed") == [1.0, 0.0, 0.0, 2.0, 3.0]
    kept = PipelineBuilder().add_string_indexer(["s"]).add_one_hot_encoder(["s"]).build()
    assert kept.fit(df).transform(df).first()["s_encoded"].size == 4
    strict = PipelineBuilder().add_string_indexer(["s"]).add_one_hot_encoder(["s"], "error").build()
    assert strict.fit(df).transform(df).first()["s_encoded"].size == 3


def test_scalers_on_constant(spark):
    df = spark.createDataFrame([(7.0,)] * 4, "x double")
    standard = PipelineBuilder().add_vector_assembler(["x"]).add_standard_scaler().build()
    assert standard.fit(df).transform(df).first()["scaled_features"][0] == 0.0
    minmax = PipelineBuilder().add_vector_assembler(["x"]).add_minmax_scaler().build()
    assert minmax.fit(df).transform(df).first()["scaled_features"][0] == 0.5


def test_builder_hands_out_its_own_lists():
    builder = PipelineBuilder().add_imputer(["x"]).add_vector_assembler(["x", "y"])
    first = builder.build()
    builder.add_standard_scaler()
    assert len(first.getStages()) == 2 and len(builder.build().getStages()) == 3
    assert first.getStages()[1].getInputCols() == ["x_imputed", "y"]
    literal = PipelineBuilder().add_imputer(["x"]).add_vector_assembler(["x"], literal=True)
    assert literal.build().getStages()[1].getInputCols() == ["x"]


def test_no_scaler(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, "b")], "x double, s string")
    pipeline = preprocessing_pipeline(["x"], ["s"], scaling=None)
    assert "scaled_features" not in pipeline.fit(df).transform(df).columns
