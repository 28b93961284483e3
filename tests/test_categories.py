"""Category tables against Spark's indexer and encoder, and ranks and totals by ranges."""

import random

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import functions as F

from tabloom.operators import ranges
from tabloom.operators.categories import CategoryEncoder, CategoryIndexer
from tabloom.operators.preprocessing import PipelineBuilder
from tabloom.streaming import open_stream, write_stream

LABELS = ["a", "B", "é", "", " ", "\U0001f600", "￮", "x.y", "10", "9", "None"]


@pytest.fixture(scope="module")
def items(spark):
    rng = random.Random(4)
    rows = []
    for i in range(3000):
        frequent = rng.choice(LABELS[:3]) if i % 3 else "hot"
        rare = rng.choice([*LABELS, *[f"l{rng.randrange(400)}"] * 5, None])
        rows.append((i, frequent, rare, rng.randrange(5), rng.random() < 0.5))
    shape = "id long, `a.b` string, rare string, num int, flag boolean"
    return spark.createDataFrame(rows, shape).repartition(7)


def by_spark(df, invalid):
    columns = ["ab", "rare", "num"]
    plain = df.withColumnRenamed("a.b", "ab")
    model = StringIndexer(inputCols=columns, outputCols=[f"{c}_i" for c in columns], handleInvalid=invalid).fit(plain)
    return model, model.transform(plain)


@pytest.mark.parametrize("invalid", ["keep", "skip"])
def test_numbers_are_those_of_spark(spark, items, invalid):
    columns = ["a.b", "rare", "num"]
    indexer = CategoryIndexer(inputCols=columns, outputCols=["ab_i", "rare_i", "num_i"], handleInvalid=invalid)
    model = indexer.fit(items)
    _, expected = by_spark(items, invalid)
    numbers = ["id", "ab_i", "rare_i", "num_i"]
    found = model.transform(items)
    assert found.columns == [*items.columns, "ab_i", "rare_i", "num_i"]
    assert sorted(found.select(*numbers).collect()) == sorted(expected.select(*numbers).collect())
    for name in numbers[1:]:
        assert found.schema[name].metadata["ml_attr"]["num_vals"] == len(expected.schema[name].metadata["ml_attr"]["vals"])
    # Unknown labels, and labels of other types.
    other = spark.createDataFrame([(1, "new", "a", 3, True)], items.schema)
    _, spark_other = by_spark(items, invalid)
    assert model.transform(other).count() == (1 if invalid == "keep" else 0)


def test_unknown_label_is_an_error(spark, items):
    model = CategoryIndexer(inputCols=["num"], outputCols=["n"]).fit(items)
    other = spark.createDataFrame([(1, "a", "a", 99, True)], items.schema)
    with pytest.raises(Exception, match="no number for a label of num: 99"):
        model.transform(other).collect()
    with pytest.raises(ValueError):
        CategoryIndexer(inputCols=["num"], outputCols=["n"], handleInvalid="other")
    with pytest.raises(ValueError):
        CategoryEncoder(inputCols=["num"], outputCols=["n"], handleInvalid="skip")


@pytest.mark.parametrize("indexed, encoded", [("keep", "keep"), ("keep", "error"), ("skip", "keep"), ("skip", "error")])
def test_slots_are_those_of_spark(items, indexed, encoded):
    columns = ["rare", "flag"]
    names = [f"{c}_i" for c in columns], [f"{c}_e" for c in columns]

    def chain(indexer, encoder):
        stages = [
            indexer(inputCols=columns, outputCols=names[0], handleInvalid=indexed),
            encoder(inputCols=names[0], outputCols=names[1], handleInvalid=encoded),
        ]
        # Spark's encoder names its slots, and cannot name one after an empty label.
        plain = items.filter("rare is null or rare != ''").withColumn("flag", F.col("flag").cast("string"))
        return Pipeline(stages=stages).fit(plain).transform(plain).select("id", *names[1])

    found = chain(CategoryIndexer, CategoryEncoder)
    expected = chain(StringIndexer, OneHotEncoder)
    assert sorted(found.collect(), key=lambda r: r.id) == sorted(expected.collect(), key=lambda r: r.id)


def test_encoder_of_plain_numbers(spark):
    df = spark.createDataFrame([(0.0,), (2.0,), (None,), (1.5,)], "x double")
    model = CategoryEncoder(inputCols=["x"], outputCols=["v"], handleInvalid="keep").fit(df)
    assert [r.v.toArray().tolist() for r in model.transform(df).collect()] == [[1, 0, 0], [0, 0, 1], [0, 0, 0], [0, 0, 0]]
    strict = CategoryEncoder(inputCols=["x"], outputCols=["v"]).fit(df)
    with pytest.raises(Exception, match="x holds no number of a label"):
        strict.transform(df).collect()


def test_saved_model_on_a_stream(spark, items, tmp_path):
    builder = PipelineBuilder().add_string_indexer(["rare", "num"], as_table=True)
    model = builder.add_one_hot_encoder(["rare", "num"], as_table=True).build().fit(items)
    model.write().overwrite().save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    expected = sorted(model.transform(items).collect(), key=lambda r: r.id)
    assert sorted(loaded.transform(items).collect(), key=lambda r: r.id) == expected
    items.write.parquet(str(tmp_path / "in"))
    stream = open_stream(spark, str(tmp_path / "in"), items.schema)
    scored = loaded.transform(stream).select("id", "rare_indexed", "num_indexed")
    write_stream(scored, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out")).orderBy("id").collect()
    assert [tuple(r) for r in found] == [(r.id, r.rare_indexed, r.num_indexed) for r in expected]


def test_whole_chain_with_tables(items):
    def chain(as_table):
        builder = PipelineBuilder().add_string_indexer(["rare"], as_table=as_table)
        builder.add_one_hot_encoder(["rare"], as_table=as_table)
        builder.add_vector_assembler(["num", "rare_encoded"]).add_standard_scaler(with_mean=False)
        named = items.filter("rare != ''")
        return builder.build().fit(named).transform(named).select("id", "scaled_features").orderBy("id").collect()

    for a, b in zip(chain(True), chain(False)):
        assert a.id == b.id and a.scaled_features.toArray() == pytest.approx(b.scaled_features.toArray())


def test_columns_without_labels(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id int, s string")
    model = CategoryIndexer(inputCols=["s"], outputCols=["i"], handleInvalid="keep").fit(df)
    assert [r.i for r in model.transform(df).collect()] == [0.0, 0.0]
    assert CategoryIndexer(inputCols=["s"], outputCols=["i"], handleInvalid="skip").fit(df.limit(0)).transform(df).count() == 0


def test_ranks_within_groups(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(10**9), i) for i in range(5000)]
    df = spark.createDataFrame(rows, "`g.x` string, v long, id int").repartition(9)
    found = ranges.ranked(df, [-F.col("v"), F.col("id")], ["g.x"], "place").collect()
    for g in ("a", "b", None):
        order = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2]))
        assert [r.id for r in sorted((r for r in found if r[0] == g), key=lambda r: r.place)] == [r[2] for r in order]
        assert sorted(r.place for r in found if r[0] == g) == list(range(len(order)))


VALUES = {
    "even": lambda rng: rng.random(),
    "crowded": lambda rng: 1 + rng.random() ** 40 * 1e-9,
    "powers": lambda rng: 2.0 ** -rng.randrange(60) * (1 + rng.randrange(3)),
    "wide": lambda rng: rng.choice([-1.7e308, 1.7e308, 0.0, 1e300]) * rng.random(),
    "ends": lambda rng: rng.choice([float("inf"), -float("inf"), float("nan"), rng.random(), -0.0, 5e-324, 1e-323]),
}


@pytest.mark.parametrize("kind", VALUES)
def test_totals_above_in_ranges_of_ranges(spark, monkeypatch, kind):
    monkeypatch.setattr(ranges, "ROWS_PER_RANGE", 20)
    monkeypatch.setattr(ranges, "PARTS", 16)
    rng = random.Random(7)
    seen = {}
    for _ in range(1500):
        v = VALUES[kind](rng) + 0.0
        seen[rng.choice(["a", "a", "a", None]), "nan" if v != v else v] = (v, rng.randrange(5), rng.randrange(5))
    rows = [(g, *r) for (g, _), r in seen.items()]
    df = spark.createDataFrame(rows, "g string, s double, p long, n long").repartition(6)
    found = ranges.totals_above(df, "s", {"tp": "p", "tn": "n"}, ["g"])
    assert found.columns == ["g", "s", "p", "n", "tp", "tn"]
    key = lambda v: (v != v, 0 if v != v else v)
    result = {(r.g, str(r.s)): (r.p, r.n, r.tp, r.tn) for r in found.collect()}
    assert len(result) == len(rows)
    for g in ("a", None):
        tp = tn = 0
        for _, s, p, n in sorted((r for r in rows if r[0] == g), key=lambda r: key(r[1]), reverse=True):
            assert result[g, str(s)] == (p, n, tp, tn)
            tp, tn = tp + p, tn + n
