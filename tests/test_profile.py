import pytest
from pyspark.sql import functions as F

from tabloom.operators import balance, profile


@pytest.fixture(scope="module")
def gappy(spark):
    rows = [
        (1, 1.0, "a", True),
        (2, None, "b", False),
        (3, float("nan"), None, None),
        (4, 4.0, "1.5", True),
    ]
    return spark.createDataFrame(rows, "i int, x double, s string, b boolean")


def test_missing(gappy):
    assert profile.missing(gappy).first().asDict() == {"i": 0, "x": 2, "s": 1, "b": 1}
    assert profile.missing(gappy, include_nan=False).first()["x"] == 1
    long = {r["column"]: (r["missing"], r["pct"]) for r in profile.missing_long(gappy).collect()}
    assert long["x"] == (2, 50.0)


def test_missing_of_any_type(spark):
    df = spark.createDataFrame(
        [([1.0], {"a": 1}, (1, 2.0)), (None, None, None)],
        "a array<float>, m map<string,int>, r struct<p:int,q:double>",
    ).withColumn("t", F.lit(None).cast("timestamp_ntz"))
    assert profile.missing(df).first().asDict() == {"a": 1, "m": 1, "r": 1, "t": 2}


def test_statistics(spark, gappy):
    found = {r["column"]: r for r in profile.statistics(gappy).collect()}
    assert set(found) == {"i", "x", "s"}
    assert (found["i"]["count"], found["i"]["mean"], found["i"]["max"]) == (4, 2.5, 4.0)
    assert (found["s"]["min_text"], found["s"]["max_text"]) == ("1.5", "b")
    with pytest.raises(ValueError):
        profile.statistics(gappy.select("b"))


def test_describe_is_sparks(gappy):
    assert profile.describe(gappy).columns == ["summary", "i", "x", "s"]


def test_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (1, None), (2, "a")], "i int, s string")
    assert profile.duplicates(df).first()["duplicates"] == 2
    assert profile.duplicates(df, ["i"]).first()["duplicates"] == 3
    assert profile.duplicates(df.limit(0)).first()["duplicates"] == 0


def test_duplicates_of_long_texts(spark):
    long = "x" * 5000
    rows = [(long,), (long,), (long + "y",), ("x" * 64,), ("x" * 65,), ("",), (None,), (None,)]
    df = spark.createDataFrame(rows, "s string")
    assert profile.duplicates(df).first()["duplicates"] == 2
    assert profile.cardinality(df, ["s"]).first()["distinct_values"] == 6


def test_duplicates_with_maps(spark):
    df = spark.createDataFrame([({"a": 1, "b": 2},), ({"b": 2, "a": 1},), ({},)], "m map<string,int>")
    assert profile.duplicates(df).first()["duplicates"] == 1


def test_cardinality_counts_null(gappy):
    found = {r["column"]: r["distinct_values"] for r in profile.cardinality(gappy, ["s", "i", "b"]).collect()}
    assert found == {"s": 4, "i": 4, "b": 3}
    approx = profile.cardinality(gappy, ["s"], approx=True).first()
    assert approx["distinct_values"] == 4


def test_report_has_every_section(gappy):
    rows = profile.report(gappy, ["s"]).collect()
    found = {(r["section"], r["column"], r["metric"]): r["value"] for r in rows}
    assert found["table", None, "total_rows"] == 4
    assert found["table", None, "total_columns"] == 4
    assert found["table", None, "duplicates"] == 0
    assert found["missing_values", "x", "missing"] == 2
    assert found["cardinality", "s", "distinct_values"] == 4
    assert found["statistics", "i", "mean"] == 2.5


def test_report_of_empty_table(gappy):
    rows = profile.report(gappy.limit(0), ["s"]).collect()
    found = {(r["section"], r["column"], r["metric"]): r["value"] for r in rows}
    assert found["table", None, "total_rows"] == 0
    assert found["cardinality", "s", "distinct_values"] == 0


def test_histogram_edges(spark):
    df = spark.createDataFrame(
        [(float(v), 7.0, None) for v in range(11)] + [(None, float("nan"), None)],
        "x double, c double, n double",
    )
    rows = profile.histogram(df, ["x", "c", "n"], bins=5).collect()
    x = {r["bin"]: r["count"] for r in rows if r["column"] == "x"}
    assert x == {0: 2, 1: 2, 2: 2, 3: 2, 4: 3}
    assert [(r["bin"], r["count"]) for r in rows if r["column"] == "c"] == [(0, 11)]
    assert not [r for r in rows if r["column"] == "n"]
    with pytest.raises(ValueError):
        profile.histogram(df, ["n"])


def test_class_extremes_of_equal_classes(spark):
    df = spark.createDataFrame([("a",), ("b",)], "label string")
    found = balance.class_extremes(df, "label").first()
    assert (found["majority"], found["minority"], found["classes"]) == ("a", "b", 2)
