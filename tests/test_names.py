"""Columns with dots, spaces and backticks in their names, through the public operators."""

import pytest
from pyspark.sql import functions as F

from tabloom.operators import balance, features, outliers, profile, profile_states, quantiles, split
from tabloom.operators.categories import CategoryIndexer
from tabloom.operators.preprocessing import MedianImputer

A, B, G = "a.b", "c d", "e`f.g"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, float(i % 50), float(i % 7) if i % 9 else None, f"g{i % 3}") for i in range(300)]
    names = ["id", A, B, G]
    shape = ", ".join(f"`{n.replace('`', '``')}` {t}" for n, t in zip(names, ["long", "double", "double", "string"]))
    return spark.createDataFrame(rows, shape).cache()


@pytest.fixture(scope="module")
def plain(odd):
    return odd.toDF("id", "a", "b", "g").cache()


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def same(found, expected):
    """Equal rows, whatever the columns are called."""
    assert len(found.columns) == len(expected.columns) and rows(found) == rows(expected)


def test_profiles(odd, plain):
    for table in (profile.missing, profile.duplicates):
        same(table(odd), table(plain))
    for table in (profile.statistics, profile.missing_long):
        same(table(odd).drop("column"), table(plain).drop("column"))
    same(profile.report(odd, [G]).drop("column"), profile.report(plain, ["g"]).drop("column"))
    same(profile.cardinality(odd, [A, G]).drop("column"), profile.cardinality(plain, ["a", "g"]).drop("column"))
    same(profile.class_distribution(odd, G), profile.class_distribution(plain, "g"))
    same(profile.histogram(odd, [A, B], 5).drop("column"), profile.histogram(plain, ["a", "b"], 5).drop("column"))
    report = lambda df: profile_states.report(profile_states.states(df)).drop("column")
    same(report(odd), report(plain))


@pytest.mark.parametrize("error", [0.0, 0.01])
def test_quantiles_and_outliers(odd, plain, error):
    assert quantiles.quantiles(odd, [A, B], [0.2, 0.7], error) == quantiles.quantiles(plain, ["a", "b"], [0.2, 0.7], error)
    for change in (outliers.detect, outliers.cap, outliers.remove):
        found, expected = (change(df, c, 0.1, error) for df, c in ((odd, [A, B]), (plain, ["a", "b"])))
        same(found, expected)
        assert found.columns[4:] == [c.replace("a_", f"{A}_", 1) if c[0] == "a" else c.replace("b_", f"{B}_", 1) for c in expected.columns[4:]]


def test_features(odd, plain):
    same(features.interaction(odd, A, B, "divide"), features.interaction(plain, "a", "b", "divide"))
    same(features.polynomial(odd, A, 3), features.polynomial(plain, "a", 3))
    for method, error in (("quantile", 0.01), ("quantile", 0), ("equal_width", 0)):
        found = features.binned(odd, A, 4, method, error)
        assert found.columns == [*odd.columns, f"{A}_binned"]
        same(found, features.binned(plain, "a", 4, method, error))
    for null_safe in (False, True):
        found = features.group_agg(odd, G, A, null_safe=null_safe)
        assert found.columns == [G, "id", A, B, *[f"{G}_{A}_{f}" for f in ("mean", "sum", "count")]]
        same(found, features.group_agg(plain, "g", "a", null_safe=null_safe))


def test_preparation_and_samples(odd, plain):
    fill = lambda df, c: MedianImputer(inputCols=[c], outputCols=["filled"]).fit(df).transform(df)
    same(fill(odd, B), fill(plain, "b"))
    index = lambda df, c: CategoryIndexer(inputCols=[c], outputCols=["i"]).fit(df).transform(df)
    same(index(odd, G), index(plain, "g"))
    pick = lambda df, c: split.sample_classes_exact(df, c, {"g0": 0.3, "g1": 0.5}, "id")
    same(pick(odd, G), pick(plain, "g"))
    keys = [A, "id"]
    for a, b in zip(split.hash_split(odd, keys, [1, 2]), split.hash_split(plain, ["a", "id"], [1, 2])):
        same(a, b)
    few, many = odd.filter(F.col("id") % 6 != 0), plain.filter(F.col("id") % 6 != 0)
    same(balance.oversample_minority(few, G, mode="exact", key="id"), balance.oversample_minority(many, "g", mode="exact", key="id"))
    same(balance.undersample_majority(few, G, mode="exact", key="id"), balance.undersample_majority(many, "g", mode="exact", key="id"))
    assert balance.undersample_majority(few, G).columns == few.columns
