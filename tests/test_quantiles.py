import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabloom.operators import quantiles as q


def _frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double").repartition(4)


def _expected(values, p):
    kept = sorted(v for v in values if v is not None and not math.isnan(v))
    return kept[max(1, math.ceil(p * len(kept))) - 1]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    values=st.lists(
        st.one_of(
            st.floats(allow_nan=True, allow_infinity=True),
            st.sampled_from([0.0, -0.0, 1.0, math.inf, -math.inf]),
            st.none(),
        ),
        min_size=1,
        max_size=60,
    )
)
def test_any_values(spark, values):
    kept = [v for v in values if v is not None and not math.isnan(v)]
    probabilities = [0.0, 0.25, 0.5, 0.9, 1.0]
    found = q.exact_quantiles(_frame(spark, values), ["x"], probabilities)[0]
    assert found == ([_expected(values, p) for p in probabilities] if kept else [])


@pytest.mark.parametrize("listed", [50_000, 5])
def test_one_value_holds_a_third(spark, monkeypatch, listed):
    """With few values listed the search has to narrow down several times."""
    monkeypatch.setattr(q, "LISTED_VALUES", listed)
    rng = np.random.default_rng(1)
    values = rng.exponential(10, 4000).tolist() + [3.25] * 2000
    probabilities = [0.1, 0.25, 0.5, 0.75, 0.999]
    found = q.exact_quantiles(_frame(spark, values), ["x"], probabilities)[0]
    assert found == [_expected(values, p) for p in probabilities]


def test_counts_of_an_order_statistic(spark, monkeypatch):
    monkeypatch.setattr(q, "LISTED_VALUES", 3)
    values = [float(v % 50) for v in range(1000)]
    df = _frame(spark, values)
    found = q.order_statistics(df, [F.col("x")], lambda i, n: [n // 2, n], [0.5, 1.0])[0]
    assert found == [q.OrderStatistic(24.0, 480, 20), q.OrderStatistic(49.0, 980, 20)]


def test_several_columns_and_types(spark):
    df = spark.range(1001).selectExpr("id", "cast(id * 2 as int) as i", "id / 4 as d", "null as n")
    df = df.withColumn("n", F.col("n").cast("double"))
    found = q.exact_quantiles(df, ["id", "i", "d", "n"], [0.5])
    assert found == [[500.0], [1000.0], [125.0], []]


def test_interpolated(spark):
    rng = np.random.default_rng(2)
    values = rng.normal(size=777)
    grid = [i / 100 for i in range(1, 100)]
    found = q.interpolated_quantiles(_frame(spark, values.tolist()), ["x"], grid)[0]
    assert np.allclose(found, np.quantile(values, grid), atol=1e-12)


def test_approximate_is_sparks(spark):
    df = spark.range(100).selectExpr("cast(id as double) as x")
    assert q.quantiles(df, ["x"], [0.5], 0.1) == df.approxQuantile(["x"], [0.5], 0.1)


def test_further_steps_sketch_no_column_per_interval(spark, monkeypatch):
    monkeypatch.setattr(q, "LISTED_VALUES", 20)
    frame = type(spark.range(1))
    sketched, plain = [], frame.approxQuantile

    def counted(self, columns, *rest):
        sketched.append(len(columns))
        return plain(self, columns, *rest)

    monkeypatch.setattr(frame, "approxQuantile", counted)
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.normal(size=60_000), np.repeat([0.5, np.inf, -np.inf], 500)])
    df = spark.createDataFrame([(v, -v) for v in values.tolist()], "x double, y double").repartition(4)
    grid = [i / 40 for i in range(41)]
    found = q.exact_quantiles(df, ["x", "y"], grid)
    assert found == [[_expected(v, p) for p in grid] for v in (values.tolist(), (-values).tolist())]
    assert sketched == [2]
