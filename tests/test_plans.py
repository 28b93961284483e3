"""What the plans must and must not hold, whatever the size of the data."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from tabloom.operators import balance, features, metrics, outliers, profile, split

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    """Shuffles of the plan as it is first made, before anything runs."""
    plan = plan_of(df)
    plan = plan.split("Initial Plan")[-1]
    return plan.count("Exchange hashpartitioning") + plan.count("Exchange SinglePartition")


@pytest.fixture(scope="module")
def items(spark):
    return spark.read.parquet(f"{SF_DIR}/lineitem.parquet")


# Training has its own inner plans; these are the queries of tables.
RELATIONAL = [
    n
    for n in queries()
    if n.startswith(
        ("profile", "feat", "outlier", "balance", "split", "metric", "confusion", "residual", "class", "histogram")
    )
]


@pytest.mark.parametrize("name", RELATIONAL)
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(queries()[name](spark, SF_DIR))
    for part in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert part not in plan, part


def test_columns_are_pruned_and_filters_pushed(items):
    plan = plan_of(profile.missing(items.select("l_tax", "l_quantity")))
    assert "ReadSchema: struct<l_quantity:double,l_tax:double>" in plan
    plan = plan_of(outliers.remove(items.select("l_tax"), "l_tax"))
    assert "GreaterThanOrEqual(l_tax" in plan and "LessThanOrEqual(l_tax" in plan


def test_shuffles(items):
    assert exchanges(profile.missing(items)) == 1
    # numbers by a hash aggregate, strings apart
    assert exchanges(profile.statistics(items)) == 2
    assert "SortAggregate" not in plan_of(profile.statistics(items.select("l_tax", "l_orderkey")))
    assert exchanges(profile.duplicates(items)) == 2
    assert exchanges(metrics.regression(items, "l_tax", "l_discount")) == 1
    assert exchanges(features.polynomial(items, "l_tax", 3)) == 0
    assert exchanges(features.binned(items, "l_tax")) == 0
    assert exchanges(outliers.cap(items, "l_tax")) == 0
    assert exchanges(split.hash_split(items, "l_orderkey", [1, 1])[0]) == 0


def test_exact_balancing_does_not_shuffle_rows(spark):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    up = balance.oversample_minority(labels, "quality", mode="exact", key="doc_id")
    down = balance.undersample_majority(labels, "quality", mode="exact", key="doc_id")
    for df in (up, down):
        assert exchanges(df) == 0 and "Window" not in plan_of(df)


def test_small_group_table_is_broadcast_and_rows_stay(items):
    df = features.group_agg(items.select("l_returnflag", "l_tax"), "l_returnflag", "l_tax")
    assert "BroadcastHashJoin" in plan_of(df) and exchanges(df) == 0


def test_curve_ranges_are_not_one_task(spark, items):
    scored = items.select((F.col("l_returnflag") == "R").cast("int").alias("label"), F.col("l_extendedprice").alias("score"))
    plan = plan_of(metrics.binary(scored))
    assert "windowspecdefinition(bucket" in plan and "BroadcastHashJoin" not in plan
