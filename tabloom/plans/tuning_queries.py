"""Hyperparameter search, on grids whose scores SQL can compute too."""

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tabloom.operators import tuning
from tabloom.operators.models import Trainer
from tabloom.operators.split import hash_fold
from tabloom.plans.registry import query, table

BUCKET = "(concat('0x', substr(md5(l_orderkey::varchar), 1, 8))::bigint)"


def _items(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_quantity", F.col("l_extendedprice").alias("label")
    )


def _line(trainer):
    model = trainer.get_model("linear", solver="normal")
    return model, tuning.param_grid(model, {"fitIntercept": [True, False]})


def _quantity():
    return Pipeline(stages=[VectorAssembler(inputCols=["l_quantity"], outputCol="features")])


def _results(spark, found, grid):
    return tuning.grid_results(spark, found, grid).select(
        "combo",
        F.col("params")["fitIntercept"].alias("fit_intercept"),
        F.round("metric", 3).alias("rmse"),
    )


def _line_scores(bucket, folds):
    """Error of a line with and without intercept on each part after training on the rest."""
    return f"""
t as (select {bucket} as fold, l_quantity as x, l_extendedprice as y from lineitem),
f as (select unnest({folds}) as k),
m as (select k, regr_slope(y, x) as a, regr_intercept(y, x) as b, sum(x * y) / sum(x * x) as c
      from t, f where fold <> k group by k),
e as (select k, sqrt(avg((y - a * x - b) ** 2)) as r1, sqrt(avg((y - c * x) ** 2)) as r2
      from t join m on fold = k group by k)
select 0::int as combo, 'True' as fit_intercept, round(avg(r1), 3) as rmse from e
union all select 1, 'False', round(avg(r2), 3) from e
"""


@query(f"with {_line_scores(f'{BUCKET} % 3', '[0, 1, 2]')}")
def tune_cross_validation(spark, sf):
    model, grid = _line(Trainer("regression"))
    found = tuning.cross_validate(
        model,
        grid,
        _items(spark, sf),
        RegressionEvaluator(metricName="rmse"),
        folds=3,
        preprocessing=_quantity(),
        fold_key="l_orderkey",
    )
    return _results(spark, found, grid)


@query(f"""
with t as (select {BUCKET} % 3 as fold, l_quantity as x, l_extendedprice as y from lineitem),
f as (select unnest([0, 1, 2]) as k),
m as (select k, regr_slope(y, x) as a, regr_intercept(y, x) as b, sum(x * y) / sum(x * x) as c
      from t, f where fold <> k group by k)
select 0::int as combo, k::int as fold, round(sqrt(avg((y - a * x - b) ** 2)), 3) as rmse
from t join m on fold = k group by k
union all
select 1, k, round(sqrt(avg((y - c * x) ** 2)), 3) from t join m on fold = k group by k
""")
def tune_fold_scores(spark, sf):
    """Scores of each combination in each fold."""
    model, grid = _line(Trainer("regression"))
    found = tuning.cross_validate(
        model,
        grid,
        _items(spark, sf),
        RegressionEvaluator(metricName="rmse"),
        folds=3,
        preprocessing=_quantity(),
        fold_key="l_orderkey",
    )
    scores = tuning.fold_results(spark, found, grid)
    return scores.select("combo", "fold", F.round("metric", 3).alias("rmse"))


@query(f"with {_line_scores(f'({BUCKET} < 3435973837)::int', '[0]')}")
def tune_train_validation(spark, sf):
    model, grid = _line(Trainer("regression"))
    found = tuning.train_validation(
        model,
        grid,
        _items(spark, sf),
        RegressionEvaluator(metricName="rmse"),
        train_ratio=0.8,
        preprocessing=_quantity(),
        split_key="l_orderkey",
    )
    return _results(spark, found, grid)


@query()
def tune_forest_grid(spark, sf):
    items = _items(spark, sf).withColumn("label", (F.col("label") > 50000).cast("double"))
    trainer = Trainer("classification")
    model = trainer.get_model("random_forest", seed=42)
    grid = tuning.param_grid(
        model, {"numTrees": [3, 5], "maxDepth": [2, 3], "minInstancesPerNode": [1, 10]}
    )
    found = tuning.train_validation(
        model,
        grid,
        items,
        BinaryClassificationEvaluator(metricName="areaUnderROC"),
        preprocessing=_quantity(),
        split_key="l_orderkey",
    )
    return tuning.grid_results(spark, found, grid)


LIMITS = list(range(100000, 400001, 50000))


# A search over the decision threshold of a rule: accuracy per threshold and fold.
@query(f"""
with t as (select (concat('0x', substr(md5(o_orderkey::varchar), 1, 8))::bigint) % 3 as fold,
                  o_totalprice as price,
                  (o_totalprice + o_custkey % 100 * 3000 > 400000)::int as y from orders),
s as (select l as combo, fold, avg(((price > l)::int = y)::int) as acc
      from t, (select unnest({LIMITS})::int as l) group by all)
select combo, round(avg(acc), 6) as avg_metric from s group by 1
order by avg(acc) desc, combo limit 1
""")
def tuning_best(spark, sf):
    price = F.col("o_totalprice")
    large = price + F.col("o_custkey") % 100 * 3000 > 400000
    scored = (
        table(spark, sf, "orders")
        .groupBy(hash_fold("o_orderkey", 3).alias("fold"))
        .agg(*[F.avg(((price > c) == large).cast("double")).alias(str(c)) for c in LIMITS])
        .unpivot("fold", [str(c) for c in LIMITS], "combo", "metric")
        .withColumn("combo", F.col("combo").cast("int"))
    )
    best = tuning.best_combo(scored, larger=True)
    return best.withColumn("avg_metric", F.round("avg_metric", 6))
