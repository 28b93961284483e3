"""Models.

Several of them are fitted here in a form that has a closed solution, so that SQL gives the
same numbers: a line through one feature, a saturated logistic model, one-split trees, and
sums for naive Bayes. The others are checked by their rows.
"""

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabloom.functions import vector_item
from tabloom.operators import diagnostics, metrics
from tabloom.operators.features import GroupAggFeatures
from tabloom.operators.models import Trainer
from tabloom.operators.outliers import IQROutlier
from tabloom.operators.preprocessing import PipelineBuilder
from tabloom.operators.scoring import score
from tabloom.operators.split import hash_split
from tabloom.plans.metric_queries import curve_sql
from tabloom.plans.registry import query, table
from tabloom.sources import runlog
from tabloom.sources.persistence import load_model, save_model
from tabloom.streaming import (
    open_stream,
    read_scored,
    score_stream,
    score_to_table,
    write_stream,
)
from tabloom.workspace import new_path


def _items(spark, sf):
    """A price that grows with the quantity, and whether it is high."""
    price = F.col("l_extendedprice") + F.col("l_quantity") * 1500.0
    return table(spark, sf, "lineitem").select(
        "l_quantity", price.alias("price"), (price > 90000).cast("double").alias("label")
    )


def _quantity():
    return Pipeline(stages=[VectorAssembler(inputCols=["l_quantity"], outputCol="features")])


def _fit(spark, sf, task, model_type, label, **params):
    trainer = Trainer(task, label_col=label)
    items = _items(spark, sf)
    model, _ = trainer.train(trainer.get_model(model_type, **params), items, _quantity())
    return model, items


def _per_quantity(scored, digits, *values):
    """All rows that agree in the quantity agree in the score."""
    return scored.groupBy("l_quantity").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.round(F.avg(v), digits).alias(v) for v in values],
    )


LINE = "l as (select regr_slope(price, x) as a, regr_intercept(price, x) as b from i)"
ITEMS = """
i as (select l_quantity as x, l_extendedprice + l_quantity * 1500.0::double as price,
             (l_extendedprice + l_quantity * 1500.0::double > 90000)::int::double as y
      from lineitem)
"""


@query(f"with {ITEMS}, {LINE} select round(a, 4) as slope, round(b, 4) as intercept from l")
def model_linear_fit(spark, sf):
    model, _ = _fit(spark, sf, "regression", "linear", "price", solver="normal")
    line = model.stages[-1]
    return spark.createDataFrame(
        [(round(float(line.coefficients[0]), 4), round(float(line.intercept), 4))],
        "slope double, intercept double",
    )


LINE_SCORES = f"""
with {ITEMS}, {LINE}
select x as l_quantity, count(*) as n, round(a * x + b, 2) as prediction from i, l group by x, a, b
"""


@query(LINE_SCORES)
def score_batch(spark, sf):
    model, items = _fit(spark, sf, "regression", "linear", "price", solver="normal")
    return _per_quantity(score(model, items, ["l_quantity"]), 2, "prediction")


@query(LINE_SCORES)
def model_save_load(spark, sf):
    model, items = _fit(spark, sf, "regression", "linear", "price", solver="normal")
    path = new_path(spark, "model")
    save_model(model, path)
    return _per_quantity(score(load_model(path), items, ["l_quantity"]), 2, "prediction")


@query("""
select l_returnflag, count(*) as n, round(avg(l_extendedprice), 4) as mean_price
from lineitem group by l_returnflag
""")
def model_resave(spark, sf):
    """A loaded model saved over its own path, loaded again, and applied."""
    items = table(spark, sf, "lineitem").select("l_returnflag", "l_extendedprice")
    groups = GroupAggFeatures(
        groupCol="l_returnflag", valueCol="l_extendedprice", functions=["mean"]
    )
    path = new_path(spark, "resaved")
    save_model(Pipeline(stages=[groups]).fit(items), path)
    loaded = load_model(path)
    save_model(loaded, path)
    both = load_model(path).transform(loaded.transform(items).select(*items.columns))
    mean = F.round("l_returnflag_l_extendedprice_mean", 4)
    return both.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.max(mean).alias("mean_price")
    )


@query("""
select count(*) as n_scored from lineitem
where concat('0x', substr(md5(l_orderkey::varchar), 1, 8))::bigint >= 3435973837
""")
def evaluate_keeps_rows(spark, sf):
    """Test rows outside the bounds of an outlier filter are scored too."""
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice")
    train, test = hash_split(items, "l_orderkey", [0.8, 0.2])
    trainer = Trainer("regression", label_col="l_extendedprice")
    steps = Pipeline(
        stages=[
            IQROutlier(inputCols=["l_extendedprice"], mode="remove", multiplier=0.1),
            VectorAssembler(inputCols=["l_quantity"], outputCol="features"),
        ]
    )
    _, _, scored = trainer.train_and_log("linear", train, test, steps)
    return scored.agg(F.count(F.lit(1)).alias("n_scored"))


@query(LINE_SCORES)
def stream_score(spark, sf):
    model, _ = _fit(spark, sf, "regression", "linear", "price", solver="normal")
    path = new_path(spark, "scored")
    # A pattern, since the source takes a folder or a pattern, and the table may be one file.
    source = f"{sf}/lineitem.parque[t]"
    stream = open_stream(spark, source, table(spark, sf, "lineitem").schema)
    scored = score_stream(model, stream.select("l_quantity"), ["l_quantity"], ["prediction"])
    write_stream(scored, path, new_path(spark, "progress")).awaitTermination()
    written = spark.read.schema("l_quantity double, prediction double").parquet(path)
    return _per_quantity(written, 2, "prediction")


@query(LINE_SCORES)
def stream_score_table(spark, sf):
    """Scored into commits of a table, by a saved model; run twice, it adds nothing twice."""
    model, _ = _fit(spark, sf, "regression", "linear", "price", solver="normal")
    saved, path, progress = (new_path(spark, n) for n in ("model", "scored", "progress"))
    save_model(model, saved)
    source = f"{sf}/lineitem.parque[t]"
    for _ in range(2):
        stream = open_stream(spark, source, table(spark, sf, "lineitem").schema)
        score_to_table(
            stream.select("l_quantity"), saved, path, progress, ["l_quantity"]
        ).awaitTermination()
    shape = "l_quantity double, prediction double"
    return _per_quantity(read_scored(spark, path, shape), 2, "prediction")


@query("""
select o_orderpriority, count(*) as n, round(avg((o_totalprice > 250000)::int), 4) as probability,
       case when avg((o_totalprice > 250000)::int) > 0.5 then 1.0 else 0.0 end::double as prediction
from orders group by 1
""")
def model_logistic(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderpriority", (F.col("o_totalprice") > 250000).cast("double").alias("label")
    )
    trainer = Trainer("classification")
    builder = PipelineBuilder().add_string_indexer(["o_orderpriority"], "error")
    builder.add_one_hot_encoder(["o_orderpriority"], "error")
    builder.add_vector_assembler(["o_orderpriority_encoded"])
    logistic = trainer.get_model("logistic", maxIter=200, tol=1e-12)
    model, _ = trainer.train(logistic, orders, builder.build())
    scored = score(model, orders, ["o_orderpriority"])
    return scored.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg(vector_item("probability", 1)), 4).alias("probability"),
        F.max("prediction").alias("prediction"),
    )


@query("""
with t as (select (l_returnflag = 'R')::int::double as class, l_quantity as f0,
                  round(l_discount * 100) as f1, round(l_tax * 100) as f2 from lineitem),
s as (select class, count(*) as n, sum(f0) as s0, sum(f1) as s1, sum(f2) as s2 from t group by 1)
select class, round(ln(n + 1) - ln((select count(*) from t) + 2), 6) as pi,
       round(ln(s0 + 1) - ln(s0 + s1 + s2 + 3), 6) as theta0,
       round(ln(s1 + 1) - ln(s0 + s1 + s2 + 3), 6) as theta1,
       round(ln(s2 + 1) - ln(s0 + s1 + s2 + 3), 6) as theta2
from s
""")
def model_naive_bayes(spark, sf):
    items = table(spark, sf, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("double").alias("label"),
        F.col("l_quantity").alias("f0"),
        F.round(F.col("l_discount") * 100).alias("f1"),
        F.round(F.col("l_tax") * 100).alias("f2"),
    )
    trainer = Trainer("classification")
    vector = PipelineBuilder().add_vector_assembler(["f0", "f1", "f2"]).build()
    model, _ = trainer.train(trainer.get_model("naive_bayes"), items, vector)
    bayes = model.stages[-1]
    rows = [
        (float(c), *(round(float(v), 6) for v in [bayes.pi[c], *bayes.theta.toArray()[c]]))
        for c in range(bayes.numClasses)
    ]
    return spark.createDataFrame(
        rows, "class double, pi double, theta0 double, theta1 double, theta2 double"
    )


def _stump_sql(target, columns, pruned=False):
    """The split of the quantity that leaves the least variance, and the two leaf means.

    A pruned tree has no split where both leaves would vote for the same class.
    """
    left, right = "sl / nl", "(st - sl) / (nt - nl)"
    if pruned:
        same = f"({left} > 0.5) = ({right} > 0.5)"
        left, right = (f"case when {same} then st / nt else {m} end" for m in (left, right))
    return f"""
with {ITEMS},
d as (select x, sum({target}) as s, count(*) as n from i group by x),
c as (select x, n, sum(s) over (order by x) as sl, sum(n) over (order by x) as nl,
             sum(s) over () as st, sum(n) over () as nt from d),
b as (select x as cut, {left} as ml, {right} as mr from c where nl < nt
      order by sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) desc limit 1),
m as (select x, n, case when x <= cut then ml else mr end as leaf from c, b)
select x as l_quantity, n, {columns} from m
"""


STUMP_CLASSES = (
    "round(leaf, 6) as probability, (leaf > 0.5)::int::double as prediction"
)
STUMP_BOOSTED = (
    "round(1 / (1 + exp(-2 * (2 * leaf - 1))), 6) as probability, "
    "(leaf > 0.5)::int::double as prediction"
)
STUMP_VALUES = "round(leaf, 2) as prediction"
STUMP = {"maxDepth": 1, "maxBins": 64, "seed": 42}
ONE_TREE = {"numTrees": 1, "bootstrap": False, "featureSubsetStrategy": "all"}


def _stump_classes(spark, sf, model_type, **params):
    model, items = _fit(spark, sf, "classification", model_type, "label", **STUMP, **params)
    scored = score(model, items, ["l_quantity"]).withColumn(
        "probability", vector_item("probability", 1)
    )
    return _per_quantity(scored, 6, "probability", "prediction")


def _stump_values(spark, sf, model_type, **params):
    model, items = _fit(spark, sf, "regression", model_type, "price", **STUMP, **params)
    return _per_quantity(score(model, items, ["l_quantity"]), 2, "prediction")


@query(_stump_sql("y", STUMP_CLASSES, pruned=True))
def model_decision_tree_classifier(spark, sf):
    return _stump_classes(spark, sf, "decision_tree")


@query(_stump_sql("y", STUMP_CLASSES, pruned=True))
def model_random_forest_classifier(spark, sf):
    return _stump_classes(spark, sf, "random_forest", **ONE_TREE)


@query(_stump_sql("y", STUMP_BOOSTED))
def model_gbt_classifier(spark, sf):
    return _stump_classes(spark, sf, "gbt", maxIter=1)


@query(_stump_sql("price", STUMP_VALUES))
def model_decision_tree_regressor(spark, sf):
    return _stump_values(spark, sf, "decision_tree")


@query(_stump_sql("price", STUMP_VALUES))
def model_random_forest_regressor(spark, sf):
    return _stump_values(spark, sf, "random_forest", **ONE_TREE)


@query(_stump_sql("price", STUMP_VALUES))
def model_gbt_regressor(spark, sf):
    return _stump_values(spark, sf, "gbt", maxIter=1)


# The score of a linear machine on one feature orders the rows as the feature does.
@query(f"""
with {ITEMS},
{curve_sql("select y as label, x as score from i")}
select round(roc.area, 6) as "areaUnderROC", round(pr.area, 6) as "areaUnderPR" from roc, pr
""")
def model_svm(spark, sf):
    model, items = _fit(
        spark, sf, "classification", "svm", "label", maxIter=5, regParam=0.1
    )
    scored = Trainer("classification").with_score(model.transform(items))
    curves = metrics.binary(scored)
    return curves.select(*[F.round(c, 6).alias(c) for c in curves.columns])


@query(f"""
with {ITEMS}, {LINE},
d as (select x, sum(price) as s, count(*) as n from i group by x),
c as (select x, n, sum(s) over (order by x) as sl, sum(n) over (order by x) as nl,
             sum(s) over () as st, sum(n) over () as nt from d),
t as (select x as cut, sl / nl as ml, (st - sl) / (nt - nl) as mr from c where nl < nt
      order by sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) desc limit 1)
select x as l_quantity, n, round(a * x + b, 2) as linear_prediction,
       round(case when x <= cut then ml else mr end, 2) as tree_prediction
from c, l, t
""")
def compare_predictions(spark, sf):
    linear, items = _fit(spark, sf, "regression", "linear", "price", solver="normal")
    tree, _ = _fit(spark, sf, "regression", "decision_tree", "price", **STUMP)
    side_by_side = diagnostics.compare_predictions(
        {"linear": linear, "tree": tree}, items, ["l_quantity"]
    )
    return _per_quantity(side_by_side, 2, "linear_prediction", "tree_prediction")


def _large_orders(spark, sf):
    """Orders with their customer; the label says whether the order is large."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderpriority",
        (F.col("o_totalprice") + F.col("o_orderkey") % 97 * 2000).alias("amount"),
        F.col("o_totalprice").alias("target"),
        (F.col("o_totalprice") > 250000).cast("double").alias("label"),
    )
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("o_custkey"),
        F.greatest("c_acctbal", F.lit(0.0)).alias("balance"),
        "c_mktsegment",
    )
    return orders.join(customers, "o_custkey")


def _order_features(with_mean=True):
    """Centring makes features negative, which naive Bayes does not take."""
    numbers, categories = ["amount", "balance"], ["o_orderpriority", "c_mktsegment"]
    builder = PipelineBuilder().add_imputer(numbers)
    builder.add_string_indexer(categories).add_one_hot_encoder(categories)
    builder.add_vector_assembler([*numbers, *(f"{c}_encoded" for c in categories)])
    return builder.add_standard_scaler(with_mean=with_mean).build()


def _compare(spark, sf, task, label, model_types, configs, with_mean):
    path = new_path(spark, "run-log")
    train, test = hash_split(_large_orders(spark, sf), "o_orderkey", [0.8, 0.2])
    trainer = Trainer(task, features_col="scaled_features", label_col=label, run_log=path)
    trainer.train_many(model_types, train, test, _order_features(with_mean), configs, "orders")
    return (
        runlog.read(spark, path)
        .filter("kind = 'metric' and key != 'training_time_seconds'")
        .select("run_name", "experiment", "key", F.round("value", 3).alias("value"))
    )


@query()
def train_compare(spark, sf):
    configs = {
        "logistic": {"maxIter": 20, "regParam": 0.01},
        "random_forest": {"numTrees": 10, "maxDepth": 5, "seed": 42},
        "gbt": {"maxIter": 5, "maxDepth": 3, "seed": 42},
        "svm": {"maxIter": 5},
    }
    types = ["logistic", "random_forest", "gbt", "decision_tree", "naive_bayes", "svm"]
    return _compare(spark, sf, "classification", "label", types, configs, False)


@query()
def train_compare_regression(spark, sf):
    configs = {
        "linear": {"maxIter": 20, "regParam": 0.1},
        "random_forest": {"numTrees": 10, "maxDepth": 5, "seed": 42},
        "gbt": {"maxIter": 5, "maxDepth": 3, "seed": 42},
    }
    types = ["linear", "random_forest", "gbt", "decision_tree"]
    return _compare(spark, sf, "regression", "target", types, configs, True)


@query()
def importance_topk(spark, sf):
    orders = _large_orders(spark, sf)
    trainer = Trainer("classification", features_col="scaled_features")
    forest = trainer.get_model("random_forest", numTrees=10, maxDepth=5, seed=42)
    model, _ = trainer.train(forest, orders, _order_features())
    return diagnostics.feature_importance(model, orders, top=10)


# Every probability vector is complete and agrees with the prediction.
@query("""
select count(*) as n, count(*) as n_sum_to_one, count(*) as n_most_likely from orders
""")
def score_batch_probability(spark, sf):
    orders = _large_orders(spark, sf)
    trainer = Trainer("classification", features_col="scaled_features")
    logistic = trainer.get_model("logistic", maxIter=20, regParam=0.01, elasticNetParam=0.8)
    model, _ = trainer.train(logistic, orders, _order_features())
    scored = score(model, orders, ["o_orderkey"]).withColumn("p", vector_to_array("probability"))
    likely = F.array_position("p", F.array_max("p")) - 1
    return scored.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.abs(F.aggregate("p", F.lit(0.0), lambda a, v: a + v) - 1) < 1e-9).alias(
            "n_sum_to_one"
        ),
        F.count_if(likely == F.col("prediction")).alias("n_most_likely"),
    )


