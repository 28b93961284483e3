"""Evaluation and residual diagnostics, over scores that a plain rule gives."""

from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators import diagnostics, metrics
from tabloom.plans.profile_queries import histogram_sql
from tabloom.plans.registry import query, table
from tabloom.sources import runlog
from tabloom.workspace import new_path


def _returned(spark, sf, score):
    """Label: the item was returned. Score: any column."""
    return table(spark, sf, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("label"), F.col(score).alias("score")
    )


def curve_sql(source):
    """Both areas of ``source(label, score)``: by ranks, and by running totals."""
    return f"""
s as (select label::int as y, score as s from ({source})),
r as (select y, rank() over (order by s) + (count(*) over (partition by s) - 1) / 2.0::double as rk
      from s),
n as (select sum(y)::double as p, count(*) - sum(y)::double as n from s),
roc as (select (sum(rk * y) - max(p) * (max(p) + 1) / 2) / (max(p) * max(n)) as area from r, n),
g as (select s, sum(y)::double as pos, count(*)::double as cnt from s group by 1),
c as (select s, sum(pos) over w as tp, sum(cnt) over w as np from g
      window w as (order by s desc)),
x as (select s, tp / p as recall, tp / np as prec from c, n),
l as (select recall, prec, lag(recall, 1, 0.0::double) over (order by s desc) as recall0,
             lag(prec) over (order by s desc) as prec0 from x),
pr as (select sum((recall - recall0) * (prec + coalesce(prec0, prec)) / 2) as area from l)
"""


def _curves(scored):
    return metrics.binary(scored).select(
        F.round("areaUnderROC", 6).alias("areaUnderROC"),
        F.round("areaUnderPR", 6).alias("areaUnderPR"),
    )


RETURNED = "select l_returnflag = 'R' as label, {} as score from lineitem"


@query(f"""
with {curve_sql(RETURNED.format("l_extendedprice"))}
select round(roc.area, 6) as "areaUnderROC" from roc
""")
def metric_auc_roc(spark, sf):
    return _curves(_returned(spark, sf, "l_extendedprice")).select("areaUnderROC")


@query(f"""
with {curve_sql(RETURNED.format("l_extendedprice"))}
select round(pr.area, 6) as "areaUnderPR" from pr
""")
def metric_auc_pr(spark, sf):
    return _curves(_returned(spark, sf, "l_extendedprice")).select("areaUnderPR")


@query(f"""
with {curve_sql(RETURNED.format("l_quantity"))}
select round(roc.area, 6) as "areaUnderROC", round(pr.area, 6) as "areaUnderPR" from roc, pr
""")
def metric_auc_tied_scores(spark, sf):
    return _curves(_returned(spark, sf, "l_quantity"))


def _guessed(spark, sf):
    """A three-class label and a guess; class 2 is never guessed where quantity is low."""
    flag = F.when(F.col("l_returnflag") == "A", 0.0).when(F.col("l_returnflag") == "N", 1.0)
    return table(spark, sf, "lineitem").select(
        flag.otherwise(2.0).alias("label"),
        F.when(F.col("l_linestatus") == "F", F.when(F.col("l_quantity") > 30, 2.0).otherwise(0.0))
        .otherwise(1.0)
        .alias("prediction"),
    )


GUESSED = """
t as (select case l_returnflag when 'A' then 0.0 when 'N' then 1.0 else 2.0 end::double as y,
             case when l_linestatus = 'F' then case when l_quantity > 30 then 2.0 else 0.0 end
                  else 1.0 end::double as h
      from lineitem)
"""
PER_CLASS = f"""
{GUESSED},
k as (select y as c from t union select h from t),
m as (select c, (select count(*) from t where y = c and h = c) as tp,
             (select count(*) from t where y = c) as support,
             (select count(*) from t where h = c) as predicted from k),
q as (select c, support, tp, case when predicted = 0 then 0 else tp / predicted::double end as pre,
             case when support = 0 then 0 else tp / support::double end as rec,
             2.0::double * tp / (support + predicted) as f from m)
"""


@query(f"""
with {PER_CLASS}
select round(sum(tp) / sum(support)::double, 6) as accuracy,
       round(sum(f * support) / sum(support), 6) as f1,
       round(sum(pre * support) / sum(support), 6) as "weightedPrecision",
       round(sum(rec * support) / sum(support), 6) as "weightedRecall"
from q
""")
def metric_multiclass(spark, sf):
    found = metrics.multiclass(_guessed(spark, sf))
    return found.select(*[F.round(c, 6).alias(c) for c in found.columns])


@query(f"with {GUESSED} select y as label, h as prediction, count(*) as count from t group by all")
def confusion_long(spark, sf):
    return metrics.confusion(_guessed(spark, sf))


@query(f"""
with {GUESSED}
select y as label, count(*) filter (h = 0) as "predicted_0.0",
       count(*) filter (h = 1) as "predicted_1.0", count(*) filter (h = 2) as "predicted_2.0"
from t group by 1
""")
def confusion_pivot(spark, sf):
    return metrics.confusion_matrix(_guessed(spark, sf), [0.0, 1.0, 2.0])


@query(f"""
with {GUESSED}, u as (select y, case when h = 2 then 7.0 else h end as h from t)
select c as label, coalesce(count(*) filter (h = 0), 0) as "predicted_0.0",
       coalesce(count(*) filter (h = 1), 0) as "predicted_1.0",
       coalesce(count(*) filter (y = c and false), 0) as "predicted_2.0",
       coalesce(count(*) filter (h = 7), 0) as "predicted_7.0"
from (select distinct y as c from u union select distinct h from u) left join u on y = c group by c
""")
def confusion_pivot_found(spark, sf):
    """Classes from the data: one is predicted and never true, one true and never predicted."""
    guess = F.when(F.col("prediction") == 2, 7.0).otherwise(F.col("prediction"))
    return metrics.confusion_matrix(_guessed(spark, sf).withColumn("prediction", guess))


@query(f"""
with {PER_CLASS}
select c::varchar as class, round(pre, 6) as precision, round(rec, 6) as recall,
       round(f, 6) as f1, support from q
union all
select 'accuracy', round(sum(tp) / sum(support)::double, 6), round(sum(tp) / sum(support)::double, 6),
       round(sum(tp) / sum(support)::double, 6), sum(support)::bigint from q
union all
select 'macro avg', round(avg(pre), 6), round(avg(rec), 6), round(avg(f), 6), sum(support)::bigint
from q
union all
select 'weighted avg', round(sum(pre * support) / sum(support), 6),
       round(sum(rec * support) / sum(support), 6), round(sum(f * support) / sum(support), 6),
       sum(support)::bigint from q
""")
def classification_report(spark, sf):
    report = metrics.classification_report(_guessed(spark, sf))
    return report.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


def _rules(spark, sf):
    """Three scorers of 'the order is large' that each know something else."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        (F.col("o_totalprice") > 250000).cast("double").alias("label"),
        (F.col("o_totalprice") + F.col("o_custkey") % 100 * 3000).alias("noisy"),
        (F.col("o_custkey") % 1000).cast("double").alias("customer"),
        F.when(F.col("o_orderpriority") < "3", 1.0).otherwise(0.0).alias("priority"),
    )
    # Score column and decision threshold of each rule.
    rules = {"noisy": 400000.0, "customer": 500.0, "priority": 0.5}
    return {
        name: orders.select(
            "o_orderkey",
            "label",
            F.col(name).alias("score"),
            (F.col(name) > limit).cast("double").alias("prediction"),
        )
        for name, limit in rules.items()
    }


RULES = """
o as (select o_orderkey, (o_totalprice > 250000)::int::double as y,
             o_totalprice + o_custkey % 100 * 3000 as noisy,
             (o_custkey % 1000)::double as customer,
             case when o_orderpriority < '3' then 1.0 else 0.0 end::double as priority
      from orders),
u as (select 'noisy' as model, y, noisy as s, (noisy > 400000)::int::double as h from o
      union all select 'customer', y, customer, (customer > 500)::int::double from o
      union all select 'priority', y, priority, (priority > 0.5)::int::double from o),
rk as (select model, y, h, rank() over (partition by model order by s)
              + (count(*) over (partition by model, s) - 1) / 2.0::double as rk from u),
a as (select model, (sum(rk * y) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * (count(*) - sum(y)))
                    as auc,
             avg((y = h)::int) as acc, sqrt(avg((y - h) ** 2)) as rmse
      from rk group by 1)
"""


@query(f"""
with {RULES}
select model, round(auc, 6) as "areaUnderROC", round(acc, 6) as accuracy from a
""")
def model_dashboard(spark, sf):
    board = metrics.dashboard(_rules(spark, sf))
    return board.withColumns({c: F.round(c, 6) for c in ("areaUnderROC", "accuracy")})


@query(f"""
with {RULES}
select o_orderkey, (noisy > 400000)::int::double as noisy_prediction,
       (customer > 500)::int::double as customer_prediction,
       (priority > 0.5)::int::double as priority_prediction
from o
""")
def join_predictions(spark, sf):
    return diagnostics.join_predictions(_rules(spark, sf), "o_orderkey")


def _run_log(spark, sf):
    """A log on disk with one run per rule."""
    path = new_path(spark, "run-log")
    stacked = metrics.stack_models(_rules(spark, sf), ["label", "score", "prediction"])
    tables = [
        metrics.binary(stacked, by=["model"]).select("model", "areaUnderROC"),
        metrics.multiclass(stacked, by=["model"]).select("model", "accuracy"),
        metrics.regression(stacked, by=["model"]).select("model", "rmse"),
    ]
    rows = [runlog.metric_entries(t, "model", "rules", "test_") for t in tables]
    runlog.append(reduce(DataFrame.unionByName, rows), path)
    return runlog.read(spark, path)


@query(f"""
with {RULES}
select model as run_name, 'rules' as experiment, round(auc, 6) as "test_areaUnderROC",
       round(acc, 6) as test_accuracy, round(rmse, 6) as test_rmse
from a
""")
def compare_results(spark, sf):
    columns = ["test_areaUnderROC", "test_accuracy", "test_rmse"]
    return runlog.compare(_run_log(spark, sf), columns).select(
        "run_name", "experiment", *[F.round(c, 6).alias(c) for c in columns]
    )


@query(f"""
with {RULES}
select model as run_name, 'rules' as experiment, round(auc, 6) as "test_areaUnderROC",
       round(acc, 6) as test_accuracy, round(rmse, 6) as test_rmse
from a
""")
def runlog_concurrent(spark, sf):
    """Writers append at once, each twice under its own name, and the log is compacted between."""
    path = new_path(spark, "run-log")
    rules = _rules(spark, sf)

    def write(name):
        alone = metrics.stack_models({name: rules[name]}, ["label", "score", "prediction"])
        tables = [
            metrics.binary(alone, by=["model"]).select("model", "areaUnderROC"),
            metrics.multiclass(alone, by=["model"]).select("model", "accuracy"),
            metrics.regression(alone, by=["model"]).select("model", "rmse"),
        ]
        rows = [runlog.metric_entries(t, "model", "rules", "test_") for t in tables]
        return runlog.append(reduce(DataFrame.unionByName, rows), path, f"rule-{name}")

    with ThreadPool(len(rules)) as pool:
        pool.map(write, rules)
        runlog.compact(spark, path)
        pool.map(write, rules)
    columns = ["test_areaUnderROC", "test_accuracy", "test_rmse"]
    return runlog.compare(runlog.read(spark, path), columns).select(
        "run_name", "experiment", *[F.round(c, 6).alias(c) for c in columns]
    )


def _best(spark, sf, metric):
    return runlog.best(_run_log(spark, sf), metric).withColumn("value", F.round("value", 6))


@query(f"""
with {RULES}
select model as run_name, 'test_areaUnderROC' as metric, round(auc, 6) as value
from a order by auc desc, model limit 1
""")
def best_model_max(spark, sf):
    return _best(spark, sf, "test_areaUnderROC")


@query(f"""
with {RULES}
select model as run_name, 'test_rmse' as metric, round(rmse, 6) as value
from a order by rmse, model limit 1
""")
def best_model_min(spark, sf):
    return _best(spark, sf, "test_rmse")


@query(f"""
with {RULES}
select model as run_name, 'test_accuracy' as metric, round(acc, 6) as value
from a order by acc desc, model limit 1
""")
def runlog_best_by_metric(spark, sf):
    return _best(spark, sf, "test_accuracy")


def _priced(spark, sf):
    """A price per item and a guess from the quantity alone."""
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_extendedprice").alias("label"),
        (F.col("l_quantity") * 1500.0).alias("prediction"),
    )


PRICED = """
e as (select l_orderkey, l_linenumber, l_extendedprice as actual, l_quantity * 1500.0::double
             as predicted, l_extendedprice - l_quantity * 1500.0::double as residual
      from lineitem)
"""


@query(f"""
with {PRICED}
select round(sqrt(avg(residual ** 2)), 4) as rmse, round(avg(residual ** 2), 2) as mse,
       round(avg(abs(residual)), 4) as mae,
       round(1 - sum(residual ** 2) / (var_pop(actual) * count(*)), 6) as r2
from e
""")
def metric_regression(spark, sf):
    return metrics.regression(_priced(spark, sf)).select(
        F.round("rmse", 4).alias("rmse"),
        F.round("mse", 2).alias("mse"),
        F.round("mae", 4).alias("mae"),
        F.round("r2", 6).alias("r2"),
    )


@query(f"with {PRICED} select * from e")
def residuals(spark, sf):
    return diagnostics.residuals(_priced(spark, sf), keep=["l_orderkey", "l_linenumber"])


@query(f"""
with {PRICED}
select least(min(actual), min(predicted)) as min_value,
       greatest(max(actual), max(predicted)) as max_value
from e
""")
def residual_axis_range(spark, sf):
    return diagnostics.axis_range(
        diagnostics.residuals(_priced(spark, sf)), ["actual", "predicted"]
    )


@query(f"""
with {PRICED}
select floor(predicted / 5000)::bigint as bx, floor(residual / 10000)::bigint as by,
       count(*) as count
from e group by all
""")
def residual_grid(spark, sf):
    table_ = diagnostics.residuals(_priced(spark, sf))
    return diagnostics.residual_grid(table_, "predicted", "residual", 5000.0, 10000.0)


@query(f"with {PRICED} {histogram_sql('e', ['residual'])}")
def residual_histogram(spark, sf):
    counts = diagnostics.residual_histogram(diagnostics.residuals(_priced(spark, sf)))
    return counts.withColumns({"lower": F.round("lower", 4), "upper": F.round("upper", 4)})


POSITIONS = ", ".join(f"({p!r}::double, {z!r}::double)" for p, z in diagnostics.plotting_positions(99))
QQ = f"""
{PRICED},
g(p, z) as (values {POSITIONS}),
a as (select list_sort(array_agg(residual)) as v from e),
qq as (select p, z, v[floor(p * (len(v) - 1))::int + 1]
              + (v[ceil(p * (len(v) - 1))::int + 1] - v[floor(p * (len(v) - 1))::int + 1])
                * (p * (len(v) - 1) - floor(p * (len(v) - 1))) as s
       from g, a)
"""


@query(f"""
with {QQ}
select round(p, 6) as p, round(z, 6) as theoretical, round(s, 4) as sample from qq
""")
def residual_qq(spark, sf):
    qq = diagnostics.residual_qq(diagnostics.residuals(_priced(spark, sf)))
    return qq.select(
        F.round("p", 6).alias("p"),
        F.round("theoretical", 6).alias("theoretical"),
        F.round("sample", 4).alias("sample"),
    )


@query(f"""
with {QQ}
select round(regr_slope(s, z), 4) as slope, round(regr_intercept(s, z), 4) as intercept from qq
""")
def residual_qq_line(spark, sf):
    qq = diagnostics.residual_qq(diagnostics.residuals(_priced(spark, sf)))
    return diagnostics.qq_line(qq).select(
        F.round("slope", 4).alias("slope"), F.round("intercept", 4).alias("intercept")
    )
