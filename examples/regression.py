"""A regression flow: spark-submit examples/regression.py SF_DIR RUN_LOG MODEL_DIR."""

import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tabloom.operators import diagnostics
from tabloom.operators.models import Trainer, best_result
from tabloom.operators.outliers import IQROutlier
from tabloom.operators.preprocessing import PipelineBuilder
from tabloom.operators.scoring import score
from tabloom.operators.split import cached, hash_split
from tabloom.sources.persistence import save_model


def main(sf_dir: str, log: str, model_path: str) -> None:
    spark = SparkSession.builder.appName("regression").getOrCreate()
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    rows = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey",
        "o_orderpriority",
        "c_mktsegment",
        "c_acctbal",
        F.dayofyear("o_orderdate").cast("double").alias("day"),
        F.col("o_totalprice").alias("target"),
    )
    builder = PipelineBuilder()
    builder.add_stage(IQROutlier(inputCols=["c_acctbal"], mode="cap"))
    builder.add_imputer(["c_acctbal_capped", "day"], "median")
    builder.add_string_indexer(["o_orderpriority", "c_mktsegment"])
    builder.add_one_hot_encoder(["o_orderpriority", "c_mktsegment"])
    builder.add_vector_assembler(
        ["c_acctbal_capped", "day", "o_orderpriority_encoded", "c_mktsegment_encoded"]
    )
    preparation = builder.add_standard_scaler().build()

    with cached(*hash_split(rows, "o_orderkey", [0.8, 0.2])) as (train, test):
        trainer = Trainer("regression", "scaled_features", "target", run_log=log)
        configs = {
            "linear": {"maxIter": 100, "regParam": 0.1},
            "random_forest": {"numTrees": 20, "maxDepth": 5, "seed": 42},
            "gbt": {"maxIter": 10, "maxDepth": 5, "seed": 42},
        }
        results = trainer.train_many(list(configs), train, test, preparation, configs, "orders")
        name, r2 = best_result(results, "r2")
        print("best:", name, r2)
        best = trainer.models[name]
        if name != "linear":
            diagnostics.feature_importance(best, test, top=10).show(truncate=False)
        errors = diagnostics.residuals(best.transform(test), "target")
        diagnostics.axis_range(errors, ["actual", "predicted"]).show()
        diagnostics.residual_histogram(errors).orderBy("bin").show(50)
        qq = diagnostics.residual_qq(errors, relative_error=0.001)
        diagnostics.qq_line(qq).show()
        save_model(best, model_path)
        score(best, test, ["target"]).show(20)


if __name__ == "__main__":
    main(*sys.argv[1:4])
