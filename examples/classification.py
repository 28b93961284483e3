"""A classification flow: spark-submit examples/classification.py SF_DIR RUN_LOG MODEL_DIR."""

import sys

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tabloom.operators import metrics, profile, tuning
from tabloom.operators.features import GroupAggFeatures, InteractionFeatures
from tabloom.operators.models import Trainer, best_result
from tabloom.operators.preprocessing import PipelineBuilder
from tabloom.operators.scoring import score
from tabloom.operators.split import cached, hash_split
from tabloom.sources import runlog
from tabloom.sources.persistence import save_model


def main(sf_dir: str, log: str, model_path: str) -> None:
    spark = SparkSession.builder.appName("classification").getOrCreate()
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey",
        "l_quantity",
        "l_discount",
        "l_tax",
        "l_linestatus",
        "l_returnflag",
        (F.col("l_extendedprice") > 50000).cast("double").alias("label"),
    )
    profile.report(items, ["l_linestatus", "l_returnflag"]).show(60, truncate=False)
    profile.class_distribution(items, "label").show()

    # Everything learned is learned from the training rows, inside the pipeline.
    numbers = ["l_quantity", "l_discount", "l_tax", "l_quantity_multiply_l_discount"]
    group = "l_returnflag_l_quantity_mean"
    builder = PipelineBuilder()
    builder.add_stage(InteractionFeatures(leftCol="l_quantity", rightCol="l_discount"))
    builder.add_stage(
        GroupAggFeatures(groupCol="l_returnflag", valueCol="l_quantity", functions=["mean"])
    )
    builder.add_imputer([*numbers, group]).add_string_indexer(["l_linestatus"])
    builder.add_one_hot_encoder(["l_linestatus"])
    builder.add_vector_assembler([*numbers, group, "l_linestatus_encoded"])
    preparation = builder.add_standard_scaler().build()

    with cached(*hash_split(items, "l_orderkey", [0.8, 0.2])) as (train, test):
        trainer = Trainer("classification", "scaled_features", run_log=log)
        configs = {
            "logistic": {"maxIter": 100, "regParam": 0.01, "elasticNetParam": 0.8},
            "random_forest": {"numTrees": 20, "maxDepth": 5, "seed": 42},
            "gbt": {"maxIter": 10, "maxDepth": 5, "seed": 42},
        }
        results = trainer.train_many(list(configs), train, test, preparation, configs, "items")
        runlog.compare(runlog.read(spark, log), ["test_areaUnderROC", "test_f1"]).show()
        print("best:", best_result(results, "areaUnderROC"))

        forest = trainer.get_model("random_forest", seed=42)
        grid = tuning.param_grid(forest, {"numTrees": [5, 10], "maxDepth": [3, 5]})
        evaluator = BinaryClassificationEvaluator(numBins=0)
        search = tuning.cross_validate(
            forest, grid, train, evaluator, 3, preparation, fold_key="l_orderkey"
        )
        tuning.grid_results(spark, search, grid).show(truncate=False)

        scored = search.bestModel.transform(test)
        metrics.classification_report(scored).show()
        save_model(search.bestModel, model_path)
        score(search.bestModel, test, ["label"]).show(20)


if __name__ == "__main__":
    main(*sys.argv[1:4])
