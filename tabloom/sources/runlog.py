"""The run log: an append-only long table of parameters and metrics, one row per entry."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.operators.metrics import larger_is_better
from tabloom.sources import commits

SCHEMA = (
    "run_id string, run_name string, experiment string, kind string, "
    "key string, value double, text string, logged_at timestamp"
)


def entries(
    spark: SparkSession,
    run_name: str,
    params: Mapping[str, object] | None = None,
    metrics: Mapping[str, float] | None = None,
    experiment: str | None = None,
    run_id: str | None = None,
) -> DataFrame:
    """One run as log rows. Parameters go to ``text``, metrics to ``value``."""
    run_id = run_id or uuid.uuid4().hex
    now = dt.datetime.now()
    rows = [
        (run_id, run_name, experiment, "param", k, None, str(v), now)
        for k, v in (params or {}).items()
    ] + [
        (run_id, run_name, experiment, "metric", k, None if v is None else float(v), None, now)
        for k, v in (metrics or {}).items()
    ]
    return spark.createDataFrame(rows, SCHEMA)


def metric_entries(
    metrics: DataFrame, run_column: str, experiment: str | None = None, prefix: str = ""
) -> DataFrame:
    """A table of metrics, one row per run, as log rows, without a detour over the driver."""
    rows = F.array(
        *[
            F.struct(F.lit(prefix + c).alias("key"), F.col(c).cast("double").alias("value"))
            for c in metrics.columns
            if c != run_column
        ]
    )
    return metrics.select(F.col(run_column).alias("run_name"), F.inline(rows)).select(
        F.concat_ws("/", F.lit(experiment), "run_name").alias("run_id"),
        "run_name",
        F.lit(experiment).cast("string").alias("experiment"),
        F.lit("metric").alias("kind"),
        "key",
        "value",
        F.lit(None).cast("string").alias("text"),
        F.current_timestamp().alias("logged_at"),
    )


def append(rows: DataFrame, path: str, commit: str | None = None) -> bool:
    """Add entries to the log, as one small file that is seen whole or not at all.

    Any number of writers may append at once. With the name of a ``commit``, such as a run's id,
    entries that are added again under it change nothing, and the result is False.
    """
    return commits.commit(rows.repartition(1), path, commit)


def read(spark: SparkSession, path: str) -> DataFrame:
    """All entries; also those of a log that is plain Parquet files."""
    if commits.is_table(spark, path):
        return commits.read(spark, path, SCHEMA)
    return spark.read.schema(SCHEMA).parquet(path)


def compact(spark: SparkSession, path: str) -> bool:
    """Gather the small files of a log into one; entries and names of commits stay."""
    return commits.compact(spark, path, SCHEMA)


def compare(log: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """One row per run, one column per metric."""
    of_metric = [
        F.max(F.when((F.col("kind") == "metric") & (F.col("key") == m), F.col("value"))).alias(m)
        for m in metrics
    ]
    return log.groupBy("run_id", "run_name", "experiment").agg(*of_metric)


def best(log: DataFrame, metric: str, larger: bool | None = None) -> DataFrame:
    """The best run ``run_name, metric, value``; the earliest, then the first by name, on ties.

    Errors are best when small, every other metric when large, unless ``larger`` says so.
    Runs without a number for the metric do not compete; 0 is a number.
    """
    if larger is None:
        larger = larger_is_better(metric)
    value = F.col("value")
    order = value.desc() if larger else value.asc()
    return (
        log.filter((F.col("kind") == "metric") & (F.col("key") == metric))
        .filter(value.isNotNull() & ~F.isnan(value))
        .orderBy(order, "logged_at", "run_name")
        .limit(1)
        .select("run_name", F.lit(metric).alias("metric"), "value")
    )
