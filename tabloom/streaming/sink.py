"""A stream scored into a table, each row once, by a model that may change while it runs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tabloom.operators import metrics
from tabloom.operators.scoring import score
from tabloom.sources import commits, runlog
from tabloom.sources.persistence import current_version, load_model

_QUERY = "sql.streaming.queryId"


def score_to_table(
    stream: DataFrame,
    model_path: str,
    path: str,
    checkpoint: str,
    keep: Sequence[str] = (),
    outputs: Sequence[str] = ("prediction",),
    task: str | None = None,
    label: str = "label",
    run_log: str | None = None,
    experiment: str | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """Score a stream batch by batch into the commits of ``path``; ``read_scored`` reads them.

    A batch is committed under the id of the query, which its checkpoint keeps, and its own
    number. A batch that is run again after a crash finds its commit and adds nothing, so each
    row is written once. At the start of every batch the current version of the saved model is
    taken up; the column ``model_version`` says which one scored a row.

    With a ``run_log`` and a ``task`` (classification or regression), the metrics of every batch
    that has rows with a ``label`` are logged, counted from what was committed.
    """
    if not stream.isStreaming:
        raise ValueError("not a stream; use score() for a table")
    if task not in (None, "classification", "regression"):
        raise ValueError(f"unknown task {task!r}, use classification or regression")
    held: dict[str | None, object] = {}

    def run(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        name = f"{spark.sparkContext.getLocalProperty(_QUERY)}-{number:012d}"
        version = current_version(model_path)
        if version not in held:
            held.clear()
            held[version] = load_model(model_path, version)
        columns = [*keep, label] if task and label not in keep else list(keep)
        scored = score(held[version], rows, columns, outputs)
        commits.commit(scored.selectExpr("*", f"'{version or ''}' as model_version"), path, name)
        if run_log and task:
            _log(spark, path, name, number, task, label, run_log, experiment)

    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    if interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def _log(
    spark: SparkSession,
    path: str,
    name: str,
    number: int,
    task: str,
    label: str,
    run_log: str,
    experiment: str | None,
) -> None:
    folder = commits.folders(spark, path).get(name)
    if folder is None:  # gathered with others since; it was logged before
        return
    rows = spark.read.parquet(folder).filter(f"`{label}` is not null")
    count = metrics.regression if task == "regression" else metrics.multiclass
    found: Mapping[str, float] = count(rows, label, "prediction").first().asDict()
    if all(v is None for v in found.values()):
        return
    values = {**found, "rows": rows.count()}
    entries = runlog.entries(spark, f"batch {number}", {"commit": name}, values, experiment, name)
    runlog.append(entries, run_log, f"metrics-{name}")


def read_scored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of all committed batches."""
    return commits.read(spark, path, schema)
