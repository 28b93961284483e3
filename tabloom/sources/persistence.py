"""Fitted pipelines on disk, as versions with a pointer to the current one."""

from __future__ import annotations

import time
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from tabloom.sources import commits

_POINTER, _VERSIONS = "CURRENT", "versions"


def save_model(model: PipelineModel, path: str, keep: int = 3) -> str:
    """Write the model as a new version of ``path``; the version's name.

    The version is written whole, then the pointer is replaced in one step: whatever stops this
    half way, the model from before or the new one loads. The ``keep`` newest versions stay, as
    loaded models still read their tables there.
    """
    spark, path = SparkSession.active(), path.rstrip("/")
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    model.write().save(f"{path}/{_VERSIONS}/{version}")
    commits.put_text(spark, f"{path}/{_POINTER}", version)
    # What stands beside the pointer is older: versions, or a model saved without any.
    older = [n for n in commits.list_names(spark, f"{path}/{_VERSIONS}") if n < version]
    for name in older[: max(0, len(older) + 1 - max(1, keep))]:
        commits.delete(spark, f"{path}/{_VERSIONS}/{name}")
    for name in ("metadata", "stages"):
        commits.delete(spark, f"{path}/{name}")
    return version


def current_version(path: str) -> str | None:
    """The version that ``load_model`` loads; None for a model without versions."""
    found = commits.get_text(SparkSession.active(), f"{path.rstrip('/')}/{_POINTER}")
    return found.strip() if found else None


def versions(path: str) -> list[str]:
    """All versions, oldest first."""
    return commits.list_names(SparkSession.active(), f"{path.rstrip('/')}/{_VERSIONS}")


def load_model(path: str, version: str | None = None) -> PipelineModel:
    """The current model of ``path``, or a version of it."""
    path = path.rstrip("/")
    version = version or current_version(path)
    return PipelineModel.load(path if version is None else f"{path}/{_VERSIONS}/{version}")
