"""The shared scratch folder, and tables written there to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SETTING = "spark.checkpoint.dir"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local_dirs: dict[str, str] = {}
# Of the innermost ``scratch``: session, path and, if in the catalog, name of all that was stored.
_stored: ContextVar[list | None] = ContextVar("stored", default=None)


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as the session names it.

    A temporary folder of this machine is used only in local mode, where driver and
    executors are one process. On a cluster the setting has to be there.
    """
    context = spark.sparkContext
    named = (
        spark.conf.get(_SETTING, None)
        or context.getConf().get(_SETTING)
        or context.getCheckpointDir()
    )
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder that all executors share")
    app = context.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="tabloom-")
    return _local_dirs[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/tabloom/{name}-{uuid.uuid4().hex}"


@contextmanager
def _shuffles_dropped(spark: SparkSession):
    """Let Spark remove the shuffle files of what runs inside as soon as it has ended."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def stage_path(df: DataFrame, name: str) -> str:
    """Write ``df`` as a table in the shared folder; the path of it.

    The shuffles behind it are not kept, as the table stands for them from then on.
    """
    path = new_path(df.sparkSession, name)
    _note(df.sparkSession, path)
    with _shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    The table outlives lost executors, and its size on disk is known to the optimizer,
    which then broadcasts it only when it is below the session's threshold.
    """
    return df.sparkSession.read.schema(df.schema).parquet(stage_path(df, name))


def _note(spark: SparkSession, path: str, table: str | None = None) -> None:
    if (stored := _stored.get()) is not None:
        stored.append((spark, path, table))


@contextmanager
def scratch():
    """Remove at the end what was stored inside; gives a ``stage`` whose tables stay.

    Frames that read a removed table cannot be used any more, so what is returned has to be stored
    by that.
    """
    outer, own = _stored.get(), []

    def kept(df: DataFrame, name: str) -> DataFrame:
        inner = _stored.set(outer)
        try:
            return stage(df, name)
        finally:
            _stored.reset(inner)

    before = _stored.set(own)
    try:
        yield kept
    finally:
        _stored.reset(before)
        for spark, path, table in own:
            if table:
                spark.sql(f"DROP TABLE IF EXISTS {table}")
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a stored table that nothing reads any more, as others stand for it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    where.getFileSystem(conf).delete(where, True)


def stage_bucketed(
    df: DataFrame,
    name: str,
    column: str,
    buckets: int,
    order: str,
    dealt: bool = False,
    parts: int = 1,
    more: Sequence[DataFrame] = (),
) -> DataFrame:
    """Write ``df`` as a table dealt by ``column`` into ``buckets`` files, each in ``order``.

    Joins and groups by that column read it where it lies, without a shuffle. ``dealt``: the rows
    are in that many partitions by the column already. ``parts``: rows go in so many parts by a whole
    number of the column, so that the shuffle of one at a time is on disk. ``more``: further rows,
    written after those of ``df`` for the same reason.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    table = f"tabloom_{path.rpartition('/')[2].replace('-', '_')}"
    _note(spark, path, table)
    given = [df, *more]
    if parts > 1:
        given = [x.filter(F.pmod(column, F.lit(parts)) == i) for x in given for i in range(parts)]
    for i, part in enumerate(given):
        rows = part if dealt else part.repartition(buckets, column)
        writer = rows.write.mode("append" if i else "error").bucketBy(buckets, column).sortBy(order)
        with _shuffles_dropped(spark):
            writer.option("path", path).saveAsTable(table)
    return spark.table(table)
