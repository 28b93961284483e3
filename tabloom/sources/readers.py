"""Scans: files of any format, catalog tables, and the seeded demo columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def load(
    spark: SparkSession,
    fmt: str,
    path: str | list[str],
    schema: StructType | str | None = None,
    **options: object,
) -> DataFrame:
    """Read files of format ``fmt``. The path may be any URI the cluster's file systems know.

    The format name is handed on as it is, so formats with their own connector (delta,
    for one) work wherever that connector is on the class path.
    """
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def load_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str | None = None,
    header: bool = True,
    infer: bool = True,
    **options: object,
) -> DataFrame:
    """Read CSV. Give a schema at scale: inferring types reads all files once more."""
    options = {"header": header, **options}
    if schema is None and infer:
        options["inferSchema"] = True
    return load(spark, "csv", path, schema, **options)


def load_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table or view, by its (qualified) name."""
    return spark.table(name)


def demo_features(ids: DataFrame, id_col: str = "id") -> DataFrame:
    """Seeded random features, a category and a label for every id of ``ids``."""
    # Seeds, scales and offsets of the four features, label threshold.
    drawn = ids.select(
        F.col(id_col).alias("id"),
        (F.randn(42) * 10 + 50).alias("feature1"),
        (F.randn(43) * 5 + 30).alias("feature2"),
        (F.rand(44) * 100).alias("feature3"),
        (F.randn(45) * 15 + 75).alias("feature4"),
        (F.col(id_col) % 3).cast("string").alias("category"),
    )
    label = F.when(F.col("feature1") + F.col("feature2") > 80, 1).otherwise(0)
    return drawn.withColumn("label", label)


def synthetic(spark: SparkSession, n: int = 10000) -> DataFrame:
    """The demo dataset with ``n`` rows."""
    return demo_features(spark.range(n))


def table_shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and of columns."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
    )


def preview(df: DataFrame, n: int = 20) -> None:
    """Print the schema and the first ``n`` rows."""
    df.printSchema()
    df.show(n)
