"""Feature engineering: interactions, powers, bins and group aggregates.

Each operator exists as a function on a DataFrame and as a ``pyspark.ml`` stage. Use the
stages when what was learned on training data must be applied to other data.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.feature import Bucketizer, QuantileDiscretizer
from pyspark.ml.param import TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReader, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.functions import quoted, valid_number
from tabloom.operators.quantiles import exact_quantiles
from tabloom.operators.stages import Saved, column_param
from tabloom.workspace import stage_path


def _divide(a: Column, b: Column) -> Column:
    # A NULL denominator fails the test as zero does, and gives 0.
    return F.when(b != 0, a / b).otherwise(0)


OPERATIONS = {
    "multiply": lambda a, b: a * b,
    "add": lambda a, b: a + b,
    "subtract": lambda a, b: a - b,
    "divide": _divide,
}

AGGREGATES = {"mean": F.avg, "sum": F.sum, "count": F.count, "max": F.max, "min": F.min}


def _operation(name: str):
    if name not in OPERATIONS:
        raise ValueError(f"unknown operation {name!r}, use one of {sorted(OPERATIONS)}")
    return OPERATIONS[name]


def interaction(df: DataFrame, left: str, right: str, operation: str = "multiply") -> DataFrame:
    """Add ``{left}_{operation}_{right}``."""
    value = _operation(operation)(quoted(left), quoted(right))
    return df.withColumn(f"{left}_{operation}_{right}", value)


def polynomial(df: DataFrame, column: str, degree: int = 2) -> DataFrame:
    """Add ``{column}_pow_d`` for every d from 2 up to ``degree``."""
    if degree < 2:
        return df
    return df.withColumns(
        {f"{column}_pow_{d}": F.pow(quoted(column), F.lit(d)) for d in range(2, degree + 1)}
    )


def binned(
    df: DataFrame,
    column: str,
    num_bins: int = 5,
    method: str = "quantile",
    relative_error: float = 0.001,
) -> DataFrame:
    """Add ``{column}_binned``, the bucket number as double.

    ``method`` is ``quantile`` or ``equal_width``. NaN gets a bucket of its own after the
    last one, NULL stays NULL. ``relative_error=0`` cuts at exact quantiles.
    """
    output = f"{column}_binned"
    if method == "quantile" and relative_error > 0:
        discretizer = QuantileDiscretizer(
            inputCol="__in",
            outputCol="__out",
            numBuckets=num_bins,
            relativeError=relative_error,
            handleInvalid="keep",
        )
        named = df.withColumn("__in", quoted(column))
        found = discretizer.fit(named).transform(named)
        return found.withColumn(output, F.col("__out")).drop("__in", "__out")
    if method == "quantile":
        discretizer = ExactQuantileBins(inputCol=column, outputCol=output, numBins=num_bins)
    elif method == "equal_width":
        discretizer = EqualWidthBins(inputCol=column, outputCol=output, numBins=num_bins)
    else:
        raise ValueError(f"unknown method {method!r}, use 'quantile' or 'equal_width'")
    return discretizer.fit(df).transform(df)


def group_agg(
    df: DataFrame,
    group: str,
    value: str,
    functions: Sequence[str] = ("mean", "sum", "count"),
    null_safe: bool = False,
) -> DataFrame:
    """Add ``{group}_{value}_{function}`` of the row's group to every row.

    The group column comes first in the result. Rows without a group get NULL, unless
    ``null_safe`` makes NULL a group of its own.
    """
    estimator = GroupAggFeatures(
        groupCol=group, valueCol=value, functions=list(functions), nullSafe=null_safe
    )
    return estimator.fit(df).transform(df)


class InteractionFeatures(Saved, Transformer):
    """``interaction`` as a pipeline stage."""

    leftCol = column_param("leftCol", "first column")
    rightCol = column_param("rightCol", "second column")
    operation = column_param("operation", "multiply, add, subtract or divide")

    def __init__(self, **values: object) -> None:
        super().__init__(**{"operation": "multiply", **values})
        _operation(self.getOrDefault("operation"))

    def _transform(self, df: DataFrame) -> DataFrame:
        get = self.getOrDefault
        return interaction(df, get("leftCol"), get("rightCol"), get("operation"))


class PolynomialFeatures(Saved, Transformer):
    """``polynomial`` as a pipeline stage."""

    inputCol = column_param("inputCol", "column to raise")
    degree = column_param("degree", "highest power", TypeConverters.toInt)

    def __init__(self, **values: object) -> None:
        super().__init__(**{"degree": 2, **values})

    def _transform(self, df: DataFrame) -> DataFrame:
        return polynomial(df, self.getOrDefault("inputCol"), self.getOrDefault("degree"))


class BinModel(Saved, Model):
    """Bucket numbers by fixed split points; the outer splits are infinite."""

    inputCol = column_param("inputCol", "column to bin")
    outputCol = column_param("outputCol", "bucket number")
    splits = column_param("splits", "split points", TypeConverters.toListFloat)

    def _transform(self, df: DataFrame) -> DataFrame:
        source, target = self.getOrDefault("inputCol"), self.getOrDefault("outputCol")
        splits = self.getOrDefault("splits")
        if len(splits) > 2:
            # Spark's stage takes no dots in names, so it works on a column of its own.
            bucketizer = Bucketizer(
                splits=splits, inputCol="__in", outputCol="__out", handleInvalid="keep"
            )
            found = bucketizer.transform(df.withColumn("__in", quoted(source)))
            about = found.schema["__out"].metadata
            return found.withColumn(target, F.col("__out").alias(target, metadata=about)).drop("__in", "__out")
        number = quoted(source).cast("double")
        single = F.when(F.isnan(number), 1.0).when(number.isNotNull(), 0.0)
        return df.withColumn(target, single)


class _Bins(Saved, Estimator):
    inputCol = column_param("inputCol", "column to bin")
    outputCol = column_param("outputCol", "bucket number")
    numBins = column_param("numBins", "number of bins", TypeConverters.toInt)

    def __init__(self, **values: object) -> None:
        super().__init__(**{"numBins": 5, **values})

    def _fit(self, df: DataFrame) -> BinModel:
        inner = self._inner_splits(df, self.getOrDefault("inputCol"), self.getOrDefault("numBins"))
        return BinModel(
            inputCol=self.getOrDefault("inputCol"),
            outputCol=self.getOrDefault("outputCol"),
            splits=[-math.inf, *inner, math.inf],
        )

    def _inner_splits(self, df: DataFrame, column: str, bins: int) -> list[float]:
        raise NotImplementedError


class EqualWidthBins(_Bins):
    """Bins of equal width between minimum and maximum of the training data."""

    def _inner_splits(self, df: DataFrame, column: str, bins: int) -> list[float]:
        number = valid_number(quoted(column))
        low, high = df.agg(F.min(number), F.max(number)).first()
        if low is None:
            raise ValueError(f"column {column} has no values")
        if math.isinf(low) or math.isinf(high):
            raise ValueError(f"column {column} has infinite values, so no bins of equal width")
        width = (high - low) / bins
        return sorted({low + i * width for i in range(1, bins)}) if width > 0 else []


class ExactQuantileBins(_Bins):
    """Bins with equal numbers of rows, cut at exact quantiles of the training data."""

    def _inner_splits(self, df: DataFrame, column: str, bins: int) -> list[float]:
        if bins < 2:
            return []
        cuts = exact_quantiles(df, [column], [i / bins for i in range(1, bins)])[0]
        if not cuts:
            raise ValueError(f"column {column} has no values")
        return sorted(set(cuts))


class _GroupParams:
    groupCol = column_param("groupCol", "group column")
    valueCol = column_param("valueCol", "aggregated column")
    functions = column_param("functions", "aggregates to add", TypeConverters.toListString)
    nullSafe = column_param("nullSafe", "NULL is a group", TypeConverters.toBoolean)


class GroupAggFeatures(_GroupParams, Saved, Estimator):
    """Learns one row of aggregates per group and adds it to the rows of that group."""

    def __init__(self, **values: object) -> None:
        defaults = {"functions": ["mean", "sum", "count"], "nullSafe": False}
        super().__init__(**{**defaults, **values})
        unknown = [f for f in self.getOrDefault("functions") if f not in AGGREGATES]
        if unknown or not self.getOrDefault("functions"):
            raise ValueError(f"unknown functions {unknown}, use {sorted(AGGREGATES)}")

    def _fit(self, df: DataFrame) -> GroupAggFeaturesModel:
        group, value = self.getOrDefault("groupCol"), self.getOrDefault("valueCol")
        table = df.groupBy(quoted(group)).agg(
            *[
                AGGREGATES[f](quoted(value)).alias(f"{group}_{value}_{f}")
                for f in self.getOrDefault("functions")
            ]
        )
        model = GroupAggFeaturesModel(
            groupCol=group,
            valueCol=value,
            functions=self.getOrDefault("functions"),
            nullSafe=self.getOrDefault("nullSafe"),
        )
        model.path = stage_path(table, "group-agg")
        return model


class GroupAggFeaturesModel(_GroupParams, Saved, Model):
    """The group table and the left join that applies it.

    The table is stored, so its size is known: a small one is broadcast by the optimizer,
    a large one is joined by a shuffle in which AQE splits groups that hold too many rows.
    """

    path: str

    @property
    def table(self) -> DataFrame:
        """The stored table, listed anew: its files change when a model is saved over it."""
        return SparkSession.active().read.parquet(self.path)

    def _transform(self, df: DataFrame) -> DataFrame:
        group = self.getOrDefault("groupCol")
        table = self.table.withColumnRenamed(group, "__group")
        same = quoted(group).eqNullSafe(F.col("__group"))
        if not self.getOrDefault("nullSafe"):
            same = quoted(group) == F.col("__group")
        joined = df.join(table, same, "left")
        rest = [c for c in joined.columns if c not in (group, "__group")]
        return joined.select(quoted(group), *[quoted(c) for c in rest])

    def write(self) -> MLWriter:
        return _GroupTableWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _GroupTableReader()


class _GroupTableWriter(MLWriter):
    def __init__(self, model: GroupAggFeaturesModel) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.table.write.parquet(f"{path}/table")


class _GroupTableReader(MLReader):
    def load(self, path: str) -> GroupAggFeaturesModel:
        spark: SparkSession = self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        model = GroupAggFeaturesModel()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        model.path = f"{path}/table"
        return model
