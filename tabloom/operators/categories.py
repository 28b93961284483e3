"""Category dictionaries as tables: for columns whose labels are too many for the driver.

``CategoryIndexer`` numbers labels as Spark's ``StringIndexer`` does, the most frequent first and
equally frequent ones by name, but counts, ranks and keeps them as a table. The table is stored,
so its size is known: the optimizer broadcasts a small one and joins a large one by a shuffle, in
which AQE splits labels that too many rows hold. ``CategoryEncoder`` makes sparse slots out of the
numbers, told by the number of labels alone.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import TypeConverters
from pyspark.ml.util import (
    DefaultParamsReader,
    DefaultParamsWriter,
    MLReader,
    MLWriter,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions import quoted
from tabloom.operators.ranges import ranked
from tabloom.operators.stages import Saved, column_param
from tabloom.workspace import new_path, stage

INVALID = ("keep", "error", "skip")


class _CategoryParams:
    inputCols = column_param("inputCols", "columns of labels", TypeConverters.toListString)
    outputCols = column_param("outputCols", "numbers of labels", TypeConverters.toListString)
    handleInvalid = column_param("handleInvalid", "keep, error or skip for unknown labels")


def _checked(values: dict[str, object], allowed: Sequence[str]) -> dict[str, object]:
    if values.get("handleInvalid", "error") not in allowed:
        raise ValueError(f"unknown handleInvalid {values['handleInvalid']!r}, use one of {allowed}")
    if len(values.get("inputCols", ())) != len(values.get("outputCols", ())):
        raise ValueError("as many output columns as input columns are needed")
    return values


class CategoryIndexer(_CategoryParams, Saved, Estimator):
    """Learns the labels of all columns in one pass, as a table for each column.

    NULL is no label. Numbers and booleans count as their text.
    """

    def __init__(self, **values: object) -> None:
        super().__init__(**_checked({"handleInvalid": "error", **values}, INVALID))

    def _fit(self, df: DataFrame) -> CategoryIndexerModel:
        columns = self.getOrDefault("inputCols")
        entries = [
            F.struct(F.lit(i).alias("column"), quoted(c).cast("string").alias("label"))
            for i, c in enumerate(columns)
        ]
        # Counted before the shuffle, so a label of a third of the rows travels as few counters.
        counted = stage(
            df.select(F.inline(F.array(*entries)))
            .filter("label is not null")
            .groupBy("column", "label")
            .agg(F.count(F.lit(1)).alias("n")),
            "label-counts",
        )
        # Java sorts strings by their 16-bit units, and so does StringIndexer.
        order = [-F.col("n"), F.encode("label", "UTF-16BE")]
        numbered = ranked(counted, order, ["column"], "number")
        path = new_path(df.sparkSession, "categories")
        numbered = numbered.select("column", "label", F.col("number").cast("double").alias("number"))
        numbered.write.partitionBy("column").parquet(path)
        counts = counted.groupBy("column").agg(F.count(F.lit(1)).alias("labels")).collect()
        sizes = {r["column"]: r["labels"] for r in counts}
        model = CategoryIndexerModel(
            inputCols=columns,
            outputCols=self.getOrDefault("outputCols"),
            handleInvalid=self.getOrDefault("handleInvalid"),
            sizes=[sizes.get(i, 0) for i in range(len(columns))],
        )
        model.path = path
        return model


class CategoryIndexerModel(_CategoryParams, Saved, Model):
    """The label tables and the joins that apply them, to tables and streams.

    ``keep`` gives unknown labels and NULL the number after the last, ``skip`` leaves their rows
    out, ``error`` fails when such a row is met.
    """

    sizes = column_param("sizes", "number of labels of each column", TypeConverters.toListInt)
    path: str

    def labels(self, i: int) -> DataFrame:
        """``label, number`` of the i-th column."""
        schema = "label string, number double"
        spark = SparkSession.active()
        if not self.getOrDefault("sizes")[i]:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(f"{self.path}/column={i}")

    def _transform(self, df: DataFrame) -> DataFrame:
        get = self.getOrDefault
        invalid = get("handleInvalid")
        for i, (source, target) in enumerate(zip(get("inputCols"), get("outputCols"))):
            size = get("sizes")[i]
            labels = self.labels(i).select(
                F.col("label").alias("__label"), F.col("number").alias("__number")
            )
            label = quoted(source).cast("string")
            joined = df.join(labels, label == F.col("__label"), "inner" if invalid == "skip" else "left")
            number = F.col("__number")
            if invalid == "keep":
                number = F.coalesce(number, F.lit(float(size)))
            elif invalid == "error":
                said = F.concat(F.lit(f"no number for a label of {source}: "), F.coalesce(label, F.lit("NULL")))
                number = F.coalesce(number, F.raise_error(said).cast("double"))
            known = size + (invalid == "keep")
            about = {"ml_attr": {"type": "nominal", "num_vals": known, "name": target}}
            kept = [quoted(c) for c in df.columns if c != target]
            df = joined.select(*kept, number.alias(target, metadata=about))
        return df

    def write(self) -> MLWriter:
        return _LabelsWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _LabelsReader()


class _LabelsWriter(MLWriter):
    def __init__(self, model: CategoryIndexerModel) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        for i, size in enumerate(self.model.getOrDefault("sizes")):
            if size:
                self.model.labels(i).write.parquet(f"{path}/labels/column={i}")


class _LabelsReader(MLReader):
    def load(self, path: str) -> CategoryIndexerModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = CategoryIndexerModel()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        model.path = f"{path}/labels"
        return model


class CategoryEncoder(_CategoryParams, Saved, Estimator):
    """Sparse one-hot slots of numbered labels; the last label has none, as in Spark's encoder.

    The number of labels is told by the column, or else is its greatest number and one more. With
    ``keep``, invalid numbers are a label after all others.
    """

    def __init__(self, **values: object) -> None:
        super().__init__(**_checked({"handleInvalid": "error", **values}, INVALID[:2]))

    def _fit(self, df: DataFrame) -> CategoryEncoderModel:
        columns = self.getOrDefault("inputCols")
        told = [df.schema[c].metadata.get("ml_attr", {}).get("num_vals") for c in columns]
        missing = [c for c, size in zip(columns, told) if size is None]
        if missing:
            found = df.agg(*[F.max(quoted(c)).alias(str(i)) for i, c in enumerate(missing)]).first()
            most = dict(zip(missing, found))
            told = [
                math.floor(most[c] or 0) + 1 if size is None else size
                for c, size in zip(columns, told)
            ]
        return CategoryEncoderModel(
            inputCols=columns,
            outputCols=self.getOrDefault("outputCols"),
            handleInvalid=self.getOrDefault("handleInvalid"),
            sizes=told,
        )


class CategoryEncoderModel(_CategoryParams, Saved, Model):
    """Slots of a fixed width for each column."""

    sizes = column_param("sizes", "number of labels of each column", TypeConverters.toListInt)

    def _transform(self, df: DataFrame) -> DataFrame:
        get = self.getOrDefault
        keep = get("handleInvalid") == "keep"
        for source, target, size in zip(get("inputCols"), get("outputCols"), get("sizes")):
            about = {"ml_attr": {"num_attrs": size if keep else size - 1}}
            slots = _slots(quoted(source), size, keep, source)
            df = df.withColumn(target, slots.alias(target, metadata=about))
        return df


def _slots(number: Column, size: int, keep: bool, name: str) -> Column:
    """A sparse vector with a one in the slot of the number."""
    width = size if keep else size - 1
    valid = (number >= 0) & (number < size) & (number == F.floor(number))
    invalid = F.lit(size) if keep else F.raise_error(F.lit(f"{name} holds no number of a label")).cast("int")
    slot = F.when(F.coalesce(valid, F.lit(False)), number.cast("int")).otherwise(invalid)
    shape = T.StructType([T.StructField("v", VectorUDT())])
    empty = json.dumps({"v": {"type": 0, "size": width, "indices": [], "values": []}})
    one = empty.replace('"values": []', '"values": [1.0]')
    before, after = one.split('"indices": []')
    held = F.concat(F.lit(f'{before}"indices": ['), slot, F.lit(f"]{after}"))
    return F.from_json(F.when(slot < width, held).otherwise(F.lit(empty)), shape)["v"]
