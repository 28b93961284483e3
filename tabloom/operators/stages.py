"""What the fitted stages of this package share."""

from __future__ import annotations

from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable


class Saved(DefaultParamsReadable, DefaultParamsWritable):
    """A stage that is described by its params alone."""

    def __init__(self, **values: object) -> None:
        super().__init__()
        self._set(**values)


def column_param(name: str, doc: str, convert=TypeConverters.toString) -> Param:
    return Param(Params._dummy(), name, doc, typeConverter=convert)
