"""Column expressions shared by the operators. All of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def is_nan(df: DataFrame, name: str) -> Column:
    """NaN test that is constant false for types that cannot hold NaN."""
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return F.isnan(quoted(name))
    return F.lit(False)


def is_missing(df: DataFrame, name: str, include_nan: bool = True) -> Column:
    """NULL for every type; NaN counts too for float and double."""
    null = quoted(name).isNull()
    if include_nan and isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return null | F.isnan(quoted(name))
    return null


def valid_number(column: Column) -> Column:
    """The column as double, with NaN turned into NULL."""
    number = column.cast("double")
    return F.when(~F.isnan(number), number)


def compact(df: DataFrame, name: str) -> Column:
    """The column in a form that is cheap to shuffle and equal for equal values only.

    Long texts become their SHA-256 and a byte that no text holds; everything else stays.
    """
    column = quoted(name)
    if df.schema[name].dataType != T.StringType():
        return column
    digest = F.concat(F.unhex(F.sha2(column, 256)), F.lit(bytearray(b"\xff")))
    return F.when(F.octet_length(column) > 64, digest).otherwise(column.cast("binary"))


def key_digest(key: str | Sequence[str]) -> Column:
    """md5 of a row key (one column or several). NULL keys hash like empty text."""
    names = [key] if isinstance(key, str) else list(key)
    return F.md5(F.concat_ws("\u0001", *[quoted(n).cast("string") for n in names]))


def hash_bucket(key: str | Sequence[str], buckets: int) -> Column:
    """Bucket 0..buckets-1 that depends on the key only, never on the partitioning."""
    return F.conv(F.substring(key_digest(key), 1, 8), 16, 10).cast("bigint") % buckets


def hash_order(key: str | Sequence[str], start: int = 1) -> Column:
    """52 bits of the digest from hex digit ``start``: an exact double that sorts as they do."""
    return F.conv(F.substring(key_digest(key), start, 13), 16, 10).cast("bigint").cast("double")


def vector_item(column: str, index: int) -> Column:
    """One slot of an ML vector column as double."""
    return vector_to_array(quoted(column))[index]
