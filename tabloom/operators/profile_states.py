"""Profiles that merge: the state of a file or batch, kept and added to others later.

``states`` reads rows once and gives a small row for each column: counts, moments, extremes, and
sketches of the distinct values and of the distribution. Rows of several states merge into one
without reading the data again, so a daily batch costs a daily batch. What ``report`` says about
counts, means, deviations and extremes is exact; the number of distinct values and quantiles are
within the bounds of their sketches.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions import is_missing, numeric_columns, quoted, valid_number

#: Sizes of the sketches: a relative error of about 1.6 % for distinct values (one deviation), and
#: of about 1.3 % of the rows for ranks.
DISTINCT_LOG, QUANTILE_SIZE = 12, 200

SCHEMA = (
    "place int, column string, type string, rows long, missing long, count long, mean double, "
    "squares double, min double, max double, min_text string, max_text string, "
    "distinct binary, distribution binary"
)


def _state(df: DataFrame, names: Sequence[str], places: dict[str, int], numbers: set[str]) -> DataFrame:
    aggregates, rows = [], []
    no_number, no_text, no_bytes = (F.lit(None).cast(t) for t in ("double", "string", "binary"))
    for i, name in enumerate(names):
        column = quoted(name)
        is_text = isinstance(df.schema[name].dataType, T.StringType)
        # Sketched by a hash, as sketches take no doubles and no structs.
        value = F.when(~is_missing(df, name), F.xxhash64(column))
        made: dict[str, Column] = {
            "missing": F.count_if(is_missing(df, name)),
            "count": F.count(column),
            "distinct": F.hll_sketch_agg(value, DISTINCT_LOG),
        }
        if name in numbers:
            number = column.cast("double")
            made |= {
                "mean": F.avg(number),
                "squares": F.var_pop(number) * F.count(number),
                "min": F.min(number),
                "max": F.max(number),
                "distribution": F.kll_sketch_agg_double(valid_number(column), QUANTILE_SIZE),
            }
        elif is_text:
            made |= {"min_text": F.min(column), "max_text": F.max(column)}
        aggregates += [c.alias(f"{key}{i}") for key, c in made.items()]

        def held(key: str, other: Column, i: int = i, made: dict = made) -> Column:
            return (F.col(f"{key}{i}") if key in made else other).alias(key)

        kind = df.schema[name].dataType.simpleString()
        rows.append(
            F.struct(
                F.lit(places[name]).alias("place"),
                F.lit(name).alias("column"),
                F.lit(kind).alias("type"),
                F.col("rows"),
                held("missing", no_number),
                held("count", no_number),
                *[held(k, no_number) for k in ("mean", "squares", "min", "max")],
                *[held(k, no_text) for k in ("min_text", "max_text")],
                *[held(k, no_bytes) for k in ("distinct", "distribution")],
            )
        )
    counted = df.agg(F.count(F.lit(1)).alias("rows"), *aggregates)
    return counted.select(F.inline(F.array(*rows)))


def states(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The state of every column, or of ``columns``: a row each.

    Numbers and the rest are summed up apart, as in ``profile.statistics``.
    """
    names = list(columns or df.columns)
    places = {name: i for i, name in enumerate(names)}
    numbers = {n for n in numeric_columns(df) if n in places}
    parts = [[n for n in names if n in numbers], [n for n in names if n not in numbers]]
    frames = [_state(df, part, places, numbers) for part in parts if part]
    return reduce(DataFrame.unionByName, frames).to(T._parse_datatype_string(SCHEMA))


def merge(held: DataFrame) -> DataFrame:
    """States of any number of parts, as one for each column.

    Squares about the means of the parts are moved to the common mean.
    """
    of_column = Window.partitionBy("column")
    n = F.col("count").cast("double")
    some = F.when(F.col("count") > 0, F.col("mean") * n)
    common = F.try_divide(F.sum(some).over(of_column), F.sum(n).over(of_column))
    away = F.col("mean") - F.col("_common")
    moved = F.when(F.col("count") > 0, F.col("squares") + n * away * away)
    return (
        held.withColumn("_common", common)
        .groupBy("column")
        .agg(
            F.min("place").alias("place"),
            F.max("type").alias("type"),
            F.sum("rows").alias("rows"),
            F.sum("missing").alias("missing"),
            F.sum("count").alias("count"),
            F.first("_common", ignorenulls=True).alias("mean"),
            F.sum(moved).alias("squares"),
            F.min("min").alias("min"),
            F.max("max").alias("max"),
            F.min("min_text").alias("min_text"),
            F.max("max_text").alias("max_text"),
            F.hll_union_agg("distinct").alias("distinct"),
            F.kll_merge_agg_double("distribution").alias("distribution"),
        )
        .to(T._parse_datatype_string(SCHEMA))
    )


def report(held: DataFrame) -> DataFrame:
    """``column, rows, missing, pct, count, mean, stddev, min, max, min_text, max_text, distinct``.

    The missing value counts as a distinct value, as in ``profile.cardinality``.
    """
    n = F.col("count")
    stddev = F.when(n > 1, F.sqrt(F.col("squares") / (n - 1)))
    empty = F.hll_sketch_estimate("distinct") + (F.col("missing") > 0).cast("long")
    return held.orderBy("place").select(
        "column",
        "rows",
        "missing",
        F.try_divide(F.col("missing") * 100.0, "rows").alias("pct"),
        "count",
        "mean",
        stddev.alias("stddev"),
        "min",
        "max",
        "min_text",
        "max_text",
        empty.alias("distinct"),
    )


def quantiles(held: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """``column, probability, value`` of the columns of numbers that have values."""
    wanted = F.array(*[F.lit(float(p)) for p in probabilities])
    filled = held.filter("distribution is not null")
    filled = filled.filter(F.kll_sketch_get_n_double("distribution") > 0)
    found = F.kll_sketch_get_quantile_double("distribution", wanted)
    return filled.select("column", F.inline(F.arrays_zip(wanted.alias("probability"), found.alias("value"))))
