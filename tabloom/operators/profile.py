"""Data-quality profiling. Every report reads each column it needs once, for all its numbers."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions import compact, is_missing, numeric_columns, quoted, text_columns


def missing(df: DataFrame, include_nan: bool = True) -> DataFrame:
    """One row with the number of missing values of every column."""
    return df.agg(*[F.count_if(is_missing(df, c, include_nan)).alias(c) for c in df.columns])


def missing_long(df: DataFrame, include_nan: bool = True) -> DataFrame:
    """One row per column: ``column, missing, pct``."""
    counted = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[
            F.count_if(is_missing(df, c, include_nan)).alias(f"m{i}")
            for i, c in enumerate(df.columns)
        ],
    )
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"m{i}").alias("missing"),
            F.try_divide(F.col(f"m{i}") * 100.0, F.col("n")).alias("pct"),
        )
        for i, c in enumerate(df.columns)
    ]
    return counted.select(F.inline(F.array(*rows)))


def describe(df: DataFrame) -> DataFrame:
    """Spark's own text summary: count, mean, stddev, min and max as strings."""
    return df.describe()


def _number_aggregates(numbers: Sequence[str]) -> list[Column]:
    aggregates = []
    for i, name in enumerate(numbers):
        value = quoted(name).cast("double")
        aggregates += [
            F.count(value).alias(f"n{i}_count"),
            F.avg(value).alias(f"n{i}_mean"),
            F.stddev_samp(value).alias(f"n{i}_stddev"),
            F.min(value).alias(f"n{i}_min"),
            F.max(value).alias(f"n{i}_max"),
        ]
    return aggregates


def _text_aggregates(texts: Sequence[str]) -> list[Column]:
    aggregates = []
    for i, name in enumerate(texts):
        aggregates += [
            F.count(quoted(name)).alias(f"t{i}_count"),
            F.min(quoted(name)).alias(f"t{i}_min"),
            F.max(quoted(name)).alias(f"t{i}_max"),
        ]
    return aggregates


def statistics(df: DataFrame) -> DataFrame:
    """Typed summary, one row per numeric or string column.

    Numbers fill ``count, mean, stddev, min, max``; strings fill ``count, min_text,
    max_text``. Columns of other types are left out. Numbers and strings are summed up apart:
    each column is still read once, and the least and greatest strings, which Spark cannot
    keep in a hash aggregate, do not slow down the numbers.
    """
    numbers, texts = numeric_columns(df), text_columns(df)
    no_number, no_text = F.lit(None).cast("double"), F.lit(None).cast("string")
    of_numbers = [
        F.struct(
            F.lit(name).alias("column"),
            F.col(f"n{i}_count").alias("count"),
            F.col(f"n{i}_mean").alias("mean"),
            F.col(f"n{i}_stddev").alias("stddev"),
            F.col(f"n{i}_min").alias("min"),
            F.col(f"n{i}_max").alias("max"),
            no_text.alias("min_text"),
            no_text.alias("max_text"),
        )
        for i, name in enumerate(numbers)
    ]
    of_texts = [
        F.struct(
            F.lit(name).alias("column"),
            F.col(f"t{i}_count").alias("count"),
            no_number.alias("mean"),
            no_number.alias("stddev"),
            no_number.alias("min"),
            no_number.alias("max"),
            F.col(f"t{i}_min").alias("min_text"),
            F.col(f"t{i}_max").alias("max_text"),
        )
        for i, name in enumerate(texts)
    ]
    frames = [
        df.agg(*aggregates).select(F.inline(F.array(*rows)))
        for aggregates, rows in (
            (_number_aggregates(numbers), of_numbers),
            (_text_aggregates(texts), of_texts),
        )
        if rows
    ]
    if not frames:
        raise ValueError("no numeric or string column to summarise")
    return reduce(DataFrame.unionByName, frames)


def duplicates(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """One row with the number of surplus rows, over all columns or over ``subset``.

    Rows are counted per distinct value before the shuffle, so many copies of one row
    travel as a single counter, and long texts as their digest.
    """
    names = list(subset or df.columns)
    keys = df.select(*[compact(df, c).alias(f"k{i}") for i, c in enumerate(names)])
    copies = keys.groupBy(*keys.columns).agg(F.count(F.lit(1)).alias("copies"))
    return copies.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates"))


def _distinct_values(df: DataFrame, name: str, approx: bool) -> Column:
    counter = F.approx_count_distinct if approx else F.count_distinct
    has_null = F.coalesce(F.max(quoted(name).isNull().cast("bigint")), F.lit(0))
    return counter(compact(df, name)) + has_null


def cardinality(df: DataFrame, columns: Sequence[str], approx: bool = False) -> DataFrame:
    """``column, distinct_values`` for all columns in one job; NULL counts as a value."""
    counted = df.agg(
        *[_distinct_values(df, c, approx).alias(f"d{i}") for i, c in enumerate(columns)]
    )
    rows = [
        F.struct(F.lit(c).alias("column"), F.col(f"d{i}").alias("distinct_values"))
        for i, c in enumerate(columns)
    ]
    return counted.select(F.inline(F.array(*rows)))


def report(df: DataFrame, categorical: Sequence[str] = (), approx: bool = False) -> DataFrame:
    """The whole quality report as one long table: ``section, column, metric, value, text``.

    One aggregation each for the strings, for all other columns, and for the distinct values,
    so that a column is read for what is asked of it; and one grouping for duplicates.
    """
    numbers, texts = numeric_columns(df), text_columns(df)
    others = [c for c in df.columns if c not in texts]

    def entry(section: str, column: str | None, metric: str, value: Column, text=None) -> Column:
        return F.struct(
            F.lit(section).alias("section"),
            F.lit(column).cast("string").alias("column"),
            F.lit(metric).alias("metric"),
            value.cast("double").alias("value"),
            (F.lit(None) if text is None else text).cast("string").alias("text"),
        )

    def lines(aggregates: list[Column], rows: list[Column]) -> DataFrame:
        return df.agg(*aggregates).select(F.inline(F.array(*rows)))

    def gaps(names: list[str]) -> tuple[list[Column], list[Column]]:
        counts = [F.count_if(is_missing(df, c)).alias(f"m{i}") for i, c in enumerate(names)]
        rows = [entry("missing_values", c, "missing", F.col(f"m{i}")) for i, c in enumerate(names)]
        return counts, rows

    aggregates, rows = gaps(others)
    aggregates += [F.count(F.lit(1)).alias("n"), *_number_aggregates(numbers)]
    rows += [
        entry("table", None, "total_rows", F.col("n")),
        entry("table", None, "total_columns", F.lit(len(df.columns))),
    ]
    rows += [
        entry("statistics", name, metric, F.col(f"n{i}_{metric}"))
        for i, name in enumerate(numbers)
        for metric in ("count", "mean", "stddev", "min", "max")
    ]
    frames = [lines(aggregates, rows)]

    if texts:
        aggregates, rows = gaps(texts)
        aggregates += _text_aggregates(texts)
        for i, name in enumerate(texts):
            rows.append(entry("statistics", name, "count", F.col(f"t{i}_count")))
            rows += [
                entry("statistics", name, metric, F.lit(None), F.col(f"t{i}_{metric}"))
                for metric in ("min", "max")
            ]
        frames.append(lines(aggregates, rows))

    if categorical:
        frames.append(
            lines(
                [_distinct_values(df, c, approx).alias(f"d{i}") for i, c in enumerate(categorical)],
                [
                    entry("cardinality", c, "distinct_values", F.col(f"d{i}"))
                    for i, c in enumerate(categorical)
                ],
            )
        )

    surplus = entry("table", None, "duplicates", F.col("duplicates"))
    frames.append(duplicates(df).select(F.inline(F.array(surplus))))
    return reduce(DataFrame.unionByName, frames)


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """Rows and share of every label value."""
    counts = df.groupBy(quoted(label)).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count"))
    return counts.select(quoted(label), "count", (F.col("count") / total.scalar()).alias("share"))


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 50) -> DataFrame:
    """Equal-width counts ``column, bin, lower, upper, count`` of all columns in one pass.

    The last bin is closed. A constant column has one bin. NULL and NaN are left out, empty
    bins are not listed.
    """
    numbers = [
        F.when(~is_missing(df, c), quoted(c).cast("double")).alias(f"h{i}")
        for i, c in enumerate(columns)
    ]
    values = df.select(*numbers)
    ends = values.agg(
        *[F.min(f"h{i}").alias(f"lo{i}") for i in range(len(columns))],
        *[F.max(f"h{i}").alias(f"hi{i}") for i in range(len(columns))],
    ).first()
    entries = []
    for i, name in enumerate(columns):
        low, high = ends[f"lo{i}"], ends[f"hi{i}"]
        if low is None:
            continue
        if math.isinf(low) or math.isinf(high):
            raise ValueError(f"column {name} has infinite values, so no bins of equal width")
        width = (high - low) / bins
        value = F.col(f"h{i}")
        if width > 0:
            slot = F.least(F.floor((value - F.lit(low)) / F.lit(width)), F.lit(bins - 1))
        else:
            slot = F.when(value.isNotNull(), F.lit(0))
        entries.append(
            F.struct(
                F.lit(name).alias("column"),
                F.when(value.isNotNull(), slot).cast("int").alias("bin"),
                F.lit(low).alias("low"),
                F.lit(width).alias("width"),
            )
        )
    if not entries:
        raise ValueError("no values to count")
    return (
        values.select(F.inline(F.array(*entries)))
        .filter(F.col("bin").isNotNull())
        .groupBy("column", "bin", "low", "width")
        .agg(F.count(F.lit(1)).alias("count"))
        .select(
            "column",
            "bin",
            (F.col("low") + F.col("bin") * F.col("width")).alias("lower"),
            (F.col("low") + (F.col("bin") + 1) * F.col("width")).alias("upper"),
            "count",
        )
    )

