"""Order without a global sort in one task: ranks and running totals, range by range.

Ranges hold neighbouring rows and are small enough for one task each. What lies before a range is
the sum of the ranges before it, which are few and are summed up on their own. Nothing here brings
rows, bounds or range lists to the driver but the bounds of Spark's own range partitioning.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.functions import quoted
from tabloom.workspace import stage

# Rows that one task sorts for running totals, and the parts into which a longer range is cut.
ROWS_PER_RANGE, PARTS = 100_000, 4096
_PLACES = 33  # bits that monotonically_increasing_id has for the place within a partition


def ranked(df: DataFrame, order: Sequence[Column], by: Sequence[str], name: str) -> DataFrame:
    """Add ``name``: the place, from 0, of each row within its group of ``by``.

    ``order`` are values that rise; they have to tell the rows of a group apart, or rows that tie
    may swap their places. The result is stored, in order; a group may span any number of tasks.
    """
    keys = [quoted(c) for c in by]
    place = F.monotonically_increasing_id()
    # The keys travel as columns of their own, so that sorting does not compute them twice.
    named = {f"__order{i}": c for i, c in enumerate(order)}
    sort = [*keys, *[F.col(c) for c in named]]
    sorted_rows = df.withColumns(named).repartitionByRange(*sort).sortWithinPartitions(*sort)
    placed = stage(
        sorted_rows.drop(*named)
        .withColumn("__id", place)
        .withColumn("__range", F.shiftright("__id", _PLACES))
        .withColumn("__place", F.col("__id").bitwiseAND((1 << _PLACES) - 1))
        .drop("__id"),
        "ranked",
    )
    # One row per group and range that it touches.
    touched = placed.groupBy(*keys, "__range").agg(
        F.count(F.lit(1)).alias("__n"), F.min("__place").alias("__first")
    )
    before = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = stage(
        touched.withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0)))
        .drop("__n")
        .select(*[quoted(c).alias(f"__by{i}") for i, c in enumerate(by)], "__range", "__first", "__start"),
        "range-starts",
    )
    same = F.lit(True)
    for i, c in enumerate(by):
        same = same & placed[f"`{c}`"].eqNullSafe(starts[f"__by{i}"])
    joined = placed.join(starts, (placed["__range"] == starts["__range"]) & same)
    rank = F.col("__start") + F.col("__place") - F.col("__first")
    return joined.select(*[quoted(c) for c in df.columns], rank.alias(name))


def _slot(value: Column, low: Column, high: Column) -> Column:
    """Which of ``PARTS`` parts of equal width between ``low`` and ``high`` a value is in.

    Every step keeps the order of values, so parts never overlap. Ends too far apart for a double
    are halved first.
    """
    width = high - low
    share = F.when(F.abs(width) == float("inf"), (value / 2 - low / 2) / (high / 2 - low / 2))
    share = share.otherwise(F.try_divide(value - low, width))
    slot = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * PARTS), F.lit(PARTS - 1))
    return F.greatest(slot, F.lit(0)).cast("int")


def _kind(value: Column) -> Column:
    """0 to 3: least infinity, numbers, greatest infinity, NaN, as Spark sorts them."""
    return (
        F.when(F.isnan(value), 3)
        .when(value == float("inf"), 2)
        .when(value == -float("inf"), 0)
        .otherwise(1)
    )


def totals_above(
    df: DataFrame, value: str, sums: Mapping[str, str], by: Sequence[str] = ()
) -> DataFrame:
    """Add running totals: for every ``sums`` name, the total of its column over the rows of the
    group with a greater ``value``.

    ``df`` has one row per group and ``value`` (a double without NULL). A group with more rows
    than a task should sort is cut into parts of equal width, parts with too many rows into parts
    again, each between its own least and greatest value, until all are small; a value is in no
    two parts. So crowded scores make more levels there and nowhere else. Totals above a part are
    those of its siblings above it, at most ``PARTS``, and of the part that holds it.
    """
    groups = list(by)
    columns = list(sums.values())
    rows = df.select(
        *[F.col(c).alias(f"__by{i}") for i, c in enumerate(groups)],
        F.col(value).alias("__value"),
        *[F.col(c).alias(f"__s{i}") for i, c in enumerate(columns)],
    )
    keys = [f"__by{i}" for i in range(len(groups))]
    held = [f"__s{i}" for i in range(len(columns))]
    starts = [f"__t{i}" for i in range(len(columns))]
    rows = stage(rows.withColumn("bucket", F.array(_kind(F.col("__value")))), "part-rows")
    parts = rows.groupBy(*keys, "bucket").agg(
        F.count(F.lit(1)).alias("__n"),
        F.min("__value").alias("__low"),
        F.max("__value").alias("__high"),
        *[F.sum(c).alias(c) for c in held],
    )
    outer = Window.partitionBy(*keys).orderBy(F.col("bucket").desc())
    above = outer.rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumns(
        {t: F.coalesce(F.sum(c).over(above), F.lit(0)) for t, c in zip(starts, held)}
    )
    parts, done = stage(parts, "parts"), []
    while True:
        large = parts.filter(F.col("__n") > ROWS_PER_RANGE)
        small = parts.filter(F.col("__n") <= ROWS_PER_RANGE).select(*keys, "bucket", *starts)
        done.append(_within(rows, small, keys, held, starts))
        if large.isEmpty():
            break
        ends = large.select(
            *keys,
            "bucket",
            F.col("__low"),
            F.col("__high"),
            *[F.col(t).alias(f"{t}_up") for t in starts],
        )
        cut = _matched(rows, ends, keys).withColumn(
            "__slot", _slot(F.col("__value"), F.col("__low"), F.col("__high"))
        )
        # Parts are told apart by the slots that lead to them.
        rows = stage(
            cut.select(
                *keys, "__value", *held, F.array_append("bucket", F.col("__slot")).alias("bucket")
            ),
            "part-rows",
        )
        inner = rows.groupBy(*keys, "bucket").agg(
            F.count(F.lit(1)).alias("__n"),
            F.min("__value").alias("__low"),
            F.max("__value").alias("__high"),
            *[F.sum(c).alias(c) for c in held],
        )
        parent = F.slice("bucket", F.lit(1), F.size("bucket") - 1)
        inner = inner.withColumn("__parent", parent)
        siblings = Window.partitionBy(*keys, "__parent").orderBy(F.col("bucket").desc())
        above = siblings.rowsBetween(Window.unboundedPreceding, -1)
        inner = inner.withColumns(
            {t: F.coalesce(F.sum(c).over(above), F.lit(0)) for t, c in zip(starts, held)}
        )
        up = ends.drop("__low", "__high").withColumnRenamed("bucket", "__up")
        same = inner["__parent"] == up["__up"]
        for k in keys:
            same = same & inner[k].eqNullSafe(up[k])
        parts = stage(
            inner.join(up, same).select(
                *[inner[k] for k in keys],
                "bucket",
                "__n",
                "__low",
                "__high",
                *held,
                *[(F.col(t) + F.col(f"{t}_up")).alias(t) for t in starts],
            ),
            "parts",
        )
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    return found.select(
        *[F.col(k).alias(c) for k, c in zip(keys, groups)],
        F.col("__value").alias(value),
        *[F.col(h).alias(c) for h, c in zip(held, columns)],
        *[F.col(t).alias(name) for t, name in zip(starts, sums)],
    )


def _matched(rows: DataFrame, parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with the columns of their part. Parts are stored, so their size is known."""
    same = rows["bucket"] == parts["bucket"]
    for k in keys:
        same = same & rows[k].eqNullSafe(parts[k])
    return rows.join(parts, same).drop(parts["bucket"], *[parts[k] for k in keys])


def _within(
    rows: DataFrame,
    parts: DataFrame,
    keys: Sequence[str],
    held: Sequence[str],
    starts: Sequence[str],
) -> DataFrame:
    """Totals above each row of parts that one task can sort."""
    place = Window.partitionBy(*keys, "bucket").orderBy(F.col("__value").desc())
    above = place.rowsBetween(Window.unboundedPreceding, -1)
    # Both sides are shuffled by part, which is what the window needs; nothing is broadcast.
    return _matched(rows, parts.hint("shuffle_hash"), keys).withColumns(
        {t: F.col(t) + F.coalesce(F.sum(c).over(above), F.lit(0)) for t, c in zip(starts, held)}
    )
