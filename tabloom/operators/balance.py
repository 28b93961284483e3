"""Class balancing by copying rows of the smallest class or thinning out the largest.

``mode="sample"`` draws rows at random, so the target is met roughly. ``mode="exact"``
meets it to the row and picks the rows by the hash of a key: the order statistic that cuts
off the wanted number is searched for first, and the rows are then chosen by a comparison
with it. No rows are ranked, sorted or shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions import hash_order, quoted
from tabloom.operators.quantiles import order_statistics

# Copies of a row that one task makes, and parts a row is cut into when there are more.
_COPIES_PER_TASK = 16
_PARTS_PER_STEP = 1000


def class_extremes(df: DataFrame, label: str) -> DataFrame:
    """One row: largest and smallest class with their counts, and the number of classes.

    Among equal counts the first label is the majority and the last one the minority.
    """
    counts = df.groupBy(quoted(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.min_by("label", F.struct(-F.col("n"), F.col("label"))).alias("majority"),
        F.max("n").alias("majority_count"),
        F.max_by("label", F.struct(-F.col("n"), F.col("label"))).alias("minority"),
        F.min("n").alias("minority_count"),
        F.count(F.lit(1)).alias("classes"),
    )


def lowest_by_hash(df: DataFrame, rows: Column, total: int, n: int, key) -> Column:
    """Condition for the ``n`` rows with the lowest key hash among the ``total`` of ``rows``."""
    if n >= total:
        return rows
    if n <= 0:
        return F.lit(False)
    order = hash_order(key)
    cut = order_statistics(df, [F.when(rows, order)], lambda i, count: [n], [n / total])[0][0]
    wanted = n - cut.below
    if wanted == cut.equal:
        return rows & (order <= F.lit(cut.value))
    # Rows that agree in the first bits of the digest are told apart by the next ones.
    tied, rest = rows & (order == F.lit(cut.value)), hash_order(key, 14)
    next_cut = order_statistics(
        df, [F.when(tied, rest)], lambda i, count: [wanted], [wanted / cut.equal]
    )[0][0]
    if wanted - next_cut.below != next_cut.equal:
        raise ValueError(f"rows with equal key {key}; give a key that tells rows apart")
    return rows & (
        (order < F.lit(cut.value)) | ((order == F.lit(cut.value)) & (rest <= F.lit(next_cut.value)))
    )


def _check(mode: str, key) -> None:
    if mode not in ("sample", "exact"):
        raise ValueError(f"unknown mode {mode!r}, use 'sample' or 'exact'")
    if mode == "exact" and key is None:
        raise ValueError("mode 'exact' needs the row key")


def _is(label: str, value: object) -> Column:
    return quoted(label).eqNullSafe(F.lit(value))


def _repeat(df: DataFrame, copies: Column, most: int) -> DataFrame:
    """Each row ``copies`` times.

    Many copies of a row are made in steps, and dealt out over the cluster between them, so
    that no task writes all copies of the rows it happened to read.
    """
    numbered = df.withColumn("__n", copies.cast("bigint")).filter(F.col("__n") > 0)
    size, sizes = _COPIES_PER_TASK, []
    while size < most:
        sizes.append(size)
        size *= _PARTS_PER_STEP
    if sizes:
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        single = numbered.filter(F.col("__n") == 1)
        many = numbered.filter(F.col("__n") > 1)
        for size in reversed(sizes):
            many = many.withColumn("__n", F.explode(_parts(F.col("__n"), size))).repartition(tasks)
        numbered = many.unionByName(single)
    repeated = F.array_repeat(F.lit(0), F.col("__n").cast("int"))
    return numbered.withColumn("__n", F.explode(repeated)).drop("__n")


def _parts(n: Column, size: int) -> Column:
    """``n`` cut into parts of ``size`` and a rest."""
    starts = F.sequence(F.lit(0).cast("bigint"), n - 1, F.lit(size).cast("bigint"))
    return F.transform(starts, lambda start: F.least(F.lit(size).cast("bigint"), n - start))


def oversample_minority(
    df: DataFrame,
    label: str = "label",
    ratio: float = 1.0,
    mode: str = "sample",
    key: str | Sequence[str] | None = None,
    drop_other: bool = False,
    seed: int = 42,
) -> DataFrame:
    """Bring the smallest class to ``int(largest * ratio)`` rows by repeating its rows.

    Classes in between stay as they are, or go with ``drop_other``. Data of one class is
    returned unchanged.
    """
    _check(mode, key)
    found = class_extremes(df, label).first()
    if found["classes"] < 2:
        return df
    is_majority, is_minority = _is(label, found["majority"]), _is(label, found["minority"])
    small = found["minority_count"]
    target = int(found["majority_count"] * ratio)
    if mode == "sample":
        rest = df.filter(is_majority if drop_other else ~is_minority)
        return rest.unionByName(df.filter(is_minority).sample(True, target / small, seed))
    each, extra = divmod(target, small)
    chosen = lowest_by_hash(df, is_minority, small, extra, key)
    copies = (
        F.when(is_minority, F.lit(each) + F.when(chosen, 1).otherwise(0))
        .when(is_majority, 1)
        .otherwise(0 if drop_other else 1)
    )
    return _repeat(df, copies, each + 1)


def undersample_majority(
    df: DataFrame,
    label: str = "label",
    ratio: float = 1.0,
    mode: str = "sample",
    key: str | Sequence[str] | None = None,
    drop_other: bool = False,
    seed: int = 42,
) -> DataFrame:
    """Bring the largest class down to ``int(smallest / ratio)`` rows."""
    _check(mode, key)
    if ratio <= 0:
        raise ValueError("ratio must be above 0")
    found = class_extremes(df, label).first()
    if found["classes"] < 2:
        return df
    is_majority, is_minority = _is(label, found["majority"]), _is(label, found["minority"])
    large = found["majority_count"]
    target = int(found["minority_count"] / ratio)
    rest = is_minority if drop_other else ~is_majority
    if mode == "sample":
        thinned = df.filter(is_majority).sample(False, min(1.0, target / large), seed)
        return thinned.unionByName(df.filter(rest))
    return df.filter(rest | lowest_by_hash(df, is_majority, large, target, key))
