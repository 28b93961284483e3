"""Splits, folds and ordered samples."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from contextlib import contextmanager
from functools import reduce
from itertools import accumulate

from pyspark import StorageLevel
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions import hash_bucket, key_digest, quoted
from tabloom.workspace import stage

# A hash split cuts the 32 bits of the hash, so shares are exact to this part of a whole.
RESOLUTION = 1 << 32
# Partitions of training rows, where the session does not name a number: at least so many, of so
# many bytes; vectors, often sparse, count as no more than their share.
TRAINING_SETTING, TRAINING_PARTITIONS = "spark.tabloom.trainingPartitions", 16
PARTITION_BYTES, MOST_VECTOR_BYTES = 64 << 20, 4096
# Hex digits of a key's hash, and how many are looked at in a step: 4096 slots.
DIGITS, STEP = 32, 3
# Equal rows that may stand in one partition.
SAME_ROWS = 1000


def random_split(df: DataFrame, weights: Sequence[float], seed: int = 42) -> list[DataFrame]:
    """Spark's seeded split. It changes with the partitioning of the input."""
    return df.randomSplit(list(weights), seed)


def hash_split(
    df: DataFrame, key: str | Sequence[str], weights: Sequence[float]
) -> list[DataFrame]:
    """Split by the hash of a row key: same rows on every run, cluster and file layout.

    Each part is a filter on the scan, without a shuffle.
    """
    ends, bucket = _ends(weights), hash_bucket(key, RESOLUTION)
    return [
        df.filter((bucket >= low) & (bucket < high)) for low, high in zip([0, *ends], ends)
    ]


def _ends(weights: Sequence[float]) -> list[int]:
    total = sum(weights)
    ends = [round(w / total * RESOLUTION) for w in accumulate(weights)]
    if any(low >= high for low, high in zip([0, *ends], ends)):
        raise ValueError(f"a share of {list(weights)} is too small to get any row")
    return ends


def hash_part(key: str | Sequence[str], weights: Sequence[float]) -> Column:
    """Number of the part of ``hash_split`` that a row is in."""
    bucket = hash_bucket(key, RESOLUTION)
    return F.array_size(F.array_compact(F.array(*[F.when(bucket >= e, 1) for e in _ends(weights)])))


def hash_fold(key: str | Sequence[str], folds: int) -> Column:
    """Fold number 0..folds-1 of a row, for cross-validation."""
    return hash_bucket(key, folds).cast("int")


def top_n(df: DataFrame, key: str | Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows by ``key``: a limit that gives the same rows every time."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.orderBy(*keys).limit(n)


def sample_classes(
    df: DataFrame, label: str, fractions: dict[object, float], seed: int = 42
) -> DataFrame:
    """Sample every class at its own rate in one pass."""
    return df.sampleBy(label, fractions, seed)


def _class_cuts(play: DataFrame, want: DataFrame, digits: int) -> tuple[DataFrame, DataFrame]:
    """``(__label, __cut)`` up to which a class is taken, and what digests do not tell apart.

    ``play(__label, __digest)`` are the rows, ``want(__label, left)`` how many of a class are
    taken. Of classes whose cut lies between equal digests come the digest and how many of its
    rows are still to be taken, as ``(__label, __cut, left)``.
    """
    found = []
    for at in range(1, digits + 1, STEP):
        slots = play.groupBy("__label", F.substring("__digest", 1, at + STEP - 1).alias("__cut")).agg(
            F.count(F.lit(1)).alias("n")
        )
        of_class = Window.partitionBy("__label")
        before = of_class.orderBy("__cut").rowsBetween(Window.unboundedPreceding, -1)
        slots = slots.withColumns(
            {"all": F.sum("n").over(of_class), "before": F.coalesce(F.sum("n").over(before), F.lit(0))}
        ).join(want, "__label")
        left = F.floor(F.col("fraction") * F.col("all") + 0.5) if "fraction" in want.columns else F.col("left")
        here = slots.withColumn("left", left - F.col("before"))
        here = here.filter((F.col("left") > 0) & (F.col("left") <= F.col("n")))
        here = stage(here.select("__label", "__cut", "left", "n"), "class-cuts")
        found.append(here.filter("left = n").select("__label", "__cut"))
        open_ = here.filter("left < n").select("__label", "__cut", "left")
        if open_.isEmpty():
            break
        want = open_.select("__label", "left")
        if at + STEP <= digits:
            play = stage(
                play.join(open_.select("__label", "__cut"), "__label")
                .filter(F.substring("__digest", 1, at + STEP - 1) == F.col("__cut"))
                .drop("__cut"),
                "class-rows",
            )
    return reduce(DataFrame.unionByName, found), open_


def sample_classes_exact(
    df: DataFrame,
    label: str,
    fractions: Mapping[object, float] | DataFrame,
    key: str | Sequence[str],
    repeated: bool = False,
) -> DataFrame:
    """Exactly ``round(fraction * rows)`` rows of every class, by the order of a key's hash.

    The same rows on every run and layout. ``fractions`` may be a table ``label, fraction``, for
    any number of classes; classes without one, and rows without a label, are left out. The hash
    that cuts a class is searched for in all classes at once: rows are counted by class and the
    first digits of the hash, then, in the slot where the cut of the class is, by the next ones.
    The passes are three over ``df`` and a few over what is left in these slots. The key has to
    tell rows apart where a class is cut, unless it may be ``repeated``: then the rows of the key
    at the cut follow in the order of a hash of all their columns, and of equal rows as many are
    taken as are wanted.
    """
    spark, kind = df.sparkSession, df.schema[label].dataType
    if not isinstance(fractions, DataFrame):
        shape = T.StructType([T.StructField("__label", kind), T.StructField("fraction", T.DoubleType())])
        rows = [(k, float(f)) for k, f in fractions.items()]
        shares = spark.createDataFrame(rows, shape)
    else:
        shares = fractions.select(F.col("label").cast(kind).alias("__label"), F.col("fraction").cast("double"))
    outside = (F.col("fraction") < 0) | (F.col("fraction") > 1) | F.isnan("fraction")
    shares = stage(shares.dropna().withColumn("fraction", F.when(outside, F.raise_error(F.lit("a fraction is not within 0 and 1")).cast("double")).otherwise(F.col("fraction"))), "class-shares")
    digest = key_digest(key).alias("__digest")
    play = df.select(quoted(label).alias("__label"), digest).join(shares.select("__label"), "__label")
    cuts, ties = _class_cuts(play, shares, DIGITS)
    names = [quoted(c) for c in df.columns]
    if ties.isEmpty():
        tied = None
    elif not repeated:
        raise ValueError(f"{key} does not tell the rows of a class apart")
    else:
        # Rows of one digest get another: their hash, and a number for those that are equal.
        at_cut = (quoted(label) == F.col("__label")) & (F.col("__digest") == F.col("__cut"))
        rows = df.withColumn("__digest", digest).join(ties.select("__label", "__cut"), at_cut)
        second = F.concat(*[F.lpad(F.hex(h), 16, "0") for h in (F.xxhash64(*names), F.col("__number"))])
        rows = rows.withColumn("__number", F.monotonically_increasing_id()).withColumn("__digest", second)
        rows = stage(rows.select("__label", "__digest", *names), "tied-rows")
        inner, _ = _class_cuts(rows.select("__label", "__digest"), ties.select("__label", "left"), DIGITS)
        inner = stage(inner.withColumnRenamed("__label", "__class"), "class-cuts")
        tied = rows.join(inner, F.col("__label") == F.col("__class"))
        tied = tied.filter(F.expr("left(__digest, length(__cut)) <= __cut")).select(*names)
    cuts = cuts.withColumn("__whole", F.lit(True))
    if tied is not None:
        cuts = cuts.unionByName(ties.select("__label", "__cut", F.lit(False).alias("__whole")))
    cuts = stage(cuts, "class-cuts")
    taken = df.withColumn("__digest", digest).join(cuts, quoted(label) == F.col("__label"))
    first = F.expr("left(__digest, length(__cut))")
    taken = taken.filter((first < F.col("__cut")) | (F.col("__whole") & (first == F.col("__cut"))))
    taken = taken.select(*names)
    return taken if tied is None else taken.unionAll(tied)


@contextmanager
def cached(*frames: DataFrame):
    """Keep DataFrames in memory or on disk while the block runs."""
    kept = [f.persist(StorageLevel.MEMORY_AND_DISK) for f in frames]
    try:
        yield kept[0] if len(kept) == 1 else kept
    finally:
        for frame in kept:
            frame.unpersist()


def _width(field: T.StructField) -> Column:
    """About how many bytes a value takes, told by its type where that can be."""
    column, kind = quoted(field.name), field.dataType
    if isinstance(kind, T.StringType):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 8
    if isinstance(kind, T.BinaryType):
        return F.coalesce(F.length(column), F.lit(0)) + 8
    if isinstance(kind, VectorUDT):
        slots = field.metadata.get("ml_attr", {}).get("num_attrs", 32)
        return F.lit(min(8 * slots, MOST_VECTOR_BYTES))
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.size(column), F.lit(0)) * 8 + 8
    return F.lit(8)


def training_partitions(df: DataFrame) -> int:
    """The setting's number, else what the rows fill in parts of ``PARTITION_BYTES``."""
    named = df.sparkSession.conf.get(TRAINING_SETTING, None)
    if named:
        return int(named)
    width = reduce(lambda a, b: a + b, [_width(f).cast("long") for f in df.schema.fields], F.lit(0).cast("long"))
    size = df.agg(F.sum(width)).first()[0] or 0
    return max(TRAINING_PARTITIONS, math.ceil(size / PARTITION_BYTES))


def _copies(df: DataFrame, n: str, step: int = 10_000) -> DataFrame:
    """Each row as often as its ``n`` says, with ``__copy`` from 0; no task makes too many."""
    steps = df.withColumn("__step", F.explode(F.sequence(F.lit(0), ((F.col(n) - 1) / step).cast("long"))))
    dealt = steps.repartition(F.xxhash64(*[quoted(c) for c in steps.columns]))
    first = F.col("__step") * step
    made = F.sequence(first, F.least(first + step, F.col(n)) - 1)
    return dealt.withColumn("__copy", F.explode(made)).drop("__step", n)


def even_rows(df: DataFrame, partitions: int) -> DataFrame:
    """The rows in ``partitions`` even parts that depend on their values only.

    Rows are dealt by the hash of their values, and equal rows, of which a part should not hold
    too many, by their number among their copies too: they are counted, where they are, and
    made again, so none of them meet before they are dealt.
    """
    names = [quoted(c) for c in df.columns]
    place = F.xxhash64(*names)
    counted = df.groupBy(place.alias("__place")).agg(F.count(F.lit(1)).alias("__n"))
    many = stage(counted.filter(F.col("__n") > SAME_ROWS), "same-rows")
    rows = df.withColumn("__place", place)
    if many.isEmpty():
        return df.repartition(partitions, place).sortWithinPartitions(place)
    few = rows.join(many.select("__place"), "__place", "left_anti").withColumn("__copy", F.lit(0).cast("long"))
    copied = rows.join(many.select("__place"), "__place", "left_semi").drop("__place")
    copied = copied.groupBy(*names).agg(F.count(F.lit(1)).alias("__n"))
    made = _copies(copied, "__n").withColumn("__place", place)
    whole = few.select(*names, "__place", "__copy").unionByName(made)
    dealt = F.xxhash64("__place", "__copy")
    return (
        whole.repartition(partitions, dealt)
        .sortWithinPartitions(dealt, "__place")
        .select(*names)
    )


@contextmanager
def training_rows(df: DataFrame):
    """Keep rows that are read many times, laid out so that a fit is the same on any cluster.

    Rows are dealt by their values to as many partitions as their bytes fill, or as the setting
    ``spark.tabloom.trainingPartitions`` says, and stand in order of a hash. Seeded samples of
    trees and sums of gradients then follow the rows alone, not the cores or the files. Copies
    of one row are spread as all others are.
    """
    with cached(even_rows(df, training_partitions(df))) as even:
        yield even
