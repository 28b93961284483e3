"""What each filter of a chain removes, under every order of the filters.

Every filter has a table of the rows that fail it. Rows go through these tables one after the
other, a left-semi join parting those that fail from those that a left-anti join lets pass, until
each row is in the cell of exactly the filters it fails. A prefix of filters leaves the cells
that hold none of them, so the counts of all orders follow from counts by part and cell.

Results for odd input: a null text is empty, and an empty text fails A only (and E, where a
smaller id is empty too). Rows without an id never fail E and have no label. Rows of equal id and
text are judged alike and all counted; of one id, any text may fail. A null part counts with the
empty one. Where an id has several labels, any 1 counts. An empty table gives no rows. Columns
besides ``doc_id``, ``text`` and the part pass unread, whatever their names.
"""

from __future__ import annotations

import itertools
import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.workspace import stage

SPACE = r"[\x20\x09-\x0D]+"
#: Texts held by more than this share of the rows are told to all tasks: fewer than its inverse.
HOT_SHARE = 0.001


def text_failures(text: Column) -> dict[str, Column]:
    """The filters that look at one text: length, repeated words, capitals, symbols."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return {
        "A": F.size(words) < 200,
        "B": F.size(F.array_distinct(words)) * F.lit(100).cast("long") < F.size(words) * 50,
        "C": capitals.cast("long") * 100 > F.length(text) * 2,
        "D": text.rlike(r"[#$%&*|]"),
    }


def judged(docs: DataFrame, part: str = "source") -> DataFrame:
    """One row per different id, text and part, with the verdicts and the number of copies."""
    text = F.coalesce(F.col("text"), F.lit(""))
    parted = F.coalesce(F.col(f"`{part}`").cast("string"), F.lit(""))
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), parted.alias("part"))
    seen = plain.select(
        "doc_id",
        "part",
        F.unhex(F.sha2("text", 256)).alias("digest"),
        *[c.alias(name) for name, c in text_failures(F.col("text")).items()],
    )
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.lit(":"), F.hex("digest"))
    counted = seen.groupBy(*seen.columns).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("row", F.unhex(F.md5(named)))


def repeats(rows: DataFrame) -> DataFrame:
    """Rows whose text a row with a smaller id holds too.

    Texts that many rows hold are compared where the rows lie; the others are gathered by text.
    """
    total = rows.agg(F.sum("n")).first()[0] or 0
    held = rows.groupBy("digest").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.sum("n").alias("copies")
    )
    held = stage(held.filter("first < last"), "audit-texts")
    hot = F.broadcast(held.filter(F.col("copies") >= total * HOT_SHARE).select("digest", "first"))
    cold = held.filter(F.col("copies") < total * HOT_SHARE).select("digest", "first")
    small = rows.select("row", "doc_id", "digest")
    found = small.join(hot, "digest").unionByName(
        small.join(hot, "digest", "left_anti").join(cold, "digest")
    )
    return found.filter("doc_id > first").select("row").distinct()


def failing_tables(rows: DataFrame) -> dict[str, DataFrame]:
    """Filter to the stored table of rows that fail it."""
    failing = {name: rows.filter(name).select("row").distinct() for name in "ABCD"}
    failing["E"] = repeats(rows)
    return {name: stage(table, f"audit-fails-{name}") for name, table in failing.items()}


def cells(rows: DataFrame, failing: dict[str, DataFrame]) -> DataFrame:
    """``rows`` with ``mask``: bit k is set where the k-th filter of ``failing`` fails.

    Each filter parts what the ones before it have left and removed, both at once.
    """
    held = rows.withColumn("mask", F.lit(0))
    for k, (name, table) in enumerate(failing.items()):
        removed = held.join(table, "row", "left_semi")
        passed = held.join(table, "row", "left_anti")
        parted = passed.unionByName(removed.withColumn("mask", F.col("mask") + F.lit(1 << k)))
        held = stage(parted, f"audit-after-{name}")
    return held


def _steps(names: str) -> Column:
    """Every order and step: the filter's bit and the bits before it."""
    made = []
    for order in itertools.permutations(range(len(names))):
        text = "".join(names[k] for k in order)
        for step, k in enumerate(order, 1):
            before = sum(1 << x for x in order[: step - 1])
            made.append({"filter_order": text, "step": step, "bit": 1 << k, "before": before})
    kind = "array<struct<filter_order string, step int, bit int, before int>>"
    return F.from_json(F.lit(json.dumps(made)), kind)


def _sum(condition, value) -> Column:
    """Sum of ``value`` over the cells that meet ``condition``."""
    return F.aggregate(
        "cells",
        F.lit(0).cast("long"),
        lambda total, c: total + F.when(condition(c["mask"]), value(c)).otherwise(F.lit(0)),
    ).cast("long")


def over_orders(counted: DataFrame, names: str) -> DataFrame:
    """From counts by ``part`` and ``mask`` (``n``, ``good``, ``toxic``) to all orders and steps."""
    gathered = counted.groupBy("part").agg(
        F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells")
    )
    steps = gathered.select("part", "cells", F.explode(_steps(names)).alias("s"))
    steps = steps.select("part", "cells", "s.*")
    bit, before = F.col("bit"), F.col("before")
    fails = lambda m: m.bitwiseAND(bit) != 0
    left = lambda m: m.bitwiseAND(before) == 0
    removed = lambda m: fails(m) & left(m)
    number = lambda c: c["n"]
    # A row failing k filters goes by each of them in a k-th of the orders.
    orders = F.lit(math.factorial(len(names)))
    shared = lambda c: (c["n"] * orders / F.bit_count(c["mask"])).cast("long")
    return steps.select(
        "part",
        "filter_order",
        "step",
        _sum(lambda m: left(m) & ~fails(m), number).alias("kept"),
        _sum(removed, number).alias("removed"),
        _sum(lambda m: fails(m) & ~left(m), number).alias("redundant"),
        _sum(lambda m: m == bit, number).alias("unique_fails"),
        _sum(removed, lambda c: c["good"]).alias("good_lost"),
        _sum(removed, lambda c: c["toxic"]).alias("toxic_lost"),
        _sum(fails, shared).alias("shapley"),
    )


def audit(
    rows: DataFrame, failing: dict[str, DataFrame], good: DataFrame, toxic: DataFrame
) -> DataFrame:
    """Counts of each part, order and step.

    ``rows`` has ``row``, ``doc_id``, ``part`` and ``n`` (copies); ``failing`` names each filter's
    table of ``row``, in the order of their letters; ``good`` and ``toxic`` hold ``doc_id``.
    """
    small = rows.select("row", "doc_id", "part", "n")
    for name, ids in (("good", good), ("toxic", toxic)):
        marks = ids.select(F.col("doc_id").cast("long").alias("doc_id")).dropna().distinct()
        small = small.join(marks.withColumn(name, F.lit(1)), "doc_id", "left")
    small = small.select(
        "row", "part", "n", *[F.coalesce(name, F.lit(0)).alias(name) for name in ("good", "toxic")]
    )
    found = cells(small, failing)
    counted = found.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        *[F.sum(F.col("n") * F.col(name)).alias(name) for name in ("good", "toxic")],
    )
    return over_orders(counted, "".join(failing))


def five_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters A to E over ``docs``, with the losses of ``labels``."""
    rows = stage(judged(docs), "audit-rows")
    return audit(
        rows, failing_tables(rows), labels.filter("quality = 1"), labels.filter("toxic = 1")
    )
