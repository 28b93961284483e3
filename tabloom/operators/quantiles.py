"""Quantiles of several columns at once, approximate or exact.

The exact form never gathers a column in one task. It brackets each wanted rank with
approximate quantiles, counts what lies below the brackets, and repeats inside them until
the few values left can be listed. Every step is one map-side aggregation over the columns
concerned; nothing is shuffled but sketches and counters.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions import quoted, valid_number

# Distinct values listed on the driver in the last step of an exact search.
LISTED_VALUES = 50_000
# Parts into which a further step cuts the values between two pivots.
SKETCH_PARTS = 128


@dataclass(frozen=True)
class OrderStatistic:
    """The value at a rank, and how many values are below it and equal to it."""

    value: float
    below: int
    equal: int


@dataclass(frozen=True)
class _Interval:
    """Open range between two neighbouring pivots of a column."""

    column: int
    low: float
    high: float
    below: int
    size: int


@dataclass
class _Series:
    """What is known about one column: counts of values below and up to each pivot."""

    name: str
    total: int = 0
    pivots: dict[float, tuple[int, int]] = field(default_factory=dict)

    def locate(self, rank: int, index: int) -> OrderStatistic | _Interval:
        low, below = -math.inf, 0
        for pivot in sorted(self.pivots):
            less, upto = self.pivots[pivot]
            if rank <= less:
                return _Interval(index, low, pivot, below, less - below)
            if rank <= upto:
                return OrderStatistic(pivot, less, upto - less)
            low, below = pivot, upto
        raise AssertionError("a rank above the count")


def _edges(pivots: set[float]) -> list[float]:
    """Bucket edges that give every pivot a bucket of its own, between those of the gaps.

    The bucket of a pivot ends at the next double. Positive infinity is not an edge but
    counted apart.
    """
    inner = {p for p in pivots if math.isfinite(p)}
    inner |= {math.nextafter(p, math.inf) for p in inner}
    inner.add(math.nextafter(-math.inf, math.inf))
    return [-math.inf, *sorted(e for e in inner if math.isfinite(e)), math.inf]


def _bucketed(values: DataFrame, names: list[str], edges: list[list[float]]) -> DataFrame:
    """Add ``{name}_b``; positive infinity goes to the bucket after the last one."""
    marked = values.withColumns(
        {f"{n}_m": F.when(F.col(n) == math.inf, math.nan).otherwise(F.col(n)) for n in names}
    )
    bucketizer = Bucketizer(
        inputCols=[f"{n}_m" for n in names],
        outputCols=[f"{n}_b" for n in names],
        splitsArray=edges,
        handleInvalid="keep",
    )
    return bucketizer.transform(marked)


def _count_pivots(values: DataFrame, series: list[_Series], found: list[set[float]]) -> None:
    names = [s.name for s in series]
    edges = [_edges(pivots) for pivots in found]
    slots = [
        F.struct(F.lit(i).alias("i"), F.col(f"{n}_b").cast("int").alias("b"))
        for i, n in enumerate(names)
    ]
    counted = (
        _bucketed(values, names, edges)
        .select(F.inline(F.array(*slots)))
        .filter(F.col("b").isNotNull())
        .groupBy("i", "b")
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    sizes = {(row["i"], row["b"]): row["n"] for row in counted}
    for i, s in enumerate(series):
        running = 0
        for b, edge in enumerate([*edges[i][:-1], math.inf]):
            size = sizes.get((i, b), 0)
            if edge in found[i] or math.isinf(edge):
                s.pivots[edge] = (running, running + size)
            running += size
        s.total = running


def _inside(
    values: DataFrame, series: list[_Series], intervals: list[_Interval]
) -> tuple[DataFrame, dict[tuple[int, int], _Interval]]:
    """``i, b, v``: the values inside the intervals, by column and bucket, in one pass.

    Beside them, which interval a column and bucket stand for.
    """
    columns = sorted({t.column for t in intervals})
    names = [series[i].name for i in columns]
    edges = [_edges({e for t in intervals if t.column == i for e in (t.low, t.high)}) for i in columns]
    slots, places = [], {}
    for i, name, cuts in zip(columns, names, edges):
        position = {edge: b for b, edge in enumerate(cuts)}
        inside = {}
        for t in intervals:
            if t.column == i:
                inside[position[math.nextafter(t.low, math.inf)]] = t
        places |= {(i, b): t for b, t in inside.items()}
        bucket = F.col(f"{name}_b").cast("int")
        slots.append(
            F.when(
                bucket.isin(list(inside)),
                F.struct(F.lit(i).alias("i"), bucket.alias("b"), F.col(name).alias("v")),
            )
        )
    inner = _bucketed(values, names, edges).select(F.inline(F.array_compact(F.array(*slots))))
    return inner, places


def _list_values(values: DataFrame, series: list[_Series], intervals: list[_Interval]) -> None:
    """Turn every value inside the (few, counted) rows of the intervals into a pivot."""
    inner, places = _inside(values, series, intervals)
    listed = (
        inner.groupBy("i", "b", "v")
        .agg(F.count(F.lit(1)).alias("n"))
        .toArrow()
        .sort_by([("i", "ascending"), ("b", "ascending"), ("v", "ascending")])
        .to_pydict()
    )
    running: dict[tuple[int, int], int] = {}
    for i, b, v, n in zip(*(listed[c] for c in "ibvn")):
        less = running.get((i, b), places[i, b].below)
        running[i, b] = less + n
        series[i].pivots[v] = (less, less + n)


def _sketch_inside(
    values: DataFrame, series: list[_Series], intervals: list[_Interval], wanted: list[list[int]]
) -> list[set[float]]:
    """Pivots inside the intervals, on both sides of the ranks wanted there.

    Every row is looked at once and enters one sketch for a column at most, so that the pass
    costs the same whatever the number of intervals.
    """
    inner, places = _inside(values, series, intervals)
    grid = [k / SKETCH_PARTS for k in range(SKETCH_PARTS + 1)]
    sketched = inner.groupBy("i", "b").agg(F.percentile_approx("v", grid, 20 * SKETCH_PARTS).alias("vs"))
    found: list[set[float]] = [set() for _ in series]
    for row in sketched.collect():
        t = places[row["i"], row["b"]]
        for rank in wanted[t.column]:
            if t.below < rank <= t.below + t.size:
                place = (rank - t.below) / t.size * SKETCH_PARTS
                near = (math.floor(place - 0.2), math.ceil(place + 0.2))
                found[t.column] |= {row["vs"][min(max(k, 0), SKETCH_PARTS)] for k in near}
    return found


def _around(share: float, error: float) -> list[float]:
    return [max(0.0, share - 2 * error), min(1.0, share + 2 * error)]


def order_statistics(
    df: DataFrame,
    columns: Sequence[Column],
    ranks: Callable[[int, int], Sequence[int]],
    shares: Sequence[float],
) -> list[list[OrderStatistic]]:
    """Exact values at given ranks (from 1) of each column; NULL and NaN have no rank.

    ``ranks(i, n)`` names the ranks wanted of column ``i`` once its count ``n`` is known;
    ``shares`` are the rough relative positions of these ranks, where the search begins.
    """
    series = [_Series(f"q{i}") for i in range(len(columns))]
    # Adding zero makes one value of the two signed zeros.
    values = df.select(
        *[(valid_number(c) + F.lit(0.0)).alias(s.name) for c, s in zip(columns, series)]
    )
    error = min(0.002, max(1e-4, 0.008 / len(shares)))
    start = sorted({p for share in shares for p in _around(share, error)})
    found = [set(vs) for vs in values.approxQuantile(values.columns, start, error)]
    _count_pivots(values, series, found)
    wanted = [list(ranks(i, s.total)) if s.total else [] for i, s in enumerate(series)]
    for s, own in zip(series, wanted):
        if not all(1 <= rank <= s.total for rank in own):
            raise ValueError(f"ranks {own} are not within 1..{s.total}")

    while True:
        places = [[s.locate(r, i) for r in own] for i, (s, own) in enumerate(zip(series, wanted))]
        intervals = list({p for own in places for p in own if isinstance(p, _Interval)})
        if not intervals:
            return places
        if sum(t.size for t in intervals) <= LISTED_VALUES:
            _list_values(values, series, intervals)
            continue
        found = _sketch_inside(values, series, intervals, wanted)
        _count_pivots(values, series, found)


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]
) -> list[list[float]]:
    """Smallest value whose share of values up to it reaches each probability."""
    found = order_statistics(
        df,
        [quoted(c) for c in columns],
        lambda i, n: [max(1, math.ceil(p * n)) for p in probabilities],
        probabilities,
    )
    return [[s.value for s in stats] for stats in found]


def interpolated_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]
) -> list[list[float]]:
    """Exact quantiles with linear interpolation between neighbouring values."""
    totals: dict[int, int] = {}

    def ranks(i: int, n: int) -> list[int]:
        totals[i] = n
        places = [p * (n - 1) for p in probabilities]
        return [r + 1 for place in places for r in (math.floor(place), math.ceil(place))]

    found = order_statistics(df, [quoted(c) for c in columns], ranks, probabilities)
    result = []
    for i, stats in enumerate(found):
        values = []
        for k, p in enumerate(probabilities if stats else []):
            place = p * (totals[i] - 1)
            low, high = stats[2 * k].value, stats[2 * k + 1].value
            values.append(low + (high - low) * (place - math.floor(place)))
        result.append(values)
    return result


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    relative_error: float = 0.01,
) -> list[list[float]]:
    """Quantiles of all columns together; ``relative_error=0`` asks for exact ones.

    A column without values gives an empty list.
    """
    if relative_error > 0:
        named = df.select(*[quoted(c).alias(f"q{i}") for i, c in enumerate(columns)])
        return named.approxQuantile(named.columns, list(probabilities), relative_error)
    return exact_quantiles(df, columns, probabilities)
