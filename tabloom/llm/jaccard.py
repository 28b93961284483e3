"""Exact Jaccard join of documents by their word shingles, in metric regions.

The distance 1 - Jaccard is a metric, and so is the number of shingles in which two sets
differ. The join goes down through three kinds of pivots:

1. The empty set: it orders documents by size. Sizes are cut into cells, and a set whose
   partners may lie in the cell below is copied there (the triangle inequality on sizes).
2. Slices of the shingle universe: in a cell, linked sets differ in at most D shingles. Shingles
   are dealt to more than D slices, and two linked sets agree in all but D. What a set has
   in a slice is the pivot of a region; the set goes to the regions of all its slices. Documents
   as pivots cannot cut here: unrelated texts stand at distance 1 from every pivot, so the
   window of any pivot would hold them all (measured in the README).
3. Documents: in a region, the member that meets most others is the pivot. Members within the
   threshold of it are one class, whatever their number, and need not be compared with each
   other. Regions where many stay outside take another pivot.
4. Documents as centres of cells, where regions still hold more than one class: some members are
   pivots, every member goes to the cell of its nearest one, and to each cell whose pivot is
   farther by no more than twice the number of shingles in which it can differ from a linked set.
   By the triangle inequality two linked sets meet in the nearest cell of either. Cells are cut
   again until they hold one class, or so few members that all of them are compared. Distances are
   those of the parities of shingles in 2048 slots, a metric in which no two sets are farther
   apart than in shingles, so that this needs no sets.
5. Shingles again, for cells that pivots do not cut since their members are all as far from each
   other as from any pivot: their sets are joined by the shingles that are rarest among them, and
   the place of the first common one bounds how far apart the two are. Edited copies hold rare
   shingles of their own first, so they are told apart without comparing them.

So copies, however many, cost one comparison each. Regions of the same members are one region, and
before two sets are compared, their parities are, in more slots where the sets are large. Nothing is dropped: the classes are the connected
components of all links.

Sets are kept as 64-bit hashes of shingles and documents of equal sets are one class from the
start. Defined results: a document without words has an empty set and is linked with nothing;
with fewer words than a shingle, all its words are its one shingle; a null text counts as
empty; rows are one document each, whatever their ids, and are linked by their own texts.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm import text as T
from tabloom.llm.graph import components
from tabloom.workspace import scratch, stage, stage_bucketed

_SEEDS = 8
# Slots of parities; sets of up to twice as many shingles are told apart well.
SLOTS = 2048
# Most slices in which shingles are counted and met, and shingles for which another one is taken.
SLICES, SLICE_SHINGLES = 4, 1 << 22
# Parts in which texts are dealt by key, one after another.
TEXT_PARTS = 2


def shingle_sets(column: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text, words lower-cased in A-Z."""
    words, offsets = T.words_of(column, lower=True)
    runs = T.rolling(words, width)
    out = []
    for begin, end in zip(offsets[:-1], offsets[1:]):
        if end - begin >= width:
            out.append(np.unique(runs[begin : end - width + 1]))
        elif end > begin:
            out.append(T.rolling(words[begin:end], end - begin) ^ np.uint64(end - begin))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _cells(percent: int, most: int) -> np.ndarray:
    """Least sizes of the cells: sizes that can be linked lie in one cell or in neighbours."""
    lows = [1]
    while lows[-1] <= most:
        # Wider than the ratio of linked sizes, so that only neighbouring cells meet.
        lows.append(max(lows[-1] + 1, -(-lows[-1] * 10000 // percent**2)))
    return np.array(lows, np.int64)


def _differ(top: int, percent: int) -> int:
    """Most shingles in which a set of at most ``top`` differs from a linked set."""
    return top * (100 - percent) // percent


def _spare(low: int, differ: int) -> int:
    """Slices beyond those that can differ: more than are empty in most sets of the cell."""
    spare = 1
    while 2 * (differ + 1 + spare) * np.exp(-low / (differ + 1 + spare)) > spare:
        spare += 1
        if spare > differ:
            break
    return spare


def _keys(s: np.ndarray) -> tuple[int, int]:
    return int(T.mix(s).sum(dtype=np.uint64)), int(
        T.mix(s ^ np.uint64(0xD1B54A32D192ED03)).sum(dtype=np.uint64)
    )


def _regions(s: np.ndarray, cells: np.ndarray, percent: int) -> np.ndarray:
    """The regions of a set: one per slice, for its cell and, in the window, the cell below."""
    n, out = len(s), []
    home = int(np.searchsorted(cells, n, "right")) - 1
    for cell in (home, home - 1):
        if cell < 0:
            continue
        top = int(cells[cell + 1]) - 1
        if cell < home and n * percent > top * 100:
            continue
        differ = _differ(top, percent)
        spare = _spare(int(cells[cell]), differ) if differ else 0
        slices = differ + 1 + spare
        for seed in range(_SEEDS):
            mixed = T.mix(s ^ np.uint64(0xA0761D6478BD642F * (seed + 1) % 2**64))
            which = (mixed >> np.uint64(33)) % np.uint64(slices)
            code = T.mix(mixed)
            halves = [
                np.bincount(which.astype(np.int64), (code >> np.uint64(k)) & np.uint64(0xFFFFFFFF), slices)
                for k in (0, 32)
            ]
            held = np.bincount(which.astype(np.int64), minlength=slices) > 0
            sums = halves[0].astype(np.uint64) + (halves[1].astype(np.uint64) << np.uint64(32))
            tag = np.uint64((cell * _SEEDS + seed) << 32) + np.arange(slices, dtype=np.uint64)
            regions = T.mix(sums + T.mix(tag + np.uint64(1)))
            empty = slices - int(held.sum())
            out.append(regions[held])
            # More slices agree than there are spare ones. If all those may be empty, deal anew.
            if empty <= spare:
                break
        else:
            out.append(regions[~held])
    return np.unique(np.concatenate(out))


def _linked(shared: Column, a: Column, b: Column, percent: int) -> Column:
    return shared * 100 >= (a + b - shared) * percent


def parities(s: np.ndarray, n: int = SLOTS) -> np.ndarray:
    """Whether the number of shingles in each of ``n`` slots is odd, as bits."""
    slots = np.bincount((T.mix(s) % np.uint64(n)).astype(np.int64), minlength=n) & 1
    return np.packbits(slots.astype(np.uint8)).view(np.int64)


def _finer_slots(s: np.ndarray) -> int:
    """Slots of a large set: a power of two that grows with it; 0 for others."""
    return 1 << int(len(s) - 1).bit_length() if len(s) > SLOTS else 0


def _parted(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` with ``n`` of a, how many parities differ (``apart``), and ``near``.

    Pairs that are not near differ in size or parities more than linked sets can.
    """
    held = F.struct("n", "parities")
    marked = pairs.join(sets.select(F.col("key").alias("a"), held.alias("_a")), "a").join(
        sets.select(F.col("key").alias("b"), held.alias("_b")), "b"
    )
    apart = sum(
        F.bit_count(F.col("_a.parities")[i].bitwiseXOR(F.col("_b.parities")[i])) for i in range(SLOTS // 64)
    )
    # Of linked sets at least percent / (100 + percent) of both sizes is shared, on either side.
    most = (F.col("_a.n") + F.col("_b.n")) * (100 - percent)
    low, high = F.least("_a.n", "_b.n"), F.greatest("_a.n", "_b.n")
    near = (apart * (100 + percent) <= most) & (low * 100 >= high * percent)
    return marked.select("a", "b", F.col("_a.n").alias("n"), apart.alias("apart"), near.alias("near"))


def _finer(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs but for large sets whose finer parities differ more than those of linked ones can.

    Where one has twice the slots of the other, its parities in half as many are compared.
    """
    held = F.struct("n", "fine", "half")
    marked = pairs.join(sets.select(F.col("key").alias("a"), held.alias("_a")), "a").join(
        sets.select(F.col("key").alias("b"), held.alias("_b")), "b"
    )
    one, two = F.size("_a.fine"), F.size("_b.fine")
    x = F.when(one <= two, F.col("_a.fine")).otherwise(F.col("_a.half"))
    y = F.when(two <= one, F.col("_b.fine")).otherwise(F.col("_b.half"))
    differ = F.zip_with(x, y, lambda i, j: F.bit_count(i.bitwiseXOR(j)))
    apart = F.aggregate(differ, F.lit(0), lambda total, i: total + i)
    most = (F.col("_a.n") + F.col("_b.n")) * (100 - percent)
    large = (one > 0) & (two > 0) & (F.greatest(one, two) <= F.least(one, two) * 2)
    near = F.when(large, apart * (100 + percent) <= most).otherwise(F.lit(True))
    return marked.filter(near).select("a", "b")


def _shared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The linked ones of distinct key pairs ``(a, b)``, by their whole sets."""
    pairs = stage(_finer(pairs, sets, percent), "pairs")
    left = sets.select(F.col("key").alias("a"), F.col("shingles").alias("_a"))
    right = sets.select(F.col("key").alias("b"), F.col("shingles").alias("_b"))
    shared = F.size(F.array_intersect("_a", "_b"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .select("a", "b", shared.alias("_shared"), F.size("_a").alias("_n"), F.size("_b").alias("_m"))
        .filter(_linked(F.col("_shared"), F.col("_n"), F.col("_m"), percent))
        .select("a", "b")
    )


def _compare(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The linked ones of distinct key pairs ``(a, b)``, parities first."""
    near = stage(_parted(pairs, sets, percent).filter("near").select("a", "b"), "near")
    return near if near.isEmpty() else _shared(near, sets, percent)


def _added(
    links: DataFrame | None, found: DataFrame, reached: DataFrame | None
) -> tuple[DataFrame, DataFrame]:
    """Links with what was ``found``, and their components: those ``reached`` if nothing was."""
    found = stage(found, "found")
    if links is not None and found.isEmpty():
        return links, reached
    links = found if links is None else links.union(found)
    return links, components(links)


def _rare(keys: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """First shingles of sets in order of rarity among ``keys(key, component)``.

    Of two linked sets the first common shingle stands among the first n - ceil(t n) + 1 of each.
    Those that no other set of ``keys`` holds meet nothing; they are the rarest, so that only their
    number matters, and only the others are shuffled by set.
    """
    with scratch() as keep:
        return keep(_rarest(keys, sets, percent), "rare")


def _rarest(keys: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    distinct = keys.select("key").distinct()
    total = distinct.join(sets.select("key", "n"), "key").agg(F.sum("n")).head()[0] or 0
    held = distinct.join(sets.select("key", "shingles"), "key")
    held = held.select("key", F.explode("shingles").alias("shingle"))
    # The universe of shingles is gone through in slices, so that one slice at a time is shuffled.
    slices, parts = min(SLICES, total // SLICE_SHINGLES + 1), []
    for i in range(slices):
        part = held.filter(F.pmod("shingle", F.lit(slices)) == i)
        counts = part.groupBy("shingle").agg(F.count(F.lit(1)).alias("_df")).filter("_df > 1")
        met = part.join(stage(counts, "common"), "shingle").select("key", "shingle", "_df")
        parts.append(stage(met, "common-of-sets"))
    common = reduce(DataFrame.union, parts)
    own = Window.partitionBy("key")
    order = own.orderBy("_df", "shingle")
    last = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    alone = F.col("n") - F.count(F.lit(1)).over(own)
    sizes = keys.join(sets.select("key", "n"), "key").select("key", "component", "n")
    return (
        common.join(sizes, "key")
        .withColumn("place", F.row_number().over(order) + alone)
        .filter(F.col("place") <= last)
        .select("key", "component", "n", "shingle", "place")
    )


def link_classes(
    docs: DataFrame,
    width: int = 3,
    percent: int = 90,
    leaf: int = 32,
    longest: int = 1 << 40,
) -> DataFrame:
    """Per document ``doc_id, n_shingles, component_id``.

    ``component_id`` is the least id reachable by links of Jaccard similarity of at least
    ``percent`` / 100, null if no row with an id is. ``leaf``: members outside the class of a region's pivot for which another
    pivot is tried, a few times, each time for four times as many.
    """
    cells = _cells(percent, longest)
    # Rows that share an id are told apart by their texts, and so are rows without one.
    row = F.xxhash64(docs["doc_id"], docs["text"])
    texts = docs.select("doc_id", "text", row.alias("row"))

    def numbered(batches):
        for batch in T.pieces(batches):
            found = shingle_sets(batch.column(1), width)
            keys = np.array([_keys(s) for s in found], np.uint64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in found], pa.int64()),
                    T.signed(keys[:, 0].copy()),
                    T.signed(keys[:, 1].copy()),
                    batch.column(2),
                ],
                ["doc_id", "n_shingles", "key", "key2", "row"],
            )

    def regions(batches):
        for batch in T.pieces(batches, "text"):
            seen, out, keys = set(), [], []
            for s in shingle_sets(batch.column(1), width):
                if len(s) and (key := _keys(s)[0]) not in seen:
                    seen.add(key)
                    out.append(_regions(s, cells, percent))
                    keys.append(np.full(len(out[-1]), key, np.uint64))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [T.signed(np.concatenate(out)), T.signed(np.concatenate(keys))],
                    ["region", "key"],
                )

    def sets_of(batches):
        for batch in T.pieces(batches):
            found = shingle_sets(batch.column(0), width)
            keys = np.array([_keys(s)[0] for s in found], np.uint64)
            ends = np.concatenate([[0], np.cumsum([len(s) for s in found])]).astype(np.int32)
            held = np.concatenate([np.zeros(0, np.uint64), *found])
            odd = np.concatenate([np.zeros(0, np.int64), *[parities(s) for s in found]])
            numbers = pa.list_(pa.int64())
            of_set = pa.array(np.arange(len(found) + 1, dtype=np.int32) * (SLOTS // 64))
            yield pa.RecordBatch.from_arrays(
                [
                    T.signed(keys),
                    pa.array([len(s) for s in found], pa.int32()),
                    pa.ListArray.from_arrays(of_set, pa.array(odd)),
                    pa.array([parities(s, m) if (m := _finer_slots(s)) else [] for s in found], numbers),
                    pa.array([parities(s, m // 2) if (m := _finer_slots(s)) else [] for s in found], numbers),
                    pa.ListArray.from_arrays(pa.array(ends), T.signed(held)),
                ],
                ["key", "n", "parities", "fine", "half", "shingles"],
            )

    with scratch() as keep_classes:
        known = stage(
            texts.mapInArrow(numbered, "doc_id long, n_shingles long, key long, key2 long, row long"),
            "sets",
        )
        classes = (
            known.filter("n_shingles > 0")
            .groupBy("key", "key2", "n_shingles")
            .agg(F.min("doc_id").alias("first"), F.min("row").alias("row"))
        )
        placed = texts.mapInArrow(regions, "region long, key long")
        with scratch() as keep:
            shared = stage(
                placed.groupBy("region")
                .agg(F.min("key").alias("_first"), F.max("key").alias("_last"))
                .filter("_first != _last")
                .select("region"),
                "shared",
            )
            members = stage(placed.join(shared, "region").distinct(), "regions")
            # Of regions with the same members one is enough: near copies share most of theirs.
            sign = [F.bit_xor(F.xxhash64("key", F.lit(i))).alias(f"_{i}") for i in (0, 1)]
            signed = members.groupBy("region").agg(F.count(F.lit(1)).alias("_n"), *sign)
            kept = signed.groupBy("_n", "_0", "_1").agg(F.min("region").alias("region")).select("region")
            members = keep(members.join(kept, "region", "left_semi"), "different-regions")
        wanted = members.select("key").distinct()
        # One row for each key; the key is taken from the row's own text again. Texts are dealt by key
        # and not their sets, which are several times as large.
        firsts = classes.join(wanted, "key").groupBy("key").agg(F.min("row").alias("row"))
        # Sets are joined by key time and again; dealt by it, they are not shuffled for that.
        buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        # Texts go in parts by their rows, of which each key has one, so that one part is shuffled at a time.
        dealt = [
            texts.select("text", "row")
            .filter(F.pmod("row", F.lit(TEXT_PARTS)) == i)
            .join(firsts.filter(F.pmod("row", F.lit(TEXT_PARTS)) == i), "row")
            .select("key", "text")
            .repartition(buckets, "key")
            .dropDuplicates(["key"])
            .select("text")
            .mapInArrow(
                sets_of,
                "key long, n int, parities array<long>, fine array<long>, half array<long>, "
                "shingles array<long>",
            )
            for i in range(TEXT_PARTS)
        ]
        sets = stage_bucketed(dealt[0], "shingles", "key", buckets, "key", dealt=True, more=dealt[1:])

        # From keys of sets to documents: classes of equal sets are linked by their least document.
        reached = _join(members, sets, percent, leaf)
        of_key = (
            classes.join(reached, classes["key"] == reached["node"], "left")
            .select("first", "key", "key2", "n_shingles", F.coalesce("component", "key").alias("_class"))
        )
        least = of_key.groupBy("_class").agg(F.min("first").alias("component_id"))
        named = of_key.join(least, "_class").select("key", "key2", "n_shingles", "component_id")
        return keep_classes(
            known.join(named, ["key", "key2", "n_shingles"], "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")),
            "classes",
        )


def _central(members: DataFrame) -> DataFrame:
    """``(region, key, pivot)``: the pivot is the member that meets most others anywhere.

    In a family of edited copies that is the one with the fewest edits, so that most of the
    others lie within the threshold of it.
    """
    sizes = members.groupBy("region").agg(F.count(F.lit(1)).alias("_size"))
    weights = (
        members.join(sizes.filter("_size > 1"), "region")
        .groupBy("key")
        .agg(F.sum("_size").alias("_weight"))
    )
    weighed = members.join(weights, "key")
    pivots = weighed.groupBy("region").agg(F.max_by("key", F.struct("_weight", "key")).alias("pivot"))
    return members.join(pivots, "region").select("region", "key", "pivot")


def _open(placed: DataFrame, reached: DataFrame) -> DataFrame:
    """``placed`` with components, where a region holds more than one besides its pivot's row."""
    named = placed.join(
        reached.withColumnRenamed("node", "key"), "key", "left"
    ).withColumn("component", F.coalesce("component", "key"))
    several = (
        named.filter("key != pivot")
        .groupBy("region")
        .agg(F.min("component").alias("_low"), F.max("component").alias("_high"))
        .filter("_low != _high")
        .select("region")
    )
    return named.join(several, "region")


def _join(members: DataFrame, sets: DataFrame, percent: int, leaf: int) -> DataFrame:
    """``(node, component)`` of every key that is linked, by links whose components are those of all."""
    links = first = reached = None
    while True:
        placed = stage(_central(members), "pivots")
        first = placed if first is None else first
        pairs = placed.filter("key != pivot").select(
            F.col("key").alias("a"), F.col("pivot").alias("b")
        )
        known = reached
        links, reached = _added(links, _compare(pairs.distinct(), sets, percent), reached)
        if reached is known:
            # Pivots that link nothing in any region leave the rest to the cells.
            break
        left = _open(placed, reached)
        # Once more with new pivots where many classes could still be balls around a document.
        own = left.filter("key = pivot").select("region", F.col("component").alias("_own"))
        others = left.join(own, "region").filter("component != _own").select("region", "key")
        many = others.groupBy("region").agg(F.count(F.lit(1)).alias("_n"))
        members = stage(
            others.join(many.filter(F.col("_n") > leaf).select("region"), "region"), "others"
        )
        if members.isEmpty():
            break
        leaf *= 4
    cells = _open(first, reached).select(F.col("region").alias("cell"), "key", "component")
    links, reached, keys = _in_cells(stage(cells, "cells"), links, reached, sets, percent)
    rare = _rare(keys, sets, percent)
    a, b = (
        rare.select("shingle", *[F.col(c).alias(f"{c}_{x}") for c in ("key", "component", "n", "place")])
        for x in "ab"
    )
    # The rest after the first common shingle has to hold all that linked sets share.
    most = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b")) + 1
    fits = most * (100 + percent) >= (F.col("n_a") + F.col("n_b")) * percent
    pairs = a.join(
        b,
        (a["shingle"] == b["shingle"])
        & (F.col("key_a") < F.col("key_b"))
        & (F.col("component_a") != F.col("component_b"))
        & fits,
    ).select(F.col("key_a").alias("a"), F.col("key_b").alias("b"))
    return _added(links, _compare(pairs.distinct(), sets, percent), reached)[1]


# Pivots of a cell, members of a cell that are all compared, and cuts before shingles are tried.
PIVOTS, FEW, CUTS = 6, 6, 2
# Pivots by which a cell is tried before all its members meet all pivots.
TRIED = 3


def _homes(met: DataFrame, distances: DataFrame, percent: int) -> DataFrame:
    """``cell, _size, key, component``, and as ``_homes`` the pivots where linked sets can be near.

    ``met`` has a row for each pivot that ``key`` is compared with, ``distances`` their distances.
    """
    spans = (
        met.join(distances.withColumnsRenamed({"a": "key", "b": "pivot"}), ["key", "pivot"])
        .groupBy("cell", "_size", "key", "component")
        .agg(
            F.collect_list(F.struct("apart", "pivot")).alias("_to"),
            F.max("n").alias("n"),
            F.min("apart").alias("_nearest"),
        )
    )
    reach = F.floor(F.col("n") * (100 - percent) / percent) * 2 + F.col("_nearest")
    return spans.select(
        "cell", "_size", "key", "component", F.filter("_to", lambda p: p["apart"] <= reach).alias("_homes")
    )


def _distances(met: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    pairs = met.select(F.col("key").alias("a"), F.col("pivot").alias("b")).distinct()
    return stage(_parted(pairs, sets, percent), "distances")


def _in_cells(
    cells: DataFrame, links: DataFrame, reached: DataFrame, sets: DataFrame, percent: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links found by cutting ``cells(cell, key, component)``, components, and the keys not cut."""
    rest = [cells.select("key", "component").limit(0)]
    for _ in range(CUTS):
        sizes = cells.groupBy("cell").agg(
            F.count(F.lit(1)).alias("_size"),
            F.min("component").alias("_low"),
            F.max("component").alias("_high"),
        )
        open_ = cells.join(sizes.filter("_low != _high").select("cell", "_size"), "cell")
        cells = stage(open_, "open-cells")
        if cells.isEmpty():
            break
        # All pairs of a few.
        a, b = (
            cells.filter(F.col("_size") <= FEW).select(
                "cell", F.col("key").alias(x), F.col("component").alias(f"_{x}")
            )
            for x in "ab"
        )
        pairs = a.join(b, "cell").filter("a < b and _a != _b").select("a", "b").distinct()
        found = _compare(pairs, sets, percent)
        # Some pivots try the others first. Where they would go to most of them, so would the members:
        # the cell is not cut, and need not meet its pivots for that.
        large = cells.filter(F.col("_size") > FEW)
        drawn = Window.partitionBy("cell").orderBy(F.xxhash64("cell", "key"))
        ranked = large.withColumn("_turn", F.row_number().over(drawn))
        pivots = stage(ranked.filter(F.col("_turn") <= PIVOTS), "cell-pivots")
        chosen = pivots.select("cell", F.col("key").alias("pivot"), F.col("component").alias("_other"))
        tried = pivots.filter(F.col("_turn") <= TRIED).join(chosen, "cell").filter("key != pivot")
        homes = _homes(tried, _distances(tried, sets, percent), percent)
        homes = homes.groupBy("cell").agg(F.avg(F.size("_homes")).alias("_mean"))
        blunt = stage(homes.filter("_mean > 2").select("cell"), "blunt")
        rest.append(cells.join(blunt, "cell").select("key", "component"))
        # Nearest pivots, and those that are little farther.
        large = large.join(blunt, "cell", "left_anti")
        met = stage(large.join(chosen, "cell").filter("key != pivot"), "met")
        if met.isEmpty():
            links, reached = _added(links, found, reached)
            cells = cells.limit(0)
            break
        distances = _distances(met, sets, percent)
        # What is in one class needs no link.
        apart = met.filter("component != _other")
        apart = apart.select(F.col("key").alias("a"), F.col("pivot").alias("b")).distinct()
        close = stage(distances.filter("near").join(apart, ["a", "b"]).select("a", "b"), "close")
        links, reached = _added(links, found.union(_shared(close, sets, percent)), reached)
        spans = _homes(met, distances, percent)
        cut = stage(
            spans.select("cell", "_size", "key", "component", F.explode("_homes").alias("_home")).select(
                "cell",
                "_size",
                F.xxhash64("cell", "_home.pivot").alias("_inner"),
                "key",
                "component",
            ),
            "cut-cells",
        )
        # A cell of which one part holds nearly all is not cut by pivots.
        parts = cut.groupBy("cell", "_size", "_inner").agg(F.count(F.lit(1)).alias("_n"))
        parts = parts.groupBy("cell", "_size").agg(F.max("_n").alias("_most"), F.sum("_n").alias("_sum"))
        whole = (F.col("_most") * 10 > F.col("_size") * 8) | (F.col("_sum") > F.col("_size") * 2)
        stuck = stage(parts.filter(whole).select("cell"), "stuck")
        rest.append(cells.join(stuck, "cell").select("key", "component"))
        named = cut.join(stuck, "cell", "left_anti").select(F.col("_inner").alias("cell"), "key", "component")
        cells = _renamed(named, reached)
    rest.append(cells.select("key", "component"))
    keys = reduce(DataFrame.union, rest)
    return links, reached, stage(_renamed(keys, reached).distinct(), "open")


def _renamed(rows: DataFrame, reached: DataFrame) -> DataFrame:
    """Rows with the components that their keys have now."""
    now = reached.select(F.col("node").alias("key"), F.col("component").alias("_now"))
    named = rows.join(now, "key", "left").withColumn("component", F.coalesce("_now", "component"))
    return named.drop("_now")
