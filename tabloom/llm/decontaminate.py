"""Benchmark passages in documents, by SimHash over item-sized windows.

A document's windows are as long as the item they are held against. Where a document shares a
word shingle with an item, the window that lines the two up is fingerprinted (windows without a
common shingle have similarity 0, so none is missed). Fingerprints of 64 bits are looked up in
an index of the items with four blocks of 16 bits: of two fingerprints that differ in at most
``radius`` bits, some block differs in at most radius / 4, and the index lists every item
under all such values of each block. What is within the radius is verified by the weighted
Jaccard similarity of the shingles, weights being their counts. Similar texts at 0.8 differ in
9.7 bits on average with a deviation of 2.9, so the radius of 19 is more than three deviations
away.

DataFrame operations only. The index grows with the benchmark; the shingles of the benchmark
are broadcast if they are few, by count, and joined by shuffle otherwise.

Defined results: null or empty texts hold nothing; items with fewer words than a shingle match
nothing; documents shorter than an item are one window; rows repeated with the same id are one
document, as are items; null ids are an id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.mixing import WORD
from tabloom.workspace import stage

BLOCKS, BLOCK_BITS = 4, 16
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Shingles of the benchmark, 24 bytes each, up to which they are broadcast.
MOST_BROADCAST = 1_000_000


def words(text: Column) -> Column:
    """All words, A-Z in lower case."""
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def shingles(held: Column, width: int) -> Column:
    """Hashes of all shingles of an array of words, in order; none if there are too few words."""
    return F.when(
        F.size(held) >= width,
        F.transform(
            F.sequence(F.lit(0), F.size(held) - width),
            lambda i: F.xxhash64(*[F.get(held, i + k) for k in range(width)]),
        ),
    ).otherwise(F.array().cast("array<long>"))


def simhash(hashes: Column) -> Column:
    """64 bits, each the majority of the shingles' bits."""

    def bit(b: Column) -> Column:
        ones = F.aggregate(
            hashes,
            F.lit(0).cast("long"),
            lambda s, h: s + F.call_function("shiftrightunsigned", h, b).bitwiseAND(F.lit(1)),
        )
        one = F.call_function("shiftleft", F.lit(1).cast("long"), b)
        return F.when(ones * 2 > F.size(hashes), one).otherwise(F.lit(0).cast("long"))

    return F.aggregate(
        F.sequence(F.lit(0), F.lit(63)),
        F.lit(0).cast("long"),
        lambda held, b: held.bitwiseOR(bit(b)),
    )


def similarity(a: Column, b: Column) -> Column:
    """Weighted Jaccard similarity of two arrays, weights being counts."""

    def count(held, h):
        return F.size(F.filter(held, lambda x: x == h))

    shared = F.aggregate(
        F.array_intersect(a, b),
        F.lit(0),
        lambda s, h: s + F.least(count(a, h), count(b, h)),
    )
    return shared / (F.size(a) + F.size(b) - shared)


def _block(fingerprint: Column, i: int) -> Column:
    return F.shiftrightunsigned(fingerprint, i * BLOCK_BITS).bitwiseAND(
        F.lit((1 << BLOCK_BITS) - 1)
    )


def _blocks(fingerprint: Column, masks: Column) -> Column:
    """Array of (block, value): every block under all values that differ by one of ``masks``."""
    return F.concat(
        *[_masked(masks, i, _block(fingerprint, i)) for i in range(BLOCKS)]
    )


def _masked(masks: Column, i: int, value: Column) -> Column:
    return F.transform(
        masks,
        lambda m: F.struct(F.lit(i).alias("block"), value.bitwiseXOR(m).alias("value")),
    )


def find_items(
    docs: DataFrame,
    items: DataFrame,
    width: int = 5,
    threshold: float = 0.8,
    radius: int = 19,
) -> DataFrame:
    """``(doc_id, item_id, similarity, n_words)``: documents that hold a passage like an item.

    ``similarity`` is that of the best window; ``n_words`` its length.
    """
    known = stage(
        items.select("item_id", words(F.col("text")).alias("_words"))
        .select("item_id", F.size("_words").alias("length"), shingles(F.col("_words"), width).alias("_item"))
        .filter(F.size("_item") > 0)
        .dropDuplicates(["item_id", "_item"])
        .withColumn("_print", simhash(F.col("_item"))),
        "items",
    )
    anchors = (
        known.select("length", F.posexplode("_item").alias("_offset", "_shingle"))
        .distinct()
    )
    anchors = stage(anchors, "anchors")
    if anchors.count() <= MOST_BROADCAST:
        anchors = F.broadcast(anchors)
    row = F.xxhash64("doc_id", "text")
    texts = docs.select("doc_id", row.alias("_row"), words(F.col("text")).alias("_words"))
    # Shingles go alone, without the words they are of; the few that are met come back to them.
    placed = texts.select(
        "_row",
        F.size("_words").alias("_size"),
        F.posexplode(shingles(F.col("_words"), width)).alias("_at", "_shingle"),
    )
    start = F.least(F.col("_at") - F.col("_offset"), F.col("_size") - F.col("length"))
    spots = stage(
        placed.join(anchors, "_shingle")
        .select("_row", F.struct("length", F.greatest(F.lit(0), start).alias("start")).alias("_spot"))
        .distinct(),
        "spots",
    )
    of_row = stage(spots.groupBy("_row").agg(F.collect_list("_spot").alias("_spots")), "spots-of-rows")
    hits = (
        texts.join(of_row, "_row")
        .select("doc_id", "_words", F.explode("_spots").alias("_spot"))
        .select(
            "doc_id",
            F.col("_spot.length").alias("length"),
            F.slice("_words", F.col("_spot.start") + 1, F.col("_spot.length")).alias("_window"),
        )
        .distinct()
    )
    windows = stage(
        hits.select("doc_id", "length", shingles(F.col("_window"), width).alias("_held"))
        .distinct()
        .withColumn("_print", simhash(F.col("_held"))),
        "windows",
    )
    masks = F.filter(
        F.sequence(F.lit(0).cast("long"), F.lit((1 << BLOCK_BITS) - 1).cast("long")),
        lambda m: F.bit_count(m) <= radius // BLOCKS,
    )
    # Written, so that its size is known where it is joined.
    index = stage(
        known.select(
            "item_id", "length", F.explode(_blocks(F.col("_print"), masks)).alias("_b")
        ).select("item_id", "length", "_b.block", "_b.value"),
        "index",
    )
    exact = F.array(F.lit(0).cast("long"))
    candidates = (
        windows.select(
            "doc_id", "length", "_held", "_print", F.explode(_blocks(F.col("_print"), exact)).alias("_b")
        )
        .select("doc_id", "length", "_held", "_print", "_b.block", "_b.value")
        .join(index, ["length", "block", "value"])
        .select("doc_id", "item_id", "length", "_held", "_print")
        .distinct()
    )
    return (
        candidates.join(known.select("item_id", "length", "_item", F.col("_print").alias("_of_item")), ["item_id", "length"])
        .filter(F.bit_count(F.col("_print").bitwiseXOR(F.col("_of_item"))) <= radius)
        .withColumn("similarity", similarity(F.col("_held"), F.col("_item")))
        .filter(F.col("similarity") >= threshold)
        .groupBy("doc_id", "item_id")
        .agg(F.max("similarity").alias("similarity"), F.max("length").alias("n_words"))
    )



def without_items(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that hold no passage like an item, with all their columns.

    Every row is judged by its own text, whatever other rows share its id.
    """
    row = F.xxhash64(docs["doc_id"], docs["text"])
    keyed = docs.select(row.alias("doc_id"), docs["text"])
    held = stage(find_items(keyed, items, **options).select("doc_id").distinct(), "leaks")
    return docs.join(held.withColumnRenamed("doc_id", "_held_row"), row == F.col("_held_row"), "left_anti")
