"""Mix sources to target weights by highest quotients over equal-token blocks.

The text of a source is dealt to shards by a hash of the document, and the documents of a
shard stand in seeded order, end to end, as one stream of tokens cut into blocks of equal
length. Sainte-Laguë apportionment gives every source, then every shard of it, an integer
number of blocks. A shard takes all its blocks as often as they go whole into its quota, and
the rest as one run of blocks in the seeded order, from a seeded start.

Everything is DataFrame operations. Per source and per shard there are sums only; the one
window over documents is inside a shard, whose length is a parameter, so a hot source is split.

Defined results: a null text has size 0 and takes nothing; an empty table gives no rows; a
null source is a source of its own, after all others; rows repeated with the same id are rows
of their own and are all counted. If all texts are empty, targets are 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
) -> DataFrame:
    """Targets of sources ``(source, source_size)``: adds ``target``.

    Weights repeat over the sources in code point order, null last. Targets share ``share``
    times all sizes by weight. One above ``most`` times its source's size stops there and the
    excess goes to the others by weight, until none is above: sorted by bound over weight, the
    stopped ones come first, so running sums find the level at which the rest stands.
    """
    if not 0 <= share <= most:
        raise ValueError("share must be between 0 and most")
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    listed = F.array(*[F.lit(float(w)) for w in weights])
    place = (F.row_number().over(by_name) - 1) % len(weights)
    rows = sizes.withColumn("_weight", F.get(listed, place)).withColumn(
        "_bound", F.col("source_size") * F.lit(float(most))
    )
    # Row by row in this order: what those before it are bound to, and the weights from it on.
    rising = Window.orderBy(F.col("_bound") / F.col("_weight"), F.col("source").asc_nulls_last())
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    onward = rising.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy().rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    left = F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(
        F.sum("_bound").over(before), F.lit(0.0)
    )
    rows = rows.withColumn("_level", left / F.sum("_weight").over(onward))
    stops = F.col("_bound") <= F.col("_level") * F.col("_weight")
    # The first row that does not stop sets the level of all that follow.
    level = F.min(F.when(~stops, F.struct(F.col("_bound") / F.col("_weight"), F.col("_level"))))
    rows = rows.withColumn("_stand", level.over(everything)["_level"])
    target = F.when(stops, F.col("_bound")).otherwise(F.col("_stand") * F.col("_weight"))
    return rows.select("source", "source_size", target.alias("target"))


def apportion(
    parts: DataFrame, claim: str, seats: str, within: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Sainte-Laguë: adds ``quota``, how many of ``seats`` each row wins in its group ``within``.

    Seat k (from 0) of a row has the quotient claim / (k + 1/2); the ``seats`` highest of the
    group win, ties to the first by ``order``. With n rows and claims summing to P, the lowest
    winning quotient lies between P / (seats + n/2) and P / (seats - n/2): seats above that
    range are won, seats below are lost, and only the few inside it, about 2n in all, are listed
    and ranked. So the work follows the number of rows, not the number of seats.
    """
    group = Window.partitionBy(*within)
    rows = (
        parts.withColumn("_sum", F.sum(claim).over(group))
        .withColumn("_half", F.count(F.lit(1)).over(group) / 2 + 1)
        .withColumn("_claim", F.col(claim).cast("double"))
    )
    none = (F.col("_sum") <= 0) | (F.col(seats) <= 0) | (F.col("_claim") <= 0)
    per_seat = F.col("_claim") / F.col("_sum")
    sure = F.floor(per_seat * F.greatest(F.col(seats) - F.col("_half"), F.lit(0.0)) + 0.5)
    at_most = F.floor(per_seat * (F.col(seats) + F.col("_half")) + 0.5)
    rows = rows.withColumn("_sure", F.when(none, 0).otherwise(sure).cast("long")).withColumn(
        "_most", F.when(none, 0).otherwise(at_most).cast("long")
    )
    rows = rows.withColumn("_open", F.col(seats) - F.sum("_sure").over(group))
    tried = F.when(
        F.col("_most") > F.col("_sure"), F.sequence(F.col("_sure"), F.col("_most") - 1)
    )
    listed = rows.withColumn("_seat", F.explode_outer(tried))
    quotient = F.col("_claim") / (F.col("_seat") + 0.5)
    best_first = Window.partitionBy(*within).orderBy(
        quotient.desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in order], F.col("_seat")
    )
    wins = F.col("_seat").isNotNull() & (F.row_number().over(best_first) <= F.col("_open"))
    kept = [c for c in parts.columns]
    return (
        listed.withColumn("_wins", wins.cast("long"))
        .groupBy(*kept)
        .agg((F.first("_sure") + F.sum("_wins")).alias("quota"))
    )


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    block_tokens: int = 8,
    shard_tokens: int = 4_000_000,
    shard_rows: int = 200_000,
    seed: int = 42,
) -> DataFrame:
    """Per document ``doc_id, source, size, source_size, target, taken``.

    ``taken`` counts the words of the document that the mix takes, repeats included. Same rows
    on every run and file layout. A shard, one task's window, has about ``shard_tokens`` words and
    ``shard_rows`` rows at most, so that a source of very many short texts is split too.
    """
    sized = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"))
    counted = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_rows")
    )
    rows = counted.select(F.col("source").alias("_named"), "_rows")
    totals = counted.select("source", "source_size")
    targets = source_targets(totals, weights, share, most).withColumn(
        "_seats",
        F.round(F.sum("target").over(Window.partitionBy()) / block_tokens).cast("long"),
    )
    by_tokens = F.ceil(F.col("source_size") / shard_tokens)
    by_rows = F.ceil(F.col("_rows") / shard_rows)
    quotas = apportion(targets, "target", "_seats", (), ("source",))
    quotas = quotas.join(rows, quotas["source"].eqNullSafe(rows["_named"])).select(
        F.col("source").alias("_source"),
        "source_size",
        "target",
        F.col("quota").alias("_source_quota"),
        F.greatest(by_tokens, by_rows, F.lit(1)).alias("_n_shards"),
    )
    place = F.xxhash64(F.col("doc_id"), F.lit(seed))
    dealt = sized.join(quotas, sized["source"].eqNullSafe(quotas["_source"])).withColumn(
        "_shard", F.pmod(place, F.col("_n_shards"))
    )
    shards = dealt.groupBy(
        "source", "_shard", "target", "source_size", "_source_quota"
    ).agg(F.sum("size").alias("_shard_size"))
    won = apportion(shards, "_shard_size", "_source_quota", ("source",), ("_shard",)).select(
        F.col("source").alias("_source_of_shard"),
        F.col("_shard").alias("_part"),
        "_shard_size",
        F.col("quota").alias("_quota"),
    )
    ordered = (
        Window.partitionBy("source", "_shard")
        .orderBy(F.xxhash64(F.col("doc_id"), F.lit(seed + 1)), "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = dealt.withColumn("_end", F.sum("size").over(ordered)).join(
        won,
        F.col("source").eqNullSafe(F.col("_source_of_shard")) & (F.col("_shard") == F.col("_part")),
    )
    blocks = F.greatest(F.ceil(F.col("_shard_size") / block_tokens), F.lit(1))
    quota = F.least(F.col("_quota"), F.floor(blocks * F.lit(float(most))).cast("long"))
    whole, rest = F.floor(quota / blocks), F.pmod(quota, blocks)
    first = F.pmod(F.xxhash64(F.col("source"), F.col("_shard"), F.lit(seed + 2)), blocks)
    start, stop = first * block_tokens, (first + rest) * block_tokens
    begin = F.col("_end") - F.col("size")

    def overlap(low, high):
        return F.greatest(
            F.least(F.col("_end"), high) - F.greatest(begin, low), F.lit(0).cast("long")
        )

    # A run that passes the last block goes on at the first.
    round_end = blocks * block_tokens
    run = overlap(start, F.least(stop, round_end)) + overlap(
        F.lit(0).cast("long"), F.greatest(stop - round_end, F.lit(0).cast("long"))
    )
    taken = F.least(
        F.col("size") * whole + run, (F.col("size") * F.lit(float(most))).cast("long")
    )
    return placed.select(
        "doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken")
    )
