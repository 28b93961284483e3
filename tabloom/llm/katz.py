"""Katz backoff language model: bigrams over unigrams, counted and evaluated in partitions.

Counting. Pieces of text are packed by bucket: the bigrams of a piece, merged and grouped by
their first word, travel as columns in one row per bucket. A bucket is given by the first word
and a slice of the second, so that the followers of a frequent word are split. From a bucket
come all its bigrams with their counts, the counts of first words (every token is the first word
of one bigram, so these are the unigram counts), and counts of counts. Bigrams stay packed up to
scoring, as most types stand once and a row for each would cost more than the work on it.

Model. Good-Turing discounts for counts up to ``k``, from the counts of counts; bigrams that
stand once are kept and discounted as all others. With the followers S of v: P(w|v) = d c(v,w) /
c(v) for w in S, else alpha(v) P(w), where alpha(v) = (1 - sum over S of P(w|v)) / (1 - sum over S
of P(w)), so that the sum over all words is 1. Unseen words are one class, which gets the mass
that discounting leaves. Bigrams travel to the bucket of their second word for P(w), and from there
to that of their first. The table there has the words (v, n, log P), the sums of v's followers that
alpha takes, and log (d c(v,w) / P(w)) of all bigrams.

Scoring. log P(text) = sum of log P(w) over tokens, plus log alpha(v) for each bigram that is
not known, plus log P(w|v) - log P(w) for each that is. The last two are known where the followers
of v are, the first where w is the first word of the next bigram; so each token travels once.
The followers of words frequent in the corpus (at most 1/share of them exist) are split.

Defined results: a null or empty text is the end token alone; rows, also of one id or without
any, are scored each by their own text, and all counted in training; without training rows every
token is unseen.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm import text as T
from tabloom.workspace import remove, stage, stage_bucketed, stage_path

START, END = np.uint64(1), np.uint64(2)
_LOW48 = np.uint64((1 << 48) - 1)
_SLICES, _HOT_SLICES, _STEP = np.uint64(16), np.uint64(256), 2654435761
# Of text; the arrays of a task take some twenty times as much.
_BATCH_BYTES = 3 << 20
_TOKEN_BYTES = 6
# Parts in which the model is dealt to its buckets, one after another.
TABLE_PARTS = 2
# Kind 0: the bigrams of a bucket; 1: a first word and its count; 2: a count and its bigrams' number.
_COUNTS = "kind byte, key long, n long, v binary, runs binary, w binary, times binary"
_TABLE = (
    "bucket long, v long, n long, x double, kept double, below double, pairs binary, gains binary"
)


def _coded(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every entry as a number from 0, and the values that the numbers stand for."""
    coded = pa.array(x).dictionary_encode()
    return coded.indices.to_numpy().astype(np.uint64), coded.dictionary.to_numpy()


def _tokens(batch: pa.RecordBatch, at: int) -> tuple[np.ndarray, ...]:
    """All bigrams of a batch, START to END, as numbers of words; the words; offsets of rows."""
    words, offsets = T.words_of(batch.column(at), lower=True)
    offsets = offsets + np.arange(len(offsets))
    number, names = _coded(words)
    number += np.uint64(2)
    del words

    def filled(places: np.ndarray, mark: int) -> np.ndarray:
        out = np.full(offsets[-1], mark, np.uint64)
        free = np.ones(len(out), bool)
        free[places] = False
        out[free] = number
        return out

    names = np.concatenate([[START, END], names])
    return filled(offsets[:-1], 0), filled(offsets[1:] - 1, 1), names, offsets


def _groups(v: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of pairs of small numbers by ``v`` and ``w``, and the begins of equal ones in it.

    Equal pairs keep their order.
    """
    if not len(v):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pair = v * (w.max() + np.uint64(1))
    pair += w
    bits = len(pair).bit_length()
    if int(pair.max()) >> (64 - bits):
        order = np.argsort(pair, kind="stable")
        pair = pair[order]
    else:
        # Places in the low bits, so that numbers are sorted and not places by them.
        pair <<= np.uint64(bits)
        pair |= np.arange(len(pair), dtype=np.uint64)
        pair.sort()
        order = (pair & np.uint64((1 << bits) - 1)).view(np.int64)
        pair >>= np.uint64(bits)
    return order, np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))


def _by_bucket(bucket: np.ndarray) -> np.ndarray:
    """An order by bucket that keeps the one within a bucket."""
    few = not len(bucket) or bucket.max() < 1 << 16
    return np.argsort(bucket.astype(np.uint16 if few else np.uint32), kind="stable")


def _six(x: np.ndarray) -> bytes:
    """The low 48 bits of 64-bit numbers."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _from_six(held: bytes) -> np.ndarray:
    out = np.zeros((len(held) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(held, np.uint8).reshape(-1, 6)
    return out.view(np.uint64).ravel()


def _small(x: np.ndarray) -> bytes:
    """Non-negative numbers in one byte each, larger ones after a 255 in eight at the end."""
    big = x >= 255
    low = np.where(big, 255, x).astype(np.uint8)
    return len(x).to_bytes(8, "little") + low.tobytes() + x[big].astype(np.int64).tobytes()


def _from_small(held: bytes) -> np.ndarray:
    n = int.from_bytes(held[:8], "little")
    out = np.frombuffer(held, np.uint8, n, 8).astype(np.int64)
    out[out == 255] = np.frombuffer(held[8 + n :], np.int64)
    return out


def _few(x: np.ndarray) -> bytes:
    """Numbers of few different values: the values, and which of them stands in each place."""
    values, number = np.unique(x, return_inverse=True)
    number = number.astype(_kind(len(values)))
    return len(values).to_bytes(8, "little") + values.tobytes() + number.tobytes()


def _from_few(held: bytes) -> np.ndarray:
    n = int.from_bytes(held[:8], "little")
    values = np.frombuffer(held, np.float64, n, 8)
    return values[np.frombuffer(held, _kind(n), -1, 8 + 8 * n)]


def _kind(n: int) -> type:
    """The smallest kind of numbers that has 0 to n - 1."""
    return np.uint8 if n <= 1 << 8 else np.uint16 if n <= 1 << 16 else np.uint32


def _bucket_of(v: np.ndarray, w: np.ndarray, slices, buckets: int) -> np.ndarray:
    return (T.mix(v + T.mix(w) % slices) % np.uint64(buckets)).astype(np.int64)


def _large(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of a partition together, up to some megabytes, so that more bigrams merge."""
    held, size = [], 0
    for piece in T.pieces(batches):
        held.append(piece)
        size += piece.nbytes
        if size >= _BATCH_BYTES:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _packed(bucket, v, w, rest: dict[str, tuple], seconds=_six) -> Iterator[tuple]:
    """Grouped bigrams cut by bucket: bucket, words and their numbers of entries, seconds, rest."""
    cuts = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))
    for a, b in zip(cuts[:-1], cuts[1:]):
        runs = np.flatnonzero(np.append(True, v[a + 1 : b] != v[a : b - 1]))
        yield (
            int(bucket[a]),
            v[a:b][runs].tobytes(),
            _small(np.diff(np.append(runs, b - a))),
            seconds(w[a:b]),
            *[pack(x, a, b) for pack, x in rest.values()],
        )


def _batch(rows: Iterator[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64(), *[pa.binary()] * (len(names) - 1)]
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(next(columns, ()), k) for k in kinds], names)


def _unpacked(table: pa.Table, first: str, second: str, from_seconds, **rest) -> Iterator[list]:
    """Rows of ``_packed``, one after another: first words, entries of each, seconds, rest."""
    for firsts, runs, seconds, *more in zip(
        *[table.column(c).to_pylist() for c in (first, "runs", second, *rest)]
    ):
        yield [
            np.frombuffer(firsts, np.uint64),
            _from_small(runs),
            from_seconds(seconds),
            *[unpack(x) for unpack, x in zip(rest.values(), more)],
        ]


def _whole(held: bytes) -> np.ndarray:
    return np.frombuffer(held, np.uint64)


def _small_part(x, a, b) -> bytes:
    return _small(x[a:b])


def _few_part(x, a, b) -> bytes:
    return _few(x[a:b])


def _counted(buckets: int):
    def count(batches):
        for batch in _large(batches):
            v, w, names, _ = _tokens(batch, 0)
            order, begins = _groups(v, w)
            times = np.diff(np.append(begins, len(order)))
            at = order[begins]
            del order, begins
            v, w = names[v[at]], names[w[at]] & _LOW48
            bucket = _bucket_of(v, w, _SLICES, buckets)
            order = _by_bucket(bucket)
            rows = _packed(bucket[order], v[order], w[order], {"n": (_small_part, times[order])})
            yield _batch(rows, ["bucket", "v", "runs", "w", "n"])

    return count


def _merged(table: pa.Table) -> pa.Table:
    """A bucket's bigrams, first words and counts of counts, as ``_COUNTS`` has them."""
    held = list(_unpacked(table, "v", "w", _from_six, n=_from_small))
    firsts, runs, w, n = (np.concatenate(x) for x in zip(*held))
    del held
    (v, firsts), (w, seconds) = _coded(firsts), _coded(w)
    v = np.repeat(v, runs)
    order, begins = _groups(v, w)
    total = np.add.reduceat(n[order], begins)
    at = order[begins]
    v, w = firsts[v[at]], seconds[w[at]]
    begins = np.flatnonzero(np.append(True, v[1:] != v[:-1]))
    sums = np.add.reduceat(total, begins)
    sizes, types = np.unique(total, return_counts=True)
    few = sizes <= 20
    _, *packed = next(_packed(np.zeros(len(v), np.int64), v, w, {"n": (_small_part, total)}))
    none = [None] * (len(begins) + int(few.sum()))
    return pa.table(
        {
            "kind": pa.array([0] + [1] * len(begins) + [2] * int(few.sum()), pa.int8()),
            "key": pa.array(np.concatenate([[0], v[begins].view(np.int64), sizes[few]])),
            "n": pa.array(np.concatenate([[0], sums, types[few]])),
            **{
                c: pa.array([x, *none], pa.binary())
                for c, x in zip(("v", "runs", "w", "times"), packed)
            },
        }
    )


def _turned(hot: np.ndarray, buckets: int):
    """Counted bigrams, packed by their second words and dealt to the buckets of these."""

    def turn(batches):
        for batch in batches:
            for v, runs, w, n in _unpacked(batch, "v", "w", _from_six, times=_from_small):
                v = np.repeat(v, runs)
                order = np.argsort(w)
                v, w, n = v[order], w[order], n[order]
                bucket = _place(w, v, hot, buckets)
                order = _by_bucket(bucket)
                rest = {"n": (_small_part, n[order])}
                rows = _packed(bucket[order], w[order], v[order], rest, np.ndarray.tobytes)
                yield _batch(rows, ["bucket", "w", "runs", "v", "n"])

    return turn


def _weighed(hot: np.ndarray, buckets: int):
    """Bigrams of a bucket of second words with P(w), packed by their first words again."""

    def weigh(asked: pa.Table, codes: pa.Table) -> pa.Table:
        names = ["bucket", "v", "runs", "w", "n", "p"]
        held = list(_unpacked(asked, "w", "v", _whole, n=_from_small))
        if not held:
            return pa.Table.from_batches([_batch(iter(()), names)])
        w, runs, v, n = (np.concatenate(x) for x in zip(*held))
        del held
        keys, p = codes.column("w").to_numpy().view(np.uint64), codes.column("p").to_numpy()
        order = np.argsort(keys)
        at, _ = _find(keys[order], w)
        p, w = np.repeat(p[order][at], runs), np.repeat(w, runs)
        order = np.argsort(v)
        v, w, n, p = v[order], w[order], n[order], p[order]
        bucket = _place(v, w, hot, buckets)
        order = _by_bucket(bucket)
        rest = {"n": (_small_part, n[order]), "p": (_few_part, p[order])}
        rows = _packed(bucket[order], v[order], w[order], rest)
        return pa.Table.from_batches([_batch(rows, names)])

    return weigh


def _dealt(by: list[float]):
    """A bucket's bigrams as one row of the model's table, and the sums of its first words."""

    def deal(table: pa.Table) -> pa.Table:
        held = list(_unpacked(table, "v", "w", _from_six, n=_from_small, p=_from_few))
        firsts, runs, w, n, p = (np.concatenate(x) for x in zip(*held))
        del held
        number, firsts = _coded(firsts)
        number = np.repeat(number.astype(np.int64), runs)
        c = n * np.array([*by, 1.0])[np.minimum(n, len(by) + 1) - 1]
        kept, below = (np.bincount(number, x, len(firsts)) for x in (c, p))
        pairs = T.mix(firsts)[number] ^ w
        order = np.argsort(pairs)
        bucket = table.column("bucket")[0].as_py()
        none = [None] * len(firsts)
        return pa.table(
            {
                "bucket": pa.array(np.full(len(firsts) + 1, bucket)),
                "v": pa.array([None, *firsts.view(np.int64).tolist()], pa.int64()),
                "n": pa.nulls(len(firsts) + 1, pa.int64()),
                "x": pa.nulls(len(firsts) + 1, pa.float64()),
                "kept": pa.array([None, *kept.tolist()], pa.float64()),
                "below": pa.array([None, *below.tolist()], pa.float64()),
                "pairs": pa.array([pairs[order].tobytes(), *none], pa.binary()),
                "gains": pa.array([_few(np.log10(c / p)[order]), *none], pa.binary()),
            }
        )

    return deal


def discounts(types: dict[int, int], k: int) -> list[float]:
    """Good-Turing discounts of the counts 1..k; 1 where the counts of counts give none."""
    out = []
    ones = types.get(1, 0)
    beyond = (k + 1) * types.get(k + 1, 0) / ones if ones else 1.0
    for r in range(1, k + 1):
        if not types.get(r) or not types.get(r + 1) or beyond >= 1:
            out.append(1.0)
            continue
        ratio = (r + 1) * types[r + 1] / (r * types[r])
        d = (ratio - beyond) / (1 - beyond)
        out.append(d if 0 < d <= 1 else 1.0)
    return out


class Katz:
    """A fitted model: tables in the shared folder, and some totals.

    ``table`` holds words and all bigrams, dealt by bucket, so that scoring reads them where
    they lie; ``hot_sums`` are those of the followers of words that are in several buckets.
    """

    def __init__(self, words, n, n_types, n_ends, unseen, hot, buckets):
        self.words, self.n, self.n_types, self.n_ends = words, n, n_types, n_ends
        self.unseen, self.hot, self.buckets = unseen, hot, buckets
        self.table = self.hot_sums = None

    def end_log(self) -> float:
        found = self.words.filter(F.col("v") == int(END)).select("log_p").head()
        return found[0] if found else self.unseen


def fit(docs: DataFrame, k: int = 5, share: float = 1e-3, bucket_tokens: int = 1 << 20) -> Katz:
    """Count all rows of ``docs(text)`` and write the model's tables.

    Texts are dealt to buckets of about ``bucket_tokens``, so that a task's part does not grow
    with the input.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    buckets = max(64, size // (_TOKEN_BYTES * bucket_tokens) + 1)
    counts_path = stage_path(
        docs.select("text")
        .mapInArrow(_counted(buckets), "bucket long, v binary, runs binary, w binary, n binary")
        .groupBy("bucket")
        .applyInArrow(_merged, _COUNTS),
        "counts",
    )
    counted = spark.read.schema(_COUNTS).parquet(counts_path)
    firsts = counted.filter("kind = 1").groupBy(F.col("key").alias("v")).agg(F.sum("n").alias("n"))
    n_docs = firsts.filter(F.col("v") == int(START)).agg(F.sum("n")).head()[0] or 0
    tokens = (
        firsts.withColumn("v", F.when(F.col("v") == int(START), int(END)).otherwise(F.col("v")))
    )
    words = stage(tokens, "words")
    sums = words.agg(F.sum("n"), F.count(F.lit(1))).head()
    n, n_types = sums[0] or 0, sums[1]
    few = words.filter(F.col("n") <= k + 1).groupBy("n").count().collect()
    d1 = discounts({r["n"]: r["count"] for r in few}, k)
    few = counted.filter("kind = 2").groupBy("key").agg(F.sum("n").alias("n")).collect()
    d2 = discounts({r["key"]: r["n"] for r in few}, k)
    listed = F.array(*[F.lit(d) for d in d1])
    count = F.col("n")
    discounted = F.when(count <= k, F.get(listed, count.cast("int") - 1) * count).otherwise(count)

    # Unigrams sum to 1 - unseen; if nothing was discounted, unseen words get one count.
    mass = words.agg(F.sum(discounted)).head()[0] or 0.0
    whole = n if 0 < mass < n - 0.5 else mass + 1
    unseen = math.log10(1 - mass / whole) if n else 0.0
    p = words.select("v", "n", (discounted / F.lit(float(whole))).alias("p"))
    hot = [r["v"] for r in words.filter(count >= max(1.0, n * share)).select("v").collect()]
    hot = np.sort(np.array([*hot, int(START)], np.int64).view(np.uint64))
    log_p = p.select("v", "n", F.log10("p").alias("log_p"))
    model = Katz(log_p, n, n_types, n_docs, unseen, hot, buckets)

    hot_codes = np.unique(hot & _LOW48)
    codes = (
        p.groupBy(F.col("v").bitwiseAND(int(_LOW48)).alias("w"))
        .agg(F.sum("p").alias("p"))
        .select(_places("w", hot_codes, buckets), "w", "p")
    )
    packed = "bucket long, v binary, runs binary, w binary, n binary, p binary"
    bigrams_path = stage_path(
        counted.filter("kind = 0")
        .select("v", "runs", "w", "times")
        .mapInArrow(
            _turned(hot_codes, buckets),
            "bucket long, w binary, runs binary, v binary, n binary",
        )
        .groupBy("bucket")
        .cogroup(codes.groupBy("bucket"))
        .applyInArrow(_weighed(hot, buckets), packed),
        "katz-bigrams",
    )
    remove(spark, counts_path)
    bigrams = spark.read.schema(packed).parquet(bigrams_path)

    def pairs(part: int) -> DataFrame:
        return (
            bigrams.filter(F.pmod("bucket", F.lit(TABLE_PARTS)) == part)
            .repartition(buckets, "bucket")
            .groupBy("bucket")
            .applyInArrow(_dealt(d2), _TABLE)
        )

    # START is the first word of as many bigrams as there are ends.
    starts = spark.range(1).select(
        F.lit(int(START)).cast("long").alias("v"),
        F.lit(n_docs).cast("long").alias("n"),
        F.lit(0.0).alias("x"),
    )
    none = F.lit(None)
    by_word = (
        log_p.withColumnRenamed("log_p", "x")
        .filter(F.col("v") != int(END))
        .union(starts.filter("n > 0"))
        .select(
            _places("v", hot, buckets),
            "v",
            "n",
            "x",
            *[none.cast("double").alias(c) for c in ("kept", "below")],
            *[none.cast("binary").alias(c) for c in ("pairs", "gains")],
        )
        .repartition(buckets, "bucket")
    )
    parts = [*map(pairs, range(TABLE_PARTS)), by_word]
    model.table = stage_bucketed(
        parts[0], "katz-model", "bucket", buckets, "v", dealt=True, more=parts[1:]
    )
    remove(spark, bigrams_path)
    split = model.table.filter(F.col("kept").isNotNull() & F.col("v").isin(hot.view(np.int64).tolist()))
    found = split.groupBy("v").agg(F.sum("kept").alias("kept"), F.sum("below").alias("below")).collect()
    found = {r["v"]: (r["kept"], r["below"]) for r in found}
    model.hot_sums = np.array([found.get(v, (0.0, 0.0)) for v in hot.view(np.int64).tolist()])
    return model


def _place(v: np.ndarray, w: np.ndarray, hot: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of bigrams: by the first word, and for hot ones by a part of the second too."""
    turn = np.where(_find(hot, v)[1], w % _HOT_SLICES, np.uint64(0))
    return (((v >> np.uint64(17)) + turn * np.uint64(_STEP)) % np.uint64(buckets)).astype(np.int64)


def _places(word: str, hot: np.ndarray, buckets: int) -> Column:
    """A row for every bucket that ``_place`` gives to bigrams of the word."""

    def bucket(turn: Column) -> Column:
        return F.pmod(F.shiftrightunsigned(word, 17) + turn * F.lit(_STEP), F.lit(buckets).cast("long"))

    zero = F.lit(0).cast("long")
    turns = F.sequence(zero, F.lit(int(_HOT_SLICES) - 1).cast("long"))
    several = F.array_distinct(F.transform(turns, bucket))
    is_hot = F.col(word).isin(hot.view(np.int64).tolist())
    return F.explode(F.when(is_hot, several).otherwise(F.array(bucket(zero)))).alias("bucket")


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``wanted`` in sorted ``keys``, and which are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _looked_up(keys, values, wanted, default=0.0) -> np.ndarray:
    """The values of ``wanted`` among sorted ``keys``, or the default."""
    at, known = _find(keys, wanted)
    return np.where(known, values[at] if len(keys) else default, default)


def _sorted(table: pa.Table, *names: str) -> list[np.ndarray]:
    """Columns of the rows that have the last one, by their word."""
    held = table.select(["v", *names]).filter(pc.is_valid(table.column(names[-1])))
    v, *rest = (held.column(c).to_numpy() for c in ("v", *names))
    v = v.view(np.uint64)
    order = np.argsort(v)
    return [x[order] for x in (v, *rest)]


def _scored(unseen: float, hot: np.ndarray, hot_sums: np.ndarray):
    """Shares of a bucket in the scores of documents."""
    names = ["doc", "n_tokens", "n_known", "base", "log_p"]

    def evaluate(asked: pa.Table, table: pa.Table) -> pa.Table:
        words, log_p, counts = _sorted(table, "x", "n")
        sums_of, *sums = _sorted(table, "kept", "below")
        kept, below = (
            np.where(_find(hot, words)[1], _looked_up(hot, y, words), _looked_up(sums_of, x, words))
            for x, y in zip(sums, hot_sums.T)
        )
        # A history whose kept counts take all its mass gets one count more for the rest.
        over = np.where(kept < counts - 0.25, counts, kept + 1)
        with np.errstate(divide="ignore", invalid="ignore"):
            back = np.log10((1 - kept / over) / (1 - below))
        back, over = np.where(np.isfinite(back), back, 0.0), np.log10(over)
        cells = table.select(["pairs", "gains"]).filter(pc.is_valid(table.column("pairs")))
        pairs, gains = np.zeros(0, np.uint64), np.zeros(0)
        for x, y in zip(cells.column("pairs").to_pylist(), cells.column("gains").to_pylist()):
            pairs, gains = np.frombuffer(x, np.uint64), _from_few(y)
        out = {name: [] for name in names}
        for firsts, runs, seconds, times, rows, ids in zip(
            *[asked.column(c).to_pylist() for c in ("v", "runs", "w", "n", "rows", "ids")]
        ):
            ids = np.frombuffer(ids, np.int64)
            firsts, runs, times = (
                np.frombuffer(firsts, np.uint64), _from_small(runs), _from_small(times)
            )
            rows = np.frombuffer(rows, np.uint16 if len(ids) <= 1 << 16 else np.uint32)
            is_token = firsts != START
            count = np.where(is_token, _looked_up(words, counts, firsts, 0), 0)
            own = np.where(count > 0, _looked_up(words, log_p, firsts), unseen) * is_token
            base = np.log10(count + 0.1) * is_token
            behind = _looked_up(words, back, firsts)
            divided = _looked_up(words, over, firsts)
            of_pair = np.repeat(np.arange(len(firsts)), runs)
            at, known = _find(pairs, T.mix(firsts)[of_pair] ^ _from_six(seconds))
            gain = (gains[at] if len(pairs) else 0.0) - divided[of_pair]
            step = np.where(known, gain, behind[of_pair])
            of_token = np.repeat(np.arange(len(of_pair)), times)
            word = of_pair[of_token]
            sums = [
                np.bincount(rows, weights, len(ids))
                for weights in (None, (count > 0)[word], base[word], own[word] + step[of_token])
            ]
            some = sums[0] > 0
            out["doc"].append(ids[some])
            for name, values in zip(names[1:], sums):
                out[name].append(values[some])
        kinds = [np.int64, np.int64, np.int64, np.float64, np.float64]
        return pa.table(
            {
                name: pa.array(np.concatenate([np.zeros(0), *out[name]]).astype(kind))
                if name != "doc"
                else pa.array(np.concatenate([np.zeros(0, np.int64), *out[name]]))
                for name, kind in zip(names, kinds)
            }
        )

    return evaluate


def score(docs: DataFrame, model: Katz, bucket_tokens: int = 1 << 20) -> DataFrame:
    """Per document ``doc_id, n_tokens, n_known, base_score, score`` under ``model``.

    ``base_score`` sums log10((c + 0.1) / (N + 0.1 (V + 1))) over the tokens. One row for every row
    of ``docs``: rows of equal id and text share what is summed for them.
    """
    # Told apart by id and text; equal ones are summed up together and share the sums.
    row = F.xxhash64("doc_id", "text")
    rows = docs.select("doc_id", row.alias("row"))
    copies = rows.groupBy("row").agg(F.count(F.lit(1)).alias("copies"))
    hot, buckets = model.hot, model.buckets
    # The model's buckets suit a table as large as the one it learned from; larger ones go in parts.
    size = docs.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    parts = size // (_TOKEN_BYTES * bucket_tokens * buckets) + 1

    def request(batches):
        for batch in _large(batches):
            v, w, names, offsets = _tokens(batch, 1)
            ids = batch.column(0).to_numpy()
            row = T.rows_of(offsets).astype(np.uint16 if len(ids) <= 1 << 16 else np.uint32)
            # Rows ascend within a bigram, as both orders keep those of equal ones.
            order, begins = _groups(v, w)
            times = np.diff(np.append(begins, len(order)))
            at = order[begins]
            v, w, row = names[v[at]], names[w[at]] & _LOW48, row[order]
            del order, begins, at
            bucket = _place(v, w, hot, buckets)
            row = row[_by_bucket(np.repeat(bucket, times))]
            order = _by_bucket(bucket)
            v, w, bucket = v[order], w[order], bucket[order]
            ends = np.append(0, np.cumsum(times[order]))
            whole = ids.tobytes()

            def rows_and_ids(x, a, b):
                """Rows of the tokens in a bucket; ids of all rows, or of its own if it has few."""
                held = x[ends[a] : ends[b]]
                if len(held) >= len(ids):
                    return held.tobytes(), whole
                own, number = np.unique(held, return_inverse=True)
                kind = np.uint16 if len(own) <= 1 << 16 else np.uint32
                return number.astype(kind).tobytes(), ids[own].tobytes()

            rest = {
                "n": (lambda x, a, b: _small(np.diff(x[a : b + 1])), ends),
                "rows": (rows_and_ids, row),
            }
            rows = [(*r[:-1], *r[-1]) for r in _packed(bucket, v, w, rest)]
            yield _batch(rows, ["bucket", "v", "runs", "w", "n", "rows", "ids"])

    def share(part: int) -> DataFrame:
        texts = docs.select(row.alias("row"), "text")
        if parts > 1:
            texts = texts.filter(F.pmod("row", F.lit(parts)) == part)
        asked = texts.mapInArrow(
            request,
            "bucket long, v binary, runs binary, w binary, n binary, rows binary, ids binary",
        )
        return (
            asked.groupBy("bucket")
            .cogroup(model.table.groupBy("bucket"))
            .applyInArrow(
                _scored(model.unseen, model.hot, model.hot_sums),
                "doc long, n_tokens long, n_known long, base double, log_p double",
            )
        )

    # A part has the whole of its texts; it is summed and stored before the next one is shuffled.
    totals = [F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base", "log_p")]
    summed = [
        stage(share(i).groupBy(F.col("doc").alias("row")).agg(*totals), "shares") for i in range(parts)
    ]
    sums = reduce(DataFrame.union, summed)
    each = sums.join(copies, "row").select(
        "row",
        *[(F.col(c) / F.col("copies")).cast("long").alias(c) for c in ("n_tokens", "n_known")],
        *[(F.col(c) / F.col("copies")).alias(c) for c in ("base", "log_p")],
    )
    # The end token is no first word; a document has one.
    end_log = model.end_log()
    per_token = math.log10(model.n + 0.1 * (model.n_types + 1))
    return rows.join(each, "row").select(
        "doc_id",
        "n_tokens",
        (F.col("n_known") + int(model.n_ends > 0)).alias("n_known"),
        (F.col("base") + math.log10(model.n_ends + 0.1) - F.col("n_tokens") * per_token).alias(
            "base_score"
        ),
        (F.col("log_p") + end_log).alias("score"),
    )
