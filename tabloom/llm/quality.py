"""Document quality by Bradley-Terry pairwise ranking.

A document's score is linear in features of its text. The weights are learned from preference
pairs: a labelled good document is preferred to a labelled bad one, and the logistic loss of the
difference of their features is lowered. The threshold is the score quantile at the share of bad
documents among the labelled ones.

The fit uses at most ``most`` labelled rows, the first by a hash of the id; features of whole
texts are computed where the texts are, and only the sample's features go to the driver, where
numpy fits some dozens of weights. Scoring is one pass without a shuffle.

Defined results: a null text counts as empty, and empty texts are scored as others are; rows
repeated with the same id are scored each; labels that are null or disagree for an id are left
out; without labels of both kinds every score is 0.5.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tabloom.llm import text as T

_CLASSES = [
    np.isin(np.arange(256), np.frombuffer(chars, np.uint8))
    for chars in (
        b"0123456789",
        b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
        b".,;:",
        b"!?",
        b"#$%&*",
        b"|<>{}[]\\/=_~^@+",
        b"\n",
        bytes(range(128, 256)),
    )
]
_SENTENCE_END = np.isin(np.arange(256), np.frombuffer(b".!?", np.uint8))


def features(column: pa.Array) -> np.ndarray:
    """A row of features for every text."""
    data, offsets = T.raw(column)
    starts, ends, rows = T.word_spans(data, offsets)
    hashes = T.word_hashes(data, starts, ends, lower=True)
    n_bytes = np.maximum(np.diff(offsets), 1)
    n_words = np.diff(rows)
    some = np.maximum(n_words, 1)

    def per_row(flags, bounds):
        return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[bounds])

    out = [np.log1p(n_words), np.log1p(np.diff(offsets))]
    for chars in _CLASSES:
        share = per_row(chars[data], offsets) / n_bytes
        out += [share, np.sqrt(share)]
    lengths = ends - starts
    mean = per_row(lengths, rows) / some
    out += [mean, per_row(lengths**2, rows) / some - mean**2]
    one = lengths == 1
    out += [per_row(one, rows) / some, per_row(lengths > 20, rows) / some]
    out.append(per_row(_SENTENCE_END[data[ends - 1]], rows) / some)
    upper = _CLASSES[1][data[starts]] if len(starts) else np.zeros(0, bool)
    out.append(per_row(upper, rows) / some)
    twins = np.append(False, hashes[1:] == hashes[:-1]) if len(hashes) else np.zeros(0, bool)
    out.append(per_row(twins, rows) / some)
    pairs = T.rolling(hashes, 3)
    different, repeated, commonest = np.ones(len(n_words)), np.zeros(len(n_words)), np.zeros(len(n_words))
    for i, (a, b) in enumerate(zip(rows[:-1], rows[1:])):
        if b > a:
            counts = np.unique(hashes[a:b], return_counts=True)[1]
            different[i] = len(counts) / (b - a)
            commonest[i] = counts.max() / (b - a)
        if b - a > 3:
            repeated[i] = 1 - len(np.unique(pairs[a : b - 2])) / (b - a - 2)
    out += [different, np.log(different) * -1, repeated, np.sqrt(repeated), commonest]
    x = np.stack(out, 1)
    return np.concatenate([x, (n_words[:, None] == 0).astype(float)], 1)


class Ranker:
    """Scores from 0 to 1, rising with the linear score; ``cut`` is where the threshold lies."""

    def __init__(self, mean, scale, weights, threshold, slope, cut):
        self.mean, self.scale, self.weights = mean, scale, weights
        self.threshold, self.slope, self.cut = threshold, slope, cut

    def raw(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        # Summed row by row: a matrix product would depend on the rows beside it.
        return (np.concatenate([z, np.minimum(z**2, 16)], 1) * self.weights).sum(1)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), 0.5)
        at = self.slope * (self.raw(x) - self.threshold) + np.log(self.cut / (1 - self.cut))
        return 1 / (1 + np.exp(-np.clip(at, -500, 500)))


def fit_pairs(
    x: np.ndarray, good: np.ndarray, cut: float = 0.3, rounds: int = 400, seed: int = 3
) -> Ranker:
    """Bradley-Terry weights from pairs of a good and a bad row."""
    if not len(x) or good.all() or not good.any():
        return Ranker(None, None, None, 0.0, 1.0, cut)
    mean, scale = x.mean(0), x.std(0) + 1e-9
    model = Ranker(mean, scale, None, 0.0, 1.0, cut)
    z = np.clip((x - mean) / scale, -8, 8)
    z = np.concatenate([z, np.minimum(z**2, 16)], 1)
    better, worse = np.flatnonzero(good), np.flatnonzero(~good)
    rng = np.random.default_rng(seed)
    w, first, second = np.zeros(z.shape[1]), 0.0, 0.0
    for t in range(1, rounds + 1):
        gap = z[rng.choice(better, 4096)] - z[rng.choice(worse, 4096)]
        p = 1 / (1 + np.exp(np.clip(gap @ w, -500, 500)))
        slope = -(gap * p[:, None]).mean(0) + 1e-3 * w
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        rate = 0.05 * (1 - t / (rounds + 1))
        w = w - rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    model.weights = w
    raw = model.raw(x)
    # The quantile lies between two rows; their middle separates the shares.
    ordered, at = np.sort(raw), len(worse)
    model.threshold = float((ordered[at - 1] + ordered[min(at, len(ordered) - 1)]) / 2)
    model.slope = 1.0
    return model


def fit(docs: DataFrame, labels: DataFrame, cut: float = 0.3, most: int = 20_000) -> Ranker:
    """Learn from ``labels(doc_id, good)``, good being 0 or 1, and their texts in ``docs``.

    The bounded sample has at most ``most`` ids, and of each the row with the least hash of its text.
    """
    agreed = (
        labels.filter("doc_id is not null and good is not null")
        .groupBy("doc_id")
        .agg(F.min("good").alias("good"), F.max("good").alias("_most"))
        .filter("good = _most")
        .select(F.col("doc_id").alias("_labelled"), F.col("good").cast("int"))
        .orderBy(F.xxhash64("_labelled"), "_labelled")
        .limit(most)
    )

    def compute(batches):
        for batch in T.pieces(batches):
            x = features(batch.column(0))
            held = pa.ListArray.from_arrays(
                pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel())
            )
            columns = [held, *batch.columns[1:]]
            yield pa.RecordBatch.from_arrays(columns, ["x", "good", "doc_id", "hash"])

    # At most ``most`` rows of two numbers are broadcast, and a row for each id comes back.
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(agreed), F.col("doc_id") == F.col("_labelled"))
        .select("text", "good", "doc_id", F.xxhash64("text").alias("hash"))
        .mapInArrow(compute, f"x array<double>, good int, doc_id {kind}, hash long")
        .groupBy("doc_id")
        .agg(F.min(F.struct("hash", "x", "good")).alias("least"))
        .select("least.x", "least.good")
        .toArrow()
    )
    x = rows.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    good = rows.column("good").to_numpy() == 1
    # Rows come in any order; sorted, the fit is the same on every run.
    x = x.reshape(len(good), -1) if len(good) else np.zeros((0, 1))
    order = np.lexsort((good, *x.T)) if len(good) else np.zeros(0, int)
    return fit_pairs(x[order], good[order], cut)


def score(docs: DataFrame, model: Ranker, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` of ``docs`` and ``score``, for every row."""

    def compute(batches):
        for batch in T.pieces(batches, "_text"):
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(model.score(features(batch.column(len(keep)))))],
                [*keep, "score"],
            )

    columns = docs.select(*keep, F.col("text").alias("_text"))
    shape = StructType([*columns.schema.fields[:-1], StructField("score", DoubleType())])
    return columns.mapInArrow(compute, shape)


def accepted(score: Column, cut: float = 0.3) -> Column:
    return (score >= cut).cast("int")
