"""Nearest neighbours by learned partitions of the vectors.

On a bounded sample (``sample`` rows by hash of the id, equal vectors once) a neighbour graph is
cut into balanced parts: parts start as recursive halves along the widest direction and are
refined by moving vectors to where most of their neighbours are, within a bound on the size. A
small classifier then learns from each vector how its neighbours are spread over the parts. Every
row is indexed under its most probable part; a query goes to several most probable parts, as
many as bring ``recall`` on the sample and hold as many rows as are asked for, and their rows are
ranked by exact inner product in double precision. Parts grow in number with the rows, up to a
32nd of the sample, so that a larger index wants a larger sample.

Parts are split by a hash into blocks of ``block_rows``, and the queries of a part into blocks
too, so that a part that holds very many rows (copies of one vector) is the work of many tasks.
Inside a block equal vectors are compared once and keep their least ids, as many as can be asked.

Defined results: vectors that are null, zero, or hold null or non-finite components take no
part, nor do those whose length is not the most frequent one (the greater of two); rows repeated
with the same id are candidates each, but none of them is found for its own id; an empty table
gives no rows; with fewer candidates than asked, all are given.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.workspace import stage

# Rows of a part for which it is cut smaller.
PART_ROWS = 100_000


def usable(vector: Column) -> Column:
    """True for vectors that take part."""
    bad = F.exists(
        vector,
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")),
    )
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array, dim: int, kind=np.float64) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, dim)


def balanced_parts(vectors: np.ndarray, near: np.ndarray, parts: int, slack: float = 0.1):
    """Part of every vector: few neighbours apart, sizes at most (1 + slack) times the mean."""
    n = len(vectors)
    part = np.zeros(n, np.int64)
    rng, made = np.random.default_rng(7), 1
    while made < parts:
        for p in range(made):
            rows = np.flatnonzero(part == p)
            held = vectors[rows] - vectors[rows].mean(0)
            axis = rng.standard_normal(vectors.shape[1])
            for _ in range(20):
                axis = held.T @ (held @ axis)
                axis /= np.linalg.norm(axis) + 1e-30
            upper = rows[np.argsort(held @ axis, kind="stable")[len(rows) // 2 :]]
            part[upper] = p + made
        made *= 2
    most = int(np.ceil((1 + slack) * n / parts))
    for _ in range(10):
        # How many neighbours, in either direction, each vector has in each part.
        ties = np.zeros((n, parts))
        for column in near.T:
            np.add.at(ties, (np.arange(n), part[column]), 1)
            np.add.at(ties, (column, part), 1)
        best = ties.argmax(1)
        gain = ties[np.arange(n), best] - ties[np.arange(n), part]
        sizes = np.bincount(part, minlength=parts)
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if sizes[best[i]] < most:
                sizes[part[i]] -= 1
                sizes[best[i]] += 1
                part[i] = best[i]
                moved += 1
        if moved < n // 200:
            break
    return part


class Router:
    """A two-layer classifier: probabilities of the parts for vectors."""

    def __init__(self, weights: list[np.ndarray], scale: float, asked: int):
        self.weights, self.scale, self.asked = weights, scale, asked

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.maximum(x * self.scale @ w1 + b1, 0) @ w2 + b2


def _train(x: np.ndarray, wanted: np.ndarray, hidden: int = 128, epochs: int = 60) -> Router:
    """Cross-entropy with soft targets by Adam."""
    rng = np.random.default_rng(11)
    dim, parts = x.shape[1], wanted.shape[1]
    scale = 1 / (np.sqrt((x**2).mean()) + 1e-30)
    weights = [
        rng.standard_normal((dim, hidden)) * np.sqrt(2 / dim),
        np.zeros(hidden),
        rng.standard_normal((hidden, parts)) * np.sqrt(1 / hidden),
        np.zeros(parts),
    ]
    router = Router(weights, scale, parts)
    first, second, t = [0.0] * 4, [0.0] * 4, 0
    for epoch in range(epochs):
        rate = 3e-3 * (1 - epoch / epochs)
        for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // 256)):
            inner = x[rows] * scale @ weights[0] + weights[1]
            held = np.maximum(inner, 0)
            out = held @ weights[2] + weights[3]
            p = np.exp(out - out.max(1, keepdims=True))
            delta = (p / p.sum(1, keepdims=True) - wanted[rows]) / len(rows)
            back = (delta @ weights[2].T) * (inner > 0)
            slopes = [(x[rows] * scale).T @ back, back.sum(0), held.T @ delta, delta.sum(0)]
            t += 1
            for i, slope in enumerate(slopes):
                first[i] = 0.9 * first[i] + 0.1 * slope
                second[i] = 0.999 * second[i] + 0.001 * slope**2
                step = first[i] / (1 - 0.9**t) / (np.sqrt(second[i] / (1 - 0.999**t)) + 1e-8)
                weights[i] -= rate * step
    return router


def fit(
    vectors: DataFrame,
    n: int,
    sample: int = 8192,
    parts: int | None = None,
    k: int = 20,
    recall: float = 0.94,
) -> Router | None:
    """Learn the parts from a sample of ``vectors(vec_id, embedding)``, ``n`` rows in all.

    ``parts`` are 32 unless given, or more where they would hold over ``PART_ROWS`` rows.
    """
    parts = parts or max(32, n // PART_ROWS)
    rows = (
        vectors.withColumn("_place", F.xxhash64("vec_id"))
        .orderBy("_place", "vec_id")
        .limit(sample)
        .select("embedding")
        .toArrow()
        .column(0)
        .to_pylist()
    )
    if not rows:
        return None
    x = np.unique(np.array(rows, np.float64), axis=0)
    # Parts of some hundred rows at least; a power of two.
    parts = 1 << int(np.log2(max(1, min(parts, n // 256, len(x) // 32))))
    near = np.empty((len(x), min(k, max(1, len(x) - 1))), np.int64)
    for begin in range(0, len(x), 1024):
        score = x[begin : begin + 1024] @ x.T
        score[np.arange(len(score)), begin + np.arange(len(score))] = -np.inf
        near[begin : begin + 1024] = np.argsort(-score, axis=1, kind="stable")[:, : near.shape[1]]
    part = balanced_parts(x, near, parts)
    wanted = np.zeros((len(x), parts))
    for column in near.T:
        np.add.at(wanted, (np.arange(len(x)), part[column]), 1 / near.shape[1])
    # How many parts to ask is judged on rows the classifier has not seen.
    seen = np.random.default_rng(5).random(len(x)) < 0.8
    trial = _train(x[seen], wanted[seen]) if 0 < seen.sum() < len(x) else _train(x, wanted)
    asked = parts
    if parts > 1:
        logits = trial.logits(x)
        home = logits.argmax(1)
        ranks = np.argsort(np.argsort(-logits[~seen], axis=1), axis=1)
        of_near = np.take_along_axis(ranks, home[near[~seen]], axis=1)
        shares = [(of_near < p).mean() for p in range(1, parts + 1)]
        asked = 1 + int(np.argmax(np.array(shares) >= recall))
    router = _train(x, wanted)
    router.asked = asked
    return router


def search(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    sample: int = 8192,
    parts: int | None = None,
    recall: float = 0.94,
    block_rows: int = 16_384,
    block_queries: int = 8_192,
) -> DataFrame:
    """The ``k`` nearest found of each query: ``query_id, rank, vec_id, score``.

    ``vectors`` and ``queries`` hold ``vec_id`` and ``embedding``. Every usable row of
    ``vectors`` is indexed; a row is not found for a query of its own id.
    """
    spark = vectors.sparkSession
    shape = "query_id long, rank int, vec_id long, score double"
    rows = vectors.select("vec_id", "embedding").filter(usable(F.col("embedding")))
    lengths = rows.groupBy(F.size("embedding").alias("dim")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("dim")).first()
    if most is None:
        return spark.createDataFrame([], shape)
    dim, n = most["dim"], most["count"]
    right_length = F.size("embedding") == dim
    rows = rows.filter(right_length)
    asked_rows = queries.select("vec_id", "embedding").filter(usable(F.col("embedding")))
    router = fit(rows, n, sample, parts, k, recall)

    def index(batches):
        for batch in batches:
            x = _matrix(batch.column(1), dim)
            part = router.logits(x).argmax(1).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), *batch.columns], ["part", "vec_id", "embedding"]
            )

    indexed = stage(
        rows.mapInArrow(index, "part int, vec_id long, embedding array<float>"),
        "vectors",
    )
    # A number for each part.
    held = np.zeros(len(router.weights[3]), np.int64)
    for row in indexed.groupBy("part").count().collect():
        held[row["part"]] = row["count"]

    def route(batches):
        for batch in batches:
            x = _matrix(batch.column(1), dim)
            best = np.argsort(-router.logits(x), axis=1, kind="stable")
            # Further parts until there are k rows besides the query's own.
            enough = (np.cumsum(held[best], axis=1) <= k).sum(1) + 1
            count = np.minimum(np.maximum(enough, router.asked), best.shape[1])
            chosen = best[np.arange(best.shape[1])[None, :] < count[:, None]]
            at = pa.array(np.repeat(np.arange(len(x)), count))
            yield pa.RecordBatch.from_arrays(
                [pa.array(chosen.astype(np.int32)), *[c.take(at) for c in batch.columns]],
                ["part", "query_id", "embedding"],
            )

    routed = asked_rows.filter(right_length).mapInArrow(
        route, "part int, query_id long, embedding array<float>"
    )
    # Blocks of a part: as many as its rows and its queries fill.
    n_blocks = indexed.groupBy("part").agg(
        F.ceil(F.count(F.lit(1)) / block_rows).alias("_blocks")
    )
    n_turns = routed.groupBy("part").agg(
        F.ceil(F.count(F.lit(1)) / block_queries).alias("_turns")
    )
    plan = n_blocks.join(n_turns, "part")
    left = indexed.join(plan, "part").select(
        "part",
        F.pmod(F.xxhash64("vec_id"), "_blocks").alias("block"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("_turns") - 1)).alias("turn"),
        "vec_id",
        "embedding",
    )
    right = routed.join(plan, "part").select(
        "part",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)).alias("block"),
        F.pmod(F.xxhash64("query_id"), "_turns").alias("turn"),
        "query_id",
        "embedding",
    )

    def rank(found: pa.Table, asked: pa.Table) -> pa.Table:
        ids = found.column("vec_id").to_numpy()
        x = _matrix(found.column("embedding").combine_chunks(), dim) if len(ids) else None
        out = ([], [], [])
        if len(ids) and asked.num_rows:
            x, of = np.unique(x, axis=0, return_inverse=True)
            order = np.lexsort((ids, of.ravel()))
            ids = ids[order]
            begins = np.concatenate([[0], np.cumsum(np.bincount(of.ravel(), minlength=len(x)))])
            wanted = asked.column("query_id").to_numpy()
            q = _matrix(asked.column("embedding").combine_chunks(), dim)
            for a in range(0, len(q), 256):
                rough = q[a : a + 256] @ x.T
                for i, scores in enumerate(rough):
                    if len(scores) > k + 1:
                        bound = np.partition(scores, len(scores) - k - 1)[len(scores) - k - 1]
                        near = np.flatnonzero(scores >= bound - 1e-9 * (1 + abs(bound)))
                    else:
                        near = np.arange(len(scores))
                    exact = (x[near] * q[a + i]).sum(1)
                    own = [ids[begins[j] : min(begins[j + 1], begins[j] + k + 1)] for j in near]
                    score = np.repeat(exact, [len(o) for o in own])
                    vec = np.concatenate(own)
                    keep = vec != wanted[a + i]
                    score, vec = score[keep], vec[keep]
                    best = np.lexsort((vec, -score))[:k]
                    out[0].append(np.full(len(best), wanted[a + i]))
                    out[1].append(vec[best])
                    out[2].append(score[best])
        columns = [
            pa.array(np.concatenate([np.zeros(0, kind), *part]).astype(kind))
            for part, kind in zip(out, (np.int64, np.int64, np.float64))
        ]
        return pa.table(columns, ["query_id", "vec_id", "score"])

    keys = ["part", "block", "turn"]
    found = (
        left.groupBy(*keys)
        .cogroup(right.groupBy(*keys))
        .applyInArrow(rank, "query_id long, vec_id long, score double")
    )
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
