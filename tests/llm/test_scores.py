"""Learned scores: quality, toxicity and the language model."""

import collections
import math
import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabloom.llm import QUERIES, katz, quality, toxicity
from tabloom.llm import text as T
from tabloom.workspace import stage_bucketed
from tests.llm import brute

SF_DIR = "/root/testdata/sf0.001"
SHAPE = "doc_id long, text string, good int, score double, _text string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 5, 0.1, "x") for i, t in rows], SHAPE).repartition(3)


def test_words_and_hashes():
    texts = ["", None, "a", "a b", " A\tb\x0bc\n", "é" * 3_000_000, "Ab aB ab", "x" * 5 + "\xa0y"]
    for lower in (False, True):
        hashes, rows = T.words_of(pa.array(texts), lower)
        expected = [brute.words(t, lower) for t in texts]
        assert list(np.diff(rows)) == [len(w) for w in expected]
        named = {}
        for w, h in zip([w for held in expected for w in held], hashes):
            assert named.setdefault(w, h) == h
        assert len(set(named.values())) == len(named)


def test_pieces_keep_all_rows():
    batch = pa.RecordBatch.from_pydict({"text": ["x" * n for n in (0, 5 << 20, 1, 3 << 20, 3 << 20)] + [None]})
    parts = list(T.pieces([batch, batch.slice(1, 2)]))
    assert [len(x or "") for p in parts for x in p.column(0).to_pylist()] == [
        0, 5 << 20, 1, 3 << 20, 3 << 20, 0, 5 << 20, 1
    ]
    assert len(parts) > 3


def test_pairs_order_good_before_bad():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((500, 4))
    good = x[:, 0] + 0.1 * rng.standard_normal(500) > -1
    model = quality.fit_pairs(x, good)
    score = model.score(x)
    assert ((score >= 0.3) == good).mean() > 0.9
    # The threshold is the quantile at the share of bad rows.
    assert abs((score < 0.3).sum() - (~good).sum()) <= 1
    assert (quality.fit_pairs(x, np.ones(500, bool)).score(x) == 0.5).all()


@pytest.mark.parametrize("name, label, least", [("op2_quality_ranking", "quality", 0.9), ("op8_toxicity", "toxic", 0.8)])
def test_held_out_accuracy(spark, name, label, least):
    sf_dir = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").toPandas().set_index("doc_id")[label]
    rows = QUERIES[name](spark, sf_dir).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 for r in rows)
    judged = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels.index]
    assert sum(p == y for p, y in judged) / len(judged) > least
    cut = 0.3 if label == "quality" else 0.7
    assert all(r.predicted == (r.score >= cut) for r in rows)


@pytest.mark.parametrize("module, label", [(quality, "good"), (toxicity, "toxic")])
def test_scores_of_odd_rows(spark, module, label):
    rows = [(i, "fine words here and there " * 5 if i % 2 else "#bad# ### !!! " * 5) for i in range(40)]
    rows += [(100, None), (101, ""), (102, "x" * 300_000), (102, "x"), (None, "y")]
    docs = frame(spark, rows)
    labels = [(i, i % 2) for i in range(40)] + [(None, 1), (3, None), (5, 0), (999, 1)]
    labelled = spark.createDataFrame(labels, f"doc_id long, {label} int")
    options = {} if module is quality else {"rounds": 2, "per_round": 512}
    model = module.fit(docs, labelled, **options)
    found = module.score(docs, model).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    by_id = {r.doc_id: r.score for r in found}
    assert (by_id[7] > by_id[8]) and by_id[100] == by_id[101]
    # Nothing to learn from: one score for all.
    blank = module.fit(docs, labelled.filter("false"))
    assert {r.score for r in module.score(docs, blank).collect()} == {0.5}
    assert module.score(docs.filter("false"), model).collect() == []


@pytest.mark.parametrize("module, label", [(quality, "good"), (toxicity, "toxic")])
def test_scores_do_not_depend_on_the_rows_beside(spark, module, label):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh#!.") for _ in range(rng.randint(1, 9)))
    rows = [(i, " ".join(word() for _ in range(rng.choice([0, 1, 5, 47, 48, 49, 200])))) for i in range(300)]
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], f"doc_id long, {label} int")
    options = {} if module is quality else {"rounds": 2, "per_round": 512}
    model = module.fit(docs, labels, **options)
    found = [
        sorted((r.doc_id, r.score) for r in module.score(docs.repartition(n), model).collect())
        for n in (1, 3, 50)
    ]
    assert found[0] == found[1] == found[2]


@pytest.mark.parametrize("module, label", [(quality, "good"), (toxicity, "toxic")])
def test_sample_is_bounded_by_ids(spark, module, label):
    """An id that very many rows hold gives one of them, the same whatever the layout."""
    rows = [(1, f"one of many texts {i} of this id") for i in range(500)] + [(i, f"text {i} !") for i in range(2, 30)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], f"doc_id long, {label} int")
    options = {} if module is quality else {"rounds": 1, "per_round": 256}
    scores = []
    for n in (2, 7):
        docs = frame(spark, rows).repartition(n)
        model = module.fit(docs, labels, **options)
        scores.append(sorted(r.score for r in module.score(docs, model).collect()))
    assert scores[0] == scores[1]
    if module is toxicity:
        small = module.fit(docs, labels, most_bytes=60, **options)
        assert len({r.score for r in module.score(docs, small).collect()}) > 1


def test_plain_scorers():
    """Both scorers against plain Python, for fixed weights."""
    rng = np.random.default_rng(3)
    x = rng.standard_normal((20, 5)) * 4
    ranker = quality.Ranker(x.mean(0), x.std(0), rng.standard_normal(10), 0.3, 1.0, 0.3)
    for row, found in zip(x, ranker.score(x)):
        z = [max(-8, min(8, (v - m) / s)) for v, m, s in zip(row, ranker.mean, ranker.scale)]
        raw = sum(w * v for w, v in zip(ranker.weights, z + [min(v * v, 16) for v in z]))
        assert found == pytest.approx(1 / (1 + math.exp(0.3 - raw - math.log(0.3 / 0.7))))

    text = "You idiot go away you idiot and so on"
    words = toxicity.Words(pa.array([text]))
    net = toxicity.Network(words.hashes[::2], word=3, char=3, hidden=2)
    for name, values in net.p.items():
        if name[0] == "c" and name != "char":
            values += np.arange(len(values)) / 9
    sigmoid = lambda v: 1 / (1 + math.exp(-v))
    tokens = brute.words(text, True)

    def vector(word):
        h = T.words_of(pa.array([word]), True)[0][0]
        known = np.flatnonzero(net.vocabulary == h)
        held = net.p["word"][known[0] if len(known) else -1]
        one = toxicity.Words(pa.array([word]))
        return [*held, *net.p["char"][one.trigrams].mean(0)]

    def window(tokens):
        states = []
        for d, order in (("f", tokens), ("b", tokens[::-1])):
            state, out = [0.0, 0.0], []
            for token in order:
                v, w, u, c = vector(token), net.p[f"w{d}"], net.p[f"u{d}"], net.p[f"c{d}"]
                gate = lambda j, s: c[j] + sum(a * w[i][j] for i, a in enumerate(v)) + sum(a * u[i][j] for i, a in enumerate(s))
                z = [sigmoid(gate(j, state)) for j in (0, 1)]
                r = [sigmoid(gate(j, state)) for j in (2, 3)]
                new = [math.tanh(gate(j, [a * b for a, b in zip(r, state)])) for j in (4, 5)]
                state = [a * s + (1 - a) * n for a, s, n in zip(z, state, new)]
                out.append(state)
            states.append(out if d == "f" else out[::-1])
        both = [a + b for a, b in zip(*states)]
        energy = [math.exp(sum(a * b for a, b in zip(s, net.p["attend"]))) for s in both]
        pooled = [sum(e * s[i] for e, s in zip(energy, both)) / sum(energy) for i in range(4)]
        return sum(a * b for a, b in zip(pooled, net.p["out"])) + net.p["bias"][0]

    expected = max(window(tokens[a : a + 4]) for a in range(0, len(tokens) - 2, 2))
    assert net.raw(pa.array([text]), 4, 2)[0] == pytest.approx(expected, rel=1e-4)


def test_gradients_of_the_network():
    texts = pa.array(["you idiot go away", "nice words in here", "", "so so"])
    words = toxicity.Words(texts)
    net = toxicity.Network(words.hashes, word=3, char=3, hidden=4)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    text, begin, size = toxicity.windows(words.rows, 4, 2)
    keep = size > 0
    place = begin[keep][None, :] + np.arange(4)[:, None]
    mask = np.arange(4)[:, None] < size[keep][None, :]
    of = words.number[np.where(mask, place, 0)]
    label = np.array([1.0, 0.0, 1.0])[: keep.sum()]

    def loss():
        z = toxicity._logits(net, words, of, mask)
        return np.mean(np.logaddexp(0, z) - label * z)

    grad = net.slopes(words, of, mask, label)
    for name in ("wf", "ub", "cb", "attend", "out", "bias"):
        at = tuple(np.unravel_index(1 % net.p[name].size, net.p[name].shape))
        held = net.p[name][at]
        values = []
        for step in (1e-3, -1e-3):
            net.p[name][at] = held + step
            values.append(loss())
        net.p[name][at] = held
        assert abs((values[0] - values[1]) / 2e-3 - grad[name][at]) < 2e-4, name


def test_windows_cover_every_word():
    rows = np.array([0, 0, 1, 48, 97, 200])
    text, begin, size = toxicity.windows(rows, 48, 24)
    for i in range(5):
        covered = {k for t, b, n in zip(text, begin, size) if t == i for k in range(b, b + n)}
        assert covered == set(range(rows[i], rows[i + 1]))
    assert (size >= 0).all() and set(text) == set(range(5))


def katz_of(docs, train, k=5):
    """log10 probability of texts by the plain definition."""
    counts, pairs, n = collections.Counter(), collections.Counter(), 0
    for i in train:
        w = docs[i]
        n += 1
        counts.update(w)
        pairs.update(zip(["<s>"] + w[:-1], w))
    total = sum(counts.values())
    d1 = katz.discounts(collections.Counter(counts.values()), k)
    d2 = katz.discounts(collections.Counter(pairs.values()), k)
    less = lambda c, d: d[c - 1] * c if c <= k else c
    mass = sum(less(c, d1) for c in counts.values())
    whole = total if 0 < mass < total - 0.5 else mass + 1
    p1 = {w: less(c, d1) / whole for w, c in counts.items()}
    unseen = 1 - mass / whole
    kept = collections.defaultdict(dict)
    for (v, w), c in pairs.items():
        kept[v][w] = less(c, d2)
    model = {}
    for v, held in kept.items():
        c = n if v == "<s>" else counts[v]
        below = sum(held.values())
        whole = c if below < c - 0.25 else below + 1
        alpha = (1 - below / whole) / (1 - sum(p1[w] for w in held))
        model[v] = ({w: x / whole for w, x in held.items()}, alpha)
        # Exactly normalised: kept followers, all other words, and the unseen class.
        rest = sum(p for w, p in p1.items() if w not in held) + unseen
        assert abs(sum(model[v][0].values()) + alpha * rest - 1) < 1e-9
    out = {}
    for i, w in docs.items():
        log = 0.0
        for v, x in zip(["<s>"] + w[:-1], w):
            held, alpha = model.get(v, ({}, 1.0))
            log += math.log10(held[x] if x in held else alpha * p1.get(x, unseen))
        base = sum(math.log10((counts[x] + 0.1) / (total + 0.1 * (len(counts) + 1))) for x in w)
        out[i] = (len(w), sum(x in counts for x in w), base, log)
    return out, total


def test_katz_query_against_the_definition(spark):
    docs = {
        r.doc_id: brute.words(r.text, True) + ["</s>"]
        for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    }
    held_out = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in docs}
    expected, total = katz_of(docs, [i for i in docs if not held_out[i]])
    rows = QUERIES["op3_katz_scores"](spark, SF_DIR).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, known, base, log = expected[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (n, known, total, held_out[r.doc_id])
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(log, rel=1e-5)
    assert sum(r.score for r in rows if r.held_out) > sum(r.base_score for r in rows if r.held_out)


def test_katz_of_odd_rows(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("abcde") for _ in range(rng.randint(0, 30)))) for i in range(50)]
    rows += [(60, None), (61, ""), (62, "hot " * 3000), (None, "a b")]
    docs = frame(spark, rows)
    model = katz.fit(docs)
    found = {r.doc_id: r for r in katz.score(docs, model).collect()}
    held = {i: brute.words(t, True) + ["</s>"] for i, t in rows}
    expected, _ = katz_of(held, list(held))
    for i, (n, known, base, log) in expected.items():
        assert (found[i].n_tokens, found[i].n_known) == (n, known)
        assert found[i].base_score == pytest.approx(base) and found[i].score == pytest.approx(log, rel=1e-5)
    # One row each for rows that share an id, have none, or are equal.
    again = [(1, "a b c"), (1, "d e"), (1, "d e"), (None, "a"), (None, None), (None, "a"), (1, None)]
    scored = katz.score(frame(spark, again), model).collect()
    expected, _ = katz_of(held | {f"x{j}": brute.words(t, True) + ["</s>"] for j, (_, t) in enumerate(again)}, list(held))
    listed = sorted((str(i), *expected[f"x{j}"][:2], round(expected[f"x{j}"][3], 3)) for j, (i, _) in enumerate(again))
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.score, 3)) for r in scored) == listed
    nothing = katz.fit(docs.filter("false"))
    assert nothing.n == 0
    assert all(r.n_known == 0 and r.base_score == 0 for r in katz.score(docs, nothing).collect())
    assert katz.score(docs.filter("false"), model).collect() == []


def test_katz_scores_one_part_after_another(spark, monkeypatch):
    """The shuffles of all parts were on disk at once."""
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(60))) for i in range(40)]
    docs = frame(spark, rows + rows[:3] + [(50, None), (None, "a b")])
    model = katz.fit(docs.filter("doc_id % 10 != 0"))
    stored, stage = [], katz.stage
    monkeypatch.setattr(katz, "stage", lambda df, name: stored.append(name) or stage(df, name))

    def scores(*size):
        found = katz.score(docs, model, *size).collect()
        return sorted(
            (r.doc_id or -1, r.n_tokens, r.n_known, round(r.base_score, 9), round(r.score, 9))
            for r in found
        )

    whole = scores()
    assert stored == ["shares"] and len(whole) == 45
    # Texts of 5,120 bytes, buckets of 3 tokens.
    assert scores(3) == whole
    assert model.buckets == 64 and stored == ["shares"] * (1 + 5120 // (6 * 3 * 64) + 1)


def test_counting_holds_little_of_a_partition_at_once():
    """Arrays of a task, for 19 MB of text in one batch: 185 MB before parts of it were smaller."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(30_000)]
    texts = pa.array([" ".join(rng.choices(words, k=500)) for _ in range(5_600)])
    batch = pa.RecordBatch.from_arrays([texts], ["text"])
    tracemalloc.start()
    found = [len(b) for b in katz._counted(64)(iter([batch]))]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) > 2 and peak < 100e6


def test_bigrams_of_the_model_are_packed(spark):
    """Every bigram was a row of the model's table, sorted and read once for each part of the texts."""
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randint(0, 300)}" for _ in range(200)) for _ in range(60)]
    held = [brute.words(t, True) for t in texts]
    pairs = {(v, w) for words in held for v, w in zip(["<s>", *words], [*words, "</s>"])}
    model = katz.fit(frame(spark, list(enumerate(texts))), share=0.01)
    cells = model.table.filter("pairs is not null").select("bucket", "pairs", "gains").collect()
    assert len(cells) == len({c.bucket for c in cells}) <= model.buckets
    assert sum(len(c.pairs) // 8 for c in cells) == len(pairs) > 6000
    assert all(len(katz._from_few(c.gains)) == len(c.pairs) // 8 for c in cells)
    assert model.table.filter("v is not null and kept is null").count() < 1500


def test_groups_of_small_and_large_numbers():
    rng = np.random.default_rng(6)
    for most in (5, 1 << 20, 1 << 31):
        v, w = (rng.choice(rng.integers(0, most, 40), 3000).astype(np.uint64) for _ in range(2))
        order, begins = katz._groups(v, w)
        assert (order == np.lexsort((w, v))).all()
        ends = np.append(begins[1:], len(v))
        assert len(begins) == len(set(zip(v.tolist(), w.tolist())))
        assert all(len(set(v[order[a:b]])) == len(set(w[order[a:b]])) == 1 for a, b in zip(begins, ends))
    assert [len(x) for x in katz._groups(v[:0], w[:0])] == [0, 0]


@pytest.mark.parametrize("different", [1, 256, 257, 70_000])
def test_numbers_of_few_values_are_kept(different):
    values = np.random.default_rng(7).permutation(np.arange(80_000) % different) / 7
    assert (katz._from_few(katz._few(values)) == values).all()


def test_tables_dealt_in_parts_are_whole(spark):
    rows = spark.range(1000).select((F.col("id") % 37).alias("bucket"), "id")
    for parts in (1, 2, 5):
        table = stage_bucketed(rows, "parts", "bucket", 8, "id", parts=parts)
        assert sorted(r.id for r in table.collect()) == list(range(1000))
        plan = table.groupBy("bucket").count()._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
