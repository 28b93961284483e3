"""Periodic runs against brute force over all lags."""

import random
import zlib

import pytest

from tabloom.llm import QUERIES, runs
from tests.llm import brute

SHAPE = "doc_id long, text string, n_words int, runs int, collapsed string, source string"


def all_runs(words, shortest=12):
    """(start, length, period) of maximal stretches at every lag, with their smallest period."""
    found = {}
    for lag in range(1, len(words) // 2 + 1):
        i = lag
        while i < len(words):
            begin = i
            while i < len(words) and words[i] == words[i - lag]:
                i += 1
            if i - begin >= max(shortest - lag, lag):
                found.setdefault((begin - lag, i - begin + lag), lag)
            i += i == begin
    return sorted((s, n, p) for (s, n), p in found.items())


def collapsed(words, found):
    gone = {i for s, n, p in found for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def made(rng):
    letters = "abcdefghijklmnopqrstuvwxyz"[: rng.choice([1, 2, 2, 3, 5, 26])]
    size, words = rng.randint(0, rng.choice([15, 60, 300])), []
    while len(words) < size:
        kind = rng.random()
        if kind < 0.4 or not words:
            words += [rng.choice(letters) for _ in range(rng.randint(1, 20))]
        elif kind < 0.8:
            words += words[-rng.randint(1, min(len(words), 60)) :] * rng.randint(1, 4)
        else:
            at = rng.randrange(len(words))
            words += words[at : at + rng.randint(1, 50)]
    return " ".join(words[:size])


@pytest.mark.parametrize("shortest", [4, 12, 30])
def test_runs_are_those_of_all_lags(spark, shortest):
    rng = random.Random(shortest)
    rows = [(i, made(rng)) for i in range(300)]
    rows += [(None, None), (None, ""), (5, " \t\n "), (5, "x " * 40), (7, "\ta b\n" * 30 + "é " * 13)]
    rows += [(900, "no line ends here" + "\x85" + "w " * 30), (901, "A a " * 12), (902, "A a " * 3)]
    docs = spark.createDataFrame([(i, t, 1, 2, "c", "s") for i, t in rows], SHAPE).repartition(3)
    result = runs.collapse(docs, shortest)
    assert result.columns == ["doc_id", "n_words", "runs", "collapsed"]
    found = sorted(
        (str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in result.collect()
    )
    expected = []
    for i, text in rows:
        w = brute.words(text)
        held = all_runs(w, shortest)
        order = sorted(held, key=lambda r: (r[0], r[2]))
        expected.append((str(i), len(w), order, collapsed(w, held)))
    assert found == sorted(expected)


def test_long_texts_that_repeat_take_little_time(spark):
    one, broken = "w " * 400_000, "w " * 150_000 + "x " + "w " * 150_000
    rare = " ".join(str(i) for i in range(200_000))
    docs = spark.createDataFrame([(1, one), (2, broken), (3, rare), (4, rare + " " + rare)], "doc_id long, text string")
    found = {r.doc_id: [tuple(x) for x in r.runs] for r in runs.collapse(docs).collect()}
    assert found[1] == [(0, 400_000, 1)]
    assert found[2] == [(0, 150_000, 1), (150_001, 150_000, 1)]
    assert found[3] == [] and found[4] == [(0, 400_000, 200_000)]


def test_nothing(spark):
    assert runs.collapse(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query_against_the_definition(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, made(rng) or None, "s") for i in range(120)]
    rows += [(i, " ".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 80))), "s") for i in range(200, 500)]
    rows += [(None, "a b " * 20, "s"), (200, "", "s")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(
        str(tmp_path / "documents.parquet")
    )
    result = QUERIES["op12_periodic_runs"](spark, str(tmp_path))
    expected, changed = [], 0
    for i, text, _ in rows:
        w = brute.words(text)
        h = None if i is None else zlib.crc32(str(i).encode())
        if w and h is not None and h % 10 == 0:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w, changed = [w[a + (k - a) % p] if k >= a else w[k] for k in range(n)], changed + 1
        held = sorted(all_runs(w), key=lambda r: (r[0], r[2]))
        first = min(held, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        expected.append((
            i,
            len(held),
            *first,
            None if first[0] is None else 1000 * first[1] // first[2],
            brute.sha("".join(f"{s},{n},{p}\n" for s, n, p in held)),
            brute.sha(collapsed(w, held)),
        ))
    assert changed > 20
    assert sorted(map(tuple, result.collect()), key=str) == sorted(expected, key=str)
    kinds = [d for _, d in result.dtypes]
    assert kinds == ["bigint"] * 6 + ["string"] * 2
