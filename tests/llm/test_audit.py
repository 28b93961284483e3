"""The filter audit against going through the documents in every order."""

import itertools
import random

import pytest

from tabloom.llm import QUERIES, audit
from tests.llm import brute

SHAPE = "doc_id long, text string, source string, row int, part string, n int, good int, mask int"


def fails(rows):
    """For each row the filters it fails."""
    out = []
    for doc_id, text, _ in rows:
        text, w = text or "", brute.words(text)
        held = set()
        if len(w) < 200:
            held.add("A")
        if 100 * len(set(w)) < 50 * len(w):
            held.add("B")
        if 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text):
            held.add("C")
        if set(text) & set("#$%&*|"):
            held.add("D")
        if doc_id is not None and any(
            i is not None and i < doc_id and (t or "") == text for i, t, _ in rows
        ):
            held.add("E")
        out.append(held)
    return out


def audited(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    held, out, shapley = fails(rows), {}, {}
    parts = {s or "" for _, _, s in rows}
    for order in itertools.permutations("ABCDE"):
        for part in parts:
            left = [(i, f) for (i, _, s), f in zip(rows, held) if (s or "") == part]
            gone = []
            for step, x in enumerate(order, 1):
                removed = [(i, f) for i, f in left if x in f]
                redundant = sum(x in f for _, f in gone)
                left, gone = [r for r in left if x not in r[1]], gone + removed
                shapley[part, x] = shapley.get((part, x), 0) + len(removed)
                out[part, "".join(order), step] = (
                    len(left),
                    len(removed),
                    redundant,
                    sum(f == {x} for (_, _, s), f in zip(rows, held) if (s or "") == part),
                    sum(i in good for i, _ in removed),
                    sum(i in toxic for i, _ in removed),
                )
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def cases(seed, n=150):
    rng = random.Random(seed)
    texts = [None, "", " ", "A" * 30, "one #", "same " * 250, "w", "É é $"]
    for _ in range(40):
        size = rng.choice([3, 199, 200, 201, 260])
        words = [rng.choice(["word", "Word", "x", "é"]) + str(rng.randrange(rng.choice([3, 90, 900]))) for _ in range(size)]
        texts.append(" ".join(words) + rng.choice(["", " |", " #", "\n"]))
    ids = [None, None, 3, 3, 3, *range(100)]
    rows = [(rng.choice(ids), rng.choice(texts), rng.choice(["a", "a", "b", "", None])) for _ in range(n)]
    rows += [(7, "copy copy", "a")] * 40 + [(8, "copy copy", None)] * 40
    labels = [(rng.choice([None, *range(100)]), rng.choice([0, 1, None]), rng.choice([0, 1])) for _ in range(80)]
    return rows, labels


def frames(spark, rows, labels):
    docs = spark.createDataFrame([(*r, 1, "p", 2, 3, 4) for r in rows], SHAPE).repartition(4)
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("seed, hot", [(1, 0.001), (2, 0.2), (3, 2.0)])
def test_audit_is_going_through_all_orders(spark, monkeypatch, seed, hot):
    monkeypatch.setattr(audit, "HOT_SHARE", hot)
    rows, labels = cases(seed)
    found = audit.five_filters(*frames(spark, rows, labels)).collect()
    expected = audited(rows, labels)
    assert len(found) == len(expected) == 600 * len({s or "" for _, _, s in rows})
    assert {tuple(r)[:3]: tuple(r)[3:] for r in found} == expected


def test_audit_of_nothing(spark):
    assert audit.five_filters(*frames(spark, [], [])).collect() == []
    rows = [(1, None, None)]
    found = audit.five_filters(*frames(spark, rows, [])).collect()
    assert {tuple(r)[:3]: tuple(r)[3:] for r in found} == audited(rows, [])


def test_query_types(spark):
    found = QUERIES["op13_filter_audit"](spark, "/root/testdata/sf0.001")
    assert found.dtypes[:3] == [("part", "string"), ("filter_order", "string"), ("step", "int")]
    assert {kind for _, kind in found.dtypes[3:]} == {"bigint"}
