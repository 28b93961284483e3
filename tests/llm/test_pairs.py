"""Joins of documents: near copies, repeated passages, benchmark passages."""

import random

import pytest
from pyspark.sql import functions as F

from tabloom import workspace
from tabloom.llm import decontaminate, graph, jaccard, substrings
from tests.llm import brute

SF_DIR = "/root/testdata/sf0.001"
SHAPE = "doc_id long, text string, key string, region int, score double"


def family(seed=1, copies=40, size=120, edits=12):
    """Edited copies of one text, exact copies, and texts of other kinds."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    base = [word() for _ in range(size)]
    rows = [" ".join(base)] * 3
    for _ in range(copies):
        text = list(base)
        for _ in range(rng.randint(0, edits)):
            text[rng.randrange(size)] = word()
        rows.append(" ".join(text))
    common = " ".join(word() for _ in range(30))
    rows += [common + " " + " ".join(word() for _ in range(rng.randint(0, 60))) for _ in range(20)]
    rows += ["", None, "  \t\n", "one", "ONE", "one two", "one  two", "a b c", "A b\tc", "x" * 200_000]
    rows += [" ".join(["again"] * 5000), " ".join(["again"] * 4000)]
    return list(enumerate(rows))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "k", 1, 0.5) for i, t in rows], SHAPE).repartition(3)


@pytest.mark.parametrize(("width", "percent", "leaf"), [(3, 90, 32), (3, 90, 1), (5, 80, 4)])
def test_classes_are_those_of_all_pairs(spark, width, percent, leaf):
    rows = family()
    found = jaccard.link_classes(frame(spark, rows), width, percent, leaf).collect()
    expected = brute.classes(rows, width, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected


@pytest.mark.parametrize("percent", [80, 90])
def test_large_sets(spark, percent):
    """Sets with finer parities, of one and of neighbouring sizes, near and apart."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(4300)]
    rows = []
    for size in (1900, 2040, 2200, 3900, 4090, 4100, 4300):
        for edits in (0, 5, 60, 150):
            text = base[:size]
            for _ in range(edits):
                text[rng.randrange(size)] = f"e{rng.randrange(10**9)}"
            rows.append(" ".join(text))
    rows += [" ".join([f"v{k}x{i}" for i in range(2500)] + base[:400]) for k in range(4)]
    rows = list(enumerate(rows))
    found = jaccard.link_classes(frame(spark, rows), 3, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute.classes(rows, 3, percent)


def test_cells_that_pivots_do_not_cut_are_not_compared_with_them(spark, monkeypatch):
    """Edited copies that are all as far from each other: no link, no class, many common regions."""
    rng = random.Random(5)
    base, rows = [f"w{i}" for i in range(150)], []
    for _ in range(300):
        text = list(base)
        for _ in range(8):
            text[rng.randrange(150)] = f"e{rng.randrange(10**9)}"
        rows.append(" ".join(text))
    rows = list(enumerate(rows))
    pairs, parted = [], jaccard._parted
    monkeypatch.setattr(jaccard, "_parted", lambda p, *a: pairs.append(p.count()) or parted(p, *a))
    found = jaccard.link_classes(frame(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute.classes(rows, 3, 90)
    # 13,182 when all members met all pivots.
    assert sum(pairs) < 25 * len(rows), pairs


def test_texts_and_not_their_sets_are_dealt_by_key(spark, monkeypatch):
    plans, written = [], jaccard.stage_bucketed

    def kept(df, *args, **named):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return written(df, *args, **named)

    monkeypatch.setattr(jaccard, "stage_bucketed", kept)
    jaccard.link_classes(frame(spark, family(copies=5))).collect()
    # The outermost operator comes first.
    assert plans and all(p.index("MapInArrow") < p.index("RepartitionByExpression") for p in plans)


def test_only_the_classes_stay_on_disk(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workspace, "shared_dir", lambda _: str(tmp_path))
    classes = jaccard.link_classes(frame(spark, family(copies=5)))
    # Sets and all tables between stayed before.
    assert [p.name.split("-")[0] for p in (tmp_path / "tabloom").iterdir()] == ["classes"]
    assert classes.count() == len(family(copies=5))


@pytest.mark.parametrize("few", [0, 1 << 17])
def test_components_with_and_without_shuffles(spark, monkeypatch, few):
    monkeypatch.setattr(graph, "FEW", few)
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 430)]
    edges += edges[:20] + [(7, 7)]
    least = {n: n for e in edges if e[0] != e[1] for n in e}
    for _ in least:
        for a, b in edges:
            if a != b:
                least[a] = least[b] = min(least[a], least[b])
    found = graph.components(spark.createDataFrame(edges, "a long, b long").repartition(4))
    assert sorted(map(tuple, found.collect())) == sorted(least.items())
    assert graph.components(found.select("node", "component").toDF("a", "b").limit(0)).collect() == []
    # One file is written without shuffles.
    assert few == 0 or len(found.inputFiles()) == 1


@pytest.mark.parametrize("percent", [60, 80, 90, 97])
def test_linked_sizes_lie_in_cells_that_meet(percent):
    cells = jaccard._cells(percent, 100_000)
    for small in range(1, 400):
        large = small * 100 // percent
        low = cells.searchsorted(small, "right")
        assert cells.searchsorted(large, "right") - low in (0, 1)


def test_classes_of_odd_rows(spark):
    assert jaccard.link_classes(frame(spark, [])).collect() == []
    rows = [(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (2, None)]
    found = jaccard.link_classes(frame(spark, rows)).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in found) == [
        (0, 2, 1), (1, 2, 1), (1, 2, 1), (2, 0, 2)
    ]


def passages(seed=2):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghijkl") * rng.randint(1, 3)
    shared = [[word() for _ in range(rng.randint(10, 70))] for _ in range(4)]
    rows = []
    for i in range(60):
        text = [word() for _ in range(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            text += rng.choice(shared) + [word() for _ in range(rng.randint(0, 5))]
        rows.append((i, " \n".join(text)))
    rows += [(60, None), (61, ""), (62, "ä" * 100_000), (63, "same " * 3000), (64, "same " * 20)]
    return rows


@pytest.mark.parametrize("width", [3, 13])
def test_repeats_are_those_of_all_windows(spark, width):
    rows = passages()
    found = substrings.drop_repeats(frame(spark, rows), width, min(3, width)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in found} == brute.without_repeats(
        rows, width
    )


def test_repeats_of_odd_rows(spark):
    text = " ".join(map(str, range(20)))
    rows = [(5, text), (5, text), (7, text), (None, text), (None, "short")]
    found = substrings.drop_repeats(frame(spark, rows)).collect()
    # Rows of the first id lose nothing; a text without an id comes last.
    assert sorted((r.doc_id or 9, r.n_removed) for r in found) == [
        (5, 0), (5, 0), (7, 20), (9, 0), (9, 20)
    ]
    assert substrings.drop_repeats(frame(spark, [])).collect() == []


def items_and_documents():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    items = [(i, " ".join(word() for _ in range(rng.randint(14, 59)))) for i in range(12)]
    rows = []
    for i in range(60):
        held = rng.choice(items)[1].split()
        for _ in range(rng.randint(0, 2)):
            held[rng.choice([0, 1, -1, -2, len(held) // 2])] = word()
        if i % 3 == 0:
            held = [w.upper() for w in held]
        text = [word() for _ in range(rng.randint(0, 50))] + held
        rows.append((i, " ".join(text + [word() for _ in range(rng.randint(0, 50))])))
    rows += [(100, None), (101, ""), (102, "a b"), (103, items[0][1]), (103, "other text")]
    return rows, [*items, (50, "too short"), (51, None), (1, items[1][1])]


def test_benchmark_passages_are_those_of_all_windows(spark):
    rows, items = items_and_documents()
    table = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_items(frame(spark, rows), table).collect()
    expected = brute.contaminated(rows, [x for x in items if x[1]])
    assert {(r.doc_id, r.item_id) for r in found} == set(expected)
    assert all(abs(r.similarity - expected[r.doc_id, r.item_id]) < 1e-12 for r in found)
    assert len(expected) > 20


def test_clean_rows_stay_whatever_their_id(spark):
    rows, items = items_and_documents()
    rows += [(None, items[2][1]), (None, "clean text of its own")]
    table = spark.createDataFrame(items, "item_id long, text string")
    docs = frame(spark, rows)
    kept = decontaminate.without_items(docs, table)
    assert kept.columns == docs.columns
    held = {(r.doc_id, r.text) for r in kept.collect()}
    assert (103, "other text") in held and (103, items[0][1]) not in held
    assert (None, "clean text of its own") in held and (None, items[2][1]) not in held
    none = table.filter("false")
    assert decontaminate.without_items(docs, none).count() == len(rows)
    assert decontaminate.find_items(docs.filter("false"), table).count() == 0


def test_large_benchmarks_are_joined_by_shuffle(spark, monkeypatch):
    rows, items = items_and_documents()
    table = spark.createDataFrame(items, "item_id long, text string")
    docs = frame(spark, rows)
    expected = {tuple(r) for r in decontaminate.find_items(docs, table).collect()}
    monkeypatch.setattr(decontaminate, "MOST_BROADCAST", 1)
    assert {tuple(r) for r in decontaminate.find_items(docs, table).collect()} == expected


def test_simhash_bits_are_majorities(spark):
    row = spark.range(1).select(
        decontaminate.simhash(F.array(*[F.lit(x).cast("long") for x in (1, 3, -1)])).alias("x"),
        decontaminate.simhash(F.array(F.lit(-5).cast("long"))).alias("y"),
    )
    assert tuple(row.head()) == (3, -5)
