"""Mixing, personal data, vectors, URL lists and the pipeline."""

import datetime as dt
import importlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from check import compare, connect
from tabloom.llm import ORACLES, QUERIES, mixing, neighbours, private_data, url_lists
from tests.llm import brute

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, source string, size int, target string, taken int, spans int, _row int"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, s, 1, "t", 2, 3, 4) for i, t, s in rows], DOCS).repartition(3)


def mixed_rows(seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(400):
        source = rng.choice(["a", "b", "b", "b", "b", "B", "é", "", None])
        rows.append((i, "w " * rng.choice([0, 1, 5, 50, 300]), source))
    return [*rows, (400, None, "a"), (401, None, "only empty"), (7, "w w", "b"), (None, "w w w", "b")]


@pytest.mark.parametrize("shard", [100, 1_000_000])
def test_mix_meets_targets(spark, shard):
    rows = mixed_rows()
    docs = docs_of(spark, rows)
    found = mixing.mix(docs, shard_tokens=shard).collect()
    assert len(found) == len(rows)
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(brute.words(text))
    expected, taken = brute.targets(sizes), dict.fromkeys(sizes, 0)
    for r in found:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(expected[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for source, size in sizes.items():
        shards = max(1, size // shard + 1)
        assert abs(taken[source] - expected[source]) <= 16 * shards + 8
    again = mixing.mix(docs.repartition(5), shard_tokens=shard).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_mix_of_nothing(spark):
    assert mixing.mix(docs_of(spark, [])).collect() == []
    rows = mixing.mix(docs_of(spark, [(1, None, "a"), (2, " ", None)])).collect()
    assert [(r.size, r.target, r.taken) for r in rows] == [(0, 0.0, 0)] * 2


def test_seats_are_those_of_one_after_the_other(spark):
    rng = random.Random(5)
    for claims, seats in (
        ([rng.randint(1, 10**6) for _ in range(12)], 500),
        ([10**9] + [4 * 10**5] * 40, 1000),
        ([3, 3, 3], 4),
        ([5, 0, 1], 3),
        ([1.0] * 7, 0),
    ):
        rows = [(i, float(c), seats) for i, c in enumerate(claims)]
        parts = spark.createDataFrame(rows, "i int, claim double, seats long")
        found = mixing.apportion(parts, "claim", "seats", (), ("i",)).orderBy("i").collect()
        assert [r.quota for r in found] == brute.highest_quotients(claims, seats)


TEXTS = [
    None,
    "",
    "mail a.b+c@d-e.co.uk, or x@y or @z.com or q@w.e_r@t.y.",
    "at 1.2.3.4 and 1.2.3.4.5.6.7.8 and 256.1.1.1 and 1.2.3.400 and 000000255.1.1.1 é 1.1.1.1",
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112, 5500 0000 0000 0004-",
    "tel +1 (017) 555-7713 and +49 and +1234567890123456 and ++1 2 3 4 5 6 7 8 9 0.",
    "ü😀 me@here.org 😀 +1 (555) 123-4567 10.0.0.1 4111111111111111",
    "1" * 50_000 + " " + "a" * 50_000 + "@" + " " + "1 2-" * 3000,
    "x@y.z " * 300,
]


def test_base_entities_are_those_of_the_patterns(spark):
    docs = docs_of(spark, [(i, t, "s") for i, t in enumerate(TEXTS)])
    for r in private_data.sanitise(docs).select("text", private_data.described(F.col("spans")).alias("d")).collect():
        assert r.d == brute.personal(r.text)
    assert private_data.sanitise(docs.filter("false")).collect() == []


def test_terms_that_stand_by_an_entity_only_are_found(spark):
    rng = random.Random(2)
    fill = lambda n: " ".join(rng.choice("abcdefgh") * 3 for _ in range(n))
    rows = [(i, f"{fill(9)} Zorblax, {fill(1)} boss@corp.com {fill(9)}", "s") for i in range(6)]
    rows += [(10 + i, fill(40), "s") for i in range(30)]
    rows += [(50, f"{fill(5)} Zorblax, without", "s")]
    # Copies of one text are one surrounding.
    rows += [(60 + i, "Copied name copy@corp.com", "s") for i in range(9)]
    docs = docs_of(spark, rows)
    found = {r.doc_id: r for r in private_data.sanitise(docs, generalise=0.7).collect()}
    for i in range(6):
        kinds = [s.kind for s in found[i].spans]
        assert kinds == [4, 0]
        term = found[i].spans[0]
        assert found[i].text[term.start : term.end] == "Zorblax,"
    assert not found[50].spans and all(len(found[60 + i].spans) == 1 for i in range(9))
    clean = private_data.sanitise(docs, generalise=0.7).select(
        "doc_id", private_data.cleaned(F.col("text"), F.col("spans")).alias("clean"), "text"
    )
    for r in clean.collect():
        if r.doc_id < 6:
            assert "Zorblax" not in r.clean and "[EMAIL]" in r.clean and "corp" not in r.clean
        elif r.doc_id < 60:
            assert r.clean == r.text


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, part int, rank int")


def test_neighbours_against_all_pairs(spark):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((12, 16))
    x = (centres[rng.integers(0, 12, 2000)] + 0.3 * rng.standard_normal((2000, 16))).astype(np.float32)
    x[500:1200] = x[500]  # a vector that is very common
    docs = vectors(spark, [(i, v.tolist(), 1, 2) for i, v in enumerate(x)])
    found = neighbours.search(
        docs, docs.filter("vec_id % 20 = 0"), parts=8, block_rows=300, block_queries=7
    ).toPandas()
    wide = x.astype(np.float64)
    hits = 0
    for i in range(0, 2000, 20):
        score = (wide * wide[i]).sum(1)
        score[i] = -np.inf
        best = np.lexsort((np.arange(2000), -score))[:20]
        mine = found[found.query_id == i].sort_values("rank")
        assert list(mine["rank"]) == list(range(1, 21))
        assert np.allclose(mine.score, [(wide[v] * wide[i]).sum() for v in mine.vec_id], atol=0, rtol=1e-15)
        hits += len(set(best) & set(mine.vec_id))
    assert hits / 2000 > 0.9
    # Ties go to the least ids.
    assert list(found[found.query_id == 600].sort_values("rank").vec_id) == list(range(500, 520))


def test_odd_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1, 1), (1, [0.5, 0.5], 1, 1), (2, None, 1, 1), (3, [0.0, 0.0], 1, 1),
        (4, [nan, 1.0], 1, 1), (5, [inf, 1.0], 1, 1), (6, [None, 1.0], 1, 1), (7, [], 1, 1),
        (8, [1.0, 0.0], 1, 1), (9, [-1.0, 0.0], 1, 1),
    ]
    docs = vectors(spark, rows)
    found = neighbours.search(docs, docs.filter("vec_id in (0, 3)")).orderBy("rank").collect()
    assert [(r.query_id, r.vec_id, r.score) for r in found] == [(0, 8, 1.0), (0, 1, 0.5), (0, 9, -1.0)]
    assert neighbours.search(docs.filter("false"), docs.filter("false")).collect() == []


def test_further_parts_are_asked_until_there_are_enough(spark):
    rng = np.random.default_rng(2)
    # A few vectors far from all others, fewer than are asked for.
    x = rng.standard_normal((1500, 8)).astype(np.float32)
    x[:5] = 50 + rng.standard_normal((5, 8))
    rows = [(i, v.tolist(), 1, 2) for i, v in enumerate(x)] + [(9000, [1.0, 2.0], 1, 2), (9001, [1.0] * 9, 1, 2)]
    docs = vectors(spark, rows)
    found = neighbours.search(docs, docs.filter("vec_id < 5"), parts=8, recall=0.01).toPandas()
    assert all(list(found[found.query_id == i].sort_values("rank")["rank"]) == list(range(1, 21)) for i in range(5))
    assert not set(found.vec_id) & {9000, 9001}


def test_long_paths_make_no_more_patterns_than_are_listed(spark):
    url = "http://b.com/" + "/".join(f"s{i}" for i in range(6000))
    rows = spark.createDataFrame([(url,)], "url string")
    held = rows.select(url_lists.patterns(F.col("url"), 3).alias("p")).first().p
    assert held == ["b.com", "com", "b.com/s0", "b.com/s0/s1", "b.com/s0/s1/s2"]
    assert rows.select(url_lists.patterns(F.col("url"), 0).alias("p")).first().p == ["b.com", "com"]


def test_shards_have_few_rows(spark):
    rows = [(i, "w" if i % 3 else None, "s") for i in range(3000)]
    docs = docs_of(spark, rows)
    found = mixing.mix(docs, shard_rows=100).collect()
    assert len(found) == 3000 and abs(sum(r.taken for r in found) - found[0].target) <= 16 * 31
    assert sorted(map(str, mixing.mix(docs.repartition(7), shard_rows=100).collect())) == sorted(map(str, found))


def test_url_lists_with_odd_rows(spark):
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    captures = spark.createDataFrame(
        [
            (1, "http://a.B.com:80/x/y?q", day(10), 0), (2, "https://u@b.com", day(40), 0),
            (3, "http://b.com/x/yy", day(10), 0), (4, None, day(10), 0), (5, "nonsense", day(10), 0),
            (6, "http://b.com/", None, 0), (7, "http://bb.com/", day(10), 0), (None, "http://b.com/", day(10), 0),
            (1, "http://zzz.org/", day(10), 0), (8, "http://b.com/x/y", day(20), 0),
        ],
        "page_id long, url string, fetched timestamp_ntz, n_entries int",
    )
    entries = spark.createDataFrame(
        [
            ("b.com", "add", day(5), 1), ("b.com", "add", day(6), 1), ("b.com", "remove", day(20), 1),
            ("b.com", "add", day(20), 1), ("b.com/x/y", "add", day(0), 1), ("a.b.com/x", "add", day(10), 1),
            (None, "add", day(0), 1), ("bb.com", "add", None, 1), ("never.com", "remove", day(0), 1),
        ],
        "pattern string, action string, dated timestamp_ntz, page_id int",
    )
    found = {r.page_id: (r.n_entries, r.pattern) for r in url_lists.in_force(captures, entries).collect()}
    assert found == {
        1: (2, "a.b.com/x"), 2: (0, None), 3: (1, "b.com"), 4: (0, None), 5: (0, None),
        6: (0, None), 7: (0, None), None: (1, "b.com"), 8: (1, "b.com/x/y"),
    }
    assert url_lists.in_force(captures.filter("false"), entries).collect() == []
    assert url_lists.in_force(captures, entries.filter("false")).filter("n_entries > 0").collect() == []


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_with_sql(spark, name):
    con = connect(SF_DIR)
    found = QUERIES[name](spark, SF_DIR).toArrow()
    assert compare(found, con.sql(ORACLES[name]).to_arrow_table()) is None


def test_pipeline_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").withColumn("score", F.lit("kept"))
    first = docs
    shapes = []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, SF_DIR).write.parquet(path := f"{tmp_path}/{len(shapes)}")
        docs = spark.read.parquet(path)
        shapes.append(docs.columns)
        rows = [(r.doc_id, r.text) for r in before.collect()]
        if name == "n-gram Jaccard join":
            expected = {i for i, (_, c) in brute.classes(rows, 5, 80).items() if i == c}
            assert {r.doc_id for r in docs.collect()} == expected
        elif name == "benchmark decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
            held = {d for d, _ in brute.contaminated(rows, items)}
            assert {r.doc_id for r in docs.collect()} == {i for i, _ in rows} - held
        elif name == "personal data":
            after = {r.doc_id: r for r in docs.collect()}
            assert set(after) == {i for i, _ in rows}
            for i, text in rows:
                assert not brute.personal(after[i].text) or brute.personal(text)
                assert (after[i].text == text) == (not brute.personal(text))
                assert after[i].n_chars == len(after[i].text)
    assert all(s == first.columns for s in shapes[:-1])
    assert docs.columns == ["doc_id", "source", "size", "source_size", "target", "taken"]


def test_pipeline_of_odd_rows(spark):
    shape = "doc_id long, text string, lang string, source string, n_chars long, key int, spans int, `a.b` int"
    rows = [
        (1, None, "en", None, None, 1, 1, 1), (2, "", None, "s", 0, 1, 1, 1),
        (3, "some words of a text " * 9, "en", "s", 9, 1, 1, 1),
        (3, "some words of a text " * 9, "en", "s", 9, 1, 1, 1),
        (None, "words without an id but a mail a@b.cd " * 4, "en", "s", 9, 1, 1, 1),
    ]
    docs = spark.createDataFrame(rows, shape)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        whole, none = stage(spark, docs, SF_DIR), stage(spark, docs.filter("false"), SF_DIR)
        assert whole.columns == docs.columns == none.columns
        assert whole.count() <= 5 and none.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() == 5


def test_nothing_else_imports_the_subpackage():
    import pathlib

    import tabloom

    for path in pathlib.Path(tabloom.__file__).parent.rglob("*.py"):
        if "llm" not in path.parts:
            assert "llm" not in path.read_text(), path
    assert importlib.import_module("__spark_entry__").queries().keys() >= QUERIES.keys()
