import collections

import pytest
from pyspark.sql import functions as F

from tabloom.functions import hash_order, key_digest
from tabloom.operators import balance, split


def counts(df, label="label"):
    return collections.Counter(r[label] for r in df.collect())


@pytest.fixture(scope="module")
def classes(spark):
    """600 of a, 300 of b, 100 of c."""
    return spark.range(1000).select(
        "id",
        F.when(F.col("id") < 600, "a").when(F.col("id") < 900, "b").otherwise("c").alias("label"),
    )


def lowest(df, label, n):
    rows = df.filter(F.col("label") == label).select("id", key_digest("id").alias("h")).collect()
    return {r["id"] for r in sorted(rows, key=lambda r: (r["h"], r["id"]))[:n]}


def test_undersample_exact(classes):
    found = balance.undersample_majority(classes, mode="exact", key="id")
    assert counts(found) == {"a": 100, "b": 300, "c": 100}
    assert {r["id"] for r in found.filter("label = 'a'").collect()} == lowest(classes, "a", 100)
    pair = balance.undersample_majority(classes, mode="exact", key="id", drop_other=True)
    assert counts(pair) == {"a": 100, "c": 100}
    all_kept = balance.undersample_majority(classes, ratio=0.01, mode="exact", key="id")
    assert counts(all_kept) == counts(classes)


@pytest.mark.parametrize("ratio", [0.05, 0.5, 1.0, 1.25, 30.0])
def test_oversample_exact(classes, ratio):
    found = balance.oversample_minority(classes, ratio=ratio, mode="exact", key="id")
    assert found.columns == classes.columns
    assert counts(found) == {"a": 600, "b": 300, "c": int(600 * ratio)}
    each, extra = divmod(int(600 * ratio), 100)
    copies = collections.Counter(r["id"] for r in found.filter("label = 'c'").collect())
    more = lowest(classes, "c", extra)
    for i in range(900, 1000):
        assert copies[i] == each + (i in more)


def test_many_copies_in_several_steps(classes, monkeypatch):
    monkeypatch.setattr(balance, "_COPIES_PER_TASK", 2)
    monkeypatch.setattr(balance, "_PARTS_PER_STEP", 3)
    rows = classes.filter("id < 6 or id >= 899")
    found = balance.oversample_minority(rows, ratio=5.05, mode="exact", key="id")
    # 101 rows: b once, c a hundred times, a six times
    assert counts(found) == {"a": 6, "b": 505, "c": 100}


def test_sample_modes(classes):
    up = counts(balance.oversample_minority(classes))
    assert up["a"] == 600 and up["b"] == 300 and 500 < up["c"] < 700
    down = counts(balance.undersample_majority(classes))
    assert 60 < down["a"] < 140 and down["b"] == 300 and down["c"] == 100
    assert counts(balance.undersample_majority(classes, ratio=0.1))["a"] == 600
    again = balance.oversample_minority(classes).collect()
    assert again == balance.oversample_minority(classes).collect()


def test_one_class_comes_back(classes):
    one = classes.filter("label = 'a'")
    for mode in ("sample", "exact"):
        assert balance.oversample_minority(one, mode=mode, key="id").count() == 600
        assert balance.undersample_majority(one, mode=mode, key="id").count() == 600


def test_null_is_a_class(spark):
    df = spark.range(90).select("id", F.when(F.col("id") < 80, 1).alias("label"))
    assert counts(balance.oversample_minority(df, mode="exact", key="id")) == {1: 80, None: 80}


def test_wrong_arguments(classes):
    with pytest.raises(ValueError):
        balance.oversample_minority(classes, mode="exact")
    with pytest.raises(ValueError):
        balance.oversample_minority(classes, mode="smote")
    with pytest.raises(ValueError):
        balance.undersample_majority(classes, ratio=0)


def test_hash_ties(spark, monkeypatch):
    """With a coarse hash the digest, and then the key, decides among equal hashes."""
    def coarse(key, start=1):
        return F.floor(hash_order(key) / 2**49).cast("double") if start == 1 else hash_order(key)

    monkeypatch.setattr(balance, "hash_order", coarse)
    df = spark.range(500).select("id", F.lit("a").alias("label"))
    chosen = balance.lowest_by_hash(df, F.lit(True), 500, 123, "id")
    assert {r["id"] for r in df.filter(chosen).collect()} == lowest(df, "a", 123)


def test_key_must_tell_rows_apart(spark):
    df = spark.range(500).select((F.col("id") % 2).alias("k"))
    with pytest.raises(ValueError):
        balance.lowest_by_hash(df, F.lit(True), 500, 100, "k")


def test_hash_split_is_stable(classes):
    parts = split.hash_split(classes, "id", [0.7, 0.2, 0.1])
    again = split.hash_split(classes.repartition(7), "id", [7, 2, 1])
    ids = [{r["id"] for r in p.collect()} for p in parts]
    assert ids == [{r["id"] for r in p.collect()} for p in again]
    assert sum(map(len, ids)) == 1000 and len(set.union(*ids)) == 1000
    assert 650 < len(ids[0]) < 750


def test_split_by_several_keys_and_null(spark):
    df = spark.createDataFrame([(1, None), (1, "a"), (None, None)], "i int, s string")
    parts = split.hash_split(df, ["i", "s"], [0.5, 0.5])
    assert sum(p.count() for p in parts) == 3


def test_folds(classes):
    found = classes.groupBy(split.hash_fold("id", 3).alias("fold")).count().collect()
    assert {r["fold"] for r in found} == {0, 1, 2} and all(270 < r["count"] < 400 for r in found)


def test_top_n(classes):
    assert [r["id"] for r in split.top_n(classes.repartition(5), "id", 3).collect()] == [0, 1, 2]


def test_cached_lets_go(classes):
    with split.cached(classes.filter("id < 5")) as kept:
        assert kept.count() == 5 and kept.is_cached
    assert not kept.is_cached


def test_training_rows_do_not_follow_the_layout(spark):
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    rows = spark.range(3000).select(
        (F.hash("id", F.lit(1)) % 100).cast("double").alias("a"),
        (F.hash("id", F.lit(2)) % 100).cast("double").alias("b"),
        (F.hash("id", F.lit(3)) % 2 == 0).cast("double").alias("label"),
    )
    rows = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows)
    forest = RandomForestClassifier(numTrees=3, maxDepth=3, seed=42)
    found = []
    for data in (rows.coalesce(1), rows.repartition(7)):
        with split.training_rows(data) as kept:
            found.append(forest.fit(kept).featureImportances.toArray().tolist())
    assert found[0] == found[1]


def test_tiny_shares_get_rows_or_raise(spark):
    parts = split.hash_split(spark.range(1_000_000), "id", [0.99999, 0.00001])
    assert 0 < parts[1].count() < 100
    with pytest.raises(ValueError):
        split.hash_split(spark.range(10), "id", [1.0, 1e-12])


def test_exact_samples_of_classes(spark):
    rows = [(i, f"c{i % 40}" if i % 3 else ("hot" if i % 2 else None)) for i in range(6000)]
    df = spark.createDataFrame(rows, "id long, `c.x` string").repartition(6)
    fractions = {f"c{k}": k / 40 for k in range(30)} | {"hot": 0.5, "none": 1.0}
    found = split.sample_classes_exact(df, "c.x", fractions, "id")
    assert found.columns == df.columns
    kept = {tuple(r) for r in found.collect()}
    assert kept <= set(rows)
    sizes, totals = {}, {}
    for _, c in rows:
        totals[c] = totals.get(c, 0) + 1
    for _, c in kept:
        sizes[c] = sizes.get(c, 0) + 1
    expected = {c: int(f * totals.get(c, 0) + 0.5) for c, f in fractions.items()}
    assert sizes == {c: n for c, n in expected.items() if n}
    again = split.sample_classes_exact(df.coalesce(1), "c.x", fractions, "id")
    assert {tuple(r) for r in again.collect()} == kept


def test_exact_samples_need_a_key_and_shares(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("k"), F.lit("a").alias("c"))
    with pytest.raises(ValueError):
        split.sample_classes_exact(df, "c", {"a": 0.3}, "k")
    assert split.sample_classes_exact(df, "c", {"a": 0.5}, "k").count() == 50
    assert split.sample_classes_exact(df, "c", {"a": 0.0}, "k").count() == 0
    assert split.sample_classes_exact(df, "c", {}, "k").count() == 0
    assert split.sample_classes_exact(df.limit(0), "c", {"a": 1.0}, "k").count() == 0
    with pytest.raises(Exception, match="not within 0 and 1"):
        split.sample_classes_exact(df, "c", {"a": 1.5}, "k").collect()


def test_exact_samples_with_repeated_keys(spark):
    # 30 keys of 20 rows each: 12 equal ones and 8 that differ; class b has one key only.
    rows = [(i % 30, "a", max(0, i // 30 - 11)) for i in range(600)] + [(0, "b", 7)] * 40 + [(None, "c", i) for i in range(10)]
    df = spark.createDataFrame(rows, "k long, c string, v long").repartition(5)
    fractions = {"a": 0.395, "b": 0.25, "c": 0.5}
    found = split.sample_classes_exact(df, "c", fractions, "k", repeated=True)
    assert found.columns == df.columns
    kept = collections.Counter(tuple(r) for r in found.collect())
    assert all(n <= collections.Counter(rows)[r] for r, n in kept.items())
    sizes = collections.Counter()
    for (_, c, _), n in kept.items():
        sizes[c] += n
    assert sizes == {"a": 237, "b": 10, "c": 5}
    # Keys are taken whole but for the one where the class is cut.
    of_key = collections.Counter()
    for (k, c, _), n in kept.items():
        of_key[k] += n if c == "a" else 0
    assert sorted(n for n in of_key.values() if n) == [17] + [20] * 11
    again = split.sample_classes_exact(df.coalesce(1), "c", fractions, "k", repeated=True)
    assert collections.Counter(tuple(r) for r in again.collect()) == kept
