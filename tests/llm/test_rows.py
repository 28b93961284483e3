"""Rows that share an id, or have none, are judged by their own texts."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from tabloom.llm import jaccard, substrings

SHAPE = "doc_id long, text string, source string"


def texts(n, size=60):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    return [" ".join(word() for _ in range(size)) for _ in range(n)]


def test_sets_are_those_of_their_own_texts(spark):
    # Twelve texts share id 100, six have no id; each has a near copy with an id of its own.
    made = texts(19)
    rows = [(100 if i < 12 else None, t, "s") for i, t in enumerate(made[:18])]
    rows += [(i, t + " more", "s") for i, t in enumerate(made[:18])]
    # Near copies of which none has an id.
    rows += [(None, made[18], "s"), (None, made[18] + " more", "s")]
    docs = spark.createDataFrame(rows, SHAPE).repartition(5)
    found = sorted(
        ((r.doc_id, r.component_id) for r in jaccard.link_classes(docs).collect()), key=str
    )
    expected = [(100, i) for i in range(12)] + [(None, i) for i in range(12, 18)]
    expected += [(i, i) for i in range(18)] + [(None, None)] * 2
    assert found == sorted(expected, key=str)


def test_clean_rows_of_an_id_outlive_its_near_copies(spark):
    made = texts(40)
    rows = [(5, made[0] + " more", "copy"), (5, made[1], "clean"), (3, made[0], "first")]
    rows += [(7, t, "shared id") for t in made[2:30]] + [(7, made[2], "again")]
    rows += [(None, t, "none") for t in made[30:]] + [(None, made[1] + " more", "copy")]
    docs = spark.createDataFrame(rows, SHAPE).withColumn("n_chars", F.length("text")).repartition(5)
    kept = corpus_pipeline.keep_one_of_near_copies(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted((r.text for r in kept.collect())) == sorted(made)


def test_rows_of_equal_short_hashes_keep_their_own_words(spark):
    """Texts without an id whose 32-bit hashes agree lose only what others hold."""
    rows = spark.range(400_000).select(F.concat_ws(" ", *[F.concat(F.lit(f"w{k}x"), "id") for k in range(20)]).alias("text"))
    twins = rows.groupBy(F.hash("text").alias("h")).agg(F.collect_list("text").alias("t")).filter("size(t) > 1").first()
    assert twins is not None
    one, other = twins.t[:2]
    docs = spark.createDataFrame([(1, one), (None, one), (None, other)], "doc_id long, text string")
    found = {(r.doc_id, r.kept == ""): r.n_removed for r in substrings.drop_repeats(docs).collect()}
    assert found == {(1, False): 0, (None, True): 20, (None, False): 0}
