"""Documents to a training mix: the stages in order, each written and read again as Parquet.

Every stage but the last returns the columns of documents; columns besides ``doc_id``, ``text``
and ``n_chars`` pass unread, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm import decontaminate, jaccard, mixing, private_data, quality
from tabloom.workspace import new_path


def _packed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text``, and all other columns in one, so that no name can clash."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    return docs.select("doc_id", "text", F.struct(*rest).alias("_rest"))


def _unpacked(packed: DataFrame, columns: list[str]) -> DataFrame:
    return packed.select(
        *[F.col("text") if c == "text" else F.col("_rest").getField(c).alias(c) for c in columns]
    )


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality ranking accepts. Learned from all labels."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, labels.select("doc_id", F.col("quality").alias("good")))
    scored = quality.score(_packed(docs), model, ("text", "_rest"))
    kept = scored.filter(quality.accepted(F.col("score"), model.cut) == 1)
    return _unpacked(kept, docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of linked rows, the one with the least id.

    Near copies of the pipeline take five words and a similarity of 0.8. Rows are judged one by
    one by their own texts, whatever other rows share their id; rows without an id come last, by
    a hash of the text. Of rows with equal id and text, one stays.
    """
    row = F.xxhash64(docs["doc_id"], docs["text"])
    classes = jaccard.link_classes(docs.select(row.alias("doc_id"), "text"), width=5, percent=80)
    ids = docs.select(row.alias("_row"), F.col("doc_id").alias("_id")).distinct()
    first = (
        classes.select(F.col("doc_id").alias("_row"), "component_id")
        .distinct()
        .join(ids, "_row")
        .groupBy("component_id")
        .agg(F.min(F.struct(F.isnull("_id").alias("_none"), "_id", "_row")).alias("_least"))
        .select(F.col("_least._row").alias("_first"))
    )
    packed = _packed(docs).withColumn("_row", row)
    kept = packed.join(first, F.col("_row") == F.col("_first")).dropDuplicates(["_row"])
    return _unpacked(kept, docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage like an item of the benchmark."""
    return decontaminate.without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and what gives it away replaced in the text."""
    found = private_data.sanitise(_packed(docs), everywhere=True)
    text = private_data.cleaned(F.col("text"), F.col("spans"))
    clean = _unpacked(found.withColumn("text", text), docs.columns)
    if "n_chars" not in docs.columns:
        return clean
    kind = docs.schema["n_chars"].dataType
    return clean.withColumn("n_chars", F.length("text").cast(kind))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that each document gives to the mix."""
    return mixing.mix(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", keep_one_of_near_copies),
    ("benchmark decontamination", drop_benchmark),
    ("personal data", sanitise),
    ("mixing sources", mix_sources),
]

# Learned scores and seeded choices have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``: one row per kept document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
