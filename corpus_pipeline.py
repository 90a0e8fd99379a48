"""From raw documents to training ids, in stages that are each written and read again.

Each stage takes (spark, docs, sf_dir), works on all documents its predecessor
kept and returns the columns of documents, but for the last one, which returns
ids. ``run`` applies them to the documents of a folder.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doselens.llm import bpe, jaccard, language, mixing, toxicity
from doselens.llm.common import held_out, materialize

BATCH_ROWS = 600
"""Rows of a batch that goes to a Python worker, in the stages that send whole texts.

Spark's 10,000 hold all texts of a task, once more in the executor and once more in the worker.
"""


def small_batches(spark: SparkSession) -> None:
    """From now on batches hold few texts; a smaller limit that the session has stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)


def keep_recognised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned; those without letters or likeness go."""
    small_batches(spark)
    bundles = language.learn(docs.where(~held_out(F.col("doc_id"))))
    found = language.identify(docs, bundles)
    return found.where(language.recognised()).select(docs.columns)


def keep_harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not find toxic."""
    small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.learn(docs, labels.where(~held_out(F.col("doc_id"))))
    return toxicity.add_scores(docs, model).where("predicted = 0").select(docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near copies.

    Documents with a null id are in no group and stay. Of rows that share an id, one stays.
    """
    found = jaccard.jaccard_components(docs).where("doc_id is not null")
    counted = found.groupBy("doc_id").agg(
        F.min("component_id").alias("component"), F.count("*").alias("rows")
    )
    # Written, so that the planner knows how small this is.
    touched = materialize(counted.where("component != doc_id or rows > 1"), "near-copies")
    kept = docs.join(touched.select("doc_id"), "doc_id", "left_anti").select(docs.columns)
    repeated = touched.where("component = doc_id").select("doc_id")
    if not repeated.isEmpty():
        first = docs.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
        kept = kept.unionByName(first.select(docs.columns))
    return kept


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents as often as the mix of sources takes them: none to three times."""
    mixed = mixing.mix(docs).groupBy(F.col("doc_id").alias("_id")).agg(F.max("copies").alias("_copies"))
    joined = docs.join(mixed.where("_copies > 0"), F.col("doc_id").eqNullSafe(F.col("_id")))
    copies = F.explode(F.sequence(F.lit(1), F.col("_copies")))
    return joined.withColumn("_copy", copies).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document, and whether decoding them gives the text again."""
    small_batches(spark)
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    chosen = docs.select(
        "doc_id", "source", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256")
    )
    # One worker with small tables that go with their task: the executors did other stages before.
    decoded = bpe.encode_and_decode(
        chosen, vocabulary, public_tokenizers.PATTERN, drop_text=True, states=80_000, pieces=80_000
    )
    return decoded.select(
        "doc_id",
        "source",
        "ids",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        (F.sha2("decoded", 256) == F.col("text_sha256")).alias("round_trip"),
    )


STAGES = [
    ("language", keep_recognised),
    ("toxicity", keep_harmless),
    ("near copies", keep_one_of_each),
    ("mixing", mix_sources),
    ("ids", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
