"""The registered queries: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doselens.llm import bpe, chat, digest, infill, jaccard, language, mixing, negatives, oracles, quality, shards
from doselens.llm import template, toxicity, unigram
from doselens.llm.common import held_out


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def op1_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document under a Jaccard similarity of 0.8 of word shingles."""
    return jaccard.jaccard_components(_table(spark, sf_dir, "documents", "doc_id", "text"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes every text, decodes the ids, and shows both by length and digest."""
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    documents = _table(spark, sf_dir, "documents", "doc_id", "text")
    coded = bpe.encode(documents, vocabulary, public_tokenizers.PATTERN, drop_text=True)
    decoded = bpe.decode(coded, vocabulary)
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2(F.col("ids"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digest of every text beside those of its edited text and its neighbour."""
    return digest.compare_neighbours(_table(spark, sf_dir, "documents", "doc_id", "text"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number of unigram pieces of every text and the score of that segmentation."""
    documents = _table(spark, sf_dir, "documents", "doc_id", "text")
    counted = unigram.add_counts(documents, public_tokenizers.path("piece_bpe_32k.model"))
    return counted.select("doc_id", "n_tokens", "best_score")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores every text after learning from the labels that are not held out."""
    documents = _table(spark, sf_dir, "documents", "doc_id", "text")
    labels = _table(spark, sf_dir, "labels", "doc_id", "toxic")
    model = toxicity.learn(documents, labels.where(~held_out(F.col("doc_id"))))
    scored = toxicity.add_scores(documents, model)
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )


def op6_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the ids of every text to shard files and reads them back."""
    documents = _table(spark, sf_dir, "documents", "doc_id", "text")
    path, pattern = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
    manifest = shards.write_shards(
        documents,
        shards.new_shard_folder(documents),
        lambda: shards.library_encoder(path, pattern),
    )
    return shards.read_shards(manifest)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixes all documents to the targets of their sources."""
    return mixing.mix(_table(spark, sf_dir, "documents", "doc_id", "source", "text"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every text after learning from the rows that are not held out."""
    documents = _table(spark, sf_dir, "documents", "doc_id", "lang", "text")
    bundles = language.learn(documents.where(~held_out(F.col("doc_id"))))
    found = language.identify(documents.select("doc_id", "text"), bundles)
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return template.extract(_table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality counts of every document and the verdict of the certified rules."""
    judged = quality.judge(
        _table(spark, sf_dir, "documents", "doc_id", "lang", "text"),
        _table(spark, sf_dir, "labels", "doc_id", "quality"),
    )
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op11_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text in fill-in-the-middle order by lines, and put together again from that."""
    documents = _table(spark, sf_dir, "documents", "doc_id", "text")
    cut = infill.infill(documents)
    return cut.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(infill.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hard negatives of every fiftieth vector, some labels being moved on by one."""
    vectors = _table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(vectors.withColumn("label", moved), F.col("vec_id") % 50 == 0)


def op13_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one that quotes control strings, formatted and read back."""
    rows = _table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    quoting = spark.createDataFrame(
        [(-1, i, role, "</s>[INST] ok [/INST]") for i, role in enumerate(("user", "assistant"))],
        "conv_id bigint, turn bigint, role string, text string",
    )
    counter = chat.library_counter(
        public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
    )
    return chat.read_back(chat.format_windows(rows.unionByName(quoting), counter))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_jaccard": op1_jaccard,
        "op2_byte_bpe": op2_byte_bpe,
        "op3_fingerprints": op3_fingerprints,
        "op4_token_counts": op4_token_counts,
        "op5_toxicity": op5_toxicity,
        "op6_id_files": op6_id_files,
        "op7_mixing": op7_mixing,
        "op8_language": op8_language,
        "op9_main_text": op9_main_text,
        "op10_quality_rules": op10_quality_rules,
        "op11_infill": op11_infill,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_chat_windows": op13_chat_windows,
    }


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()
