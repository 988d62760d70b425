"""One query for each operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from secflow.llm import (
    alignment, chat, decontaminate, language, merkle, neighbours, ngram_lm, packing, periodic, pieces, pii, simhash, suffix_dedup,
)
from secflow.llm.common import table


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors found for each row whose vec_id is divisible by 100."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbours.nearest(vectors, vectors.filter("vec_id % 100 = 0"))


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts hold control strings, rebuilt from events, formatted and read back."""
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    said = "</s>[INST] ok [/INST]"
    added = spark.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(-1).cast("long").alias("conv_id"), F.lit(turn).cast("long").alias("turn"), F.lit(role).alias("role"), F.lit(said).alias("text"))
        for turn, role in enumerate(("user", "assistant"))
    ])).alias("t")).select("t.*")
    return chat.digest(chat.read_back(chat.render(chat.reconstruct(chat.as_log(turns.union(added))))))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash of 4-word shingles and components at 4 or fewer differing bits."""
    return simhash.simhash_components(table(spark, sf_dir, "documents"), words=4, max_bits=4)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of each document; four fifths of the labelled documents train."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    told = language.learn_and_identify(docs)
    return told.select("doc_id", "held_out", "language.lang_pred", "language.score", "language.languages")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of each document that are left after all earlier 100-byte strings have gone."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.digest(suffix_dedup.repeated_spans(docs))


def op6_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stupid-backoff score of each document by the counts of all others."""
    return ngram_lm.backoff_scores(table(spark, sf_dir, "documents")).withColumn("log_prob", F.round("log_prob", 4))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op8_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of each text and of its edited text, and how alike they and the next text's are."""
    return merkle.compare_with_edits(table(spark, sf_dir, "documents"))


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 4 best segmentations of each text into pieces: ids, their score, number, digest and round trip, and the decoded text."""
    return pieces.encode_documents(table(spark, sf_dir, "documents"), with_decoded=True, best_apart=False)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of each text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.digest(pii.with_spans(docs))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two tokenizers aligned in each document, and how common the linked pairs are."""
    return alignment.align_documents(table(spark, sf_dir, "documents"))


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in each document, a tenth of which are made periodic first."""
    return periodic.digest(periodic.periodic_runs(table(spark, sf_dir, "documents"), rewrite=periodic.planted))


def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that are under windows of benchmark items."""
    return decontaminate.digest(decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_neighbours": op1_neighbours,
    "op2_chat": op2_chat,
    "op3_simhash": op3_simhash,
    "op4_language": op4_language,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_ngram_lm": op6_ngram_lm,
    "op7_packing": op7_packing,
    "op8_merkle": op8_merkle,
    "op9_pieces": op9_pieces,
    "op10_pii": op10_pii,
    "op11_alignment": op11_alignment,
    "op12_periodic": op12_periodic,
    "op13_decontaminate": op13_decontaminate,
    "pipeline": corpus_pipeline.run,
}

SQL: dict[str, str] = {"op2_chat": chat.SQL, "op6_ngram_lm": ngram_lm.SQL, "op12_periodic": periodic.SQL, "op13_decontaminate": decontaminate.SQL}
