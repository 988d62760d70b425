"""A corpus pipeline: language ID, two kinds of dedup, masking of personal data, packing.

Each stage takes the documents that its predecessor kept, from Parquet, and all but the last return documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from secflow.llm import language, packing, pii, simhash, suffix_dedup
from secflow.session import checkpoint_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language: those without a text or a letter (``und``) go."""
    told = language.learn_and_identify(docs.select(*COLUMNS))
    return told.filter(F.col("language.lang_pred") != "und").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: the one of the smallest id, null last; of equal ids, the first by its key.

    Rows are told apart by a key made of id and text, so different texts of one id are judged each by itself, and rows
    without an id like any other. Rows of equal id and text are copies. If different rows shared a key, both would stay.
    """
    keyed = docs.select(*COLUMNS, F.xxhash64("doc_id", "text").alias("_key"))
    groups = simhash.simhash_components(keyed, id_col="_key", words=4, max_bits=4)
    members = groups.select(F.col("doc_id").alias("_key"), "component_id").distinct().join(keyed.select("_key", "doc_id").distinct(), "_key")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "_key"))
    chosen = members.groupBy("component_id").agg(first.alias("first")).select("first._key")
    place = F.row_number().over(Window.partitionBy("_key", "doc_id", "text").orderBy("lang", "source", "n_chars"))
    return keyed.join(chosen, "_key", "left_semi").withColumn("_place", place).filter("_place = 1").select(*COLUMNS)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the 100-byte strings that occur earlier; what has nothing left stays as an empty text."""
    spans = suffix_dedup.repeated_spans(docs, keep=["lang", "source"], as_text=True)
    return spans.select("doc_id", F.col("kept").alias("text"), "row.lang", "row.source", F.length("kept").cast("long").alias("n_chars"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each span of personal data replaced by its kind."""
    found = pii.with_spans(docs.select(*COLUMNS), name="_spans")
    text = found.withColumn("text", pii.masked(F.col("text"), F.col("_spans")))
    return text.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 2048 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("language ID", identify_language),
    ("SimHash near-dedup", drop_near_copies),
    ("suffix-array dedup", drop_repeats),
    ("PII", mask_personal_data),
    ("best-fit packing", pack),
]

#: Fitted models and packing can't be written in SQL; tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written below ``spark.checkpoint.dir`` and read again."""
    folder = f"{checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k + 1 == len(STAGES):
            return out
        out.write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
