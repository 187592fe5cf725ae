"""A corpus pipeline: language, quality, near duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame; it is written as Parquet and read
again as the next stage's documents. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintara.llm import crf, jaccard, packing, pii, repetition
from vintara.llm.common import prepare, write_through

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# How far the mean of each word's best label probability is above chance, at least (crf.predict).
LEAST_EVIDENCE = 0.2


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose words have languages that the field is sure of, one or several.

    Those without a letter go. Where nothing could be learned (no usable row with a language), all
    documents with a letter stay.
    """
    prepare(spark)
    field = crf.learn(docs)
    if field is None:
        return docs.select(*COLUMNS).where(F.col("text").rlike("\\p{L}"))
    labelled = crf.predict(docs.select(*COLUMNS), field, evidence=True)
    sure = (F.col("lang_pred") != crf.UNDECIDED) & (F.col("evidence") >= LEAST_EVIDENCE)
    return labelled.where(sure).select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that pass the base rules and the repetition limits."""
    prepare(spark)
    return repetition.quality(docs.select(*COLUMNS)).where("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each component of near duplicates: the smallest doc_id."""
    prepare(spark)
    return jaccard.one_of_each(docs.select(*COLUMNS)).select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put the kind in place of each span of personal data; n_chars follows the text."""
    prepare(spark)
    docs = docs.select(*COLUMNS)
    found = pii.detect(docs, pii.learn(docs))
    clean = found.withColumn("text", pii.masked(F.col("text"), F.col("spans")))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens; a row for each piece of a document."""
    prepare(spark)
    return packing.pack_documents(docs, "word_bpe_49k.json", end_id=1)


STAGES = [
    ("language_id", language),
    ("quality_rules", quality),
    ("jaccard_join", near_duplicates),
    ("pii", personal_data),
    ("packing", pack),
]

# SQL can't express the learned stages; tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each result is stored and read again."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_through(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
