"""The pipeline over the table ``documents``: five stages, each on all that the one before kept.

Every stage is written as Parquet and read again, so a lost executor repeats a stage at most.
All stages but the last return the columns of ``documents``. Empty inputs give empty results;
rows with a null ``doc_id`` are kept unless a stage rejects their text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, jaccard, language, secret_scan, templates
from millrace.llm.common import stored, table

TOKENIZER = "word_bpe_49k.json"
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts whose language cannot be told go. The model learns from the rows outside the fold."""
    fold = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = language.fit(docs.filter(~fold), F.col("doc_id"))
    told = language.predict(docs, model).filter(F.col("lang_pred") != language.UNDETERMINED)
    return told.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the least ``doc_id`` stays.

    The operator names no link for documents without a word, so all of them stay, and so do
    rows with a null key. A ``doc_id`` that occurs twice stays with all its rows.
    """
    groups = jaccard.jaccard_join(docs.select("doc_id", "text"))
    gone = groups.filter(F.col("component_id") != F.col("doc_id")).select("doc_id")
    return docs.join(stored(gone, "duplicates"), "doc_id", "left_anti").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, as it is or with other values, go."""
    benchmark = table(spark, sf_dir, "benchmark", "item_id", "text")
    found = templates.contaminated(docs.select("doc_id", "text"), benchmark)
    gone = stored(found.select("doc_id"), "contaminated")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark, and ``n_chars`` counts the text again where one was."""
    clean = secret_scan.hide_secrets(docs)
    length = F.when(F.col("hidden"), F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", length).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, little-endian unsigned 32-bit, and their number."""
    made = bpe.encode(
        docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path(TOKENIZER)
    )
    return made.select(
        "doc_id",
        "lang",
        "source",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
    )


STAGES = [
    ("language ID", language_id),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("secret scans", hide_secrets),
    ("BPE encoding", encode),
]

# Language prediction, template slots, lexing and merging cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", *COLUMNS)
    for k, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{k}")
    return docs
