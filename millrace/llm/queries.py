"""The registered queries of this package: thin calls of the operators on whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    bpe,
    chat,
    jaccard,
    language,
    lexical,
    licenses,
    pii,
    prefix_trie,
    quality,
    secret_scan,
    templates,
    urls,
    vector_search,
)
from millrace.llm.common import table
from millrace.llm.spans import digest_columns

TOKENIZER = "word_bpe_49k.json"

# The rules of the contract.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
CONTROL_CHAT = r"\### Assistant: </turn> ok"


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    return quality.judge_quality(documents)


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    return secret_scan.scan_secrets(documents).select("doc_id", *digest_columns(secret_scan.BASE_KINDS))


def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, urls.RULE_SCHEMA)
    judged = urls.judge_urls(table(spark, sf_dir, "pages", "page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op4_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    return templates.contaminated(documents, table(spark, sf_dir, "benchmark", "item_id", "text"))


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_join(table(spark, sf_dir, "documents", "doc_id", "text"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    return pii.scan_pii(documents).select("doc_id", *digest_columns(pii.BASE_KINDS))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    return licenses.scan_licenses(documents, licenses.templates(spark))


def held_out():
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = language.fit(documents.filter(~held_out()), F.col("doc_id"))
    return language.predict(documents.select("doc_id", "text"), model).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score"
    )


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    added = spark.createDataFrame(
        [(-7, 0, "user", CONTROL_CHAT), (-7, 1, "assistant", CONTROL_CHAT)], turns.schema
    )
    parts = turns.unionByName(added).withColumn("parts", chat.text_parts(F.col("text")))
    back = chat.format_chats(parts).withColumn("turns", chat.read_back(F.col("formatted")))
    masked = F.transform(
        "loss_spans",
        lambda s: F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")),
    )
    loss = F.array_join(F.transform(masked, chat.unescape), "")
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    path = public_tokenizers.path(TOKENIZER)
    return bpe.decode(bpe.encode(documents, path), path).select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    return lexical.search(documents, table(spark, sf_dir, "benchmark", "item_id", "text"))


def op13_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return vector_search.nearest(vectors, vectors.filter(F.col("vec_id") % 20 == 0))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_secrets": op2_secrets,
    "op3_urls": op3_urls,
    "op4_templates": op4_templates,
    "op5_jaccard": op5_jaccard,
    "op6_pii": op6_pii,
    "op7_licenses": op7_licenses,
    "op8_language": op8_language,
    "op9_chat": op9_chat,
    "op10_bpe": op10_bpe,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_search": op12_search,
    "op13_nearest": op13_nearest,
}
