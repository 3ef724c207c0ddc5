"""One query per training-data operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webgrove.llm import chat, configurations, decontaminate, jaccard, merkle, packing, pii, quality, resampling, sharding, tokens, urls, warc
from webgrove.llm.common import table


#: The queries' key; real runs bring a secret of their own.
SURROGATE_KEY = b"a key for the registered queries"


def vocabulary(name: str) -> str:
    """A public tokenizer's file; the package that holds it is installed on every executor."""
    from public_tokenizers import path

    return path(name)


def op1_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], said.schema)
    windows = chat.chat_windows(
        said.unionByName(added), json_file=vocabulary("byte_bpe_50k.json"), rank_file=vocabulary("byte_bpe_50k.tiktoken"))
    return chat.read_back(windows)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(
        table(spark, sf_dir, "documents", "doc_id", "text"),
        json_file=vocabulary("byte_bpe_50k.json"), rank_file=vocabulary("byte_bpe_50k.tiktoken"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents", "doc_id", "text"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality_rules(table(spark, sf_dir, "documents", "doc_id", "text", "lang"), table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_entities(table(spark, sf_dir, "documents", "doc_id", "text"), key=SURROGATE_KEY)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(
        table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"), keep_text=False)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("item_ids")).cast("binary"), 256).alias("items_sha256"), "contaminated")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.archive_and_read(table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.filter_urls(table(spark, sf_dir, "pages", "page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents", "doc_id", "text"), model_file=vocabulary("piece_bpe_32k.model"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, sf_dir, "documents", "doc_id", "text"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.importance_resample(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "text"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ("doc_id", "source", "lang", "n_chars", "text")
    docs = table(spark, sf_dir, "documents", *fields)
    # a seventh of the documents claims one character more than it has
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 0
    forged = merkle.leaf_digest(*(F.col(c) + 1 if c == "n_chars" else F.col(c) for c in fields))
    manifest = merkle.merkle_manifest(docs.withColumn("forged", F.when(tampered, forged)), fields=fields, carry=("forged",))
    checked = merkle.verified(manifest.withColumn("claimed", F.coalesce("forged", "leaf")), "claimed")
    return checked.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", "verified")


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return configurations.best_fit_packing(
        table(spark, sf_dir, "documents", "doc_id", "text"),
        json_file=vocabulary("byte_bpe_50k.json"), rank_file=vocabulary("byte_bpe_50k.tiktoken"))


QUERIES = {
    "op1_chat_windows": op1_chat_windows,
    "op2_packing": op2_packing,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_quality_rules": op4_quality_rules,
    "op5_surrogates": op5_surrogates,
    "op6_decontamination": op6_decontamination,
    "op7_warc": op7_warc,
    "op8_url_filter": op8_url_filter,
    "op9_token_counts": op9_token_counts,
    "op10_sharding": op10_sharding,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_best_fit_packing": op13_best_fit_packing,
}
