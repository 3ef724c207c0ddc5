"""From raw documents to packed training sequences: five stages, each written and read again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webgrove.llm import decontaminate, jaccard, packing, pii, quality
from webgrove.llm.common import stored, table
from webgrove.llm.queries import SURROGATE_KEY, vocabulary


def text_digest() -> Column:
    """What rows of one text have in common; null for no text."""
    return F.unhex(F.sha2(F.col("text").cast("binary"), 256))


def free_name(docs: DataFrame, name: str) -> str:
    """A name that no column of ``docs`` has."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, as they are, with all their columns.

    Judged row by row over whole texts, by the thresholds of their language; rows of one id need
    not share a verdict.  Null and empty texts have no words and go.
    """
    rows = docs.select("doc_id", "text", "lang", F.struct(*docs.columns).alias("_document"))
    judged = quality.quality_rules(rows, table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))
    return judged.where("kept").select("_document.*")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, that of the least id; documents without an id all stay.

    An id is no key: of its texts, those in different groups stay.  Rows are told apart by id
    and digest of the text, and of rows that share both the least one stays, in every run.
    Null, empty and blank texts are no copies of each other.  Texts are compared whole.
    """
    key, row = free_name(docs, "_digest"), free_name(docs, "_row")
    keyed = docs.withColumn(key, text_digest())
    groups = jaccard.jaccard_components(keyed.select(F.struct(F.isnull("doc_id").alias("nameless"), "doc_id", F.col(key).alias("digest")).alias("doc_id"), "text"))
    first = stored(groups.where("component_id = doc_id and not doc_id.nameless").select("doc_id.doc_id", "doc_id.digest").distinct(), "first")
    named = (keyed.join(first, (keyed["doc_id"] == first["doc_id"]) & keyed[key].eqNullSafe(first["digest"]), "left_semi")
             .groupBy("doc_id", key).agg(F.min(F.struct(*docs.columns)).alias(row)).select(f"{row}.*"))
    return named.unionByName(docs.where("doc_id is null"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated, those without an id too; passages of an item are cut from them.

    A passage of ``decontaminate.WINDOW`` words or more is cut and ``n_chars`` counted anew.  Words of
    shorter items, which plain prose may hold, stay, as does every text without a passage.  The
    verdict is one on the whole text, so it is carried by the text's digest, not by an id that other texts
    may have.  Null and empty texts stay.
    """
    texts = docs.select(text_digest().alias("doc_id"), "text")
    found = decontaminate.find_contamination(texts, table(spark, sf_dir, "benchmark", "item_id", "text"), keep_text=False)
    long = F.filter("spans", lambda s: s["words"] >= decontaminate.WINDOW)
    hit = stored(found.select("doc_id", "contaminated", long.alias("spans")).where("contaminated or size(spans) > 0").distinct(), "contaminated")
    gone, spans = F.coalesce(hit["contaminated"], F.lit(False)), hit["spans"]
    clean = F.coalesce(F.size(spans), F.lit(0)) < 1
    text = F.when(clean, docs["text"]).otherwise(decontaminate.cut(docs["text"], spans))
    own = {"text": text, "n_chars": F.when(clean, docs["n_chars"]).otherwise(F.length(text).cast("bigint"))}
    return (docs.join(hit, F.unhex(F.sha2(docs["text"].cast("binary"), 256)) == hit["doc_id"], "left").where(~gone)
            .select(*(own[c].alias(c) if c in own else docs[c] for c in docs.columns)))


def privacy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by surrogates; ``n_chars`` counts the new text.

    Null and empty texts stay as they are; equal mentions get equal surrogates in all rows.
    """
    replaced = pii.replace_entities(docs, key=SURROGATE_KEY)
    return replaced.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document and its place in a packed sequence; a null text is an empty one.

    Whole texts are packed, cut where a sequence is full; repeated rows are packed row by row.
    """
    return packing.pack_documents(docs, json_file=vocabulary("byte_bpe_50k.json"), rank_file=vocabulary("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality rules", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("PII", privacy_stage),
    ("packing", packing_stage),
]

#: SQL has neither the tokenizer nor the keyed surrogates; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source", "n_chars")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, name.replace(" ", "-"))
    return docs
