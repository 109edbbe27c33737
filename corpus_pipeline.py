"""The corpus pipeline: documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
Stages judge their own input: models and counts are made from the documents that came in.

Defined cases, for all stages: an empty table gives no rows; extra columns stay as they are, whatever their names; very
long texts are read whole. Null and empty texts have no language and go with the first stage; what later stages do with
nulls, repeats and ties is said at each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitesieve.llm import decontaminate, language, packing, shared, simhash, substring_dedup

#: No SQL expresses the trained language model, the tokenizer or the fingerprints' components.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; those without letters or with an even mixture of languages go. Null ids and
    null langs teach nothing and are judged like others; repeated rows are judged each. Where no row has a usable lang,
    there is nothing to reject by: documents with a letter stay."""
    return language.accepted(docs, language.trained(docs), least=0.35)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near copies (null ids come first; texts under one id are
    documents of their own, the least hash of a text first); of rows that repeat its id and text, one, whichever."""
    return simhash.first_of_each(docs)


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their repeated passages; documents of which nothing is left go, and so do null and empty texts.
    n_chars follows the text. Rows that repeat id and text are one document; a null id comes before all others."""
    left = substring_dedup.rewritten(docs).filter(F.length(F.trim("text")) > 0)
    return left.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else left


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate, each row judged by its own text; null texts are clean."""
    return decontaminate.clean(docs, shared.table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document: see packing.packed. Null texts are the end id alone; repeated rows are packed each."""
    return packing.packed(docs, packing.tokenizer_path())


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup_stage),
    ("decontamination", decontamination),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written as Parquet to the shared folder and read again, and goes when
    the next one is written."""
    docs, before = shared.table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        folder = shared.folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
        if before:
            shared.discard(before)
        before = folder
    return docs
