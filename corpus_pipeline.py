"""A corpus pipeline of five stages, each written as Parquet and read again by the next.

Every stage takes (spark, docs, sf_dir); all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import crc_mod, stored, table
from tidemark.llm.decontaminate import remove_contamination
from tidemark.llm.ngram_join import ngram_jaccard_join
from tidemark.llm.pii import redact
from tidemark.llm.piece_dropout import encode_pieces
from tidemark.llm.toxicity import drop_toxic


def _recounted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under 0.5 stay; learnt from the labels that are not held out.

    Null and empty texts stay, texts of any length are read whole, equal texts fare alike, and so do documents without labels;
    an empty table stays empty. Without labels of both kinds all stay, or none where all labels say toxic.
    """
    return drop_toxic(docs, table(spark, sf_dir, "labels").where(crc_mod("doc_id", 5) != 0))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of linked documents the one of the least id stays; rows without an id all stay.

    Rows of the same id and text count as one. Null texts, and those without a word, are alike to nothing. Texts of any
    length are compared whole.
    """
    classes = ngram_jaccard_join(docs)
    kept = classes.where("doc_id = class_id").select("doc_id").distinct()
    with_id = docs.where("doc_id IS NOT NULL").join(kept, "doc_id", "left_semi")
    once = with_id.withColumn("_text_hash", F.xxhash64("text")).dropDuplicates(["doc_id", "_text_hash"]).drop("_text_hash")
    return once.unionByName(docs.where("doc_id IS NULL"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that are mostly benchmark text go.

    Null and empty texts stay as they are, texts of any length are scanned whole, repeated rows fare alike; an empty
    benchmark cuts nothing.
    """
    return _recounted(remove_contamination(docs, table(spark, sf_dir, "benchmark")))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by their kind; all rows stay.

    Null and empty texts stay as they are, texts of any length are read whole, repeated rows are redacted alike; of spans that
    overlap the first to start gives its kind, of those the longest.
    """
    return _recounted(redact(docs))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts with their piece ids under seeded merge dropout; all rows stay.

    Null and empty texts have no ids, texts of any length are encoded whole, equal texts alike; of candidates of equal rank
    the leftmost comes first.
    """
    return encode_pieces(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("pieces", pieces),
]
#: Learnt scores, links by hashed signatures and seeded segmentation are beyond SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
