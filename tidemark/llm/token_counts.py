"""Token counts through a digest cache: only distinct texts that the cache lacks are encoded."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_rows, shared_folder, stored, table

TOKENIZER = "byte_bpe_50k.json"
CACHE_SCHEMA = "content string, tokenizer string, n_tokens long"
_loaded: dict[str, object] = {}


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer_version(path: str) -> str:
    """Digest of the vocabulary file: a changed file is another version."""
    import hashlib

    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()[:32]


def counter(path: str):
    """``texts -> counts``; loaded once in a process."""
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            _loaded[path] = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
        else:
            from tokenizers import Tokenizer

            tok = Tokenizer.from_file(path)
            tok.no_truncation()
            tok.no_padding()
            _loaded[path] = lambda texts: [len(e) for e in tok.encode_batch_fast(texts, add_special_tokens=False)]
    return _loaded[path]


def content_digest(text: Column) -> Column:
    """SHA-256 of the content as the tokenizer sees it: a null text is the empty one, nothing else is folded."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def cached_token_counts(
    docs: DataFrame, cache: str, *, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER, limit: int = 512, encode_rows: int = 32,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit for each row; new counts are appended to the table at ``cache``.

    The cache is a Parquet table (content digest, tokenizer version, count). Distinct digests of ``docs`` that it
    lacks are found by an anti join; one text of each is encoded, and the counts are appended before they are
    used, so a second call over the same texts encodes nothing. A digest that two writers append twice is read
    once. Null text counts as empty (0 tokens). Rows with null or repeated ids are kept one by one; columns other
    than the two named are ignored. Empty tables append nothing.
    """
    spark = docs.sparkSession
    path = tokenizer_path(tokenizer)
    version = tokenizer_version(path)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("content", content_digest(F.col("text")))
    known = read_cache(spark, cache, version)
    wanted = docs
    if known is not None:  # digests meet the cache first, so that texts it knows need not be moved
        wanted = docs.join(docs.select("content").distinct().join(known, "content", "left_anti"), "content", "left_semi")
    missing = wanted.groupBy("content").agg(F.first("text").alias("text"))

    def encode(content, text):
        return {"content": content, "tokenizer": [version] * len(text), "n_tokens": counter(path)(text)}

    map_rows(missing, encode, CACHE_SCHEMA, encode_rows).write.mode("append").parquet(cache)
    # written once more, one row for a digest: the join below then has bare exchanges, of which a hot one can be split
    known = stored(read_cache(spark, cache, version), "token-counts-read")
    counted = docs.select("doc_id", "content", F.octet_length("text").cast("long").alias("n_bytes")).join(known, "content")
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def read_cache(spark: SparkSession, cache: str, version: str) -> DataFrame | None:
    """Counts by content digest; None where nothing has been stored yet."""
    from pyspark.errors import AnalysisException

    try:
        kept = spark.read.schema(CACHE_SCHEMA).parquet(cache)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None
    return kept.where(F.col("tokenizer") == version).groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a cache of its own, empty at first, so that every distinct text is encoded."""
    return cached_token_counts(table(spark, sf_dir, "documents"), shared_folder(spark, "token-counts"))
