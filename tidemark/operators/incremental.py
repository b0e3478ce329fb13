"""Recomputing only what changed: hashes, differences, upserts and carried results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def todo(rows: DataFrame, manifest: DataFrame, *, key: str, digest: str, forced: Column | None = None) -> DataFrame:
    """Rows whose manifest entry is missing or differs, and those ``forced``."""
    m = manifest.select(key, F.col(digest).alias("_old"))
    wanted = ~F.col(digest).eqNullSafe(F.col("_old"))
    return rows.join(m, key, "left").where(wanted if forced is None else wanted | forced).drop("_old")


def upsert(base: DataFrame, prior: DataFrame, chunk: DataFrame, *, key: str, text: str) -> DataFrame:
    """Base rows with the text of the chunk, else of the prior result; prior rows absent from the base stay as they are.

    Ids of the chunk that the base lacks are ignored, and rows without a text go. All three have one row a key.
    """
    kept = prior.join(base.select(key), key, "left_anti")
    new = base.join(prior.select(key, F.col(text).alias("_prior")), key, "left").join(chunk.select(key, F.col(text).alias("_chunk")), key, "left")
    new = new.withColumn(text, F.coalesce("_chunk", "_prior")).drop("_prior", "_chunk")
    return new.unionByName(kept, allowMissingColumns=True).where(F.col(text).isNotNull())


def replace_own(rows: DataFrame, mine: Column, new: DataFrame, *, key: str, first: int, order: list[str]) -> DataFrame:
    """Rows that are not ``mine``, and the new ones numbered from ``first`` in each media item."""
    numbered = new.withColumn(key, (F.row_number().over(W.partitionBy("media").orderBy(*order)) + (first - 1)).cast("long"))
    return rows.where(~F.coalesce(mine, F.lit(False))).unionByName(numbered, allowMissingColumns=True)


def carry_over(new: DataFrame, old: DataFrame, words: Column, *, near_ms: int = 300) -> DataFrame:
    """For each new segment the first old one of the same speaker and words within ``near_ms``: (new_ord, old_ord).

    Both have media, ord, speaker, start_ms, end_ms and the columns of ``words``.
    """
    a = new.select("media", "speaker", words.alias("k"), F.col("ord").alias("new_ord"), F.col("start_ms").alias("s1"), F.col("end_ms").alias("e1"))
    b = old.select("media", "speaker", words.alias("k"), F.col("ord").alias("old_ord"), F.col("start_ms").alias("s2"), F.col("end_ms").alias("e2"))
    near = (F.abs(F.col("s1") - F.col("s2")) <= near_ms) & (F.abs(F.col("e1") - F.col("e2")) <= near_ms)
    return a.join(b, ["media", "speaker", "k"]).where(near).groupBy("media", "new_ord").agg(F.min("old_ord").alias("old_ord"))


def changed(new: DataFrame, old: DataFrame) -> bool:
    """Do two tables of one schema differ as bags of rows?"""
    old = old.select(new.columns)
    return not (new.exceptAll(old).isEmpty() and old.exceptAll(new).isEmpty())
