"""Manifests of rendered clips across schemes: upgrade, trust by time, carry, re-roll."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import manifest_hash


def old_hash(speaker: Column, text: Column) -> Column:
    return F.sha1(F.concat_ws("|", speaker, text).cast("binary"))


def is_old_scheme(rows: DataFrame) -> bool:
    """Do most entries of the first fifty clips (id, speaker, entry, text, prior_text) hash speaker and text alone?"""
    match = (F.col("entry") == old_hash(F.col("speaker"), F.col("text"))) | (F.col("entry") == old_hash(F.col("speaker"), F.col("prior_text")))
    n, k = rows.orderBy("id").limit(50).where("entry IS NOT NULL").agg(F.count("*"), F.count_if(match)).first()
    return n > 0 and k >= max(3, n // 2)


def bridged(rows: DataFrame, *, pace: str = "pace7") -> DataFrame:
    """(id, entry) in the new scheme for clips made under the old one.

    ``rows`` are (id, speaker, entry, text, prior_text, reference). An entry is upgraded under the text whose old
    hash it is; others are left out. A manifest of the new scheme passes as it is.
    """
    if not is_old_scheme(rows):
        return rows.where("entry IS NOT NULL").select("id", "entry")
    said = F.when(F.col("entry") == old_hash(F.col("speaker"), F.col("text")), F.col("text")).when(F.col("entry") == old_hash(F.col("speaker"), F.col("prior_text")), F.col("prior_text"))
    up = rows.withColumn("said", said).where("said IS NOT NULL")
    return up.select("id", manifest_hash(F.col("speaker"), F.col("said"), F.col("reference"), pace).alias("entry"))


def adopted(clips: DataFrame, records: DataFrame, references: DataFrame, *, slack_s: float = 1.0) -> DataFrame | None:
    """(id, entry) for clips without a manifest, from the text record they were made of; None where none can be trusted.

    ``clips`` are (id, speaker, made_at), ``records`` (rank, recorded_at, id, text), ``references`` (speaker,
    reference, cut_at), times in seconds. The first record no newer than the newest clip counts; speakers whose
    reference was cut after it are left out.
    """
    newest = clips.agg(F.max("made_at")).first()[0]
    if newest is None:
        return clips.select("id", F.lit(None).cast("string").alias("entry")).limit(0)
    rank = records.groupBy("rank").agg(F.max("recorded_at").alias("at")).where(F.col("at") <= newest + slack_s).agg(F.min("rank")).first()[0]
    if rank is None:
        return None
    text = records.where(F.col("rank") == rank).select("id", "text")
    kept = references.where(F.col("cut_at").isNull() | (F.col("cut_at") <= newest + slack_s))
    return clips.join(text, "id").join(kept, "speaker").select("id", manifest_hash(F.col("speaker"), F.col("text"), F.col("reference")).alias("entry"))


def carried_manifest(pairs: DataFrame, old: DataFrame) -> DataFrame:
    """(id, entry) of carried clips: pairs (id, old_id, new_hash, same_reference) whose old entry is the new hash."""
    met = pairs.where("same_reference").join(old.select(F.col("id").alias("old_id"), "entry"), "old_id")
    return met.where("entry = new_hash").select("id", "entry")


def reroll(current: DataFrame, rungs: list[Callable[[DataFrame], DataFrame]], *, least_sim: float = 0.9) -> DataFrame:
    """Climb a ladder of renderings: (id, flags, sim, rung). Each rung re-renders what is not yet clean and is kept
    only where it is better; the last good take stays otherwise."""
    from .quality import better

    best = current.select("id", "flags", "sim", F.lit(0).alias("rung"))
    for k, render in enumerate(rungs, 1):
        poor = best.where((F.size("flags") > 0) | (F.col("sim") < least_sim))
        made = render(poor).select("id", F.col("flags").alias("_f"), F.col("sim").alias("_s"))
        met = best.join(made, "id", "left")
        take = F.coalesce(better(F.col("_f"), F.col("_s"), F.col("flags"), F.col("sim")), F.lit(False)) & F.col("_f").isNotNull()
        best = met.select("id", F.when(take, F.col("_f")).otherwise(F.col("flags")).alias("flags"), F.when(take, F.col("_s")).otherwise(F.col("sim")).alias("sim"), F.when(take, k).otherwise(F.col("rung")).alias("rung"))
    return best
