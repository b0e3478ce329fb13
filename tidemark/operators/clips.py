"""Clips: where they speak, how they are paced, which of them are cut from a recording and from which copy."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sequence import slot_ends


def _by_clip(frames: DataFrame, keys: list[str], share: float) -> DataFrame:
    """Levels of each clip in order, and the given percentile of them. A clip is a few seconds long."""
    g = frames.groupBy(*keys).agg(F.percentile("level", F.lit(share)).alias("_top"), F.array_sort(F.collect_list(F.struct("frame_no", "level"))).alias("_f"))
    return g.withColumn("_x", F.transform("_f", lambda f: f["level"])).withColumn("_n", F.size("_f"))


def _places(test) -> Column:
    """Places (from 0) of the levels that pass."""
    return F.filter(F.transform("_x", lambda x, i: F.when(test(x), i)), lambda i: i.isNotNull())


def speech_bounds(
    frames: DataFrame, keys: list[str], *, frame_ms: int = 20, floor: float = 0.01, share: float = 0.1, margin_ms: int = 50, tail_share: float = 0.01, tail_max_ms: int = 350,
    head_share: float = 0.05, head_max_ms: int = 100, tail_margin_ms: int | None = None,
) -> DataFrame:
    """(keys, lo_ms, hi_ms) between which each clip of (keys, frame_no, level) speaks, with some air; null for silence.

    Speech is where frames exceed a share of their 99th percentile; from there both ends reach out over neighbouring
    frames while the sound still decays, for a bounded time.
    """
    c = _by_clip(frames, keys, 0.99).withColumn("_loud", _places(lambda x: x > F.greatest(F.lit(floor), share * F.col("_top"))))
    low = lambda s: F.greatest(F.lit(0.3 * floor), s * F.col("_top"))
    first, last = F.array_min("_loud"), F.array_max("_loud")
    before = F.array_max(F.filter(_places(lambda x: x <= low(head_share)), lambda i: i < F.array_min("_loud")))
    after = F.array_min(F.filter(_places(lambda x: x <= low(tail_share)), lambda i: i > F.array_max("_loud")))
    a = F.greatest(F.coalesce(before + 1, F.lit(0)), first - math.ceil(head_max_ms / frame_ms))
    b = F.least(F.coalesce(after - 1, F.col("_n") - 1), last + math.ceil(tail_max_ms / frame_ms))
    tail = margin_ms if tail_margin_ms is None else tail_margin_ms
    lo, hi = F.greatest(a * frame_ms - margin_ms, F.lit(0)), F.least((b + 1) * frame_ms + tail, F.col("_n") * frame_ms)
    some = F.size("_loud") > 0
    return c.select(*keys, F.when(some, lo).cast("long").alias("lo_ms"), F.when(some, hi).cast("long").alias("hi_ms"))


def audition(frames: DataFrame, keys: list[str], *, frame_ms: int = 50, floor: float = 0.01) -> DataFrame:
    """(keys, head_ms, tail_ms, share): silence at both ends of each clip and its voiced share; a silent one is silence twice."""
    c = _by_clip(frames, keys, 0.95).withColumn("_loud", _places(lambda x: x > F.greatest(F.lit(floor), 0.1 * F.col("_top"))))
    some, whole = F.size("_loud") > 0, F.col("_n") * frame_ms
    head = F.when(some, F.array_min("_loud") * frame_ms).otherwise(whole)
    tail = F.when(some, (F.col("_n") - 1 - F.array_max("_loud")) * frame_ms).otherwise(whole)
    return c.select(*keys, head.cast("long").alias("head_ms"), tail.cast("long").alias("tail_ms"), (F.size("_loud") / F.col("_n")).alias("share"))


def voiced_time(frames: DataFrame, keys: list[str], *, frame_ms: int = 20, share: float = 10 ** (-30 / 20)) -> DataFrame:
    """(keys, voiced_ms): time of the frames above 30 dB under each clip's own 99th percentile."""
    top = frames.groupBy(*keys).agg(F.percentile("level", F.lit(0.99)).alias("_top"))
    loud = frames.join(top, keys).groupBy(*keys).agg(F.count_if(F.col("level") > share * F.col("_top")).alias("n"))
    return loud.select(*keys, (F.col("n") * frame_ms).alias("voiced_ms"))


def edge_sound(frames: DataFrame, words: DataFrame, keys: list[str], *, frame_ms: int, loud: float) -> DataFrame:
    """(keys, lead_ms, tail_ms): sound before the first heard word (keys, start_ms, end_ms) and after the last one.

    Clips without sound or without words are left out.
    """
    sound = frames.where(F.col("level") > loud).groupBy(*keys).agg((F.min("frame_no") * frame_ms).alias("_a"), (F.max("frame_no") * frame_ms).alias("_b"))
    heard = words.groupBy(*keys).agg(F.min("start_ms").alias("_s"), F.max("end_ms").alias("_e"))
    return sound.join(heard, keys).select(*keys, (F.col("_s") - F.col("_a")).alias("lead_ms"), (F.col("_b") - F.col("_e")).alias("tail_ms"))


def synthesis_slots(segments: DataFrame, *, least_ms: int = 1000, open_ms: int = 2000) -> DataFrame:
    """(media, ord, slot_ms) of the segments to be voiced: until the next one on the timeline, or past the end by ``open_ms``.

    Overlaid segments are off the timeline: they have their own span. ``segments`` as for ``slot_ends``.
    """
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    s = segments.where(~flag("echo") & ~flag("orig"))
    end = F.when(flag("overlap"), F.col("end_ms")).otherwise(F.coalesce("slot_end", F.col("end_ms") + open_ms))
    return s.join(slot_ends(segments), ["media", "ord"], "left").select("media", "ord", F.greatest(end - F.col("start_ms"), F.lit(least_ms)).alias("slot_ms"))


def paste_source(own: Column, loudest_other: Column, expected: Column, *, over: float = 3.0, ratio: float = 6.0) -> Column:
    """``raw`` or ``cleaned``: the raw copy where the owner's level beats the leak that is expected, or where nothing is
    calibrated (a null expectation) the others' level by a fixed ratio."""
    ok = F.when(expected.isNotNull(), own > over * expected).otherwise(F.coalesce(loudest_other, F.lit(0.0)) < ratio * own)
    return F.when(ok, "raw").otherwise("cleaned")


def cut_list(routed: DataFrame) -> DataFrame:
    """(media, ord, label, copy, file, start_ms, length_ms) of what is pasted from the recording instead of being voiced.

    ``routed`` are segments with a ``route`` of ``multitrack.confidence`` and a ``copy`` of ``paste_source``. Sounds
    always come from the raw copy: cleaning mutes them. Without a speaker the file has no name (null).
    """
    s = routed.where(F.col("route").isin("paste", "backchannel"))
    label = F.when(F.col("route") == "paste", "low_conf").otherwise("backchannel")
    name = F.when(F.col("speaker").isNotNull(), F.format_string("%s_%06d.wav", F.col("speaker").cast("string"), F.floor(F.col("start_ms") / 100)))
    return s.select("media", "ord", label.alias("label"), F.when(F.col("route") == "paste", F.col("copy")).otherwise("raw").alias("copy"), name.alias("file"), "start_ms", (F.col("end_ms") - F.col("start_ms")).alias("length_ms"))


def complete_items(segments: DataFrame, *, text: str = "text") -> DataFrame:
    """(media) of the items of which no segment, pasted originals aside, lacks a text (null): only those are exported."""
    s = segments.where(~F.coalesce("orig", F.lit(False))) if "orig" in segments.columns else segments
    return s.groupBy("media").agg(F.bool_and(F.col(text).isNotNull()).alias("ok")).where("ok").select("media")


def bed_gain(frames: DataFrame, *, ramp: int = 1, **options) -> DataFrame:
    """(track, frame_no, gain) of a music bed (track, frame_no, level, loud): lone effects ducked, edges ramped over
    ``2 * ramp + 1`` frames; bed and speech are the levels of the same frames."""
    from .signal import lone_effect_gain, moving_average

    return moving_average(lone_effect_gain(frames, **options), "gain", half=ramp)
