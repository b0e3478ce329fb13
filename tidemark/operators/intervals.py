"""Interval operators over (media, start_ms, end_ms). Intervals are half-open; times are whole milliseconds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def interval_join(left: DataFrame, right: DataFrame, *, on: list[str], condition: Column | None = None, bucket_ms: int = 30_000, how: str = "inner") -> DataFrame:
    """Rows of ``left`` and ``right`` that overlap within equal ``on`` columns.

    ``left`` has l_start and l_end, ``right`` r_start and r_end; no other column names may clash but ``on``.
    Both sides are dealt into time buckets and joined on (on, bucket), which is an equi-join that shuffles or
    broadcasts as Catalyst sees fit; a pair is kept in the bucket where its overlap begins, so that it comes
    once. Choose ``bucket_ms`` near the usual length; a longer interval lies in several buckets.
    """
    span = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / bucket_ms), F.floor(F.greatest(F.col(b) - 1, F.col(a)) / bucket_ms)))
    lb, rb = left.withColumn("_bucket", span("l_start", "l_end")), right.withColumn("_bucket", span("r_start", "r_end"))
    met = lb.join(rb, [*on, "_bucket"]).where("l_start < r_end AND r_start < l_end").where(F.col("_bucket") == F.floor(F.greatest("l_start", "r_start") / bucket_ms))
    if condition is not None:
        met = met.where(condition)
    return met.drop("_bucket")


def overlap_ms() -> Column:
    return F.least("l_end", "r_end") - F.greatest("l_start", "r_start")


def _sides(left: DataFrame, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    a = left.select("media", F.col("ord").alias("l_ord"), F.col("start_ms").alias("l_start"), F.col("end_ms").alias("l_end"))
    return a, turns.select("media", F.col("ord").alias("r_ord"), F.col("speaker").alias("r_speaker"), F.col("start_ms").alias("r_start"), F.col("end_ms").alias("r_end"))


def best_overlap_speaker(words: DataFrame, turns: DataFrame, **options) -> DataFrame:
    """(media, ord, speaker): speaker of the single turn that overlaps most, the first turn on a tie; null for none."""
    met = interval_join(*_sides(words, turns), on=["media"], **options)
    best = met.groupBy("media", F.col("l_ord").alias("ord")).agg(F.min(F.struct((-overlap_ms()).alias("o"), "r_ord", "r_speaker"))["r_speaker"].alias("speaker"))
    return words.select("media", "ord").join(best, ["media", "ord"], "left")


def total_overlap_speaker(segments: DataFrame, turns: DataFrame, **options) -> DataFrame:
    """(media, ord, speaker): the speaker with the greatest summed overlap, first seen on a tie.

    Where nothing overlaps it is the item's first speaker by name; null where the item has no turns.
    """
    met = interval_join(*_sides(segments, turns), on=["media"], **options)
    sums = met.groupBy("media", F.col("l_ord").alias("ord"), "r_speaker").agg(F.sum(overlap_ms()).alias("o"), F.min("r_ord").alias("first"))
    best = sums.groupBy("media", "ord").agg(F.min(F.struct((-F.col("o")).alias("o"), "first", "r_speaker"))["r_speaker"].alias("speaker"))
    names = turns.groupBy("media").agg(F.min("speaker").alias("_default"))
    met = segments.select("media", "ord").join(best, ["media", "ord"], "left").join(names, "media", "left")
    return met.select("media", "ord", F.coalesce("speaker", "_default").alias("speaker"))


def turn_overlaps(turns: DataFrame, *, min_ms: int = 800, **options) -> DataFrame:
    """Pairs of turns of different speakers that overlap for ``min_ms`` or more, with their intersection."""
    b = _sides(turns, turns)[1]
    a = turns.select("media", F.col("ord").alias("l_ord"), F.col("speaker").alias("l_speaker"), F.col("start_ms").alias("l_start"), F.col("end_ms").alias("l_end"))
    met = interval_join(a, b, on=["media"], condition=(F.col("l_speaker") != F.col("r_speaker")) & (F.struct("l_start", "l_ord") < F.struct(F.col("r_start").alias("l_start"), F.col("r_ord").alias("l_ord"))), **options)
    return met.where(overlap_ms() >= min_ms).select("media", F.col("l_ord").alias("a"), F.col("r_ord").alias("b"), F.greatest("l_start", "r_start").alias("start_ms"), F.least("l_end", "r_end").alias("end_ms"))


def uncovered(segments: DataFrame, turns: DataFrame, **options) -> DataFrame:
    """Segments that no turn of another speaker overlaps."""
    b = _sides(segments, turns)[1]
    a = segments.select("media", F.col("ord").alias("l_ord"), F.col("speaker").alias("l_speaker"), F.col("start_ms").alias("l_start"), F.col("end_ms").alias("l_end"))
    met = interval_join(a, b, on=["media"], condition=F.col("l_speaker") != F.col("r_speaker"), **options)
    return segments.join(met.select("media", F.col("l_ord").alias("ord")).distinct(), ["media", "ord"], "left_anti")


def covered_share(holes: DataFrame, turns: DataFrame, *, share: float = 0.5, **options) -> DataFrame:
    """Holes (media, ord, speaker, start_ms, end_ms) of which some turn of the same speaker covers ``share`` or more."""
    a = holes.select("media", "speaker", F.col("ord").alias("l_ord"), F.col("start_ms").alias("l_start"), F.col("end_ms").alias("l_end"))
    b = turns.select("media", "speaker", F.col("ord").alias("r_ord"), F.col("start_ms").alias("r_start"), F.col("end_ms").alias("r_end"))
    met = interval_join(a, b, on=["media", "speaker"], condition=F.col("l_ord") != F.col("r_ord"), **options)
    met = met.where(overlap_ms() >= share * (F.col("l_end") - F.col("l_start")))
    return holes.join(met.select("media", F.col("l_ord").alias("ord")).distinct(), ["media", "ord"], "left_semi")


def gaps(turns: DataFrame, *, min_ms: int = 500) -> DataFrame:
    """Stretches of ``min_ms`` or more before a turn in which none of the earlier turns lasts."""
    before = W.partitionBy("media").orderBy("start_ms", "ord").rowsBetween(W.unboundedPreceding, -1)
    return turns.withColumn("gap_start", F.max("end_ms").over(before)).where(F.col("start_ms") - F.col("gap_start") >= min_ms).select("media", "gap_start", F.col("start_ms").alias("gap_end"))


def all_gaps(turns: DataFrame, totals: DataFrame, *, min_ms: int = 500) -> DataFrame:
    """``gaps`` with those before the first turn and after the last one; ``totals`` are (media, total_ms)."""
    last = turns.groupBy("media").agg(F.min("start_ms").alias("_s"), F.max("end_ms").alias("_e"))
    edge = totals.join(last, "media", "left")
    whole = F.struct(F.lit(0).cast("long").alias("gap_start"), F.coalesce("_s", "total_ms").cast("long").alias("gap_end"))
    rest = F.when(F.col("_e").isNotNull(), F.struct(F.col("_e").cast("long").alias("gap_start"), F.col("total_ms").cast("long").alias("gap_end")))
    edges = edge.select("media", F.explode(F.array_compact(F.array(whole, rest))).alias("g")).select("media", "g.*").where(F.col("gap_end") - F.col("gap_start") >= min_ms)
    return gaps(turns, min_ms=min_ms).unionByName(edges)


def subtract(islands: DataFrame, spans: DataFrame, *, keys: list[str], pad_ms: int = 250, min_ms: int = 400) -> DataFrame:
    """What is left of disjoint islands without the spans, padded; pieces shorter than ``min_ms`` go.

    A sweep: ends of both kinds become deltas, summed per moment and then run over time.
    """
    step = lambda df, start, end, i, s: df.select(*keys, F.explode(F.array(F.struct(start.alias("t"), F.lit(i).alias("di"), F.lit(s).alias("ds"), F.lit(i).alias("begins")), F.struct(end.alias("t"), F.lit(-i).alias("di"), F.lit(-s).alias("ds"), F.lit(0).alias("begins")))).alias("e")).select(*keys, "e.*")
    events = step(islands, F.col("start_ms"), F.col("end_ms"), 1, 0).unionByName(step(spans, F.col("start_ms") - pad_ms, F.col("end_ms") + pad_ms, 0, 1))
    events = events.groupBy(*keys, "t").agg(F.sum("di").alias("di"), F.sum("ds").alias("ds"), F.max("begins").alias("begins"))
    order = W.partitionBy(*keys).orderBy("t")
    run = order.rowsBetween(W.unboundedPreceding, 0)
    free = (F.sum("di").over(run) > 0) & (F.sum("ds").over(run) == 0)
    events = events.withColumn("free", free).withColumn("next_t", F.lead("t").over(order))
    starts = F.col("free") & ((F.col("begins") > 0) | ~F.coalesce(F.lag("free").over(order), F.lit(False)))
    events = events.withColumn("run", F.sum(starts.cast("int")).over(run)).where("free")
    out = events.groupBy(*keys, "run").agg(F.min("t").alias("start_ms"), F.max("next_t").alias("end_ms"))
    return out.where(F.col("end_ms") - F.col("start_ms") >= min_ms).drop("run")
