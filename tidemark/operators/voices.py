"""Voice references, laughter, bleed decisions and clip bounds."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .sequence import ordered_fold

# Tokens that recognisers write for sounds.
SOUNDS = (
    "mm", "mmm", "hmm", "hm", "mhm", "mmhmm", "uh", "um", "uhhuh", "oh", "ooh", "ah", "aah", "huh", "heh", "hah", "ha", "ho", "wow", "whoa", "ugh", "hmph", "phew", "shh",
)


def reference_runs(segments: DataFrame, *, gap_ms: int = 500, max_ms: int = 20_000, min_ms: int = 6000) -> DataFrame:
    """Runs of a speaker's consecutive segments to cut a voice reference from, with their rank.

    Long enough runs come first, the longest of them leading; equal ones keep their order. A single segment over
    the limit is no run. (media, speaker, start_ms, end_ms, n, rank).
    """

    def fold(rows):
        run = None
        for r in [*rows, None]:
            if run and r is not None and r["start_ms"] - run["end_ms"] <= gap_ms and r["end_ms"] - run["start_ms"] <= max_ms:
                run["end_ms"], run["n"] = r["end_ms"], run["n"] + 1
                continue
            if run and run["end_ms"] - run["start_ms"] <= max_ms:
                yield run
            run = r and {"media": r["media"], "speaker": r["speaker"], "start_ms": r["start_ms"], "end_ms": r["end_ms"], "n": 1}

    kind = {"bigint": "long"}.get(k := segments.schema["speaker"].dataType.simpleString(), k)
    runs = ordered_fold(segments.select("media", "ord", "speaker", "start_ms", "end_ms"), ["media", "speaker"], ["ord"], fold, f"media long, speaker {kind}, start_ms long, end_ms long, n long")
    span = F.col("end_ms") - F.col("start_ms")
    return runs.withColumn("rank", F.row_number().over(W.partitionBy("media", "speaker").orderBy(span < min_ms, -span, "start_ms")))


def capped_regions(regions: DataFrame, *, keys: list[str], gap_ms: int, max_ms: int) -> DataFrame:
    """Join neighbouring intervals unless the whole would last longer than ``max_ms``."""

    def fold(rows):
        held = None
        for r in rows:
            if held and r["start_ms"] - held["end_ms"] <= gap_ms and r["end_ms"] - held["start_ms"] <= max_ms:
                held["end_ms"] = max(held["end_ms"], r["end_ms"])
            else:
                if held:
                    yield held
                held = {**{k: r[k] for k in keys}, "start_ms": r["start_ms"], "end_ms": r["end_ms"]}
        if held:
            yield held

    types = ", ".join(f"{k} {({'bigint': 'long'}).get(t := regions.schema[k].dataType.simpleString(), t)}" for k in keys)
    return ordered_fold(regions.select(*keys, "start_ms", "end_ms"), keys, ["start_ms", "end_ms"], fold, f"{types}, start_ms long, end_ms long")


def nearest_pause(turns: DataFrame, targets: DataFrame, *, min_ms: int = 300, reach_ms: int = 60_000) -> DataFrame:
    """For each target (media, t) the middle of the closest pause within reach, the earlier on a tie; null for none."""
    from .intervals import gaps, interval_join

    g = gaps(turns, min_ms=min_ms).select("media", ((F.col("gap_start") + F.col("gap_end")) / 2).cast("long").alias("r_start")).withColumn("r_end", F.col("r_start") + 1)
    a = targets.select("media", "t", (F.col("t") - reach_ms).alias("l_start"), (F.col("t") + reach_ms + 1).alias("l_end"))
    best = interval_join(a, g, on=["media"]).groupBy("media", "t").agg(F.min(F.struct(F.abs(F.col("r_start") - F.col("t")).alias("d"), "r_start"))["r_start"].alias("pause"))
    return targets.join(best, ["media", "t"], "left")


def chunk_bounds(turns: DataFrame, totals: DataFrame, hops: DataFrame, *, chunk_ms: int = 1_200_000, reach_ms: int = 60_000, min_ms: int = 300, hop_ms: int = 300) -> DataFrame:
    """(media, n, bound_ms): where a recording is cut into chunks, each counted from the last cut.

    A cut is snapped to the middle of the closest pause within reach, the earlier on a tie; without one to the middle
    of the quietest of the ``hops`` (media, hop, level) in reach, the first of them; without any it stays.
    ``totals`` are (media, total_ms). The first bound is 0, the last the total.
    """
    from .intervals import all_gaps

    whole = totals.select("media", F.col("total_ms").alias("at"), F.lit("total").alias("kind"), F.lit(0.0).alias("level"))
    pause = all_gaps(turns, totals, min_ms=min_ms).select("media", F.floor((F.col("gap_start") + F.col("gap_end")) / 2).alias("at"), F.lit("pause").alias("kind"), F.lit(0.0).alias("level"), "gap_end")
    # silence after the last turn is no pause before one
    last = turns.groupBy("media").agg(F.max("start_ms").alias("_last"))
    pause = pause.join(last, "media").where(F.col("gap_end") <= F.col("_last")).drop("gap_end", "_last")
    quiet = hops.select("media", (F.col("hop") * hop_ms).alias("at"), F.lit("hop").alias("kind"), F.col("level").cast("double").alias("level"))

    def fold(rows):
        total = next((r["at"] for r in rows if r["kind"] == "total"), None)
        if total is None:
            return
        pauses = np.array([r["at"] for r in rows if r["kind"] == "pause"], np.int64)
        at, level = (np.array([r[c] for r in rows if r["kind"] == "hop"]) for c in ("at", "level"))
        bounds, t = [0], chunk_ms
        while t < total - reach_ms:
            near = pauses[(pauses >= t - reach_ms) & (pauses <= t + reach_ms)]
            inside = np.flatnonzero((at >= max(t - reach_ms, 0)) & (at + hop_ms <= t + reach_ms))
            cut = int(near[np.abs(near - t).argmin()]) if len(near) else int(at[inside[level[inside].argmin()]] + hop_ms // 2) if len(inside) else t
            bounds.append(max(cut, bounds[-1] + 1))
            t = bounds[-1] + chunk_ms
        yield from ({"media": rows[0]["media"], "n": i, "bound_ms": b} for i, b in enumerate([*bounds, int(total)]))

    return ordered_fold(whole.unionByName(pause).unionByName(quiet), ["media"], ["at", "kind"], fold, "media long, n long, bound_ms long")


def guarded_pass(run: Callable[[int, int], list[dict]], start_ms: int, end_ms: int, *, window: int = 80, least: int = 4, advance_ms: int = 60_000) -> list[dict]:
    """Words of ``run(a, b)``, run anew from the last sentence end before punctuation fails, while that gains a minute.

    A driver loop around a recogniser that is called from outside; its words come as rows of word, start_ms, end_ms.
    """
    out: list[dict] = []
    at = start_ms
    while True:
        words = run(at, end_ms)
        mark = [w["word"].strip()[-1:] in ".,!?…" for w in words]
        poor = next((i for i in range(window - 1, len(words)) if sum(mark[i - window + 1 : i + 1]) < least), None)
        ends = [i for i in range(poor - window + 1 if poor is not None else 0) if words[i]["word"].strip()[-1:] in ".!?…"]
        if poor is None or not ends or words[ends[-1]]["end_ms"] - at < advance_ms:
            return out + words
        out += words[: ends[-1] + 1]
        at = words[ends[-1]]["end_ms"]


def frame_levels(x: np.ndarray, frame: int) -> np.ndarray:
    n = len(x) // frame
    return np.sqrt((x[: n * frame].reshape(n, frame).astype(np.float64) ** 2).mean(1)) if n else np.zeros(0)


def speech_bounds(x: np.ndarray, sr: int, *, floor: float = 0.01, share: float = 0.1, margin: float = 0.05, tail_share: float = 0.01, tail_max: float = 0.35, head_share: float = 0.05, head_max: float = 0.1, tail_margin: float | None = None) -> tuple[int, int] | None:
    """Samples between which a clip speaks, with some air; null for silence.

    Speech is where 20 ms frames exceed a share of their 99th percentile; from there both ends reach out while the
    sound still decays, for a bounded time.
    """
    frame = sr // 50
    level = frame_levels(x, frame)
    if not len(level):
        return None
    top = np.percentile(level, 99)
    loud = np.flatnonzero(level > max(floor, share * top))
    if not len(loud):
        return None

    def reach(edge: int, step: int, low: float, most: float) -> int:
        at = edge
        while 0 <= at + step < len(level) and abs(at - edge) * frame < most * sr and level[at + step] > max(0.3 * floor, low * top):
            at += step
        return at

    first, last = reach(loud[0], -1, head_share, head_max), reach(loud[-1], 1, tail_share, tail_max)
    return max(0, int(first) * frame - int(margin * sr)), min(len(x), (int(last) + 1) * frame + int((margin if tail_margin is None else tail_margin) * sr))


def audition(x: np.ndarray, sr: int, *, frame: float = 0.05, floor: float = 0.01) -> tuple[float, float, float]:
    """Seconds of silence at the head and the tail, and the voiced share."""
    level = frame_levels(x, int(frame * sr))
    loud = np.flatnonzero(level > max(floor, 0.1 * np.percentile(level, 95))) if len(level) else np.zeros(0, int)
    if not len(loud):
        return len(x) / sr, len(x) / sr, 0.0
    return float(loud[0] * frame), float((len(level) - 1 - loud[-1]) * frame), len(loud) / len(level)


def is_laugh(seconds: Column, bursts: Column, panns: Column) -> Column:
    return ((seconds >= 0.7) & (bursts >= 2)) | (panns >= 0.05)


def speech_words(text: Column) -> Column:
    """Words of a transcript that are no mere sounds."""
    tokens = F.filter(F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}_' ]+", " "), " +"), lambda t: t != "")
    bare = lambda t: F.replace(t, F.lit("'"), F.lit(""))
    return F.filter(tokens, lambda t: ~(bare(t).isin(*SOUNDS) | F.rlike(bare(t), F.lit("^(ha|he|ah|ho|hee|hah)+h?$"))))


def is_speech_leak(n_words: Column, panns: Column) -> Column:
    return (n_words > 0) & ((n_words > 2) | (panns < 0.05))


def is_bleed(heard: Column, others: Column, share: float = 0.5) -> Column:
    """Do the others' words hold at least a share of what was heard (of its longer words, if it has any)?"""
    norm = lambda a: F.transform(a, lambda w: F.regexp_replace(F.lower(w), r"[^\p{L}\p{N}_]+", ""))
    words, pool = norm(heard), norm(others)
    long_ = F.filter(words, lambda w: F.length(w) >= 4)
    content = F.when(F.size(long_) > 0, long_).otherwise(words)
    return (F.size(content) > 0) & (F.size(F.filter(content, lambda w: F.array_contains(pool, w))) >= share * F.size(content))


def bleed_dropped(own: Column, others: Column, expected: Column | None = None, *, ratio: float = 6, over: float = 3) -> Column:
    """Is a sound another track's? Against the calibrated expectation where there is one, else against the others' level."""
    plain = others >= ratio * F.greatest(own, F.lit(1e-6))
    return plain if expected is None else F.when(expected.isNotNull(), own <= over * expected).otherwise(plain)


def foreign_frames(frames: DataFrame, windows: DataFrame, *, margin: float = 0.05, grow: int = 3, sure: float = 0.15) -> DataFrame:
    """(track, frame_no, foreign): voiced frames whose windows sound like another voice, grown over unsure neighbours.

    ``windows`` are (track, start_ms, end_ms, score); a frame takes the mean of those over it, 1 without any.
    """
    from .intervals import interval_join

    f = frames.select("track", "frame_no", "voiced", (F.col("frame_no") * 250).alias("l_start"), (F.col("frame_no") * 250 + 250).alias("l_end"))
    w = windows.select("track", "score", F.col("start_ms").alias("r_start"), F.col("end_ms").alias("r_end"))
    mean = interval_join(f, w, on=["track"]).groupBy("track", "frame_no").agg(F.avg("score").alias("score"))
    f = frames.join(mean, ["track", "frame_no"], "left").withColumn("score", F.coalesce("score", F.lit(1.0)))
    f = f.withColumn("foreign", F.col("voiced") & (F.col("score") < -margin))
    order = W.partitionBy("track").orderBy("frame_no")
    for _ in range(grow):
        near = F.coalesce(F.lag("foreign").over(order), F.lit(False)) | F.coalesce(F.lead("foreign").over(order), F.lit(False))
        f = f.withColumn("foreign", F.col("foreign") | (near & F.col("voiced") & (F.col("score") < sure)))
    return f.select("track", "frame_no", "foreign")


def allocate(chars: Column, total_ms: Column, *, least_ms: int = 400, pad_ms: int = 500) -> Column:
    """Time of each piece: its share of the letters, at least ``least_ms``, and padding."""
    whole = F.greatest(F.aggregate(chars, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(1))
    return F.transform(chars, lambda c: F.greatest(F.floor(total_ms * c / whole), F.lit(least_ms)) + pad_ms)


def upper_median(values: Column) -> Column:
    s = F.sort_array(F.collect_list(values))
    return F.element_at(s, (F.floor(F.size(s) / 2) + 1).cast("int"))


def decibels(level: float) -> float:
    return 20 * math.log10(max(level, 1e-9))
