"""Rules for speakers recorded on tracks of their own: echoes, fragments, confidence, overlaps."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.speech import shared_blocks, text_ratio, vectorised
from .intervals import interval_join
from .sequence import ordered_fold

# Sounds that are no words, phrases that recognisers invent over breath, fillers and stop words.
NON_VERBAL = r"(?i)^[-\s.,!?…]*(?:(?:m+[-\s]?h?m+|h+m+|uh[-\s]?huh|mhm+|ha(?:[-\s]?ha)+)[-.!?,…\s]*)+$"
INVENTED = ("thank you.", "thanks for watching.", "thank you for watching.", "subscribe!", "thanks.")
FILLERS = ("yeah", "yes", "okay", "ok", "mmhmm", "hmm", "mm", "mmm", "right", "uhhuh", "no", "so", "and", "oh", "wow", "sure", "yep", "exactly", "ha")
STOP_WORDS = (
    "the", "a", "an", "it", "its", "is", "are", "was", "were", "be", "they", "theyre", "we", "you", "i", "he", "she", "that", "thats", "this", "to", "of", "in", "on", "at", "for", "with", "what", "whats", "about", "like", "just", "but", "do", "dont", "did", "there", "theres", "have", "has", "can", "if", "or", "all", "one", "not",
)
LOOP_FILLERS = (
    "yeah", "yes", "no", "okay", "ok", "right", "sure", "yep", "exactly", "mm", "mmm", "hmm", "mmhmm", "uhhuh", "uh", "um", "oh", "wow", "so", "and", "i", "dont", "know", "thanks", "thank", "you", "ha", "wait",
)


def non_verbal(text: Column | str) -> Column:
    return F.rlike(F.col(text) if isinstance(text, str) else text, F.lit(NON_VERBAL))


def plain_words(text: Column | str) -> Column:
    t = F.regexp_replace(F.lower(F.col(text) if isinstance(text, str) else text), "[^a-z0-9 ]", "")
    return F.filter(F.split(t, " +"), lambda w: w != "")


def orphan(text: Column, n_words: Column) -> Column:
    """A piece of three words or fewer without an end mark that is no sound either."""
    return (n_words <= 3) & ~F.rlike(F.trim(text), F.lit(r"[.!?…]$")) & ~non_verbal(text)


def quiet_inventions(segments: DataFrame, *, share: float = 0.25) -> DataFrame:
    """Segments (media, ord, speaker, text, level) of an invented phrase, quieter than a share of the speaker's median."""
    m = segments.groupBy("media", "speaker").agg(F.median("level").alias("_m"))
    hit = segments.where(F.lower(F.trim("text")).isin(*INVENTED)).join(m, ["media", "speaker"])
    return hit.where(F.col("level") < share * F.col("_m")).drop("_m")


def confidence(
    segments: DataFrame, words: DataFrame, *, slack_ms: int = 50, paste: float = 0.5, flag: float = 0.65, longest_ms: int = 4000, sound: Column | None = None,
) -> DataFrame:
    """Mean probability of the words inside each segment (null without any) and what follows from it.

    ``route`` is ``paste`` for short lines of low confidence, else ``backchannel`` for sounds that are no words, else
    ``flag`` for lines of middling confidence, else null. A segment without words has no confidence, so only its text counts.
    ``sound`` tells the segments that are sounds where the text's spelling (``non_verbal``) is not to.
    """
    a = segments.select("media", "speaker", "ord", "text", F.col("start_ms").alias("_s"), F.col("end_ms").alias("_e"), (F.col("start_ms") - slack_ms).alias("l_start"), (F.col("end_ms") + slack_ms).alias("l_end"))
    b = words.select("media", "speaker", "prob", F.col("start_ms").alias("r_start"), F.col("end_ms").alias("r_end"))
    met = interval_join(a, b, on=["media", "speaker"]).where("r_start >= l_start AND r_end <= l_end")
    p = met.groupBy("media", "ord").agg(F.avg("prob").alias("conf"))
    low = (F.col("conf") < paste) & (F.col("end_ms") - F.col("start_ms") <= longest_ms)
    sound = non_verbal(F.trim("text")) if sound is None else sound
    route = F.when(low, "paste").when(sound, "backchannel").when(F.col("conf") < flag, "flag")
    return segments.join(p, ["media", "ord"], "left").withColumn("route", route)


def echo_segments(segments: DataFrame, *, near_ms: int = 700, least: float = 0.8) -> DataFrame:
    """Segments (media, ord, speaker, start_ms, text, level) that repeat another speaker's at the same moment: (media, ord).

    Pairs come from a band join; in order of the earlier row, the quieter of a pair goes (the later on a tie), and
    a row that has gone neither begins nor joins later pairs, but finishes the pairs of its own turn.
    """
    row = lambda p: [F.col("ord").alias(f"{p}_ord"), F.col("speaker").alias(f"{p}_speaker"), F.col("text").alias(f"{p}_text"), F.col("level").alias(f"{p}_level")]
    a = segments.select("media", *row("l"), F.col("start_ms").alias("l_start"), (F.col("start_ms") + near_ms + 1).alias("l_end"))
    b = segments.select("media", *row("r"), F.col("start_ms").alias("r_start"), (F.col("start_ms") + 1).alias("r_end"))
    later = F.struct(F.col("l_start").alias("t"), F.col("l_ord").alias("o")) < F.struct(F.col("r_start").alias("t"), F.col("r_ord").alias("o"))
    met = interval_join(a, b, on=["media"], condition=(F.col("l_speaker") != F.col("r_speaker")) & later)
    met = met.where(vectorised(text_ratio, "double")("l_text", "r_text") >= least)

    def resolve(rows):
        gone: set = set()
        began = None
        for r in rows:
            if r["l_ord"] != began:
                began, skip = r["l_ord"], r["l_ord"] in gone
            if skip or r["r_ord"] in gone:
                continue
            gone.add(r["l_ord"] if r["l_level"] < r["r_level"] else r["r_ord"])
        return [{"media": rows[0]["media"], "ord": o} for o in sorted(gone)]

    return ordered_fold(met, ["media"], ["l_start", "l_ord", "r_start", "r_ord"], resolve, "media long, ord long")


def echo_fragments(segments: DataFrame, *, near_ms: int = 4000, quiet: float = 0.5, share: float = 0.7) -> DataFrame:
    """Quiet segments most of whose words stand in what others say around them: (media, ord)."""
    m = segments.groupBy("media", "speaker").agg(F.median("level").alias("_m"))
    words = F.regexp_extract_all(F.lower("text"), F.lit("([a-zа-яё]{3,})"), F.lit(1))
    a = segments.join(m, ["media", "speaker"]).where(F.col("level") < quiet * F.col("_m")).withColumn("w", words).where(F.size("w") >= 3)
    a = a.select("media", "ord", "w", F.col("speaker").alias("s1"), (F.col("start_ms") - near_ms).alias("l_start"), (F.col("end_ms") + near_ms).alias("l_end"))
    b = segments.select("media", F.col("speaker").alias("s2"), F.lower("text").alias("t"), F.col("start_ms").alias("r_start"), F.col("end_ms").alias("r_end"))
    met = interval_join(a, b, on=["media"], condition=F.col("s1") != F.col("s2"))
    near = met.groupBy("media", "ord", "w").agg(F.array_join(F.sort_array(F.collect_list("t")), " ").alias("t"))
    return near.where(F.size(F.filter("w", lambda x: F.contains(F.col("t"), x))) >= share * F.size("w")).select("media", "ord")


def repeats(segments: DataFrame, *, window_ms: int = 3000, least: float = 0.6) -> DataFrame:
    """Pairs in which another speaker says much of the same: (media, a, b, shared, echo), echo being the echoing row or null."""
    s = segments.withColumn("w", F.filter(plain_words("text"), lambda x: ~x.isin(*FILLERS))).where(F.size("w") >= 2)
    row = lambda p: [F.col("ord").alias(p), F.col("speaker").alias(f"s{p}"), F.col("w").alias(f"w{p}"), F.col("end_ms").alias(f"e{p}"), plain_words("text").alias(f"x{p}")]
    a = s.select("media", *row("a"), F.col("start_ms").alias("l_start"), (F.greatest("end_ms", F.col("start_ms") + window_ms) + 1).alias("l_end"))
    b = s.select("media", *row("b"), F.col("start_ms").alias("r_start"), (F.col("start_ms") + 1).alias("r_end"))
    met = interval_join(a, b, on=["media"], condition=(F.col("sa") != F.col("sb")) & (F.struct(F.col("l_start").alias("t"), F.col("a").alias("o")) < F.struct(F.col("r_start").alias("t"), F.col("b").alias("o"))))
    met = met.withColumn("shared", vectorised(lambda x, y: shared_blocks(list(x), list(y)), "int")("wa", "wb"))
    met = met.where((F.col("shared") >= 2) & (F.col("shared") >= least * F.least(F.size("wa"), F.size("wb"))))

    def echo(short: str, long_: str, start: str, long_start: str) -> Column:
        content = F.array_except(F.array_distinct(F.col(f"x{short}")), F.array(*[F.lit(x) for x in (*FILLERS, *STOP_WORDS)]))
        in_other = F.size(F.array_intersect(content, F.col(f"x{long_}")))
        inside = (F.col(long_start) < F.col(start)) & (F.col(start) < F.col(f"e{long_}"))
        return (F.col(f"e{short}") - F.col(start) <= 3500) & inside & (F.size(content) > 0) & (in_other >= 0.6 * F.size(content))

    a_short = F.col("ea") - F.col("l_start") <= F.col("eb") - F.col("r_start")
    found = F.when(a_short & echo("a", "b", "l_start", "r_start"), F.col("a")).when(~a_short & echo("b", "a", "r_start", "l_start"), F.col("b"))
    return met.select("media", "a", "b", "shared", found.alias("echo"))


def interruptions(segments: DataFrame, turns: DataFrame, *, slack_ms: int = 200, least_ms: int = 400, most_ms: int = 6000) -> DataFrame:
    """Segments that began, by the speaker's turn, inside another speaker's segment: (media, ord, start_ms, lead_ms, over).

    Candidates (the latest own turn that spans the start) come from an interval join; the walk in order is
    sequential, since a moved start decides whether later rows are covered.
    """
    a = segments.select("media", "speaker", "ord", (F.col("start_ms") + slack_ms).alias("l_start"), (F.col("start_ms") + slack_ms + 1).alias("l_end"))
    t = turns.select("media", "speaker", F.col("start_ms").alias("r_start"), F.col("end_ms").alias("r_end"))
    own = interval_join(a, t, on=["media", "speaker"]).where("r_start < l_start AND r_end > l_start").groupBy("media", "ord").agg(F.max("r_start").alias("turn_ms"))
    rows = segments.withColumn("overlap", F.coalesce("overlap", F.lit(False)) if "overlap" in segments.columns else F.lit(False)).join(own, ["media", "ord"], "left")

    def walk(rs):
        starts = np.array([r["start_ms"] for r in rs], np.int64)
        ends = np.array([r["end_ms"] for r in rs], np.int64)

        def spanning(t):
            """Rows over a moment, in order; starts only ever move back, and a moved one is kept in the array."""
            return (rs[i] for i in np.flatnonzero((starts < t) & (ends > t)))

        for k, r in enumerate(rs):
            if r["overlap"] or pd.isna(r["turn_ms"]) or not least_ms <= r["start_ms"] - r["turn_ms"] <= most_ms:
                continue
            over = next((o for o in spanning(r["turn_ms"]) if o["speaker"] != r["speaker"] and o["start_ms"] < r["turn_ms"] < o["end_ms"]), None)
            if over is not None:
                starts[k] = r["turn_ms"]
                lead, r["start_ms"], r["overlap"] = int(r["start_ms"] - r["turn_ms"]), int(r["turn_ms"]), True
                yield {"media": r["media"], "ord": r["ord"], "start_ms": r["start_ms"], "lead_ms": lead, "over": over["ord"]}

    return ordered_fold(rows.select("media", "ord", "speaker", "start_ms", "end_ms", "overlap", "turn_ms"), ["media"], ["ord"], walk, "media long, ord long, start_ms long, lead_ms long, over long")


def loops(hits: DataFrame, words: DataFrame, *, n: int = 3, repeats: int = 3, quiet_ms: int = 60_000) -> DataFrame:
    """Of raw n-gram loop hits (media, ord, gram) the reported ones: (media, ord, start_ms, gram).

    Loops of fillers alone are speech. A hit takes its words out, and the same phrase soon after is not told again.
    """
    tokens = F.split("gram", " ")
    real = hits.where(F.exists(tokens, lambda t: ~(t.isin(*LOOP_FILLERS) | F.rlike(t, F.lit("^(ha|ah|he)+$")) | (t == ""))))
    rows = real.join(words.select("media", "ord", "start_ms"), ["media", "ord"])

    def walk(rs):
        free, last = -1, None
        for r in rs:
            if r["ord"] < free:
                continue
            free = r["ord"] + n * repeats
            if last and last["gram"] == r["gram"] and r["start_ms"] - last["start_ms"] < quiet_ms:
                continue
            last = r
            yield {"media": r["media"], "ord": r["ord"], "start_ms": r["start_ms"], "gram": r["gram"]}

    return ordered_fold(rows.select("media", "ord", "gram", "start_ms"), ["media"], ["ord"], walk, "media long, ord long, start_ms long, gram string")


def hidden_speech(regions: DataFrame, heard: DataFrame, nearby: DataFrame, *, first_id: int = 8000, most_share: float = 0.6) -> DataFrame:
    """Rows to add for speech found under an overlap.

    ``regions`` are (media, region, start_ms, end_ms), ``heard`` (media, region, speaker, sim, level, words) for each
    separated voice and candidate speaker, ``nearby`` (media, region, words) what is already known around. Voices
    under level .01, of fewer than two words or mostly known are left out; the most similar speaker gets the rest.
    """
    best = heard.where("level >= 0.01").groupBy("media", "region", "words").agg(F.max_by("speaker", "sim").alias("speaker"))
    met = best.join(nearby.withColumnRenamed("words", "known"), ["media", "region"], "left").join(regions, ["media", "region"])
    own = F.array_distinct("words")
    met = met.where((F.size("words") >= 2) & (F.size(F.array_intersect(own, F.coalesce("known", F.array().cast("array<string>")))) <= most_share * F.size(own)))
    ids = F.row_number().over(W.partitionBy("media").orderBy("start_ms", "speaker")) + (first_id - 1)
    return met.select("media", ids.cast("long").alias("ord"), "speaker", "start_ms", "end_ms", F.array_join("words", " ").alias("text"), F.lit(True).alias("overlap"))
