"""Remaining rules: predicates, neighbourhoods, dictionary checks and findings for the quality gate."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import norm_text
from .intervals import interval_join, overlap_ms
from .sequence import ordered_fold
from .voices import speech_bounds


def voiced(kind: str = "type", echo: str = "echo") -> Column:
    """Is a segment to be spoken: no pasted original and no echo (nulls are neither)?"""
    return ~F.col(kind).eqNullSafe(F.lit("orig")) & ~F.coalesce(F.col(echo), F.lit(False))


def between(column: str, least: int | None = None, under: int | None = None) -> Column:
    """A range test that reaches the scan."""
    c = F.lit(True) if least is None else F.col(column) >= least
    return c if under is None else c & (F.col(column) < under)


def neighbour_words(segments: DataFrame, *, near_ms: int = 500) -> DataFrame:
    """(media, ord, words): distinct words that other speakers say around each segment, sorted."""
    a = segments.select("media", "ord", F.col("speaker").alias("s1"), (F.col("start_ms") - near_ms).alias("l_start"), (F.col("end_ms") + near_ms).alias("l_end"))
    b = segments.select("media", F.col("speaker").alias("s2"), F.split(F.lower("text"), r"\s+").alias("w"), F.col("start_ms").alias("r_start"), F.col("end_ms").alias("r_end"))
    met = interval_join(a, b, on=["media"], condition=F.col("s1") != F.col("s2")).select("media", "ord", F.explode("w").alias("word")).where("word <> ''")
    return met.distinct().groupBy("media", "ord").agg(F.sort_array(F.collect_list("word")).alias("words"))


def span_rms(spans: DataFrame, frames: DataFrame, *, frame_ms: int = 250) -> DataFrame:
    """(track, ord, rms): mean level of the frames from a span's first to before its last, one at least."""
    first, last = F.floor(F.col("start_ms") / frame_ms), F.floor(F.col("end_ms") / frame_ms)
    s = spans.select("track", "ord", F.explode(F.sequence(first, F.greatest(last - 1, first))).alias("frame_no"))
    return s.join(frames, ["track", "frame_no"]).groupBy("track", "ord").agg(F.avg("level").alias("rms"))


def foreign_share(segments: DataFrame, foreign: DataFrame, voiced_frames: DataFrame, *, frame_ms: int = 250) -> DataFrame:
    """(track, ord, share): foreign among the voiced frames of each segment; segments without voice are left out."""
    s = segments.select("track", "ord", F.explode(F.sequence(F.floor(F.col("start_ms") / frame_ms), F.floor((F.col("end_ms") - 1) / frame_ms))).alias("frame_no"))
    met = s.join(voiced_frames.select("track", "frame_no").distinct(), ["track", "frame_no"]).join(foreign.where("foreign").select("track", "frame_no", F.lit(1).alias("f")), ["track", "frame_no"], "left")
    return met.groupBy("track", "ord").agg((F.count("f") / F.count("*")).alias("share"))


def foreign_bucket(share: Column, *, mostly: float = 0.5, partly: float = 0.2) -> Column:
    return F.when(share > mostly, "mostly").when(share > partly, "partly")


def sung_text(segments: DataFrame, accents: DataFrame) -> DataFrame:
    """Segments (ord, text) with ``sung``: the marked text where there is one (ord, marked), else the text as it is."""
    return segments.join(accents.select("ord", "marked"), "ord", "left").withColumn("sung", F.coalesce("marked", "text")).drop("marked")


def decided(segments: DataFrame, decisions: DataFrame) -> DataFrame:
    """Segments (ord, text) with the translation that was decided on for their very words (text, translation), else null.

    Words are compared without punctuation and case; of several decisions on the same words the first by text counts.
    """
    key = lambda c: F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " "))
    known = decisions.groupBy(key(F.col("text")).alias("_key")).agg(F.min_by("translation", "text").alias("translation"))
    return segments.withColumn("_key", key(F.col("text"))).join(known, "_key", "left").drop("_key")


def missing_voices(segments: DataFrame, references: DataFrame) -> DataFrame:
    """(speaker) who speak but have no reference (speaker): nothing can be synthesised for them."""
    said = segments.where("speaker IS NOT NULL").select("speaker").distinct()
    return said.join(references.select("speaker"), "speaker", "left_anti")


def extents(rows: DataFrame, *, by: str = "media") -> DataFrame:
    """(by, first_ms, last_ms, n) of intervals."""
    return rows.groupBy(by).agg(F.min("start_ms").alias("first_ms"), F.max("end_ms").alias("last_ms"), F.count("*").alias("n"))


def locality_order(rows: DataFrame, *, by: str = "speaker", order: tuple[str, ...] = ("start_ms", "ord")) -> DataFrame:
    """Rows dealt by ``by`` and sorted in each part, with their ``place`` among those of the same ``by``: what depends on the
    same reference is worked on together."""
    w = W.partitionBy(by).orderBy(*order)
    return rows.withColumn("place", (F.row_number().over(w) - 1).cast("long")).sortWithinPartitions(by, *order)


def counted_passes(rows: DataFrame, name: str, **passes: Column):
    """The rows and an observation of how many of them pass each test, filled in by whatever action reads them first."""
    from pyspark.sql import Observation

    seen = Observation(name)
    return rows.observe(seen, *[F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in passes.items()]), seen


def spans_voiced(gaps: DataFrame, voiced: DataFrame, *, frame_ms: int = 250, least_ms: int = 10_000, share: float = 0.5) -> DataFrame:
    """Wordless gaps (track, ord, start_ms, end_ms) of ``least_ms`` or more over sound: (track, ord, voiced_share) from ``share`` on.

    ``voiced`` are the (track, frame_no) that sound.
    """
    g = gaps.where(F.col("end_ms") - F.col("start_ms") >= least_ms)
    frames = g.select("track", "ord", F.explode(F.sequence(F.floor(F.col("start_ms") / frame_ms), F.floor((F.col("end_ms") - 1) / frame_ms))).alias("frame_no"))
    met = frames.join(voiced.select("track", "frame_no", F.lit(1).alias("_v")).distinct(), ["track", "frame_no"], "left")
    return met.groupBy("track", "ord").agg((F.count("_v") / F.count("*")).alias("voiced_share")).where(F.col("voiced_share") >= share)


def preflight(rows: DataFrame, *, least_ms: int = 300) -> DataFrame:
    """(media, n, median, least, most) of speech time over the span it was said in, the upper median; short spans are left out."""
    from .voices import upper_median

    r = rows.where(F.col("span_ms") > least_ms).withColumn("_r", F.col("speech_ms") / F.col("span_ms"))
    return r.groupBy("media").agg(F.count("*").alias("n"), upper_median(F.col("_r")).alias("median"), F.min("_r").alias("least"), F.max("_r").alias("most"))


def stages_to_run(stages: DataFrame) -> DataFrame:
    """(item, stage) that are to be run: no output, or one older than an input (item, stage, output_at, input_at)."""
    stale = F.col("output_at").isNull() | F.coalesce(F.col("input_at") > F.col("output_at"), F.lit(False))
    return stages.where(stale).select("item", "stage")


def hits_of_homographs(texts: DataFrame, forms: list[str], *, text: str = "text") -> DataFrame:
    """(word, n): listed forms that stand without a mark, most frequent first."""
    w = texts.select(F.explode(F.regexp_extract_all(F.lower(F.col(text)), F.lit(r"([\p{L}+]+)"), F.lit(1))).alias("word"))
    return w.where(F.col("word").isin(*forms)).groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word")


def stretched_regions(words: DataFrame, *, stretch_ms: int = 2000, reach_ms: int = 30_000) -> DataFrame:
    """(media, first_ord, last_ord): stretches around drawn-out words, out to sentence ends nearby, joined where they meet.

    A drawn-out word that ends a sentence itself takes the next one in. The reach is strict on both sides.
    """

    def fold(rows):
        ends = [r["word"].strip()[-1:] in ".!?…" for r in rows]
        held = None
        for i, r in enumerate(rows):
            if r["end_ms"] - r["start_ms"] <= stretch_ms:
                continue
            a = i
            while a > 0 and not ends[a - 1] and r["start_ms"] - rows[a - 1]["start_ms"] < reach_ms:
                a -= 1
            b = i
            while b + 1 < len(rows) and (b == i or not ends[b]) and rows[b + 1]["end_ms"] - r["end_ms"] < reach_ms:
                b += 1
            if held and a <= held[1] + 1:
                held[1] = max(held[1], b)
            else:
                if held:
                    yield {"media": r["media"], "first_ord": rows[held[0]]["ord"], "last_ord": rows[held[1]]["ord"]}
                held = [a, b]
        if held:
            yield {"media": rows[0]["media"], "first_ord": rows[held[0]]["ord"], "last_ord": rows[held[1]]["ord"]}

    return ordered_fold(words.select("media", "ord", "word", "start_ms", "end_ms"), ["media"], ["ord"], fold, "media long, first_ord long, last_ord long")


def first_per_key(rows: DataFrame, *, key: str, order: list[str], n: int = 3) -> DataFrame:
    return rows.withColumn("_k", F.row_number().over(W.partitionBy(key).orderBy(*order))).where(F.col("_k") <= n).drop("_k")


def join_trimmed(pieces: list[np.ndarray], sr: int, gap_s: float = 0.35) -> np.ndarray:
    """Pieces cut to their speech (a silent one stays whole) and joined with silence between."""
    out: list[np.ndarray] = []
    for p in pieces:
        bounds = speech_bounds(p, sr, tail_margin=0.12)
        out += [np.zeros(int(gap_s * sr), p.dtype)] * bool(out) + [p if bounds is None else p[bounds[0] : bounds[1]]]
    return np.concatenate(out) if out else np.zeros(0, np.float32)


# -- dictionaries


def term_findings(texts: DataFrame, terms: list[dict], *, source: str, target: str) -> DataFrame:
    """Rows (ord, term, advice) of translations that break a glossary.

    A term has ``pattern`` on the source and ``want``, a stem that the target must then hold; where the source has
    no match but the term has ``avoid``, the target must not match that. A term of ``forbid`` alone must not occur.
    """
    rules = []
    t, s = F.lower(F.col(target)), F.col(source)
    for x in terms:
        if "forbid" in x:
            bad = F.contains(t, F.lit(x["forbid"].lower()))
        else:
            used = F.rlike(s, F.lit(f"(?i){x['pattern']}"))
            bad = F.when(used, ~F.contains(t, F.lit(x["want"].lower()))).otherwise(F.rlike(t, F.lit(f"(?i){x['avoid']}")) if x.get("avoid") else F.lit(False))
        rules.append(F.when(bad, F.struct(F.lit(x.get("forbid") or x["pattern"]).alias("term"), F.lit(x.get("why", "")).alias("advice"))))
    return texts.select("ord", F.explode(F.array_compact(F.array(*rules))).alias("f")).select("ord", "f.*")


def stem_findings(stems: DataFrame) -> DataFrame:
    """(severity, key, msg) for stems (key, value): lower-case keys, one mark in each hyphen part, no short stems."""
    parts = F.split("value", "-")
    marks = F.forall(parts, lambda p: F.length(p) - F.length(F.replace(p, F.lit("+"), F.lit(""))) == 1)
    checks = F.array_compact(F.array(
        F.when(F.col("key") != F.lower("key"), F.struct(F.lit("fail").alias("severity"), F.lit("key is not lower case").alias("msg"))),
        F.when(~marks, F.struct(F.lit("fail").alias("severity"), F.lit("each part needs one mark").alias("msg"))),
        F.when(F.length("key") <= 3, F.struct(F.lit("warn").alias("severity"), F.lit("short stem").alias("msg"))),
    ))
    return stems.select("key", F.explode(checks).alias("c")).select("c.severity", "key", "c.msg")


def variant_findings(variants: DataFrame) -> DataFrame:
    """(severity, key, msg) for homograph variants (key, ord, marked, en): a mark, cues, and no marked form twice."""
    seen = F.row_number().over(W.partitionBy("key", "marked").orderBy("ord")) > 1
    v = variants.withColumn("again", seen)
    marked = F.coalesce(F.contains("marked", F.lit("+")), F.lit(False))
    cues = F.coalesce(F.size(F.filter("en", lambda c: c.isNotNull() & (c != ""))) > 0, F.lit(False))
    checks = F.array_compact(F.array(F.when(F.col("key") != F.lower("key"), "key is not lower case"), F.when(~marked, "no marked form"), F.when(marked & ~cues, "no cues"), F.when(marked & F.col("again"), "marked form twice")))
    return v.select(F.lit("fail").alias("severity"), "key", F.explode(checks).alias("msg"))


def name_candidates(texts: DataFrame, *, text: str = "text") -> DataFrame:
    """(word, n): capitalised words without a mark that never stand in lower case, most frequent first."""
    w = texts.select(F.explode(F.regexp_extract_all(F.col(text), F.lit(r"([\p{L}+]+)"), F.lit(1))).alias("word"))
    upper = w.where(F.rlike("word", F.lit(r"^\p{Lu}\p{Ll}+$"))).groupBy("word").agg(F.count("*").alias("n")).withColumn("low", F.lower("word"))
    lower = w.where(F.rlike("word", F.lit(r"^\p{Ll}+$"))).select(F.col("word").alias("low")).distinct()
    return upper.join(lower, "low", "left_anti").select("word", "n").orderBy(F.desc("n"), "word")


# -- findings


def _finding(df: DataFrame, stage: str, severity: Column | str, msg: Column) -> DataFrame:
    sev = F.lit(severity) if isinstance(severity, str) else severity
    return df.select(F.lit(stage).alias("stage"), sev.alias("severity"), F.col("ord").alias("seg_id"), msg.alias("msg"))


def accent_findings(segments: DataFrame, accents: DataFrame, *, respell: Callable[[Column], Column] | None = None) -> DataFrame:
    """Segments (ord, text) against accents (ord, marked): missing, stale (with names respelt on both sides, where there is a
    ``respell``), or long without any mark."""
    m = segments.join(accents, "ord", "left").withColumn("plain", F.coalesce(norm_text("marked", respell) == norm_text("text", respell), F.lit(False)))
    missing, stale = m.where("marked IS NULL"), m.where("marked IS NOT NULL AND NOT plain")
    bare = m.where((F.length("text") > 12) & ~F.contains("marked", F.lit("+")))
    return _finding(missing, "accents", "fail", F.lit("missing")).unionByName(_finding(stale, "accents", "fail", F.lit("stale"))).unionByName(_finding(bare, "accents", "warn", F.lit("unmarked")))


def clip_findings(rows: DataFrame, *, most_missing: float = 0.1, before_synthesis: bool = False) -> DataFrame:
    """Rows (ord, bytes, entry, wanted): absent clips (a warning before synthesis or up to a share) and stale ones."""
    absent = F.coalesce("bytes", F.lit(0)) < 1024
    total = rows.agg(F.avg(absent.cast("double")).alias("_share"))
    few = (F.col("_share") <= most_missing) | F.lit(before_synthesis)
    m = rows.withColumn("_share", total.scalar())
    gone = _finding(m.where(absent), "clips", F.when(few, "warn").otherwise("fail"), F.lit("missing"))
    return gone.unionByName(_finding(rows.where(~absent & ~F.col("entry").eqNullSafe(F.col("wanted"))), "clips", "fail", F.lit("stale")))


def reference_findings(refs: DataFrame) -> DataFrame:
    """References (ord, text, seconds, head): no text, too long, too short, a silent head."""
    checks = F.array_compact(F.array(
        F.when(F.coalesce(F.trim("text"), F.lit("")) == "", F.struct(F.lit("fail").alias("s"), F.lit("no text").alias("m"))),
        F.when(F.col("seconds") > 11.6, F.struct(F.lit("fail").alias("s"), F.lit("too long").alias("m"))),
        F.when(F.col("seconds") < 4, F.struct(F.lit("warn").alias("s"), F.lit("short").alias("m"))),
        F.when(F.col("head") > 0.3, F.struct(F.lit("warn").alias("s"), F.lit("silent head").alias("m"))),
    ))
    r = refs.withColumn("c", F.explode(checks))
    return _finding(r, "refs", F.col("c.s"), F.col("c.m"))


def paste_findings(pastes: DataFrame, holes: DataFrame, segments: DataFrame, *, longest_ms: int = 4000, share: float = 0.5, clear: float = -1.0) -> DataFrame:
    """Pasted originals (ord, bytes, auto, start_ms, end_ms) without a file or, pasted by rule, too long; and uncovered holes
    (media, ord, speaker, start_ms, end_ms, n_words, logprob): three clear words or more fail, fewer or unclear ones
    warn, and so does what was another speaker's (a ``bleed`` column, where there is one)."""
    lost = _finding(pastes.where(F.coalesce("bytes", F.lit(0)) == 0), "paste", "fail", F.lit("file missing"))
    long_ = _finding(pastes.where(F.coalesce("auto", F.lit(False)) & (F.col("end_ms") - F.col("start_ms") > longest_ms)), "paste", "fail", F.lit("long"))
    bleed = F.coalesce("bleed", F.lit(False)) if "bleed" in holes.columns else F.lit(False)
    a = holes.withColumn("_bleed", bleed).select("media", "speaker", "ord", "n_words", "logprob", "_bleed", F.col("start_ms").alias("l_start"), F.col("end_ms").alias("l_end"))
    b = segments.select("media", "speaker", F.col("start_ms").alias("r_start"), F.col("end_ms").alias("r_end"))
    covered = interval_join(a, b, on=["media", "speaker"]).where(overlap_ms() >= share * (F.col("l_end") - F.col("l_start"))).select("media", "ord").distinct()
    open_ = a.join(covered, ["media", "ord"], "left_anti").withColumn("_clear", F.coalesce("logprob", F.lit(0.0)) >= clear)
    severity = F.when(~F.col("_bleed") & (F.col("n_words") >= 3) & F.col("_clear"), "fail").otherwise("warn")
    msg = F.when(F.col("_bleed"), "another speaker's words").when(F.col("_clear"), "untranscribed").otherwise("untranscribed, unclear")
    return lost.unionByName(long_).unionByName(_finding(open_, "speech", severity, msg))


def unchecked_speakers(pastes: DataFrame, checked: DataFrame) -> DataFrame:
    """(speaker) of automatic pastes (speaker, auto) that no speech check (speaker) has heard."""
    own = pastes.where(F.coalesce("auto", F.lit(False))).select("speaker").distinct()
    return own.join(checked.select("speaker").distinct(), "speaker", "left_anti")


def translation_findings(translated: DataFrame, base: DataFrame) -> DataFrame:
    """Failures for segments (ord, text, orig) without a translation and for those of ``base`` that are not there at all.
    Pasted originals need none."""
    said = lambda df: df.where(~F.coalesce("orig", F.lit(False)))
    bare = said(translated).where(F.coalesce("text", F.lit("")) == "")
    gone = said(base).select("ord").join(translated.select("ord"), "ord", "left_anti")
    return _finding(bare, "translation", "fail", F.lit("untranslated")).unionByName(_finding(gone, "translation", "fail", F.lit("absent")))


def unknown_ids(chunk: DataFrame, base: DataFrame, *, key: str) -> DataFrame:
    """Keys of a chunk that the base lacks: they are refused."""
    return chunk.select(key).join(base.select(key), key, "left_anti")


def track_findings(wanted: DataFrame, files: DataFrame) -> DataFrame:
    """A failure for each track (ord, file) whose file (file, bytes) is not there."""
    return _finding(wanted.join(files.select("file").distinct(), "file", "left_anti"), "tracks", "fail", F.concat(F.col("file"), F.lit(" missing")))


def words_findings(items: DataFrame, degraded: DataFrame, loops: DataFrame) -> DataFrame:
    """Findings on transcripts: items (media, n_words) without words fail, degraded windows tell their reason at their own
    severity, loops (media, ord, start_ms, gram) warn. The item stands in for a segment."""
    at = lambda ms: F.round(F.col(ms) / 60_000).cast("long").cast("string")
    empty = items.where(F.coalesce("n_words", F.lit(0)) == 0).withColumn("ord", F.col("media"))
    windows = degraded.withColumn("ord", F.col("media"))
    told = F.concat(F.lit("degraded "), at("t0_ms"), F.lit("-"), at("t1_ms"), F.lit(" min: "), F.col("reason"))
    again = F.concat(F.lit("possible loop at "), at("start_ms"), F.lit(" min: "), F.col("gram"))
    found = _finding(empty, "words", "fail", F.lit("no words")).unionByName(_finding(windows, "words", F.col("severity"), told))
    return found.unionByName(_finding(loops.withColumn("ord", F.col("media")), "words", "warn", again))


def qc_findings(takes: DataFrame, *, rerolled: bool, before_synthesis: bool = False) -> DataFrame:
    """One finding for each clip (ord, flags, sim) that quality control still flags: a failure once re-rolling has been tried."""
    flagged = takes.where(F.size("flags") > 0)
    sim = F.format_string("%.2f", F.col("sim"))
    msg = F.concat(F.array_join("flags", ","), F.lit(" sim "), sim, F.lit(" after re-roll" if rerolled else " not re-rolled"))
    return _finding(flagged, "clips", "fail" if rerolled and not before_synthesis else "warn", msg)
