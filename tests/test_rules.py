"""Remaining rules on literal rows."""

import numpy as np
from pyspark.sql import functions as F

from tidemark.operators import rules


def rows(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def test_predicates(spark):
    s = spark.createDataFrame([(0, None, None, 5), (1, "orig", None, 6), (2, None, True, 7), (3, "x", False, 8)], "id long, type string, echo boolean, start_ms long")
    assert rows(s.where(rules.voiced()), "id") == [(0,), (3,)]
    assert rows(s.where(rules.between("start_ms", 6, 8)), "id") == [(1,), (2,)]
    assert s.where(rules.between("start_ms")).count() == 4


def test_neighbours_and_levels(spark):
    s = spark.createDataFrame([(1, 0, "A", 0, 1000, "Hi there"), (1, 1, "B", 1200, 2000, "well  hi"), (1, 2, "B", 9000, 9500, "far")], "media long, ord long, speaker string, start_ms long, end_ms long, text string")
    assert rows(rules.neighbour_words(s).withColumn("w", F.array_join("words", " ")), "ord", "w") == [(0, "hi well"), (1, "hi there")]
    f = spark.createDataFrame([("t", i, float(i)) for i in range(10)], "track string, frame_no long, level double")
    spans = spark.createDataFrame([("t", 0, 500, 1300), ("t", 1, 600, 700)], "track string, ord long, start_ms long, end_ms long")
    assert rows(rules.span_rms(spans, f), "ord", "rms") == [(0, 3.0), (1, 2.0)]
    foreign = f.select("track", "frame_no", (F.col("frame_no") >= 4).alias("foreign"))
    assert rows(rules.foreign_share(spans, foreign, f), "ord", "share") == [(0, 0.5), (1, 0.0)]


def test_stretched(spark):
    w = [(1, i, t, a, b) for i, (t, a, b) in enumerate([("one.", 0, 400), ("two", 500, 900), ("looong", 1000, 4000), ("end.", 4100, 4500), ("next", 4600, 5000)])]
    got = rules.stretched_regions(spark.createDataFrame(w, "media long, ord long, word string, start_ms long, end_ms long"))
    assert rows(got, "first_ord", "last_ord") == [(1, 3)]


def test_dictionaries(spark):
    stems = spark.createDataFrame([("рид", "Р+ида-Солом+она"), ("Ab", "ab"), ("корин", "Кор+инф")], "key string, value string")
    assert rows(rules.stem_findings(stems), "severity", "key", "msg") == [("fail", "Ab", "each part needs one mark"), ("fail", "Ab", "key is not lower case"), ("warn", "Ab", "short stem"), ("warn", "рид", "short stem")]
    variants = spark.createDataFrame([("замок", 0, "з+амок", ["castle"]), ("замок", 1, "зам+ок", []), ("замок", 2, "з+амок", ["fort"]), ("мука", 0, None, ["flour"])], "key string, ord int, marked string, en array<string>")
    assert rows(rules.variant_findings(variants), "key", "msg") == [("замок", "marked form twice"), ("замок", "no cues"), ("мука", "no marked form")]
    t = spark.createDataFrame([(0, "The Gospel says", "говорит книга"), (1, "The gospel", "евангелие"), (2, "other", "плохое слово")], "ord long, en string, ru string")
    terms = [{"pattern": r"\bgospel\b", "want": "евангел", "why": "name it"}, {"forbid": "плох", "why": "milder"}]
    assert rows(rules.term_findings(t, terms, source="en", target="ru"), "ord", "advice") == [(0, "name it"), (2, "milder")]
    names = spark.createDataFrame([("Anna saw Bob and Bob saw anna",), (None,)], "text string")
    assert [tuple(r) for r in rules.name_candidates(names).collect()] == [("Bob", 2)]


def test_findings(spark):
    seg = spark.createDataFrame([(0, "текст"), (1, "другой текст здесь"), (2, "ещё")], "ord long, text string")
    acc = spark.createDataFrame([(0, "т+екст"), (1, "другой текст здесь")], "ord long, marked string")
    assert rows(rules.accent_findings(seg, acc), "severity", "seg_id", "msg") == [("fail", 2, "missing"), ("warn", 1, "unmarked")]
    clips = spark.createDataFrame([(0, 5000, "a", "a"), (1, None, "a", "a"), (2, 5000, None, "a")], "ord long, bytes long, entry string, wanted string")
    assert rows(rules.clip_findings(clips), "severity", "seg_id") == [("fail", 1), ("fail", 2)]
    assert rows(rules.clip_findings(clips, before_synthesis=True), "severity", "seg_id") == [("fail", 2), ("warn", 1)]
    refs = spark.createDataFrame([(0, "", 12.0, 0.0), (1, "x", 3.0, 0.5), (2, "x", 8.0, 0.1)], "ord long, text string, seconds double, head double")
    assert rows(rules.reference_findings(refs), "seg_id", "msg") == [(0, "no text"), (0, "too long"), (1, "short"), (1, "silent head")]
    pastes = spark.createDataFrame([(0, 0, False, 0, 9000), (1, 5, True, 0, 4500), (2, 5, False, 0, 9000)], "ord long, bytes long, auto boolean, start_ms long, end_ms long")
    holes = spark.createDataFrame([(1, 7, "A", 0, 1000, 3, -0.5), (1, 8, "A", 5000, 6000, 4, -0.2), (1, 9, "A", 7000, 8000, 2, 0.0)], "media long, ord long, speaker string, start_ms long, end_ms long, n_words int, logprob double")
    said = spark.createDataFrame([(1, "A", 400, 2000)], "media long, speaker string, start_ms long, end_ms long")
    assert rows(rules.paste_findings(pastes, holes, said), "stage", "seg_id") == [("paste", 0), ("paste", 1), ("speech", 8), ("speech", 9)]


def test_join_trimmed():
    sr = 16_000
    tone = (0.3 * np.sin(2 * np.pi * 220 * np.arange(sr) / sr)).astype("f4")
    silence = np.zeros(sr // 2, "f4")
    joined = rules.join_trimmed([np.r_[silence, tone, silence], silence], sr, gap_s=0.25)
    assert abs(len(joined) - (1.05 + 0.12 + 0.25 + 0.5) * sr) < 0.05 * sr
    assert len(rules.join_trimmed([], sr)) == 0


def test_empty_tables(spark):
    from tidemark.operators import intervals, multitrack, sequence, voices

    s = spark.createDataFrame([], "media long, ord long, speaker string, start_ms long, end_ms long, text string")
    for out in (sequence.merge_short(s), sequence.transcript_turns(s), sequence.runon_cuts(s), intervals.gaps(s), intervals.turn_overlaps(s), multitrack.repeats(s), voices.reference_runs(s), sequence.concurrency_marks(s), rules.neighbour_words(s)):
        assert out.collect() == []
