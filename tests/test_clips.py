"""Clip rules, confidence, acceptance and voices on literal rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import clips, intervals, multitrack, quality, rules, sequence, signal, voices

SEG = "media long, ord long, speaker string, start_ms long, end_ms long, text string"


def clip_frames(spark, levels):
    return spark.createDataFrame([(k, i, float(x)) for k, level in levels.items() for i, x in enumerate(level)], "clip string, frame_no long, level double")


def test_bounds_agree_with_the_samples(spark):
    r = np.random.default_rng(5)
    sr, frame = 1000, 20
    made, sound = {}, {}
    for k in range(12):
        x = np.r_[np.zeros(300), r.normal(0, 0.3, 400) * np.linspace(1, 0.01, 400), r.normal(0, 0.005 * (k % 3), 300), np.zeros(200)][: 1200 - 20 * (k % 4)]
        sound[f"c{k}"], made[f"c{k}"] = x, voices.frame_levels(x, frame)
    made["silent"], sound["silent"] = np.zeros(30), np.zeros(600)
    got = {x.clip: (x.lo_ms, x.hi_ms) for x in clips.speech_bounds(clip_frames(spark, made), ["clip"]).collect()}
    for k, x in sound.items():
        want = voices.speech_bounds(x, sr)
        assert got[k] == ((None, None) if want is None else want), k
    heard = {x.clip: (x.head_ms / 1000, x.tail_ms / 1000, x.share) for x in clips.audition(clip_frames(spark, {k: voices.frame_levels(x, 50) for k, x in sound.items()}), ["clip"]).collect()}
    for k, x in sound.items():
        assert heard[k] == pytest.approx(voices.audition(x[: len(x) // 50 * 50], sr)), k


def test_edges_and_voiced_time(spark):
    f = clip_frames(spark, {"a": [0, 0.2, 0.2, 0, 0.2], "b": [0, 0]})
    words = spark.createDataFrame([("a", 40, 50), ("a", 60, 70), ("b", 0, 10)], "clip string, start_ms long, end_ms long")
    assert [tuple(x) for x in clips.edge_sound(f, words, ["clip"], frame_ms=20, loud=0.1).collect()] == [("a", 20, 10)]
    assert {x.clip: x.voiced_ms for x in clips.voiced_time(f, ["clip"]).collect()} == {"a": 60, "b": 0}


def test_confidence_of_wordless_and_nonverbal_segments(spark):
    s = spark.createDataFrame([(1, 0, "A", 0, 1000, "text"), (1, 1, "A", 5000, 6000, "no words"), (1, 2, "A", 7000, 8000, "Mm-hmm."), (1, 3, "A", 9000, 10_000, "uh-huh"), (1, 4, "B", 0, 9000, "long"), (1, 5, "B", 20_000, 21_000, "fair")], SEG)
    w = spark.createDataFrame([(1, "A", 0, 500, 0.4), (1, "A", 7000, 7500, 0.3), (1, "A", 9000, 9100, 0.6), (1, "B", 10, 20, 0.1), (1, "B", 20_000, 20_500, 0.6)], "media long, speaker string, start_ms long, end_ms long, prob double")
    got = multitrack.confidence(s, w).orderBy("ord")
    assert [(x.conf, x.route) for x in got.collect()] == [(0.4, "paste"), (None, None), (0.3, "paste"), (0.6, "backchannel"), (0.1, "flag"), (0.6, "flag")]
    cut = clips.cut_list(got.withColumn("copy", clips.paste_source(F.lit(1.0), F.lit(7.0), F.when(F.col("ord") == 0, 0.2)))).orderBy("ord")
    assert [(x.ord, x.label, x.copy, x.file) for x in cut.collect()] == [(0, "low_conf", "raw", "A_000000.wav"), (2, "low_conf", "cleaned", "A_000070.wav"), (3, "backchannel", "raw", "A_000090.wav")]


def test_acceptances(spark):
    found = spark.createDataFrame([("s", "fail", 1, "bad a"), ("s", "fail", 1, "bad a"), ("s", "warn", 2, "odd"), ("t", "fail", 3, "bad a")], "stage string, severity string, seg_id long, msg string").repartition(5)
    ok = spark.createDataFrame([(0, "s", "bad"), (1, "s", "bad a"), (2, "s", "odd")], "ord int, stage string, contains string")
    got = sorted((x.stage, x.severity, x.msg) for x in quality.accept(found, ok).collect())
    assert got == [("s", "warn", "bad a"), ("s", "warn", "bad a"), ("s", "warn", "odd"), ("s", "warn", "unused acceptance: bad a"), ("s", "warn", "unused acceptance: odd"), ("t", "fail", "bad a")]
    assert quality.accept(found, ok.limit(0)).count() == 4 and quality.accept(found.limit(0), ok).count() == 3


@pytest.mark.parametrize("most", [4096, 2])
def test_voice_margin_keeps_repeated_rows(spark, most):
    r = np.random.default_rng(1)
    rows = [(i, i % 5, r.normal(size=8).astype(float).tolist()) for i in range(40)] + [(99, None, [1.0] * 8)]
    rows += [rows[0]] * 3
    got = signal.voice_margin(spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>"), most=most).collect()
    assert len(got) == 44
    unit = {}
    for label in range(5):
        v = np.mean([np.float32(x[2]).astype(float) for x in rows if x[1] == label], axis=0)
        unit[label] = v / (np.linalg.norm(v) + 1e-9)
    for x in got:
        if x.label is None:
            assert x.margin is None
            continue
        v = next(np.float32(y[2]).astype(float) for y in rows if y[0] == x.vec_id)
        sim = {k: float(v @ c) / (np.linalg.norm(v) * np.linalg.norm(c) + 1e-9) for k, c in unit.items()}
        assert x.margin == pytest.approx(sim[x.label] - max(s for k, s in sim.items() if k != x.label), abs=1e-6)


def test_voice_profiles(spark):
    r = np.random.default_rng(2)
    main, other = np.eye(6)[0], np.eye(6)[1]
    unit = lambda v: (v / np.linalg.norm(v)).tolist()
    rows = [("A", float(50 + i), unit(main + r.normal(0, 0.05, 6))) for i in range(30)] + [("A", 90.0, unit(other)), ("B", 1.0, unit(other))]
    rows += [("A", float(i), unit(other)) for i in range(20)]
    got = {x.speaker: np.array(x.profile) for x in signal.voice_profiles(spark.createDataFrame(rows, "speaker string, level double, embedding array<double>")).collect()}
    assert got["A"] @ main > 0.99 and got["B"] @ other > 0.999


def test_slots_and_complete_items(spark):
    s = spark.createDataFrame([(1, 0, "A", 0, 900, "x", False, False, False), (1, 1, "B", 400, 700, "y", False, False, True), (1, 2, "A", 3000, 3500, None, False, False, False), (1, 3, "A", 9000, 9100, "z", True, False, False), (2, 0, "A", 0, 1, "", False, False, False)], SEG + ", orig boolean, echo boolean, overlap boolean")
    assert sorted((x.media, x.ord, x.slot_ms) for x in clips.synthesis_slots(s).collect()) == [(1, 0, 3000), (1, 1, 1000), (1, 2, 6000), (2, 0, 2001)]
    assert [x.media for x in clips.complete_items(s).collect()] == [2]


def test_gaps_at_both_ends(spark):
    t = spark.createDataFrame([(1, 0, 1000, 2000), (1, 1, 5000, 6000)], "media long, ord long, start_ms long, end_ms long")
    totals = spark.createDataFrame([(1, 6200), (2, 700), (3, 100)], "media long, total_ms long")
    assert sorted((x.media, x.gap_start, x.gap_end) for x in intervals.all_gaps(t, totals).collect()) == [(1, 0, 1000), (1, 2000, 5000), (2, 0, 700)]


def test_drawn_out_word_that_ends_its_sentence(spark):
    w = [(1, i, t, a, b) for i, (t, a, b) in enumerate([("one.", 0, 400), ("looong.", 1000, 4000), ("next", 4100, 4500), ("end.", 4600, 5000), ("far", 5100, 5200)])]
    got = rules.stretched_regions(spark.createDataFrame(w, "media long, ord long, word string, start_ms long, end_ms long"))
    assert [(x.first_ord, x.last_ord) for x in got.collect()] == [(1, 3)]
    edge = [(1, 0, "a", 0, 100), (1, 1, "b", 30_000, 33_000), (1, 2, "c", 62_000, 63_000)]
    got = rules.stretched_regions(spark.createDataFrame(edge, "media long, ord long, word string, start_ms long, end_ms long"))
    assert [(x.first_ord, x.last_ord) for x in got.collect()] == [(1, 1)]  # the reach is strict


def test_findings_on_words_tracks_and_clips(spark):
    items = spark.createDataFrame([(1, 5), (2, None)], "media long, n_words long")
    words = spark.createDataFrame([(1, i, "w", i * 500, i * 500 + 400) for i in range(100)], "media long, ord long, word string, start_ms long, end_ms long")
    degraded = sequence.degraded_reasons(words)
    assert [(x.severity, x.reason, x.t0_ms, x.t1_ms) for x in degraded.collect()] == [("fail", "punctuation 0.0%", 0, 300_000)]
    loops = spark.createDataFrame([(1, 3, 90_000, "a b c")], "media long, ord long, start_ms long, gram string")
    got = sorted((x.severity, x.seg_id, x.msg) for x in rules.words_findings(items, degraded, loops).collect())
    assert got == [("fail", 1, "degraded 0-5 min: punctuation 0.0%"), ("fail", 2, "no words"), ("warn", 1, "possible loop at 2 min: a b c")]
    takes = spark.createDataFrame([(1, ["A", "B"], 0.5), (2, [], 0.9)], "ord long, flags array<string>, sim double")
    assert [(x.severity, x.msg) for x in rules.qc_findings(takes, rerolled=True).collect()] == [("fail", "A,B sim 0.50 after re-roll")]
    assert [x.severity for x in rules.qc_findings(takes, rerolled=False).collect()] == ["warn"]


def test_empty_tables(spark):
    f = spark.createDataFrame([], "clip string, frame_no long, level double")
    for out in (clips.speech_bounds(f, ["clip"]), clips.audition(f, ["clip"]), clips.voiced_time(f, ["clip"]), signal.voice_margin(spark.createDataFrame([], "vec_id long, label int, embedding array<float>"))):
        assert out.collect() == []
