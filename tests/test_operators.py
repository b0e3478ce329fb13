"""Operators on literal rows: the rules one by one, ties and empty tables, and invariants on random data."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import speech, text
from tidemark.operators import bridge, incremental, intervals, multitrack, quality, sequence, signal, voices

WORD = "media long, ord long, speaker string, word string, start_ms long, end_ms long"
SEG = "media long, ord long, speaker string, start_ms long, end_ms long, text string"


def words(spark, rows):
    return spark.createDataFrame([(1, i, s, w, a, b) for i, (a, b, w, s) in enumerate(rows)], WORD)


def segments(spark, rows, extra=""):
    return spark.createDataFrame([(1, i, *r) for i, r in enumerate(rows)], "media long, ord long, speaker string, start_ms long, end_ms long, text string" + extra)


def test_sentences(spark):
    w = words(spark, [(0, 400, "Hello", "A"), (400, 900, "there.", "B"), (1000, 1300, "How", None), (5000, 5300, "are", None), (5300, 5500, "you", "A")])
    got = sequence.build_sentences(w).orderBy("sentence").collect()
    assert [(r.text, r.speaker) for r in got] == [("Hello there.", "B"), ("How are you", "A")]
    got = sequence.build_sentences(w, gap_ms=2500).orderBy("sentence").collect()
    assert [r.text for r in got] == ["Hello there.", "How", "are you"]
    assert sequence.build_sentences(w.limit(0)).collect() == []


def test_merge_short(spark):
    s = segments(spark, [("A", 0, 5000, ""), ("A", 5500, 11_000, ""), ("A", 11_200, 13_000, ""), ("B", 13_000, 14_000, ""), ("B", 15_500, 16_000, "")])
    got = sequence.merge_short(s).orderBy("first_ord").collect()
    assert [(r.first_ord, r.end_ms, r.n) for r in got] == [(0, 11_000, 2), (2, 13_000, 1), (3, 14_000, 1), (4, 16_000, 1)]


def test_split_long(spark):
    rows = [(i * 1000, i * 1000 + 500 - (200 if i == 7 else 0), "w," if i in (4, 9) else "w", "A") for i in range(14)]
    got = sequence.split_long(words(spark, rows).withColumn("run", F.lit(0).cast("long")), max_ms=6000).orderBy("piece").collect()
    assert [(r.first_ord, r.last_ord, r.cut) for r in got] == [(0, 4, False), (5, 9, False), (10, 13, False)]
    plain = sequence.split_long(words(spark, [(a, b, "w", s) for a, b, _, s in rows]).withColumn("run", F.lit(0).cast("long")), max_ms=8000).orderBy("piece").collect()
    assert [(r.first_ord, r.last_ord, r.cut) for r in plain] == [(0, 7, True), (8, 13, False)]


def test_slot_ends(spark):
    rows = [("A", 0, 1, "", False, False, False), ("B", 10, 1, "", True, False, False), ("A", 20, 1, "", False, True, False), ("A", 22, 1, "", False, False, False), ("B", 30, 1, "", False, False, True), ("A", 40, 1, "", True, False, False)]
    got = sequence.slot_ends(segments(spark, rows, ", orig boolean, echo boolean, overlap boolean")).orderBy("ord").collect()
    assert [(r.ord, r.slot_end) for r in got] == [(0, 22), (3, 40)]


def test_runons(spark):
    s = segments(spark, [("A", 0, 1000, "and then"), ("A", 1500, 2000, "we went."), ("A", 9000, 9500, "so"), ("B", 9600, 9700, "hm."), ("A", 9900, 10_000, "on")])
    assert [r.ord for r in sequence.runon_cuts(s).collect()] == [0]


def test_intervals(spark):
    turns = spark.createDataFrame([(1, 0, "A", 0, 5000), (1, 1, "B", 4000, 70_000), (1, 2, "A", 4000, 4100), (1, 3, "A", 71_000, 72_000)], "media long, ord long, speaker string, start_ms long, end_ms long")
    w = spark.createDataFrame([(1, 0, "x", 3900, 4200), (1, 1, "x", 4500, 5500), (1, 2, "x", 70_100, 70_200)], "media long, ord long, speaker string, start_ms long, end_ms long")
    assert [r.speaker for r in intervals.best_overlap_speaker(w, turns).orderBy("ord").collect()] == ["A", "B", None]
    assert [r.speaker for r in intervals.total_overlap_speaker(w, turns).orderBy("ord").collect()] == ["A", "B", "A"]  # the first by name where nothing overlaps
    assert [(r.a, r.b, r.start_ms, r.end_ms) for r in intervals.turn_overlaps(turns, bucket_ms=700).collect()] == [(0, 1, 4000, 5000)]
    assert [(r.gap_start, r.gap_end) for r in intervals.gaps(turns).collect()] == [(70_000, 71_000)]


def test_subtract(spark):
    make = lambda rows: spark.createDataFrame([(1, a, b) for a, b in rows], "media long, start_ms long, end_ms long")
    cut = lambda i, s: sorted((r.start_ms, r.end_ms) for r in intervals.subtract(make(i), make(s), keys=["media"]).collect())
    assert cut([(10_000, 16_000)], [(10_000, 11_500), (14_500, 16_000)]) == [(11_750, 14_250)]
    assert cut([(5000, 8000)], [(4000, 9000)]) == []
    assert cut([(11_300, 14_400)], []) == [(11_300, 14_400)]
    assert cut([(10_000, 12_000)], [(10_000, 11_400)]) == []
    assert cut([(0, 1000), (1000, 2000)], []) == [(0, 1000), (1000, 2000)]


def test_random_joins_match_a_double_loop(spark):
    r = random.Random(1)
    rows = [(m, i, r.choice("AB"), a := r.randrange(0, 90_000), a + r.randrange(1, 40_000)) for m in (1, 2) for i in range(60)]
    t = spark.createDataFrame(rows, "media long, ord long, speaker string, start_ms long, end_ms long")
    got = {(x.media, x.a, x.b) for x in intervals.turn_overlaps(t, min_ms=1, bucket_ms=7000).collect()}
    assert got == {(a[0], a[1], b[1]) for a in rows for b in rows if a[0] == b[0] and a[2] != b[2] and (a[3], a[1]) < (b[3], b[1]) and min(a[4], b[4]) > b[3]}


def test_concurrency_and_placement(spark):
    s = segments(spark, [("A", 0, 5000, ""), ("B", 1000, 3000, ""), ("C", 1500, 2900, ""), ("A", 4900, 6000, "")])
    assert [(r.ord, r.under) for r in sequence.concurrency_marks(s).orderBy("ord").collect()] == [(1, 0), (2, 0)]
    clips = spark.createDataFrame([(1, 0, 0, 1000, 2000.0), (1, 1, 1000, 3000, 1000.0), (1, 2, 3000, None, 500.0)], "media long, ord long, start_ms long, next_ms long, dur_ms double")
    got = sequence.placement(clips).orderBy("ord").collect()
    assert [(round(r.place_ms), round(r.tempo, 2)) for r in got] == [(0, 1.35), (1481, 1.0), (3000, 1.0)]


def test_pace(spark):
    row = spark.createDataFrame([(120, 10_000, 20_000), (130, 20_000, None), (130, 10_000, 8000), (10, 5000, 9000)], "chars long, span long, slot long")
    got = [r[0] for r in row.select(text.plan_span(F.col("chars"), F.col("span"), F.col("slot"))).collect()]
    assert got == [10_000, 14_444, 10_000, 1111]


def test_numbers_and_words():
    assert speech.number_words(0) == ["ноль"] and speech.number_words(42) == ["сорок", "два"]
    assert speech.number_words(1960) == "тысяча девятьсот шестьдесят".split()
    assert speech.number_words(2000) == "две тысячи".split() and speech.number_words(5000) == "пять тысяч".split()
    assert speech.number_words(21_000) == "двадцать одна тысяча".split() and speech.number_words(4 * 10**8) == "четыреста миллионов".split()
    assert speech.heard_words("В 2000 г+оду ёж") == ["в", "две", "тысячи", "году", "еж"]
    assert speech.script_similarity("две тысячи", "2000", "2000") == 1.0 and speech.script_similarity("x", "", "x") == 0.0


@given(st.text(alphabet="абв xyz.,!?—:;é", max_size=600), st.integers(20, 200))
@settings(max_examples=150, deadline=None)
def test_split_text_keeps_everything(t, limit):
    pieces = speech.split_text(t, limit)
    assert all(0 < len(p.encode()) <= limit for p in pieces)
    assert "".join("".join(pieces).split()) == "".join(t.split())


def test_punctuation_goes_back_to_its_words():
    assert speech.reattach_punctuation([" hello", " world"], "Hello, world!") == [" Hello,", " world!"]
    assert speech.reattach_punctuation([" hello"], "other") is None
    assert speech.reattach_punctuation([" so", " —", " well"], "So, «well»...") == [" So,", " —", " «well»..."]


def test_texts(spark):
    row = spark.createDataFrame([("Ёлка, з+амок_1!", 3_723_999)], "t string, ms long")
    got = row.select(text.norm_text("t"), text.alnum_key("t"), text.pace_chars("t"), text.clock("ms")).first()
    assert tuple(got) == ("елказамок_1", "ёлказамок1", 14, "01:02:03")


def test_signal(spark):
    env = ([8] * 5 + [60] * 3) * 4 + [8] * 3
    f = spark.createDataFrame([("t", i, float(x)) for i, x in enumerate(env)], "track string, frame_no long, level double")
    assert signal.bursts(f).first().bursts == 4
    hum = spark.createDataFrame([("t", i, float(x)) for i, x in enumerate([10] + [50] * 20 + [10])], "track string, frame_no long, level double")
    assert signal.bursts(hum).first().bursts == 1
    def gains(bed, loud):
        g = spark.createDataFrame([("t", i, float(x), bool(s)) for i, (x, s) in enumerate(zip(bed, loud, strict=True))], "track string, frame_no long, level double, loud boolean")
        return [r.gain for r in signal.lone_effect_gain(g).orderBy("frame_no").collect()]

    pause = [True] * 10 + [False] * 20 + [True] * 10
    assert gains([0.03] * 40, pause) == [1.0] * 40  # a steady bed stays
    assert gains([0.004] * 15 + [0.04] * 4 + [0.004] * 21, pause) == [1.0] * 15 + [0.01] * 4 + [1.0] * 21
    assert gains([0.004] * 12 + [0.04] * 20 + [0.004] * 8, [True] * 8 + [False] * 26 + [True] * 6) == [1.0] * 40  # long: music
    assert gains([0.03] * 12 + [0.12] * 3 + [0.03] * 25, [True] * 6 + [False] * 28 + [True] * 6) == [1.0] * 12 + [0.01] * 3 + [1.0] * 25
    assert gains([0.0] * 5 + [0.2] * 10 + [0.0] * 25, [False] * 25 + [True] * 15) == [1.0] * 40  # before the first speech
    sound = spark.createDataFrame([("t", i, 0.5 if (i // 10) % 2 else 0.0) for i in range(45)], "track string, i long, x double")
    assert [round(r.rms, 3) for r in signal.frame_rms(sound, frame=10).orderBy("frame_no").collect()] == [0, 0.5, 0, 0.5]


def test_speech_bounds():
    sr = 16_000
    t = np.arange(sr) / sr
    tone, silence = 0.3 * np.sin(2 * np.pi * 220 * t).astype("f4"), np.zeros(sr, "f4")
    lo, hi = voices.speech_bounds(np.r_[silence, tone, silence], sr)
    assert abs(lo - 0.95 * sr) < 0.03 * sr and abs(hi - 2.05 * sr) < 0.03 * sr
    assert voices.speech_bounds(silence, sr) is None and voices.speech_bounds(silence[:10], sr) is None
    head, tail, share = voices.audition(np.r_[silence, tone], sr)
    assert head == pytest.approx(1.0) and tail == 0 and share == pytest.approx(0.5)


def test_guarded_pass():
    def run(a, b):
        out, at = [], a
        while at < b:
            k = len(out)
            marked = k % 8 == 7 and (a or at < 120_000)
            out.append({"word": " w." if marked else " w", "start_ms": at, "end_ms": at + 400})
            at += 500
        return out

    got = voices.guarded_pass(run, 0, 300_000)
    assert sum(w["word"].endswith(".") for w in got) >= 70 and [w["start_ms"] for w in got] == sorted(w["start_ms"] for w in got)


def test_harvest_rules(spark):
    row = spark.createDataFrame([("Ha ha, right.", ["I", "saw", "Corinth"], ["corinth!", "and"])], "t string, heard array<string>, others array<string>")
    got = row.select(voices.speech_words(F.col("t")), voices.is_bleed(F.col("heard"), F.col("others")), voices.bleed_dropped(F.lit(0.054), F.lit(0.2)), voices.bleed_dropped(F.lit(0.017), F.lit(0.3)), voices.is_laugh(F.lit(0.6), F.lit(1), F.lit(0.06)), voices.is_speech_leak(F.lit(1), F.lit(0.2))).first()
    assert list(got) == [["right"], True, False, True, True, False]


def test_multitrack(spark):
    s = segments(spark, [("A", 0, 2000, "Nice to meet you", 9.0), ("B", 300, 2100, "nice to meet you.", 3.0), ("C", 400, 2000, "Nice to meet you!", 2.0), ("A", 9000, 9500, "bye", 1.0)], ", level double")
    assert [r.ord for r in multitrack.echo_segments(s).orderBy("ord").collect()] == [1, 2]
    long_ = segments(spark, [("A", 0, 9000, "we drove the old railway bridge slowly"), ("B", 1000, 2500, "the railway bridge"), ("B", 20_000, 21_000, "unrelated words here")])
    assert [(r.a, r.b, r.echo) for r in multitrack.repeats(long_).collect()] == [(0, 1, 1)]
    turns = spark.createDataFrame([(1, "A", 0, 9000), (1, "B", 4000, 12_000)], "media long, speaker string, start_ms long, end_ms long")
    seg = segments(spark, [("A", 0, 8000, ""), ("B", 6000, 9000, ""), ("B", 9500, 12_000, "")])
    assert [(r.ord, r.start_ms, r.lead_ms, r.over) for r in multitrack.interruptions(seg, turns).orderBy("ord").collect()] == [(1, 4000, 2000, 0), (2, 4000, 5500, 0)]
    w = words(spark, [(i * 100, i * 100 + 90, x, "A") for i, x in enumerate("the big cat the big cat the big cat yeah yeah yeah yeah yeah yeah yeah yeah yeah".split())])
    assert [(r.ord, r.gram) for r in multitrack.loops(sequence.ngram_loops(w), w).collect()] == [(0, "the big cat")]


def test_reference_runs(spark):
    s = segments(spark, [("A", 0, 3000, ""), ("A", 5000, 9000, ""), ("A", 9200, 13_000, ""), ("A", 20_000, 45_000, ""), ("B", 0, 1000, "")])
    got = voices.reference_runs(s).orderBy("speaker", "rank").collect()
    assert [(r.speaker, r.start_ms, r.end_ms, r.rank) for r in got] == [("A", 5000, 13_000, 1), ("A", 0, 3000, 2), ("B", 0, 1000, 1)]


def test_incremental(spark):
    rows = spark.createDataFrame([(i, f"h{i}") for i in range(5)], "id long, entry string")
    assert incremental.todo(rows, rows, key="id", digest="entry").collect() == []
    edited = rows.withColumn("entry", F.when(F.col("id") == 3, "new").otherwise(F.col("entry")))
    assert [r.id for r in incremental.todo(edited, rows, key="id", digest="entry").collect()] == [3]
    base = spark.createDataFrame([(0, 1.0), (1, 2.0), (2, 3.0)], "id long, end double")
    prior = spark.createDataFrame([(0, 2.5, "old"), (500, 9.0, "hand")], "id long, end double, text string")
    chunk = spark.createDataFrame([(0, "new"), (1, "one"), (99, "unknown")], "id long, text string")
    got = {r.id: (r.end, r.text) for r in incremental.upsert(base, prior, chunk, key="id", text="text").collect()}
    assert got == {0: (1.0, "new"), 1: (2.0, "one"), 500: (9.0, "hand")}
    assert not incremental.changed(rows, rows) and incremental.changed(edited, rows)


def test_bridge(spark):
    old = bridge.old_hash(F.lit("S"), F.col("text"))
    t = spark.createDataFrame([(i, "S", f"t{i}", None, "ref") for i in range(6)], "id long, speaker string, text string, prior_text string, reference string")
    up = bridge.bridged(t.withColumn("entry", old))
    assert up.count() == 6 and up.where(F.col("entry").isin([r[0] for r in t.select(old).collect()])).count() == 0
    same = t.withColumn("entry", F.lit("abc"))
    assert {r.entry for r in bridge.bridged(same).collect()} == {"abc"}
    clips = t.select("id", "speaker", F.lit(100.0).alias("made_at"))
    late = spark.createDataFrame([(0, 150.0, 1, "x")], "rank int, recorded_at double, id long, text string")
    refs = spark.createDataFrame([("S", "ref", 50.0)], "speaker string, reference string, cut_at double")
    assert bridge.adopted(clips, late, refs) is None
    assert [r.id for r in bridge.adopted(clips, late.withColumn("recorded_at", F.lit(100.5)), refs).collect()] == [1]


def test_quality(spark):
    row = spark.createDataFrame([(0, 5, 0.0, 0, 0), (9, 5, 0.5, 900, 100), (5, 5, 0.9, 0, 0)], "heard int, sung int, sim double, lead int, tail int")
    got = [r[0] for r in row.select(quality.qc_flags(*map(F.col, ("heard", "sung", "sim", "lead", "tail")))).collect()]
    assert got == [["SILENT"], ["MISMATCH", "EXTRA", "LEAD"], []]
    found = spark.createDataFrame([("segments", "fail", 1, "span 0 ms"), ("refs", "warn", 2, "short")], "stage string, severity string, seg_id long, msg string")
    ok = spark.createDataFrame([(0, "segments", "span 0"), (1, "segments", "never")], "ord int, stage string, contains string")
    out = quality.accept(found, ok)
    assert sorted(r.severity for r in out.collect()) == ["warn", "warn", "warn"]
    assert quality.verdict(out).first().ok and not quality.verdict(out, strict=True).first().ok and not quality.verdict(found).first().ok


def test_sources_and_sinks(spark, tmp_path):
    import json
    import wave

    from tidemark.sources import documents as src

    for name, value in (("a", {"language": "en", "words": [{"start": 0.5, "end": 1.25, "word": " Hi", "speaker": "A"}]}), ("b", [{"start": 1, "end": 2, "word": " yo"}])):
        (tmp_path / "work" / name).mkdir(parents=True)
        (tmp_path / "work" / name / "words.json").write_text(json.dumps(value))
    got = src.read_words(spark, f"{tmp_path}/work/*/words.json").orderBy("media").collect()
    assert [(r.media, r.word, r.start_ms, r.end_ms) for r in got] == [("a", " Hi", 500, 1250), ("b", " yo", 1000, 2000)]
    (tmp_path / "work" / "a" / "accents.json").write_text('{"_comment": "x", "7": "т+екст"}')
    assert [(r.key, r.value) for r in src.read_map(spark, f"{tmp_path}/work/a/accents.json").collect()] == [("7", "т+екст")]
    assert src.first_existing(spark, f"{tmp_path}/nope", f"{tmp_path}/work").endswith("work")
    with wave.open(str(tmp_path / "work" / "a" / "x.wav"), "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(8000)
        w.writeframes((np.r_[np.zeros(2000), np.full(2000, 16384), np.zeros(100)]).astype("<i2").tobytes())
    assert [round(r.rms, 2) for r in src.read_wav_levels(spark, f"{tmp_path}/work/a").orderBy("frame_no").collect()] == [0.0, 0.5]
    files = src.list_files(spark, f"{tmp_path}/work/a", "*.wav")
    wanted = spark.createDataFrame([(1, "x.wav"), (2, "y.wav")], "id long, file string")
    assert [r.id for r in src.missing_files(wanted, files).collect()] == [2]
    rows = spark.createDataFrame([(1, 0, "a"), (1, 1, "b")], "media long, ord long, text string")
    assert src.rotate_if_changed(rows, f"{tmp_path}/t") and not src.rotate_if_changed(rows, f"{tmp_path}/t") and src.rotate_if_changed(rows.limit(1), f"{tmp_path}/t")
    assert spark.read.parquet(f"{tmp_path}/t").count() == 1 and spark.read.parquet(f"{tmp_path}/t.prev").count() == 2
    src.write_documents(rows, f"{tmp_path}/d")
    assert [s.text for s in spark.read.json(f"{tmp_path}/d").first().segments] == ["a", "b"]
    for _ in range(2):
        src.append_log(spark, f"{tmp_path}/log", {"secs": 1})
    assert spark.read.text(f"{tmp_path}/log").count() == 2
    assert src.timestamped_export(rows, f"{tmp_path}/e", datetime(2024, 5, 6, 7, 8, 9)).endswith("0506-070809")


def test_streaming(spark, tmp_path):
    from tidemark.streaming import windows

    t0 = datetime(2024, 1, 1)
    rows = [("v", t0 + timedelta(seconds=2 * i), "w." if i % 8 == 0 and i > 150 else "w") for i in range(300)] + [("v", t0 + timedelta(hours=1), "w")]
    spark.createDataFrame(rows, "media string, ts timestamp, word string").write.parquet(f"{tmp_path}/w")
    stream = spark.readStream.schema("media string, ts timestamp, word string").parquet(f"{tmp_path}/w")
    q = windows.degraded_windows(stream).writeStream.format("memory").queryName("degraded").option("checkpointLocation", f"{tmp_path}/c1").trigger(availableNow=True).start()
    q.awaitTermination()
    assert [(r.start, r.n, r.marks) for r in spark.table("degraded").collect()] == [(t0, 150, 0)]
    frames = [("t", t0 + timedelta(seconds=i), 20.0 if i < 5 or 30 < i < 40 else 0.0) for i in range(60)] + [("t", t0 + timedelta(hours=1), 9.0)]
    spark.createDataFrame(frames, "track string, ts timestamp, level double").write.parquet(f"{tmp_path}/f")
    stream = spark.readStream.schema("track string, ts timestamp, level double").parquet(f"{tmp_path}/f")
    q = windows.voiced_sessions(stream).writeStream.format("memory").queryName("sessions").option("checkpointLocation", f"{tmp_path}/c2").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.n for r in spark.table("sessions").collect()) == [5, 9]
