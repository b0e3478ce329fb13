"""Track queries on tables that are longer than any preview, against brute force."""

import random
from difflib import SequenceMatcher

import duckdb
import pytest

from tidemark.plans import catalogue, tracks


@pytest.fixture(scope="module")
def long_tracks(spark, tmp_path_factory):
    """Frames of four tracks, 9,000 each: (folder, {track: levels})."""
    folder = tmp_path_factory.mktemp("tracks")
    quantity = lambda i: float(1 + (i * 7919 + i // 97 * 31) % 50)
    rows = [(i // 4, i % 4, 1, i % 4, 1.0, quantity(i)) for i in range(36_000)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, l_quantity double").write.parquet(f"{folder}/lineitem.parquet")
    levels = {t: [int(max(quantity(i) - 20, 0)) for i in range(t, 36_000, 4)] for t in range(4)}
    return str(folder), levels


def test_foreign_frames_of_long_tracks(spark, long_tracks):
    folder, levels = long_tracks
    want = {}
    for track, level in levels.items():
        n = len(level)
        score = []
        for k in range(n):
            over = [(level[w] - 15) / 30 for w in range(max(k - 6, 0), min(k + 2, n)) if w % 2 == 0 and w * 250 < k * 250 + 250 and k * 250 < w * 250 + 1500]
            score.append(sum(over) / len(over) if over else 1.0)
        foreign = [level[k] > 5 and score[k] < -0.05 for k in range(n)]
        for _ in range(3):
            foreign = [foreign[k] or ((k > 0 and foreign[k - 1] or k + 1 < n and foreign[k + 1]) and level[k] > 5 and score[k] < 0.15) for k in range(n)]
        want |= {(track, k): foreign[k] for k in range(n)}
    got = {(r.track, r.frame_no): r.foreign for r in catalogue.QUERIES["foreign_frames"](spark, folder).collect()}
    assert got == want
    assert any(f for (_, k), f in want.items() if k >= 2000)


def test_echo_segments_of_whole_texts(spark, tmp_path):
    pool = ["We went down to the old harbour.", "They went down to the old harbour.", "We went for a colder evening swim.", "Nobody remembers the second verse.", "Everybody remembers the second verse.", "Nobody asked about rent or wages."]
    r = random.Random(5)
    rows = [(c, t, "user" if t % 2 else "assistant", r.choice(pool)) for c in range(3) for t in range(150)]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    segments = sorted(tracks._folded(spark, str(tmp_path)).collect(), key=lambda s: (s.media, s.start_ms, s.ord))

    def echoes(likeness, least):
        gone = set()
        for i, a in enumerate(segments):
            if (a.media, a.ord) in gone:
                continue
            for b in segments[i + 1 :]:
                if b.media != a.media or b.start_ms - a.start_ms > 1500:
                    break
                if (b.media, b.ord) not in gone and a.speaker != b.speaker and likeness(a.text.lower(), b.text.lower()) >= least:
                    loser = a if a.level < b.level else b
                    gone.add((loser.media, loser.ord))
        return gone

    ratio = lambda a, b: SequenceMatcher(None, a, b).ratio()
    want = echoes(ratio, 0.8)
    assert want and want != echoes(lambda a, b: ratio(a[:6], b[:6]), 0.6)
    got = tracks.echo_segments(spark, str(tmp_path)).collect()
    assert len(got) == len(want) and {(x.media, x.ord) for x in got} == want


def test_span_rms_of_long_tracks(spark, long_tracks):
    folder, levels = long_tracks
    want = {}
    for track, level in levels.items():
        for k in range(len(level)):
            first = k * 700 // 250
            over = level[first : max((k * 700 + 100 + k % 9 * 300) // 250 - 1, first) + 1]
            if over:
                want[track, k] = round(sum(over) / len(over), 6)
    got = {(r.track, r.ord): r.rms for r in catalogue.QUERIES["span_rms"](spark, folder).collect()}
    assert got == pytest.approx(want)


def spoken(spark, folder, rows):
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    return str(folder)


def sql_rows(folder, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{folder}/conversations.parquet/*.parquet')")
    return sorted(con.execute(tracks.SQL[name]).fetchall(), key=str)


#: Sounds in the spelling of the SQL, in others, and among words.
SOUNDS = "Well then. Hmm. Mm-hmm. Haha. That was all. Uh-huh. mhm! Mm-hmm. Hmhm. It was so. Ha ha. Hmm. Mmm."


def test_routes_of_sounds_in_the_texts_agree_with_sql(spark, tmp_path):
    folder = spoken(spark, tmp_path, [(c, t, "user" if t % 2 else "assistant", SOUNDS) for c in range(4) for t in range(6)])
    got = sorted((tuple(r) for r in catalogue.QUERIES["confidence_routing"](spark, folder).collect()), key=str)
    assert got == sql_rows(folder, "confidence_routing")
    assert {r[3] for r in got} == {"paste", "backchannel", "flag", None}


def test_cut_list_of_sounds_and_missing_speakers_agrees_with_sql(spark, tmp_path):
    folder = spoken(spark, tmp_path, [(c, t, None if t % 5 == 3 else "user" if t % 2 else "assistant", SOUNDS) for c in range(4) for t in range(6)])
    got = sorted((tuple(r) for r in catalogue.QUERIES["cut_list"](spark, folder).collect()), key=str)
    assert got == sql_rows(folder, "cut_list")
    assert any(r[4] is None for r in got) and {r[2] for r in got} == {"low_conf", "backchannel"}
