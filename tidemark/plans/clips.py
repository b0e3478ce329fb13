"""Queries of the clip operators, of voice profiles, gaps and the remaining findings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import clips, rules
from ..operators import multitrack as mt
from ..operators import sequence as sq
from ..operators import signal as sg
from .binding import DOC_WORDS_SQL, FRAMES_SQL, document_words, line_frames, table
from .timeline import SEGMENTS_SQL, conversation_segments

QUERIES: dict = {}
SQL: dict = {}


def query(sql: str | None = None):
    def put(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return put


KEYS = ["track", "clip"]


def _clips(spark, sf) -> DataFrame:
    """Each track's frames as clips of 120 frames; a clip's ends are quiet to a degree of its own."""
    f = line_frames(spark, sf).select("track", F.floor(F.col("frame_no") / 120).cast("long").alias("clip"), (F.col("frame_no") % 120).alias("frame_no"), "level")
    quiet = (F.col("frame_no") < F.col("clip") % 40) | (F.col("frame_no") > 119 - F.col("clip") % 30)
    return f.withColumn("level", F.when(F.col("clip") % 37 == 5, 0.0).when(quiet, F.col("level") / 500.0).otherwise(F.col("level") / 30.0))


_CLIPS_SQL = f"""{FRAMES_SQL}, c0 AS (SELECT track, frame_no // 120 AS clip, frame_no % 120 AS frame_no, level::DOUBLE AS level FROM frames),
c AS (SELECT track, clip, frame_no, CASE WHEN clip % 37 = 5 THEN 0.0::DOUBLE WHEN frame_no < clip % 40 OR frame_no > 119 - clip % 30 THEN level / 500.0::DOUBLE ELSE level / 30.0::DOUBLE END AS level FROM c0)"""


@query(f"""WITH {_CLIPS_SQL}, t AS (SELECT track, clip, quantile_cont(level, 0.99::DOUBLE) AS top, count(*) AS n FROM c GROUP BY track, clip),
v AS (SELECT track, clip, any_value(top) AS top, any_value(n) AS n, min(frame_no) FILTER (level > greatest(0.01, 0.1::DOUBLE * top)) AS a, max(frame_no) FILTER (level > greatest(0.01, 0.1::DOUBLE * top)) AS b FROM c JOIN t USING (track, clip) GROUP BY track, clip),
r AS (SELECT track, clip, any_value(n) AS n, any_value(a) AS a, any_value(b) AS b, max(frame_no) FILTER (frame_no < a AND level <= greatest(0.003::DOUBLE, 0.05::DOUBLE * top)) AS h, min(frame_no) FILTER (frame_no > b AND level <= greatest(0.003::DOUBLE, 0.01::DOUBLE * top)) AS t FROM c JOIN v USING (track, clip) GROUP BY track, clip)
SELECT track, clip, CASE WHEN a IS NOT NULL THEN greatest(greatest(coalesce(h + 1, 0), a - 5) * 20 - 50, 0) END AS lo_ms, CASE WHEN a IS NOT NULL THEN least((least(coalesce(t - 1, n - 1), b + 18) + 1) * 20 + 50, n * 20) END AS hi_ms FROM r""")
def speech_bounds(spark, sf):
    return clips.speech_bounds(_clips(spark, sf), KEYS)


@query(f"""WITH {_CLIPS_SQL}, t AS (SELECT track, clip, quantile_cont(level, 0.95::DOUBLE) AS top, count(*) AS n FROM c GROUP BY track, clip),
v AS (SELECT track, clip, any_value(n) AS n, min(frame_no) FILTER (loud) AS a, max(frame_no) FILTER (loud) AS b, count(*) FILTER (loud) AS k FROM (SELECT *, level > greatest(0.01, 0.1::DOUBLE * top) AS loud FROM c JOIN t USING (track, clip)) GROUP BY track, clip)
SELECT track, clip, coalesce(a, n) * 50 AS head_ms, coalesce(n - 1 - b, n) * 50 AS tail_ms, round(k / n, 6) AS share FROM v""")
def audition(spark, sf):
    return clips.audition(_clips(spark, sf), KEYS).withColumn("share", F.round("share", 6))


@query(f"""WITH {_CLIPS_SQL}, t AS (SELECT track, clip, quantile_cont(level, 0.99::DOUBLE) AS top FROM c GROUP BY track, clip)
SELECT track, clip, count(*) FILTER (level > {10 ** (-30 / 20)!r}::DOUBLE * top) * 20 AS voiced_ms FROM c JOIN t USING (track, clip) GROUP BY track, clip""")
def voiced_time(spark, sf):
    return clips.voiced_time(_clips(spark, sf), KEYS)


@query(f"""WITH {_CLIPS_SQL}, w AS (SELECT track, clip, frame_no * 20 AS s, frame_no * 20 + 300 AS e FROM c WHERE frame_no % 17 = 9 AND clip % 5 > 0),
s AS (SELECT track, clip, min(frame_no) * 20 AS a, max(frame_no) * 20 AS b FROM c WHERE level > 0.05::DOUBLE GROUP BY track, clip), h AS (SELECT track, clip, min(s) AS s, max(e) AS e FROM w GROUP BY track, clip)
SELECT track, clip, s - a AS lead_ms, b - e AS tail_ms FROM s JOIN h USING (track, clip)""")
def edge_sound(spark, sf):
    c = _clips(spark, sf)
    words = c.where("frame_no % 17 = 9 AND clip % 5 > 0").select(*KEYS, (F.col("frame_no") * 20).alias("start_ms"), (F.col("frame_no") * 20 + 300).alias("end_ms"))
    return clips.edge_sound(c, words, KEYS, frame_ms=20, loud=0.05)


_FLAGS = "ord % 7 = 3 AS orig, ord % 11 = 5 AS echo, ord % 13 = 6 AS overlap"


@query(f"""WITH {SEGMENTS_SQL}, s AS (SELECT *, {_FLAGS} FROM segments), l AS (SELECT *, row_number() OVER (PARTITION BY media ORDER BY start_ms, ord) AS pos FROM s WHERE NOT echo AND NOT overlap),
e AS (SELECT a.media, a.ord, (SELECT b.start_ms FROM l b WHERE b.media = a.media AND b.pos > a.pos AND (NOT b.orig OR b.speaker = a.speaker) ORDER BY b.pos LIMIT 1) AS slot_end FROM l a WHERE NOT a.orig)
SELECT s.media, s.ord, greatest(CASE WHEN overlap THEN end_ms ELSE coalesce(slot_end, end_ms + 2000) END - start_ms, 1000) AS slot_ms FROM s LEFT JOIN e ON s.media = e.media AND s.ord = e.ord WHERE NOT orig AND NOT echo""")
def synthesis_slots(spark, sf):
    s = conversation_segments(spark, sf)
    return clips.synthesis_slots(s.withColumns({"orig": F.col("ord") % 7 == 3, "echo": F.col("ord") % 11 == 5, "overlap": F.col("ord") % 13 == 6}))


@query(f"WITH {SEGMENTS_SQL} SELECT media FROM segments GROUP BY media HAVING count(*) FILTER (media % 3 = 0 AND ord % 40 = 7) = 0")
def complete_items(spark, sf):
    s = conversation_segments(spark, sf)
    return clips.complete_items(s.withColumn("text", F.when((F.col("media") % 3 != 0) | (F.col("ord") % 40 != 7), F.col("text"))))


@query(f"""WITH {FRAMES_SQL}, f AS (SELECT track, frame_no, level % 10 + 0.0 AS level, level >= 28 AS loud FROM frames),
l AS (SELECT *, NOT max(loud) OVER (PARTITION BY track ORDER BY frame_no ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS lone FROM f),
a AS (SELECT *, last_value(CASE WHEN loud THEN level END IGNORE NULLS) OVER (PARTITION BY track ORDER BY frame_no ROWS UNBOUNDED PRECEDING) AS b4, first_value(CASE WHEN loud THEN level END IGNORE NULLS) OVER (PARTITION BY track ORDER BY frame_no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS af FROM l),
o AS (SELECT *, coalesce(lone AND b4 IS NOT NULL AND af IS NOT NULL AND level > 1 AND level > 2 * greatest(least(b4, af), 1.0), FALSE) AS poke FROM a),
n AS (SELECT *, CASE WHEN poke AND NOT coalesce(lag(poke) OVER (PARTITION BY track ORDER BY frame_no), FALSE) THEN 1 ELSE 0 END AS new FROM o),
r AS (SELECT *, sum(new) OVER (PARTITION BY track ORDER BY frame_no ROWS UNBOUNDED PRECEDING) AS run FROM n),
g AS (SELECT track, frame_no, CASE WHEN poke AND sum(CASE WHEN poke THEN 1 ELSE 0 END) OVER (PARTITION BY track, run) <= 15 THEN 0.01::DOUBLE ELSE 1.0::DOUBLE END AS gain FROM r)
SELECT track, frame_no, round(avg(gain) OVER (PARTITION BY track ORDER BY frame_no ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING), 6) AS gain FROM g""")
def bed_gain(spark, sf):
    frames = line_frames(spark, sf).withColumn("loud", F.col("level") >= 28).withColumn("level", (F.col("level") % 10).cast("double"))
    return clips.bed_gain(frames, floor=1.0).withColumn("gain", F.round("gain", 6))


@query("""WITH w AS (SELECT vec_id, label % 4 AS speaker, vec_id % 97 AS level, list_transform(embedding::DOUBLE[], lambda x: x) AS v FROM embeddings), c AS (SELECT speaker, quantile_cont(level, 0.7::DOUBLE) AS cut FROM w GROUP BY speaker),
w2 AS (SELECT w.*, level >= cut AS loud FROM w JOIN c USING (speaker)),
p1 AS (SELECT speaker, p, avg(x) AS x FROM (SELECT speaker, unnest(v) AS x, generate_subscripts(v, 1) AS p FROM w2 WHERE loud) GROUP BY speaker, p), f AS (SELECT speaker, list(x ORDER BY p) AS c, sqrt(sum(x * x)) + 1e-9 AS n FROM p1 GROUP BY speaker),
near AS (SELECT w2.* FROM w2 JOIN f USING (speaker) WHERE list_dot_product(v, c) / n > 0.1), k AS (SELECT speaker, count(*) AS n, count(*) FILTER (loud) AS nl FROM near GROUP BY speaker HAVING count(*) >= 10),
p2 AS (SELECT speaker, p, avg(x) AS x FROM (SELECT near.speaker, unnest(v) AS x, generate_subscripts(v, 1) AS p FROM near JOIN k USING (speaker) WHERE nl < 10 OR loud) GROUP BY speaker, p), f2 AS (SELECT speaker, list(x ORDER BY p) AS c, sqrt(sum(x * x)) + 1e-9 AS n FROM p2 GROUP BY speaker)
SELECT speaker, array_to_string(list_transform(coalesce(f2.c, f.c), lambda x: CAST(CAST(round(x / coalesce(f2.n, f.n) * 10000) AS INT) AS VARCHAR)), ' ') AS profile FROM f LEFT JOIN f2 USING (speaker)""")
def voice_profiles(spark, sf):
    w = table(spark, sf, "embeddings").select((F.col("label") % 4).alias("speaker"), (F.col("vec_id") % 97).alias("level"), "embedding")
    p = sg.voice_profiles(w, close=0.1)
    return p.select("speaker", F.array_join(F.transform("profile", lambda x: F.round(x * 10_000).cast("int").cast("string")), " ").alias("profile"))


@query("SELECT 'tracks' AS stage, 'fail' AS severity, CAST(user_id AS BIGINT) AS seg_id, 'u' || user_id || '.wav missing' AS msg FROM (SELECT DISTINCT user_id FROM events) WHERE user_id % 6 = 1")
def track_findings(spark, sf):
    u = table(spark, sf, "events").select(F.col("user_id").cast("long").alias("ord")).distinct().where("ord IS NOT NULL").withColumn("file", F.concat(F.lit("u"), F.col("ord").cast("string"), F.lit(".wav")))
    return rules.track_findings(u, u.where("ord % 6 <> 1").select("file", F.lit(1).alias("bytes")))


@query(f"""WITH {DOC_WORDS_SQL}, x AS (SELECT media, min(start_ms) AS f FROM words GROUP BY media), v AS (SELECT words.*, CAST(floor((start_ms - f) / 300000) AS BIGINT) AS win, f FROM words JOIN x USING (media)),
g AS (SELECT media, win, f, count(*) AS n, count(*) FILTER (right(word, 1) IN ('.', ',', '!', '?', '…')) AS marks, count(*) FILTER (end_ms - start_ms > 2000) AS drawn FROM v GROUP BY media, win, f HAVING count(*) >= 80),
r AS (SELECT *, marks < 0.04 * n AS poor, n * 60000 > 260 * 300000 AS quick, drawn >= 3 AS long_, (marks * 2000 + n) // (n * 2) AS pm FROM g)
SELECT 'words' AS stage, CASE WHEN poor OR quick THEN 'fail' ELSE 'warn' END AS severity, media AS seg_id, 'degraded ' || ((f + win * 300000 + 30000) // 60000) || '-' || ((f + (win + 1) * 300000 + 30000) // 60000) || ' min: ' ||
  concat_ws('; ', CASE WHEN poor THEN 'punctuation ' || (pm // 10) || '.' || (pm % 10) || '%' END, CASE WHEN quick THEN ((n * 120000 + 300000) // 600000) || ' words/min' END, CASE WHEN long_ THEN drawn || ' stretched words' END) AS msg FROM r WHERE poor OR quick OR long_
UNION ALL SELECT 'words', 'fail', doc_id, 'no words' FROM documents WHERE doc_id NOT IN (SELECT media FROM x)""")
def words_findings(spark, sf):
    """Degraded windows and items without words; loops are told by ``ngram_loops``."""
    w = document_words(spark, sf)
    items = table(spark, sf, "documents").select(F.col("doc_id").alias("media")).join(w.groupBy("media").agg(F.count("*").alias("n_words")), "media", "left")
    none = mt.loops(sq.ngram_loops(w), w).where("false")
    return rules.words_findings(items, sq.degraded_reasons(w), none)


@query("""WITH q AS (SELECT doc_id, (quality * 60 + length(text) % 40) / 100.0::DOUBLE AS sim, length(text) AS n FROM documents JOIN labels USING (doc_id))
SELECT 'clips' AS stage, 'fail' AS severity, doc_id AS seg_id, concat_ws(',', CASE WHEN sim < 0.75 THEN 'MISMATCH' END, CASE WHEN n % 1000 > 800 THEN 'LEAD' END) || ' sim ' || printf('%.2f', sim) || ' after re-roll' AS msg FROM q WHERE sim < 0.75 OR n % 1000 > 800""")
def qc_findings(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    sim, n = (F.col("quality") * 60 + F.length("text") % 40) / F.lit(100.0), F.length("text")
    flags = F.array_compact(F.array(F.when(sim < 0.75, "MISMATCH"), F.when(n % 1000 > 800, "LEAD")))
    return rules.qc_findings(d.select(F.col("doc_id").alias("ord"), sim.alias("sim"), flags.alias("flags")), rerolled=True)
