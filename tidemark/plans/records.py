"""Queries of the signal, text, incremental and quality operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import speech, text
from ..operators import incremental as inc
from ..operators import quality as qa
from ..operators import signal as sg
from .binding import FRAMES_SQL, WORDS_SQL, conversation_words, line_frames, table
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


# -- signal


@query(f"""WITH {FRAMES_SQL}, v AS (SELECT *, level > 5.6 AS loud FROM frames),
n AS (SELECT *, CASE WHEN loud AND NOT coalesce(lag(loud) OVER (PARTITION BY track ORDER BY frame_no), FALSE) THEN 1 ELSE 0 END AS new FROM v),
r AS (SELECT *, sum(new) OVER (PARTITION BY track ORDER BY frame_no ROWS UNBOUNDED PRECEDING) AS run FROM n),
i AS (SELECT track, min(frame_no) * 250 AS s, (max(frame_no) + 1) * 250 AS e FROM r WHERE loud GROUP BY track, run HAVING count(*) >= 2),
m AS (SELECT *, CASE WHEN coalesce(s - max(e) OVER (PARTITION BY track ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <= 500, FALSE) THEN 0 ELSE 1 END AS new FROM i),
g AS (SELECT *, sum(new) OVER (PARTITION BY track ORDER BY s ROWS UNBOUNDED PRECEDING) AS region FROM m)
SELECT track, CAST(greatest(min(s) - 400, 0) AS BIGINT) AS start_ms, CAST(max(e) + 400 AS BIGINT) AS end_ms FROM g GROUP BY track, region""")
def voiced_islands(spark, sf):
    return sg.voiced_islands(line_frames(spark, sf), gap_ms=500)


@query(f"WITH {FRAMES_SQL}, c AS (SELECT track, greatest(15.0, 0.12 * quantile_cont(level, 0.95)) AS cut FROM frames GROUP BY track) SELECT frames.* FROM frames JOIN c USING (track) WHERE level >= cut")
def bleed_filter(spark, sf):
    return sg.bleed_filter(line_frames(spark, sf))


def _solo(frames: DataFrame) -> DataFrame:
    """Frames of a track in which every other track of the recording is under 10."""
    by = frames.groupBy("media", "frame_no").agg(F.count_if(F.col("level") >= 10).alias("n"))
    return frames.where("level >= 10").join(by.where("n = 1").select("media", "frame_no"), ["media", "frame_no"], "left_semi").select("track", "frame_no")


_PAIRS_SQL = f"""{FRAMES_SQL}, n AS (SELECT media, frame_no FROM frames GROUP BY media, frame_no HAVING count(*) FILTER (level >= 10) = 1),
j AS (SELECT track AS j, media, frame_no, level AS lj FROM frames JOIN n USING (media, frame_no) WHERE level > 20),
pairs AS (SELECT i.track AS i, j.j, CASE WHEN count(*) >= 8 THEN round(median(i.level / j.lj), 9) END AS coefficient FROM frames i JOIN j USING (media, frame_no) WHERE i.track <> j.j GROUP BY i.track, j.j)"""


@query(f"WITH {_PAIRS_SQL} SELECT * FROM pairs")
def bleed_calibration(spark, sf):
    frames = line_frames(spark, sf)
    return sg.pair_coefficients(frames, _solo(frames)).withColumn("coefficient", F.round("coefficient", 9))


@query(f"""WITH {_PAIRS_SQL}, m AS (SELECT a.track, a.frame_no, max(coefficient * b.level) AS e, bool_or(b.level > 20 AND coefficient IS NULL) AS unknown
  FROM frames a JOIN frames b ON a.media = b.media AND a.frame_no = b.frame_no AND a.track <> b.track LEFT JOIN pairs ON pairs.i = a.track AND pairs.j = b.track GROUP BY a.track, a.frame_no)
SELECT track, frame_no, CASE WHEN NOT unknown THEN round(e, 6) END AS expected FROM m""")
def bleed_expected(spark, sf):
    frames = line_frames(spark, sf)
    pairs = sg.pair_coefficients(frames, _solo(frames)).withColumn("coefficient", F.round("coefficient", 9))
    return sg.expected_bleed(frames, pairs).withColumn("expected", F.round("expected", 6))


@query(f"""WITH {FRAMES_SQL}, f AS (SELECT track, frame_no, level % 10 + 0.0 AS level, level >= 28 AS loud FROM frames),
l AS (SELECT *, NOT max(loud) OVER (PARTITION BY track ORDER BY frame_no ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS lone FROM f),
a AS (SELECT *, last_value(CASE WHEN loud THEN level END IGNORE NULLS) OVER (PARTITION BY track ORDER BY frame_no ROWS UNBOUNDED PRECEDING) AS b4, first_value(CASE WHEN loud THEN level END IGNORE NULLS) OVER (PARTITION BY track ORDER BY frame_no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS af FROM l),
o AS (SELECT *, coalesce(lone AND b4 IS NOT NULL AND af IS NOT NULL AND level > 1 AND level > 2 * greatest(least(b4, af), 1.0), FALSE) AS poke FROM a),
n AS (SELECT *, CASE WHEN poke AND NOT coalesce(lag(poke) OVER (PARTITION BY track ORDER BY frame_no), FALSE) THEN 1 ELSE 0 END AS new FROM o),
r AS (SELECT *, sum(new) OVER (PARTITION BY track ORDER BY frame_no ROWS UNBOUNDED PRECEDING) AS run FROM n)
SELECT track, frame_no, CASE WHEN poke AND sum(CASE WHEN poke THEN 1 ELSE 0 END) OVER (PARTITION BY track, run) <= 15 THEN 0.01::DOUBLE ELSE 1.0::DOUBLE END AS gain FROM r""")
def lone_sfx_gain(spark, sf):
    frames = line_frames(spark, sf).withColumn("loud", F.col("level") >= 28).withColumn("level", (F.col("level") % 10).cast("double"))
    return sg.lone_effect_gain(frames, floor=1.0)


@query(f"WITH {FRAMES_SQL} SELECT track, frame_no, round(avg(level) OVER (PARTITION BY track ORDER BY frame_no ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING), 6) AS level FROM frames")
def moving_average(spark, sf):
    return sg.moving_average(line_frames(spark, sf), "level", half=5).select("track", "frame_no", F.round("level", 6).alias("level"))


@query(f"""WITH {FRAMES_SQL}, p AS (SELECT *, max(level) OVER (PARTITION BY track) AS peak FROM frames), s AS (SELECT *, CASE WHEN level >= 0.5 * peak THEN 1 WHEN level <= 0.3 * peak THEN 0 END AS st FROM p),
h AS (SELECT *, coalesce(last_value(st IGNORE NULLS) OVER (PARTITION BY track ORDER BY frame_no ROWS UNBOUNDED PRECEDING), 0) AS h FROM s),
e AS (SELECT track, CASE WHEN h = 1 AND coalesce(lag(h) OVER (PARTITION BY track ORDER BY frame_no), 0) = 0 THEN 1 ELSE 0 END AS e FROM h) SELECT track, CAST(sum(e) AS BIGINT) AS bursts FROM e GROUP BY track""")
def bursts(spark, sf):
    return sg.bursts(line_frames(spark, sf))


_CENTROIDS_SQL = """p AS (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS p FROM embeddings), m AS (SELECT label, p, avg(x) AS x FROM p GROUP BY label, p),
c AS (SELECT label, list(x ORDER BY p) AS v, sqrt(sum(x * x)) + 1e-9 AS n FROM m GROUP BY label), u AS (SELECT label, list_transform(v, lambda x: x / n) AS centroid FROM c)"""


@query(f"WITH {_CENTROIDS_SQL} SELECT label, array_to_string(list_transform(centroid, lambda x: CAST(CAST(round(x * 10000) AS INT) AS VARCHAR)), ' ') AS centroid FROM u")
def speaker_centroids(spark, sf):
    """In ten-thousandths, as text."""
    c = sg.centroids(table(spark, sf, "embeddings"))
    return c.select("label", F.array_join(F.transform("centroid", lambda x: F.round(x * 10_000).cast("int").cast("string")), " ").alias("centroid"))


@query(f"""WITH {_CENTROIDS_SQL}, s AS (SELECT vec_id, e.label, u.label AS other, list_dot_product(e.v, centroid) / (sqrt(list_dot_product(e.v, e.v)) * sqrt(list_dot_product(centroid, centroid)) + 1e-9) AS sim
  FROM (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings) AS e, u WHERE u.label IS NOT NULL)
SELECT vec_id, label, round(max(sim) FILTER (label = other) - max(sim) FILTER (label <> other), 6) AS margin FROM s GROUP BY vec_id, label""")
def voice_margin(spark, sf):
    return sg.voice_margin(table(spark, sf, "embeddings")).withColumn("margin", F.round("margin", 6))


# -- text


def _docs(spark, sf) -> DataFrame:
    return table(spark, sf, "documents")


@query("SELECT doc_id, regexp_replace(lower(translate(text, '+ёЁ', chr(1) || 'еЕ')), '[^\\p{L}\\p{N}_]+', '', 'g') AS norm FROM documents")
def norm_text(spark, sf):
    return _docs(spark, sf).select("doc_id", text.norm_text("text").alias("norm"))


_PLAN_SQL = f"""{SEGMENTS_SQL}, pc AS (SELECT media, ord, length(text) AS chars, end_ms - start_ms AS span, lead(start_ms) OVER (PARTITION BY media ORDER BY start_ms, ord) - start_ms AS slot FROM segments),
p AS (SELECT *, greatest(chars * 1000 // 13, least(span, chars * 1000 // 9)) AS wanted, CAST(floor(slot * 0.95::DOUBLE) AS BIGINT) AS room FROM pc)"""


def _paced(spark, sf) -> DataFrame:
    from pyspark.sql import Window as W

    s = conversation_segments(spark, sf)
    nxt = F.lead("start_ms").over(W.partitionBy("media").orderBy("start_ms", "ord"))
    return s.select("media", "ord", F.length("text").cast("long").alias("chars"), (F.col("end_ms") - F.col("start_ms")).alias("span"), (nxt - F.col("start_ms")).alias("slot"))


@query(f"WITH {_PLAN_SQL} SELECT media, ord, CAST(CASE WHEN slot IS NOT NULL AND wanted > room THEN greatest(room, chars * 1000 // 13) ELSE wanted END AS BIGINT) AS plan_ms FROM p")
def pace_plan(spark, sf):
    return _paced(spark, sf).select("media", "ord", text.plan_span(F.col("chars"), F.col("span"), F.col("slot")).alias("plan_ms"))


@query(f"WITH {_PLAN_SQL} SELECT media, ord, CASE WHEN span >= 1500 AND chars * 10000 < span * 13 * 8 THEN 'SHORT' WHEN chars * 100000 > span * 13 * 115 + 1000000 THEN 'LONG' END AS flag FROM p")
def budget_flags(spark, sf):
    return _paced(spark, sf).select("media", "ord", text.budget_flag(F.col("chars"), F.col("span")).alias("flag"))


@query("""SELECT d.doc_id, g.term, g.advice FROM documents d JOIN (VALUES ('idiot', 'avoid'), ('password', 'withhold'), ('license', 'keep')) g(term, advice) ON contains(lower(d.text), g.term)
UNION ALL SELECT doc_id, 'the without that', 'check' FROM documents WHERE regexp_matches(text, '\\bthe\\b') AND NOT regexp_matches(text, '\\bthat\\b')""")
def glossary_check(spark, sf):
    d = _docs(spark, sf)
    terms = F.array(*[F.struct(F.lit(t).alias("term"), F.lit(a).alias("advice")) for t, a in (("idiot", "avoid"), ("password", "withhold"), ("license", "keep"))])
    hits = F.filter(terms, lambda t: F.contains(F.lower("text"), t["term"]))
    pair = F.when(F.rlike("text", F.lit(r"\bthe\b")) & ~F.rlike("text", F.lit(r"\bthat\b")), F.array(F.struct(F.lit("the without that").alias("term"), F.lit("check").alias("advice")))).otherwise(F.array())
    return d.select("doc_id", F.explode(F.concat(hits, pair)).alias("h")).select("doc_id", "h.*")


@query()
def text_split(spark, sf):
    pieces = speech.vectorised(lambda t: speech.split_text(t), "array<string>")("text")
    return table(spark, sf, "conversations").select("conv_id", "turn", F.posexplode(pieces).alias("piece", "text"))


@query()
def script_sim(spark, sf):
    c = table(spark, sf, "conversations")
    nxt = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("other"))
    sim = speech.vectorised(lambda a, b: speech.script_similarity(a, b, b), "double")("text", "other")
    return c.join(nxt, ["conv_id", "turn"]).select("conv_id", "turn", F.round(sim, 6).alias("sim"))


# -- incremental


@query("SELECT doc_id, sha1(coalesce(lang, '') || '|' || coalesce(text, '') || '|' || substr(sha1(coalesce(source, '')), 1, 12) || '|pace7') AS entry FROM documents")
def manifest_hash(spark, sf):
    e = lambda c: F.coalesce(c, F.lit(""))
    return _docs(spark, sf).select("doc_id", text.manifest_hash(e(F.col("lang")), e(F.col("text")), F.substring(F.sha1(e(F.col("source")).cast("binary")), 1, 12)).alias("entry"))


@query("SELECT doc_id, entry FROM (SELECT doc_id, sha1(coalesce(text, '')) AS entry FROM documents) WHERE doc_id % 10 = 3 OR doc_id % 17 = 4")
def todo_diff(spark, sf):
    now = _docs(spark, sf).select("doc_id", F.sha1(F.coalesce("text", F.lit("")).cast("binary")).alias("entry"))
    old = now.where("doc_id % 17 <> 4").withColumn("entry", F.when(F.col("doc_id") % 10 == 3, F.lit("stale")).otherwise(F.col("entry")))
    return inc.todo(now, old, key="doc_id", digest="entry")


@query("SELECT doc_id FROM documents WHERE doc_id % 10 = 3 AND regexp_matches(text, '[\\p{L}\\p{N}_]')")
def stale_ids(spark, sf):
    d = _docs(spark, sf).select("doc_id", text.norm_text("text").alias("now"))
    old = d.select("doc_id", F.when(F.col("doc_id") % 10 == 3, F.lit("")).otherwise(F.col("now")).alias("was"))
    return d.join(old, "doc_id").where("now <> was").select("doc_id")


@query(f"""WITH {SEGMENTS_SQL}, k AS (SELECT *, trim(regexp_replace(regexp_replace(lower(text), '[^a-z0-9'' ]+', ' ', 'g'), ' +', ' ', 'g')) AS k FROM segments),
o AS (SELECT media, ord + 100000 AS ord, speaker, start_ms + CASE WHEN ord % 3 = 0 THEN 500 ELSE 200 END AS start_ms, end_ms + 100 AS end_ms, k FROM k)
SELECT a.media, a.ord AS new_ord, min(o.ord) AS old_ord FROM k a JOIN o ON a.media = o.media AND a.speaker = o.speaker AND a.k = o.k AND abs(a.start_ms - o.start_ms) <= 300 AND abs(a.end_ms - o.end_ms) <= 300 GROUP BY a.media, a.ord""")
def carry_over(spark, sf):
    s = conversation_segments(spark, sf)
    old = s.withColumns({"ord": F.col("ord") + 100_000, "start_ms": F.col("start_ms") + F.when(F.col("ord") % 3 == 0, 500).otherwise(200), "end_ms": F.col("end_ms") + 100})
    return inc.carry_over(s, old, text.latin_words("text"))


@query("""WITH b AS (SELECT doc_id, source FROM documents WHERE doc_id % 5 <> 0), p AS (SELECT doc_id, source, text FROM documents WHERE doc_id % 2 = 0), c AS (SELECT doc_id, '> ' || text AS text FROM documents WHERE doc_id % 3 = 0)
SELECT * FROM (SELECT b.doc_id, b.source, coalesce(c.text, p.text) AS text FROM b LEFT JOIN p ON b.doc_id = p.doc_id LEFT JOIN c ON b.doc_id = c.doc_id UNION ALL SELECT * FROM p WHERE doc_id NOT IN (SELECT doc_id FROM b)) WHERE text IS NOT NULL""")
def upsert_translation(spark, sf):
    d = _docs(spark, sf)
    return inc.upsert(d.where("doc_id % 5 <> 0").select("doc_id", "source"), d.where("doc_id % 2 = 0").select("doc_id", "source", "text"), d.where("doc_id % 3 = 0").select("doc_id", F.concat(F.lit("> "), "text").alias("text")), key="doc_id", text="text")


@query(f"""WITH {SEGMENTS_SQL} SELECT media, ord, speaker, start_ms FROM segments WHERE ord % 9 <> 2
UNION ALL SELECT media, 9000 + row_number() OVER (PARTITION BY media ORDER BY start_ms) AS ord, 'auto' AS speaker, start_ms FROM segments WHERE ord % 9 = 4""")
def replace_auto(spark, sf):
    s = conversation_segments(spark, sf).select("media", "ord", "speaker", "start_ms")
    return inc.replace_own(s, F.col("ord") % 9 == 2, s.where("ord % 9 = 4").withColumn("speaker", F.lit("auto")), key="ord", first=9001, order=["start_ms"])


# -- quality


def _qc(spark, sf) -> DataFrame:
    d = _docs(spark, sf).join(table(spark, sf, "labels"), "doc_id")
    n = F.length("text").cast("long")
    sim = (F.col("quality") * 60 + n % 40) / F.lit(100.0)
    return d.select("doc_id", "lang", sim.alias("sim"), qa.qc_flags(n % 13, n % 7, sim, n % 1000, (n * 7) % 1100).alias("flags"))


_QC_SQL = """q AS (SELECT doc_id, lang, (quality * 60 + length(text) % 40) / 100.0::DOUBLE AS sim, length(text) AS n FROM documents JOIN labels USING (doc_id)),
f AS (SELECT doc_id, lang, sim, CASE WHEN n % 13 = 0 THEN 'SILENT' ELSE concat_ws(',', CASE WHEN sim < 0.75 THEN 'MISMATCH' END, CASE WHEN n % 13 > 1.25 * (n % 7) + 2 THEN 'EXTRA' END, CASE WHEN n * 7 % 1100 > 800 THEN 'TAIL' END, CASE WHEN n % 1000 > 800 THEN 'LEAD' END) END AS flags FROM q)"""


@query(f"WITH {_QC_SQL} SELECT * FROM f")
def qc_flags(spark, sf):
    return _qc(spark, sf).withColumn("flags", F.array_join("flags", ","))


@query(f"WITH {_QC_SQL} SELECT doc_id, sim, flags FROM f ORDER BY flags = '', sim, doc_id LIMIT 60")
def qc_worst(spark, sf):
    return _qc(spark, sf).orderBy(F.size("flags") == 0, "sim", "doc_id").limit(60).select("doc_id", "sim", F.array_join("flags", ",").alias("flags"))


@query(f"WITH {_QC_SQL} SELECT flag, count(*) AS n FROM (SELECT unnest(string_split(flags, ',')) AS flag FROM f WHERE flags <> '') GROUP BY flag")
def qc_histogram(spark, sf):
    return _qc(spark, sf).select(F.explode("flags").alias("flag")).groupBy("flag").agg(F.count("*").alias("n"))


@query(f"WITH {_QC_SQL}, t AS (SELECT doc_id // 3 AS clip, doc_id % 3 AS rung, sim, CASE WHEN flags = '' THEN 0 ELSE len(string_split(flags, ',')) END AS n FROM f) SELECT clip, arg_min(rung, (n, -sim, rung)) AS rung FROM t GROUP BY clip")
def reroll_pick(spark, sf):
    takes = _qc(spark, sf).select(F.floor(F.col("doc_id") / 3).alias("clip"), (F.col("doc_id") % 3).alias("rung"), "flags", "sim")
    return qa.best_take(takes, key="clip")


def _echo_words(spark, sf) -> DataFrame:
    w = conversation_words(spark, sf)
    return w.select("media", "ord", "speaker", (F.col("start_ms") % 20_000).alias("start_ms"), text.alnum_key("word").alias("key"), (F.col("ord") * 7919 % 101).alias("level"))


_ECHO_SQL = f"""{WORDS_SQL}, w AS (SELECT media, ord, speaker, start_ms % 20000 AS start_ms, regexp_replace(lower(word), '[^\\p{{L}}\\p{{N}}]+', '', 'g') AS key, ord * 7919 % 101 AS level FROM words),
e AS (SELECT a.media, a.ord FROM w a WHERE key <> '' AND EXISTS (SELECT 1 FROM w b WHERE a.media = b.media AND a.key = b.key AND a.speaker <> b.speaker AND abs(a.start_ms - b.start_ms) <= 600 AND a.level < 0.9 * b.level))"""


@query(f"WITH {_ECHO_SQL} SELECT * FROM e")
def echo_words(spark, sf):
    return qa.echo_words(_echo_words(spark, sf))


@query(f"""WITH {_ECHO_SQL}, x AS (SELECT w.media, w.ord, speaker, e.ord IS NOT NULL AS echo FROM w LEFT JOIN e ON w.media = e.media AND w.ord = e.ord),
r AS (SELECT *, row_number() OVER (PARTITION BY media, speaker ORDER BY ord) - sum(CASE WHEN echo THEN 1 ELSE 0 END) OVER (PARTITION BY media, speaker ORDER BY ord ROWS UNBOUNDED PRECEDING) AS run FROM x)
SELECT media, ord FROM (SELECT *, count(*) OVER (PARTITION BY media, speaker, run) AS n FROM r WHERE echo) WHERE n >= 2""")
def echo_runs(spark, sf):
    w = _echo_words(spark, sf)
    return qa.echo_runs(w, qa.echo_words(w), least=2)


_DOCTOR_SQL = f"""{SEGMENTS_SQL}, s AS (SELECT *, CAST(end_ms - start_ms AS BIGINT) AS span FROM segments),
found AS (SELECT 'segments' AS stage, CASE WHEN span <= 0 THEN 'fail' ELSE 'warn' END AS severity, ord AS seg_id, 'span ' || span || ' ms' AS msg FROM s WHERE span <= 0 OR span > 9000
UNION ALL SELECT 'translation', 'warn', ord, 'over budget: ' || length(text) || ' letters' FROM s WHERE span >= 1500 AND length(text) * 10000 > span * 12 * 13 + 100000
UNION ALL SELECT 'segments', 'fail', ord, 'speaker missing' FROM s WHERE speaker IS NULL)"""


def _findings(spark, sf) -> DataFrame:
    s = conversation_segments(spark, sf)
    return qa.segment_findings(s, F.length("text").cast("long"), longest_ms=9000, fast=12)


@query(f"""WITH {_DOCTOR_SQL}, a(ord, stage, part) AS (VALUES (0, 'segments', 'missing'), (1, 'translation', 'nothing like it'), (2, 'segments', 'speaker')), n AS (SELECT *, row_number() OVER () AS rn FROM found),
hit AS (SELECT rn, min(a.ord) AS used FROM n JOIN a ON a.stage = n.stage AND contains(n.msg, a.part) AND n.severity = 'fail' GROUP BY rn)
SELECT stage, severity, u AS unused, count(*) AS n FROM (SELECT n.stage, CASE WHEN used IS NOT NULL THEN 'warn' ELSE severity END AS severity, FALSE AS u FROM n LEFT JOIN hit ON n.rn = hit.rn
  UNION ALL SELECT stage, 'warn', TRUE FROM a WHERE ord NOT IN (SELECT used FROM hit)) GROUP BY stage, severity, u""")
def doctor(spark, sf):
    accepted = spark.createDataFrame([(0, "segments", "missing"), (1, "translation", "nothing like it"), (2, "segments", "speaker")], "ord int, stage string, contains string")
    out = qa.accept(_findings(spark, sf), accepted)
    return out.groupBy("stage", "severity", F.contains("msg", F.lit("unused")).alias("unused")).agg(F.count("*").alias("n"))


@query(f"WITH {_DOCTOR_SQL} SELECT count(*) FILTER (severity = 'fail') AS failures, count(*) FILTER (severity = 'warn') AS warnings, count(*) FILTER (severity = 'fail') = 0 AS ok FROM found")
def doctor_verdict(spark, sf):
    return qa.verdict(_findings(spark, sf))


@query()
def repeat_pairs(spark, sf):
    """Pairs of near segments of different speakers that share most of their words."""
    from ..operators.intervals import interval_join

    s = conversation_segments(spark, sf).withColumn("w", F.split(text.latin_words("text"), " ")).where(F.size("w") >= 2)
    a = s.select("media", F.col("ord").alias("a"), F.col("speaker").alias("sa"), F.col("w").alias("wa"), F.col("start_ms").alias("l_start"), F.greatest(F.col("end_ms"), F.col("start_ms") + 60_000).alias("l_end"))
    b = s.select("media", F.col("ord").alias("b"), F.col("speaker").alias("sb"), F.col("w").alias("wb"), F.col("start_ms").alias("r_start"), (F.col("start_ms") + 1).alias("r_end"))
    met = interval_join(a, b, on=["media"], condition=(F.col("a") < F.col("b")) & (F.col("sa") != F.col("sb")))
    met = met.withColumn("shared", speech.vectorised(lambda x, y: speech.shared_blocks(list(x), list(y)), "int")("wa", "wb"))
    return met.where((F.col("shared") >= 2) & (F.col("shared") >= 0.3 * F.least(F.size("wa"), F.size("wb")))).select("media", "a", "b", "shared")


@query("SELECT media, count(*) AS n FROM (SELECT conv_id AS media FROM conversations) GROUP BY media ORDER BY n DESC, media LIMIT 40")
def longest_items(spark, sf):
    return table(spark, sf, "conversations").groupBy(F.col("conv_id").alias("media")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "media").limit(40)


@query(f"WITH {WORDS_SQL} SELECT media, ord, gap_ms FROM (SELECT media, ord, lead(start_ms) OVER (PARTITION BY media ORDER BY ord) - end_ms AS gap_ms FROM words) WHERE gap_ms > 2500")
def wordless_gaps(spark, sf):
    """Pauses longer than 2.5 s between neighbouring words."""
    from pyspark.sql import Window as W

    w = conversation_words(spark, sf)
    return w.withColumn("gap_ms", F.lead("start_ms").over(W.partitionBy("media").orderBy("ord")) - F.col("end_ms")).where("gap_ms > 2500").select("media", "ord", "gap_ms")
