"""Queries of the remaining predicates, findings, gaps and ladders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import stress, text
from ..functions.dictionaries import HOMOGRAPHS, NAME_STEMS
from ..operators import bridge, rules, voices
from ..operators import incremental as inc
from ..operators import multitrack as mt
from ..operators import quality as qa
from ..operators import sequence as sq
from ..operators import signal as sg
from .binding import FRAMES_SQL, TURNS_SQL, event_turns, line_frames, table
from .texts import _lines, _lines_sql, _names_sql
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


#: Short lines as recognisers write them, dealt to the documents.
HEARD = ["Mm-hmm.", "uh-huh", "Ha ha ha!", "hmm...", "and then we", "Yes.", "so", "Ha ha, right.", "oh wow I see", "hah", "well, the laser", "thank you.", "", "mhm, mhm"]


def _heard(spark, sf) -> DataFrame:
    pick = F.element_at(F.array(*[F.lit(x) for x in HEARD]), (F.col("doc_id") % len(HEARD) + 1).cast("int"))
    return table(spark, sf, "documents").select("doc_id", pick.alias("heard"))


_HEARD_SQL = "h AS (SELECT doc_id, ([" + ", ".join(f"'{x}'" for x in HEARD) + f"])[doc_id % {len(HEARD)} + 1] AS heard FROM documents)"
_SOUNDS = ", ".join(f"'{x}'" for x in voices.SOUNDS)


@query(f"WITH {SEGMENTS_SQL}, s AS (SELECT media, ord, CASE WHEN ord % 7 = 3 THEN 'orig' WHEN ord % 7 = 5 THEN 'line' END AS type, CASE WHEN ord % 11 < 9 THEN ord % 11 = 5 END AS echo FROM segments) SELECT media, ord FROM s WHERE coalesce(type, '') <> 'orig' AND NOT coalesce(echo, FALSE)")
def voiced_segments(spark, sf):
    s = conversation_segments(spark, sf).select("media", "ord", F.when(F.col("ord") % 7 == 3, "orig").when(F.col("ord") % 7 == 5, "line").alias("type"), F.when(F.col("ord") % 11 < 9, F.col("ord") % 11 == 5).alias("echo"))
    return s.where(rules.voiced()).select("media", "ord")


@query(f"WITH {TURNS_SQL} SELECT * FROM turns WHERE start_ms >= 3600000 AND start_ms < 7200000")
def range_filter(spark, sf):
    return event_turns(spark, sf).where(rules.between("start_ms", 3_600_000, 7_200_000))


@query("SELECT doc_id, sha1(coalesce(text, '')) AS entry FROM documents WHERE doc_id % 13 = 2 OR doc_id IN (1, 5, 9)")
def forced_todo(spark, sf):
    now = table(spark, sf, "documents").select("doc_id", F.sha1(F.coalesce("text", F.lit("")).cast("binary")).alias("entry"))
    return inc.todo(now, now.where("doc_id % 13 <> 2"), key="doc_id", digest="entry", forced=F.col("doc_id").isin(1, 5, 9))


@query(f"WITH {_HEARD_SQL} SELECT doc_id, regexp_matches(heard, '(?i)^[-\\s.,!?…]*(?:(?:m+[-\\s]?h?m+|h+m+|uh[-\\s]?huh|mhm+|ha(?:[-\\s]?ha)+)[-.!?,…\\s]*)+$') AS sound FROM h")
def non_verbal_lines(spark, sf):
    return _heard(spark, sf).select("doc_id", mt.non_verbal("heard").alias("sound"))


@query(f"""WITH {_HEARD_SQL} SELECT doc_id FROM h WHERE heard <> '' AND len(string_split(heard, ' ')) <= 3 AND NOT regexp_matches(trim(heard), '[.!?…]$')
  AND NOT regexp_matches(heard, '(?i)^[-\\s.,!?…]*(?:(?:m+[-\\s]?h?m+|h+m+|uh[-\\s]?huh|mhm+|ha(?:[-\\s]?ha)+)[-.!?,…\\s]*)+$')""")
def orphan_lines(spark, sf):
    h = _heard(spark, sf).where("heard <> ''")
    return h.where(mt.orphan(F.col("heard"), F.size(F.split("heard", " ")))).select("doc_id")


@query(f"""WITH {_HEARD_SQL}, t AS (SELECT doc_id, list_filter(string_split(regexp_replace(lower(heard), '[^\\p{{L}}\\p{{N}}_'' ]+', ' ', 'g'), ' '), lambda x: x <> '') AS w FROM h)
SELECT doc_id, array_to_string(list_filter(w, lambda x: NOT (x IN ({_SOUNDS}) OR regexp_matches(x, '^(ha|he|ah|ho|hee|hah)+h?$'))), ' ') AS words FROM t""")
def speech_words(spark, sf):
    return _heard(spark, sf).select("doc_id", F.array_join(voices.speech_words(F.col("heard")), " ").alias("words"))


@query("""WITH d AS (SELECT doc_id, list_slice(string_split(text, ' '), 1, 12) AS a, list_slice(string_split(text, ' '), 7, 30) AS b FROM documents WHERE text IS NOT NULL),
n AS (SELECT doc_id, list_transform(a, lambda w: regexp_replace(lower(w), '[^\\p{L}\\p{N}_]+', '', 'g')) AS a, list_transform(b, lambda w: regexp_replace(lower(w), '[^\\p{L}\\p{N}_]+', '', 'g')) AS b FROM d),
c AS (SELECT doc_id, b, CASE WHEN len(list_filter(a, lambda w: length(w) >= 4)) > 0 THEN list_filter(a, lambda w: length(w) >= 4) ELSE a END AS c FROM n)
SELECT doc_id, len(c) > 0 AND len(list_filter(c, lambda w: list_contains(b, w))) >= 0.5 * len(c) AS bleed FROM c""")
def bleed_words(spark, sf):
    w = F.split("text", " ")
    return table(spark, sf, "documents").where("text IS NOT NULL").select("doc_id", voices.is_bleed(F.slice(w, 1, 12), F.slice(w, 7, 24)).alias("bleed"))


@query(f"WITH {_lines_sql()} SELECT doc_id, length(trim(regexp_replace('  ' || replace(ru, '+', '') || '  x ', '\\s+', ' ', 'g'))) AS chars FROM l")
def pace_chars(spark, sf):
    return _lines(spark, sf).select("doc_id", text.pace_chars(F.concat(F.lit("  "), "ru", F.lit("  x "))).alias("chars"))


@query("""WITH d AS (SELECT doc_id, [length(text) % 97, length(text) % 31, length(text) % 7] AS c, length(text) % 9000 AS t FROM documents WHERE text IS NOT NULL)
SELECT doc_id, array_to_string(list_transform(c, lambda x: CAST(greatest(CAST(floor(t * x / greatest(list_sum(c), 1)) AS BIGINT), 400) + 500 AS VARCHAR)), ' ') AS ms FROM d""")
def allocated_pieces(spark, sf):
    n = F.length("text").cast("long")
    d = table(spark, sf, "documents").where("text IS NOT NULL").select("doc_id", F.array(n % 97, n % 31, n % 7).alias("c"), (n % 9000).alias("t"))
    return d.select("doc_id", F.array_join(F.transform(voices.allocate(F.col("c"), F.col("t")), lambda x: x.cast("string")), " ").alias("ms"))


@query("SELECT label, list_sort(list(x))[len(list(x)) // 2 + 1] AS x FROM (SELECT label, vec_id * 7919 % 1009 AS x FROM embeddings) GROUP BY label")
def upper_medians(spark, sf):
    return table(spark, sf, "embeddings").groupBy("label").agg(voices.upper_median(F.col("vec_id") * 7919 % 1009).alias("x"))


_SPANS_SQL = "t AS (SELECT track, frame_no AS ord, frame_no * 700 AS s, frame_no * 700 + 100 + frame_no % 9 * 300 AS e FROM frames)"


def _spans(f: DataFrame) -> DataFrame:
    return f.select("track", F.col("frame_no").alias("ord"), (F.col("frame_no") * 700).alias("start_ms"), (F.col("frame_no") * 700 + 100 + F.col("frame_no") % 9 * 300).alias("end_ms"))


@query(f"""WITH {FRAMES_SQL}, {_SPANS_SQL}, x AS (SELECT track, ord, unnest(range(s // 250, (e - 1) // 250 + 1)) AS frame_no FROM t),
m AS (SELECT track, ord, count(*) FILTER (level > 20) / count(*) AS share FROM x JOIN frames USING (track, frame_no) WHERE level > 5 GROUP BY track, ord)
SELECT track, ord, round(share, 6) AS share, CASE WHEN share > 0.5 THEN 'mostly' WHEN share > 0.2 THEN 'partly' END AS bucket FROM m""")
def foreign_shares(spark, sf):
    f = line_frames(spark, sf)
    got = rules.foreign_share(_spans(f), f.select("track", "frame_no", (F.col("level") > 20).alias("foreign")), f.where("level > 5"))
    return got.select("track", "ord", F.round("share", 6).alias("share"), rules.foreign_bucket(F.col("share")).alias("bucket"))


@query(f"WITH {FRAMES_SQL}, g AS (SELECT track, frame_no, CASE WHEN level > 25 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS gain FROM frames) SELECT track, frame_no, round(avg(gain) OVER (PARTITION BY track ORDER BY frame_no ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING), 6) AS gain FROM g")
def muting_gain(spark, sf):
    f = line_frames(spark, sf).select("track", "frame_no", (F.col("level") > 25).alias("foreign"))
    return sg.muting_gain(f).withColumn("gain", F.round("gain", 6))


@query(f"""WITH {FRAMES_SQL}, g AS (SELECT track, frame_no AS ord, frame_no * 250 AS s, frame_no * 250 + frame_no % 40 * 1000 AS e FROM frames WHERE frame_no % 20 = 7), x AS (SELECT track, ord, unnest(range(s // 250, (e - 1) // 250 + 1)) AS frame_no FROM g WHERE e - s >= 10000),
m AS (SELECT x.track, x.ord, count(f.track) / count(*) AS share FROM x LEFT JOIN (SELECT * FROM frames WHERE level > 5) AS f ON f.track = x.track AND f.frame_no = x.frame_no GROUP BY x.track, x.ord) SELECT track, ord, round(share, 6) AS voiced_share FROM m WHERE share >= 0.5""")
def spans_voiced(spark, sf):
    f = line_frames(spark, sf)
    g = f.where("frame_no % 20 = 7").select("track", F.col("frame_no").alias("ord"), (F.col("frame_no") * 250).alias("start_ms"), (F.col("frame_no") * 250 + F.col("frame_no") % 40 * 1000).alias("end_ms"))
    return rules.spans_voiced(g, f.where("level > 5")).withColumn("voiced_share", F.round("voiced_share", 6))


@query("""WITH p AS (SELECT doc_id AS id, doc_id * 3 AS old_id, CASE WHEN doc_id % 4 = 0 THEN 'x' ELSE sha1(coalesce(text, '')) END AS new_hash, doc_id % 5 > 0 AS same FROM documents), o AS (SELECT doc_id * 3 AS old_id, sha1(coalesce(text, '')) AS entry FROM documents WHERE doc_id % 7 > 0)
SELECT id, entry FROM p JOIN o USING (old_id) WHERE same AND entry = new_hash""")
def carried_manifest(spark, sf):
    h = F.sha1(F.coalesce("text", F.lit("")).cast("binary"))
    d = table(spark, sf, "documents")
    pairs = d.select(F.col("doc_id").alias("id"), (F.col("doc_id") * 3).alias("old_id"), F.when(F.col("doc_id") % 4 == 0, "x").otherwise(h).alias("new_hash"), (F.col("doc_id") % 5 > 0).alias("same_reference"))
    return bridge.carried_manifest(pairs, d.where("doc_id % 7 > 0").select((F.col("doc_id") * 3).alias("id"), h.alias("entry")))


@query(f"""WITH {SEGMENTS_SQL}, n AS (SELECT media, count(*) AS n, count(*) FILTER (ord % 9 = media % 9) AS k FROM segments GROUP BY media)
SELECT 'segments' AS stage, 'fail' AS severity, media AS seg_id, k || ' run-on of ' || n AS msg FROM n WHERE k > 0.05 * n""")
def runon_findings(spark, sf):
    s = conversation_segments(spark, sf)
    return qa.runon_findings(s, s.where("ord % 9 = media % 9").select("media", "ord"))


@query(f"WITH {SEGMENTS_SQL} SELECT 'segments' AS stage, 'warn' AS severity, media AS seg_id, count(*) || ' cut in mid-sentence' AS msg FROM segments WHERE ord % 23 = 3 GROUP BY media")
def cut_findings(spark, sf):
    return qa.cut_findings(conversation_segments(spark, sf).withColumn("cut", F.col("ord") % 23 == 3))


@query("""WITH r AS (SELECT doc_id AS ord, CASE WHEN doc_id % 6 = 0 THEN ' ' ELSE text END AS text, (doc_id % 150) / 10.0::DOUBLE AS seconds, (doc_id % 8) / 10.0::DOUBLE AS head FROM documents)
SELECT 'refs' AS stage, 'fail' AS severity, ord AS seg_id, 'no text' AS msg FROM r WHERE trim(coalesce(text, '')) = '' UNION ALL SELECT 'refs', 'fail', ord, 'too long' FROM r WHERE seconds > 11.6
UNION ALL SELECT 'refs', 'warn', ord, 'short' FROM r WHERE seconds < 4 UNION ALL SELECT 'refs', 'warn', ord, 'silent head' FROM r WHERE head > 0.3""")
def reference_findings(spark, sf):
    k = F.col("doc_id")
    return rules.reference_findings(table(spark, sf, "documents").select(k.alias("ord"), F.when(k % 6 == 0, " ").otherwise(F.col("text")).alias("text"), ((k % 150) / 10.0).alias("seconds"), ((k % 8) / 10.0).alias("head")))


@query(f"""WITH {TURNS_SQL}, p AS (SELECT *, ord % 5 AS bytes, ord % 2 = 0 AS auto FROM turns WHERE ord % 3 = 0),
h AS (SELECT media, ord, speaker, start_ms + 2000 AS s, end_ms + 9000 AS e, ord % 6 AS n, -(ord % 5) / 2.5::DOUBLE AS lp, ord % 8 = 1 AS bleed FROM turns WHERE ord % 4 = 1),
o AS (SELECT * FROM h WHERE NOT EXISTS (SELECT 1 FROM turns t WHERE t.media = h.media AND t.speaker = h.speaker AND least(t.end_ms, h.e) - greatest(t.start_ms, h.s) >= 0.5 * (h.e - h.s)))
SELECT 'paste' AS stage, 'fail' AS severity, ord AS seg_id, 'file missing' AS msg FROM p WHERE bytes = 0 UNION ALL SELECT 'paste', 'fail', ord, 'long' FROM p WHERE auto AND end_ms - start_ms > 4000
UNION ALL SELECT 'speech', CASE WHEN NOT bleed AND n >= 3 AND lp >= -1 THEN 'fail' ELSE 'warn' END, ord, CASE WHEN bleed THEN 'another speaker''s words' WHEN lp >= -1 THEN 'untranscribed' ELSE 'untranscribed, unclear' END FROM o""")
def paste_findings(spark, sf):
    turns, k = event_turns(spark, sf), F.col("ord")
    pastes = turns.where("ord % 3 = 0").withColumns({"bytes": k % 5, "auto": k % 2 == 0})
    holes = turns.where("ord % 4 = 1").withColumns({"start_ms": F.col("start_ms") + 2000, "end_ms": F.col("end_ms") + 9000, "n_words": k % 6, "logprob": -(k % 5) / 2.5, "bleed": k % 8 == 1})
    return rules.paste_findings(pastes, holes, turns)


@query(f"WITH {TURNS_SQL} SELECT DISTINCT speaker FROM turns WHERE ord % 2 = 0 AND speaker NOT IN (1, 3)")
def unchecked_speakers(spark, sf):
    turns = event_turns(spark, sf)
    return rules.unchecked_speakers(turns.select("speaker", (F.col("ord") % 2 == 0).alias("auto")), turns.where("speaker IN (1, 3)"))


@query("""WITH t AS (SELECT doc_id AS ord, CASE WHEN doc_id % 8 > 1 THEN text WHEN doc_id % 8 = 1 THEN '' END AS text, doc_id % 9 = 0 AS orig FROM documents WHERE doc_id % 10 <> 3), b AS (SELECT doc_id AS ord, doc_id % 9 = 0 AS orig FROM documents)
SELECT 'translation' AS stage, 'fail' AS severity, ord AS seg_id, 'untranslated' AS msg FROM t WHERE NOT orig AND coalesce(text, '') = '' UNION ALL SELECT 'translation', 'fail', ord, 'absent' FROM b WHERE NOT orig AND ord NOT IN (SELECT ord FROM t)""")
def translation_findings(spark, sf):
    k = F.col("doc_id")
    b = table(spark, sf, "documents").select(k.alias("ord"), F.when(k % 8 > 1, F.col("text")).when(k % 8 == 1, "").alias("text"), (k % 9 == 0).alias("orig"))
    return rules.translation_findings(b.where("ord % 10 <> 3"), b)


@query("SELECT doc_id AS ord, CASE WHEN doc_id % 3 = 1 THEN replace(text, 'a', '+a') ELSE text END AS sung FROM documents")
def sung_text(spark, sf):
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("ord"), "text")
    return rules.sung_text(d, d.where("ord % 3 = 1").select("ord", F.replace("text", F.lit("a"), F.lit("+a")).alias("marked"))).select("ord", "sung")


@query(f"""WITH {_HEARD_SQL}, d AS (SELECT trim(regexp_replace(lower(t), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) AS k, arg_min(v, t) AS v FROM (VALUES ('MM hmm', 'ага'), ('mm, hmm!', 'угу'), ('Well the laser', 'ну, лазер'), ('Yes', 'да')) AS x(t, v) GROUP BY k)
SELECT doc_id AS ord, v AS translation FROM h LEFT JOIN d ON trim(regexp_replace(lower(heard), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) = d.k""")
def decided_lines(spark, sf):
    decisions = spark.createDataFrame([("MM hmm", "ага"), ("mm, hmm!", "угу"), ("Well the laser", "ну, лазер"), ("Yes", "да")], "text string, translation string")
    return rules.decided(_heard(spark, sf).select(F.col("doc_id").alias("ord"), F.col("heard").alias("text")), decisions).select("ord", "translation")


@query("SELECT DISTINCT role AS speaker FROM conversations WHERE role IS NOT NULL AND role <> 'user'")
def missing_voices(spark, sf):
    s = table(spark, sf, "conversations").select(F.col("role").alias("speaker"))
    return rules.missing_voices(s, s.where("speaker = 'user'").distinct())


@query("SELECT doc_id FROM documents WHERE doc_id % 5 = 0 AND doc_id % 3 <> 0")
def unknown_ids(spark, sf):
    d = table(spark, sf, "documents").select("doc_id")
    return rules.unknown_ids(d.where("doc_id % 5 = 0"), d.where("doc_id % 3 = 0"), key="doc_id")


@query(f"WITH {TURNS_SQL} SELECT media, min(start_ms) AS first_ms, max(end_ms) AS last_ms, count(*) AS n FROM turns GROUP BY media")
def extents(spark, sf):
    return rules.extents(event_turns(spark, sf))


@query(f"WITH {TURNS_SQL} SELECT media, ord, speaker, row_number() OVER (PARTITION BY speaker ORDER BY start_ms, ord) - 1 AS place FROM turns")
def locality_order(spark, sf):
    return rules.locality_order(event_turns(spark, sf)).select("media", "ord", "speaker", "place")


@query(f"WITH {TURNS_SQL} SELECT count(*) FILTER (end_ms - start_ms > 20000) AS long_turns, count(*) FILTER (speaker = 2) AS of_two, count(*) AS n FROM turns")
def pass_counters(spark, sf):
    """The counters of an observation, as the one row that its action fills in."""
    turns = event_turns(spark, sf)
    seen, counts = rules.counted_passes(turns, "passes", long_turns=F.col("end_ms") - F.col("start_ms") > 20_000, of_two=F.col("speaker") == 2, n=F.lit(True))
    seen.write.format("noop").mode("overwrite").save()
    got = counts.get
    return spark.createDataFrame([tuple(got[k] for k in ("long_turns", "of_two", "n"))], "long_turns long, of_two long, n long")


@query(f"""WITH {TURNS_SQL}, r AS (SELECT media, (end_ms - start_ms) / (200 + ord % 900) AS r FROM turns WHERE 200 + ord % 900 > 300)
SELECT media, count(*) AS n, round(list_sort(list(r))[len(list(r)) // 2 + 1], 6) AS median, round(min(r), 6) AS least, round(max(r), 6) AS most FROM r GROUP BY media""")
def preflight(spark, sf):
    t = event_turns(spark, sf).select("media", (F.col("end_ms") - F.col("start_ms")).alias("speech_ms"), (F.col("ord") % 900 + 200).alias("span_ms"))
    return rules.preflight(t).select("media", "n", *[F.round(c, 6).alias(c) for c in ("median", "least", "most")])


@query("SELECT doc_id AS item, 'accents' AS stage FROM documents WHERE doc_id % 5 = 0 OR doc_id % 7 > 4")
def stages_to_run(spark, sf):
    k = F.col("doc_id")
    return rules.stages_to_run(table(spark, sf, "documents").select(k.alias("item"), F.lit("accents").alias("stage"), F.when(k % 5 > 0, F.lit(4)).alias("output_at"), (k % 7).alias("input_at")))


@query(f"WITH {_lines_sql()} SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(ru), '[\\p{{L}}+]+')) AS word FROM l) WHERE word IN ({', '.join(chr(39) + x + chr(39) for x in HOMOGRAPHS)}) GROUP BY word")
def homograph_hits(spark, sf):
    return rules.hits_of_homographs(_lines(spark, sf), list(HOMOGRAPHS), text="ru")


@query("SELECT k AS key, 'short stem' AS msg, 'warn' AS severity FROM (VALUES " + ", ".join(f"('{k}')" for k in NAME_STEMS) + ") AS t(k) WHERE length(k) <= 3")
def stem_findings(spark, sf):
    return rules.stem_findings(spark.createDataFrame(list(NAME_STEMS.items()), "key string, value string")).select("key", "msg", "severity")


_NORM_SQL = "regexp_replace(lower(translate(replace(%s, '+', ''), 'ёЁ', 'еЕ')), '[^\\p{L}\\p{N}_]+', '', 'g')"


@query(f"""WITH {_lines_sql()}, a AS (SELECT doc_id AS ord, ru, CASE WHEN doc_id % 11 <> 3 THEN {_names_sql('accented', True)} || CASE WHEN doc_id % 6 = 1 THEN ' ещё' ELSE '' END END AS marked FROM l),
n AS (SELECT ord, ru, marked, {_NORM_SQL % _names_sql('ru', True)} AS x, {_NORM_SQL % _names_sql("coalesce(marked, '')", True)} AS y FROM a)
SELECT 'accents' AS stage, 'fail' AS severity, ord AS seg_id, 'missing' AS msg FROM n WHERE marked IS NULL UNION ALL SELECT 'accents', 'fail', ord, 'stale' FROM n WHERE marked IS NOT NULL AND x <> y
UNION ALL SELECT 'accents', 'warn', ord, 'unmarked' FROM n WHERE length(ru) > 12 AND NOT contains(marked, '+')""")
def respelt_accents(spark, sf):
    """Names that the dictionary respells are not stale."""
    forced = lambda c: stress.name_stress(c, force=True)
    d = _lines(spark, sf).withColumnRenamed("doc_id", "ord")
    marked = F.concat(forced(F.col("accented")), F.when(F.col("ord") % 6 == 1, " ещё").otherwise(""))
    return rules.accent_findings(d.select("ord", F.col("ru").alias("text")), d.where("ord % 11 <> 3").select("ord", marked.alias("marked")), respell=forced)


@query(f"""WITH RECURSIVE {SEGMENTS_SQL}, i AS (SELECT *, ord % 5 = 0 AS cut, row_number() OVER (PARTITION BY media ORDER BY ord) AS rn FROM segments),
f AS (SELECT media, rn, ord AS first_ord, speaker, start_ms, end_ms FROM i WHERE rn = 1 UNION ALL
  SELECT i.media, i.rn, CASE WHEN j THEN f.first_ord ELSE i.ord END, i.speaker, CASE WHEN j THEN f.start_ms ELSE i.start_ms END, i.end_ms
  FROM f JOIN i ON i.media = f.media AND i.rn = f.rn + 1, LATERAL (SELECT f.speaker = i.speaker AND i.start_ms - f.end_ms <= 1000 AND i.end_ms - f.start_ms <= 12000 AS j))
SELECT f.media, f.first_ord, any_value(f.speaker) AS speaker, min(f.start_ms) AS start_ms, arg_max(f.end_ms, f.rn) AS end_ms, count(*) AS n, string_agg(i.text, ' ' ORDER BY f.rn) AS text, arg_max(i.cut, f.rn) AS cut FROM f JOIN i ON i.media = f.media AND i.rn = f.rn GROUP BY f.media, f.first_ord""")
def merge_sessions(spark, sf):
    return sq.merge_sessions(conversation_segments(spark, sf).withColumn("cut", F.col("ord") % 5 == 0))


@query(f"""WITH RECURSIVE {TURNS_SQL}, o AS (SELECT media, max(end_ms) OVER (PARTITION BY media ORDER BY start_ms, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS gs, start_ms AS ge FROM turns),
p AS (SELECT media, (coalesce(gs, 0) + ge) // 2 AS p FROM o WHERE ge - coalesce(gs, 0) >= 300 AND media % 2 = 0), h AS (SELECT media, hop * 300 AS at_ms, hop * 7919 % 1009 AS level FROM (SELECT DISTINCT media FROM turns), (SELECT unnest(range(0, 28800, 50)) AS hop)),
f AS (SELECT media, 0::BIGINT AS n, 0::BIGINT AS bound_ms FROM (SELECT DISTINCT media FROM turns) UNION ALL
  SELECT media, n + 1, greatest(coalesce(pause, hop, t), bound_ms + 1) FROM (SELECT f.media, f.n, f.bound_ms, f.bound_ms + 1200000 AS t,
    (SELECT arg_min(p.p, (abs(p.p - f.bound_ms - 1200000), p.p)) FROM p WHERE p.media = f.media AND abs(p.p - f.bound_ms - 1200000) <= 60000) AS pause,
    (SELECT arg_min(h.at_ms, (h.level, h.at_ms)) + 150 FROM h WHERE h.media = f.media AND h.at_ms >= greatest(f.bound_ms + 1140000, 0) AND h.at_ms + 300 <= f.bound_ms + 1260000) AS hop FROM f WHERE f.bound_ms + 1200000 < 8640000 - 60000))
SELECT media, n, bound_ms FROM f UNION ALL SELECT media, max(n) + 1, 8640000 FROM f GROUP BY media""")
def chunk_bounds(spark, sf):
    """The first 144 minutes of each day; every other day has no turns, so only its quietest moments count."""
    turns = event_turns(spark, sf)
    items = turns.select("media").distinct()
    hops = items.withColumn("hop", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(28_799).cast("long"), F.lit(50).cast("long"))))
    return voices.chunk_bounds(turns.where("media % 2 = 0"), items.withColumn("total_ms", F.lit(8_640_000).cast("long")), hops.withColumn("level", F.col("hop") * 7919 % 1009))
