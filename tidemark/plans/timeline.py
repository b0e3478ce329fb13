"""Queries of the interval and sequence operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import intervals as iv
from ..operators import sequence as sq
from .binding import DOC_WORDS_SQL, TURNS_SQL, WORDS_SQL, conversation_words, document_words, event_turns, table

QUERIES: dict = {}
SQL: dict = {}


def query(sql: str | None = None):
    def put(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return put


def conversation_segments(spark, sf) -> DataFrame:
    """Sentences of the conversations as segments (media, ord, speaker, start_ms, end_ms, text)."""
    return sq.build_sentences(conversation_words(spark, sf), gap_ms=2500).select("media", F.col("first_ord").alias("ord"), "speaker", "start_ms", "end_ms", "text")


def sentences_sql(gap: bool, words: str = WORDS_SQL) -> str:
    cut = "coalesce(lag(word) OVER o, '') SIMILAR TO '.*[.!?…]'" + (" OR coalesce(start_ms - lag(end_ms) OVER o > 2500, FALSE)" if gap else "")
    return f"""{words},
cuts AS (SELECT *, CASE WHEN {cut} THEN 1 ELSE 0 END AS cut FROM words WINDOW o AS (PARTITION BY media ORDER BY ord)),
sw AS (SELECT *, CAST(sum(cut) OVER (PARTITION BY media ORDER BY ord ROWS UNBOUNDED PRECEDING) AS BIGINT) AS sentence FROM cuts),
sp AS (SELECT media, sentence, speaker, row_number() OVER (PARTITION BY media, sentence ORDER BY sum(end_ms - start_ms) DESC, min(ord)) AS k FROM sw WHERE speaker IS NOT NULL GROUP BY media, sentence, speaker),
sentences AS (SELECT sw.media, sw.sentence, min(ord) AS first_ord, max(ord) AS last_ord, min(start_ms) AS start_ms, max(end_ms) AS end_ms, any_value(sp.speaker) AS speaker, string_agg(word, ' ' ORDER BY ord) AS text
  FROM sw LEFT JOIN sp ON sw.media = sp.media AND sw.sentence = sp.sentence AND k = 1 GROUP BY sw.media, sw.sentence),
segments AS (SELECT media, first_ord AS ord, speaker, start_ms, end_ms, text FROM sentences)"""


SEGMENTS_SQL = sentences_sql(True)


@query(f"WITH {sentences_sql(False)} SELECT * FROM sentences")
def build_sentences(spark, sf):
    return sq.build_sentences(conversation_words(spark, sf))


@query(f"WITH {sentences_sql(True)} SELECT * FROM sentences")
def build_sentences_gap(spark, sf):
    return sq.build_sentences(conversation_words(spark, sf), gap_ms=2500)


@query(f"""WITH RECURSIVE {SEGMENTS_SQL},
i AS (SELECT *, row_number() OVER (PARTITION BY media ORDER BY ord) AS rn FROM segments),
f AS (SELECT media, rn, ord AS first_ord, speaker, start_ms, end_ms FROM i WHERE rn = 1 UNION ALL
  SELECT i.media, i.rn, CASE WHEN j THEN f.first_ord ELSE i.ord END, i.speaker, CASE WHEN j THEN f.start_ms ELSE i.start_ms END, i.end_ms
  FROM f JOIN i ON i.media = f.media AND i.rn = f.rn + 1, LATERAL (SELECT f.speaker = i.speaker AND i.start_ms - f.end_ms <= 1000 AND i.end_ms - f.start_ms <= 12000 AS j))
SELECT media, first_ord, any_value(speaker) AS speaker, min(start_ms) AS start_ms, max(end_ms) AS end_ms, count(*) AS n FROM f GROUP BY media, first_ord""")
def merge_short(spark, sf):
    return sq.merge_short(conversation_segments(spark, sf))


_OVER = "a.media = b.media AND a.start_ms < b.end_ms AND b.start_ms < a.end_ms"
_LEN = "(least(a.end_ms, b.end_ms) - greatest(a.start_ms, b.start_ms))"


@query(f"""WITH {TURNS_SQL}, seg AS (SELECT media, ord, start_ms + 1000 AS start_ms, end_ms + 4000 AS end_ms FROM turns),
m AS (SELECT a.media, a.ord, b.speaker, row_number() OVER (PARTITION BY a.media, a.ord ORDER BY {_LEN} DESC, b.ord) AS k FROM seg a JOIN turns b ON {_OVER})
SELECT seg.media, seg.ord, m.speaker FROM seg LEFT JOIN m ON seg.media = m.media AND seg.ord = m.ord AND k = 1""")
def speaker_overlap_tag(spark, sf):
    turns = event_turns(spark, sf)
    return iv.best_overlap_speaker(turns.withColumns({"start_ms": F.col("start_ms") + 1000, "end_ms": F.col("end_ms") + 4000}), turns)


@query(f"""WITH {TURNS_SQL}, seg AS (SELECT media, ord, start_ms + 1000 + CASE WHEN ord % 9 = 4 THEN 1000000000 ELSE 0 END AS start_ms, end_ms + 60000 + CASE WHEN ord % 9 = 4 THEN 1000000000 ELSE 0 END AS end_ms FROM turns),
m AS (SELECT a.media, a.ord, b.speaker, row_number() OVER (PARTITION BY a.media, a.ord ORDER BY sum({_LEN}) DESC, min(b.ord)) AS k FROM seg a JOIN turns b ON {_OVER} GROUP BY a.media, a.ord, b.speaker)
SELECT seg.media, seg.ord, coalesce(m.speaker, d.speaker) AS speaker FROM seg LEFT JOIN m ON seg.media = m.media AND seg.ord = m.ord AND k = 1 LEFT JOIN (SELECT media, min(speaker) AS speaker FROM turns GROUP BY media) AS d ON d.media = seg.media""")
def segment_speaker_total(spark, sf):
    turns = event_turns(spark, sf)
    return iv.total_overlap_speaker(turns.withColumns({"start_ms": F.col("start_ms") + 1000 + F.when(F.col("ord") % 9 == 4, 10**9).otherwise(0), "end_ms": F.col("end_ms") + 60_000 + F.when(F.col("ord") % 9 == 4, 10**9).otherwise(0)}), turns)


@query(f"""WITH {TURNS_SQL} SELECT a.media, a.ord AS a, b.ord AS b, greatest(a.start_ms, b.start_ms) AS start_ms, least(a.end_ms, b.end_ms) AS end_ms
FROM turns a JOIN turns b ON {_OVER} AND a.speaker <> b.speaker AND (a.start_ms < b.start_ms OR a.start_ms = b.start_ms AND a.ord < b.ord) WHERE {_LEN} >= 800""")
def turn_overlaps(spark, sf):
    return iv.turn_overlaps(event_turns(spark, sf))


@query(f"WITH {TURNS_SQL} SELECT * FROM turns a WHERE NOT EXISTS (SELECT 1 FROM turns b WHERE {_OVER} AND a.speaker <> b.speaker)")
def uncovered_overlap(spark, sf):
    turns = event_turns(spark, sf)
    return iv.uncovered(turns, turns)


@query(f"WITH {TURNS_SQL} SELECT * FROM turns a WHERE EXISTS (SELECT 1 FROM turns b WHERE {_OVER} AND a.speaker = b.speaker AND a.ord <> b.ord AND {_LEN} >= 0.5 * (a.end_ms - a.start_ms))")
def covered_hole(spark, sf):
    turns = event_turns(spark, sf)
    return iv.covered_share(turns, turns)


@query(f"""WITH {TURNS_SQL}, g AS (SELECT media, max(end_ms) OVER (PARTITION BY media ORDER BY start_ms, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS gap_start, start_ms AS gap_end FROM turns)
SELECT * FROM g WHERE gap_end - gap_start >= 500""")
def diar_gaps(spark, sf):
    return iv.gaps(event_turns(spark, sf))


def _subtract_sql(min_ms: int, islands: str, spans: str, pad: int) -> str:
    return f"""WITH {TURNS_SQL}, isl AS ({islands}), sp AS ({spans}),
e AS (SELECT media, t, sum(di) AS di, sum(ds) AS ds, max(b) AS b FROM (SELECT media, start_ms AS t, 1 AS di, 0 AS ds, 1 AS b FROM isl UNION ALL SELECT media, end_ms, -1, 0, 0 FROM isl
  UNION ALL SELECT media, start_ms - {pad}, 0, 1, 0 FROM sp UNION ALL SELECT media, end_ms + {pad}, 0, -1, 0 FROM sp) GROUP BY media, t),
r AS (SELECT *, sum(di) OVER o > 0 AND sum(ds) OVER o = 0 AS free, lead(t) OVER (PARTITION BY media ORDER BY t) AS nt FROM e WINDOW o AS (PARTITION BY media ORDER BY t ROWS UNBOUNDED PRECEDING)),
s AS (SELECT *, CASE WHEN free AND (b > 0 OR NOT coalesce(lag(free) OVER (PARTITION BY media ORDER BY t), FALSE)) THEN 1 ELSE 0 END AS st FROM r),
u AS (SELECT *, sum(st) OVER (PARTITION BY media ORDER BY t ROWS UNBOUNDED PRECEDING) AS run FROM s)
SELECT media, min(t) AS start_ms, max(nt) AS end_ms FROM u WHERE free GROUP BY media, run HAVING max(nt) - min(t) >= {min_ms}"""


_MERGED_SQL = """SELECT media, min(start_ms) AS start_ms, max(end_ms) AS end_ms FROM (SELECT *, sum(n) OVER (PARTITION BY media ORDER BY start_ms, end_ms ROWS UNBOUNDED PRECEDING) AS g FROM (
  SELECT *, CASE WHEN coalesce(start_ms - max(end_ms) OVER (PARTITION BY media ORDER BY start_ms, end_ms ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <= {gap}, FALSE) THEN 0 ELSE 1 END AS n FROM turns WHERE {where})) GROUP BY media, g"""


@query(_subtract_sql(400, _MERGED_SQL.format(gap=400, where="speaker = 0"), "SELECT * FROM turns WHERE speaker <> 0", 250))
def subtract_intervals(spark, sf):
    turns = event_turns(spark, sf)
    return iv.subtract(sq.merge_regions(turns.where("speaker = 0"), keys=["media"], gap_ms=400), turns.where("speaker <> 0"), keys=["media"])


@query(_subtract_sql(1000, _MERGED_SQL.format(gap=0, where="speaker = 1"), "SELECT * FROM turns WHERE speaker <> 1", 0))
def solo_spans(spark, sf):
    turns = event_turns(spark, sf)
    return iv.subtract(sq.merge_regions(turns.where("speaker = 1"), keys=["media"], gap_ms=0), turns.where("speaker <> 1"), keys=["media"], pad_ms=0, min_ms=1000)


@query(f"""WITH {TURNS_SQL}, g AS (SELECT *, CASE WHEN coalesce(start_ms - max(end_ms) OVER (PARTITION BY media, speaker ORDER BY start_ms, end_ms ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <= 8000, FALSE) THEN 0 ELSE 1 END AS new FROM turns),
r AS (SELECT *, CAST(sum(new) OVER (PARTITION BY media, speaker ORDER BY start_ms, end_ms ROWS UNBOUNDED PRECEDING) AS BIGINT) AS region FROM g)
SELECT media, speaker, region, min(start_ms) AS start_ms, max(end_ms) AS end_ms, count(*) AS n FROM r GROUP BY media, speaker, region""")
def merge_regions(spark, sf):
    return sq.merge_regions(event_turns(spark, sf), keys=["media", "speaker"], gap_ms=8000)


_FLAGS = "ord % 7 = 3 AS orig, ord % 11 = 5 AS echo, ord % 13 = 6 AS overlap"


@query(f"""WITH {SEGMENTS_SQL}, s AS (SELECT *, {_FLAGS} FROM segments), l AS (SELECT *, row_number() OVER (PARTITION BY media ORDER BY start_ms, ord) AS pos FROM s WHERE NOT echo AND NOT overlap)
SELECT a.media, a.ord, (SELECT b.start_ms FROM l b WHERE b.media = a.media AND b.pos > a.pos AND (NOT b.orig OR b.speaker = a.speaker) ORDER BY b.pos LIMIT 1) AS slot_end FROM l a WHERE NOT a.orig""")
def slot_ends(spark, sf):
    s = conversation_segments(spark, sf)
    return sq.slot_ends(s.withColumns({"orig": F.col("ord") % 7 == 3, "echo": F.col("ord") % 11 == 5, "overlap": F.col("ord") % 13 == 6}))


@query(f"""WITH {SEGMENTS_SQL}, n AS (SELECT *, lead(start_ms) OVER (PARTITION BY media, speaker ORDER BY ord) AS ns FROM segments)
SELECT a.media, a.ord FROM n a WHERE ns IS NOT NULL AND right(text, 1) NOT IN ('.', '!', '?', '…', '"') AND ns - end_ms <= 2500
AND NOT EXISTS (SELECT 1 FROM segments b WHERE b.media = a.media AND b.speaker <> a.speaker AND b.start_ms < a.ns AND b.end_ms > a.end_ms AND a.ns > a.end_ms)""")
def runon_cuts(spark, sf):
    return sq.runon_cuts(conversation_segments(spark, sf))


@query(f"""WITH {WORDS_SQL}, n AS (SELECT *, CASE WHEN coalesce(right(lag(word) OVER o, 1) IN ('.', '!', '?', '…') OR start_ms - lag(end_ms) OVER o > 2500, FALSE) THEN 1 ELSE 0 END AS new FROM words WINDOW o AS (PARTITION BY media, speaker ORDER BY ord)),
r AS (SELECT *, sum(new) OVER (PARTITION BY media, speaker ORDER BY ord ROWS UNBOUNDED PRECEDING) AS run FROM n),
g AS (SELECT media, speaker, min(ord) AS first_ord, max(ord) AS last_ord, arg_min(start_ms, ord) AS start_ms, arg_max(end_ms, ord) AS end_ms, right(arg_max(word, ord), 1) AS e FROM r GROUP BY media, speaker, run)
SELECT media, speaker, first_ord, last_ord, start_ms, end_ms FROM g WHERE e NOT IN ('.', '!', '?', '…') AND end_ms - start_ms > 6000""")
def unpunctuated_runs(spark, sf):
    return sq.unpunctuated_runs(conversation_words(spark, sf), min_ms=6000)


@query(f"""WITH {SEGMENTS_SQL}, n AS (SELECT *, CASE WHEN lag(ord) OVER o IS NULL OR lag(speaker) OVER o IS DISTINCT FROM speaker THEN 1 ELSE 0 END AS new FROM segments WINDOW o AS (PARTITION BY media ORDER BY start_ms, ord)),
t AS (SELECT *, CAST(sum(new) OVER (PARTITION BY media ORDER BY start_ms, ord ROWS UNBOUNDED PRECEDING) AS BIGINT) AS turn FROM n)
SELECT media, turn, '[' || printf('%02d:%02d:%02d', min(start_ms) // 3600000, min(start_ms) // 60000 % 60, min(start_ms) // 1000 % 60) || '] ' || coalesce(any_value(speaker), '') || ': ' || string_agg(text, ' ' ORDER BY start_ms, ord) AS line FROM t GROUP BY media, turn""")
def transcript_turns(spark, sf):
    return sq.transcript_turns(conversation_segments(spark, sf))


def _degraded_sql(tempo: int, stretch: int, count: int) -> str:
    return f"""WITH {DOC_WORDS_SQL}, w AS (SELECT *, CAST(floor((start_ms - min(start_ms) OVER (PARTITION BY media)) / 300000) AS BIGINT) AS win FROM words),
g AS (SELECT media, win, count(*) AS n, count(*) FILTER (right(word, 1) IN ('.', ',', '!', '?', '…')) AS marks, count(*) FILTER (end_ms - start_ms > {stretch}) AS lw FROM w GROUP BY media, win HAVING count(*) >= 80),
r AS (SELECT media, win, n, marks < 0.04 * n AS punct, n * 60000 > {tempo} * 300000 AS tempo, lw >= {count} AS stretched FROM g) SELECT * FROM r WHERE punct OR tempo OR stretched"""


@query(_degraded_sql(260, 2000, 3))
def degraded_windows(spark, sf):
    return sq.degraded_windows(document_words(spark, sf))


@query(_degraded_sql(110, 1200, 1))
def degraded_windows_tight(spark, sf):
    return sq.degraded_windows(document_words(spark, sf), tempo_max=110, stretch_ms=1200, stretch_count=1)


@query(f"""WITH {DOC_WORDS_SQL}, w AS (SELECT *, sum(CASE WHEN right(word, 1) IN ('.', ',', '!', '?', '…') THEN 1 ELSE 0 END) OVER o AS n, count(*) OVER o AS k FROM words WINDOW o AS (PARTITION BY media ORDER BY ord ROWS BETWEEN 79 PRECEDING AND CURRENT ROW))
SELECT media, min(ord) AS ord FROM w WHERE k = 80 AND n < 4 GROUP BY media""")
def first_poor(spark, sf):
    return sq.first_poor(document_words(spark, sf))


@query(f"""WITH {DOC_WORDS_SQL}, w AS (SELECT media, ord, regexp_replace(lower(word), '[^\\p{{L}}\\p{{N}}]+', '', 'g') AS k0 FROM words),
l AS (SELECT media, ord, k0, {', '.join(f'lead(k0, {i}) OVER (PARTITION BY media ORDER BY ord) AS k{i}' for i in range(1, 9))} FROM w)
SELECT media, ord, k0 || ' ' || k1 || ' ' || k2 AS gram FROM l WHERE k0 <> '' AND k3 = k0 AND k4 = k1 AND k5 = k2 AND k6 = k3 AND k7 = k4 AND k8 = k5""")
def ngram_loops_raw(spark, sf):
    return sq.ngram_loops(document_words(spark, sf))


@query(f"""WITH RECURSIVE {DOC_WORDS_SQL}, p AS (SELECT media, ord, word, start_ms, end_ms, lead(start_ms) OVER (PARTITION BY media ORDER BY ord) - end_ms AS pause, right(rtrim(word), 1) IN (',', ';', ':', '—') AS marked FROM words),
f AS (SELECT media, min(ord) AS a, max(ord) AS b, min(start_ms) AS s, max(end_ms) AS e, FALSE AS cut, FALSE AS half, 0 AS depth FROM p GROUP BY media UNION ALL
  SELECT media, CASE WHEN side = 0 THEN a ELSE place + 1 END, CASE WHEN side = 0 THEN place ELSE b END, CASE WHEN side = 0 THEN s ELSE ns END, CASE WHEN side = 0 THEN ne ELSE e END, CASE WHEN side = 0 THEN NOT any_marked ELSE cut END, TRUE, depth + 1
  FROM (SELECT f.media, f.a, f.b, f.s, f.e, f.cut, f.depth, arg_max(p.ord, (p.marked, p.pause, p.ord)) AS place, arg_max(p.end_ms, (p.marked, p.pause, p.ord)) AS ne, arg_max(p.end_ms + p.pause, (p.marked, p.pause, p.ord)) AS ns, bool_or(p.marked) AS any_marked
    FROM f JOIN p ON p.media = f.media AND p.ord >= f.a AND p.ord < f.b WHERE f.e - f.s > 25000 AND f.a < f.b GROUP BY f.media, f.a, f.b, f.s, f.e, f.cut, f.depth) AS x, (VALUES (0), (1)) AS y(side))
SELECT media, 0::BIGINT AS run, row_number() OVER (PARTITION BY media ORDER BY a) - 1 AS piece, a AS first_ord, b AS last_ord, s AS start_ms, e AS end_ms, cut FROM f WHERE NOT (e - s > 25000 AND a < b)""")
def split_long(spark, sf):
    return sq.split_long(document_words(spark, sf).withColumn("run", F.col("ord") * 0))


@query(f"""WITH RECURSIVE {SEGMENTS_SQL}, c AS (SELECT media, ord, start_ms, lead(start_ms) OVER (PARTITION BY media ORDER BY start_ms, ord) AS next_ms, length(text) * 90 AS dur_ms, row_number() OVER (PARTITION BY media ORDER BY start_ms, ord) AS rn FROM segments),
f AS (SELECT media, 0::BIGINT AS rn, NULL::BIGINT AS ord, 0.0::DOUBLE AS place_ms, 1.0::DOUBLE AS tempo, 0.0::DOUBLE AS cur FROM (SELECT DISTINCT media FROM c) UNION ALL
  SELECT media, rn, ord, place, tempo, place + dur_ms / tempo FROM (SELECT *, CASE WHEN t > 1.02::DOUBLE THEN t ELSE 1.0::DOUBLE END AS tempo FROM (
    SELECT *, least(greatest(dur_ms::DOUBLE / greatest(coalesce(next_ms::DOUBLE, 'infinity'::DOUBLE) - place, 500.0::DOUBLE), 1.0::DOUBLE), 1.35::DOUBLE) AS t FROM (
      SELECT c.*, greatest(c.start_ms::DOUBLE, least(f.cur, c.start_ms::DOUBLE + 1000)) AS place FROM f JOIN c ON c.media = f.media AND c.rn = f.rn + 1))))
SELECT media, ord, place_ms, tempo, cur AS end_ms FROM f WHERE rn > 0""")
def placement(spark, sf):
    s = conversation_segments(spark, sf)
    ends = sq.slot_ends(s.withColumns({f: F.lit(False) for f in ("orig", "echo", "overlap")})).withColumnRenamed("slot_end", "next_ms")
    return sq.placement(s.join(ends, ["media", "ord"]).withColumn("dur_ms", F.length("text").cast("long") * 90))


@query(f"""WITH RECURSIVE {TURNS_SQL}, i AS (SELECT *, row_number() OVER (PARTITION BY media ORDER BY start_ms, ord) AS rn FROM turns),
f AS (SELECT media, 0::BIGINT AS rn, NULL::BIGINT AS ord, CAST([] AS STRUCT(o BIGINT, sp BIGINT, s BIGINT, e BIGINT)[]) AS live, NULL::BIGINT AS under FROM (SELECT DISTINCT media FROM i) UNION ALL
  SELECT media, rn, ord, CASE WHEN len(held) > 0 THEN kept ELSE list_append(kept, {{'o': ord, 'sp': speaker, 's': start_ms, 'e': end_ms}}) END, CASE WHEN len(held) > 0 THEN list_reduce(held, lambda x, y: CASE WHEN y.s > x.s THEN y ELSE x END).o END FROM (
    SELECT *, list_filter(kept, lambda p: p.sp <> speaker AND p.s < start_ms AND least(p.e, end_ms) - start_ms >= 300) AS held FROM (
      SELECT i.*, list_filter(f.live, lambda p: p.e - i.start_ms >= 300) AS kept FROM f JOIN i ON i.media = f.media AND i.rn = f.rn + 1)))
SELECT media, ord, under FROM f WHERE under IS NOT NULL""")
def concurrency_marks(spark, sf):
    return sq.concurrency_marks(event_turns(spark, sf))


@query(SQL["concurrency_marks"].replace("SELECT media, ord, under FROM f WHERE under IS NOT NULL", """, k AS (SELECT media, ord, under FROM f WHERE under IS NOT NULL)
SELECT t.media, t.ord, k.under IS NOT NULL AS overlap, CASE WHEN k.under IS NOT NULL THEN 0.35::DOUBLE WHEN (t.media, t.ord) IN (SELECT (media, under) FROM k) THEN (-0.35)::DOUBLE ELSE 0.0::DOUBLE END AS pan, CASE WHEN k.under IS NOT NULL THEN -2 ELSE 0 END AS gain_db FROM turns t LEFT JOIN k ON t.media = k.media AND t.ord = k.ord"""))
def overlay_geometry(spark, sf):
    turns = event_turns(spark, sf)
    return sq.overlay_geometry(turns, sq.concurrency_marks(turns))


@query(f"""WITH {DOC_WORDS_SQL}, w AS (SELECT *, min(start_ms) OVER (PARTITION BY media) AS f FROM words), x AS (SELECT *, CAST(floor((start_ms - f) / 300000) AS BIGINT) AS win FROM w),
g AS (SELECT media, win, f, count(*) AS n, count(*) FILTER (right(word, 1) IN ('.', ',', '!', '?', '…')) AS marks, count(*) FILTER (end_ms - start_ms > 1200) AS drawn FROM x GROUP BY media, win, f HAVING count(*) >= 80),
r AS (SELECT *, marks < 0.04 * n AS poor, n * 60000 > 110 * 300000 AS quick, drawn >= 1 AS long_, (marks * 2000 + n) // (n * 2) AS pm FROM g)
SELECT media, win, f + win * 300000 AS t0_ms, f + (win + 1) * 300000 AS t1_ms, CASE WHEN poor OR quick THEN 'fail' ELSE 'warn' END AS severity,
  concat_ws('; ', CASE WHEN poor THEN 'punctuation ' || (pm // 10) || '.' || (pm % 10) || '%' END, CASE WHEN quick THEN ((n * 120000 + 300000) // 600000) || ' words/min' END, CASE WHEN long_ THEN drawn || ' stretched words' END) AS reason FROM r WHERE poor OR quick OR long_""")
def degraded_reasons(spark, sf):
    return sq.degraded_reasons(document_words(spark, sf), tempo_max=110, stretch_ms=1200, stretch_count=1)


@query(f"""WITH {TURNS_SQL}, g AS (SELECT media, max(end_ms) OVER (PARTITION BY media ORDER BY start_ms, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS gap_start, start_ms AS gap_end FROM turns),
e AS (SELECT media, min(start_ms) AS s, max(end_ms) AS e FROM turns GROUP BY media)
SELECT * FROM (SELECT * FROM g UNION ALL SELECT media, 0, s FROM e UNION ALL SELECT media, e, 86400000 FROM e) WHERE gap_end - gap_start >= 500""")
def all_gaps(spark, sf):
    turns = event_turns(spark, sf)
    return iv.all_gaps(turns, turns.select("media", F.lit(86_400_000).cast("long").alias("total_ms")).distinct())


@query("SELECT role AS speaker, count(*) AS n FROM conversations GROUP BY role")
def speaker_counts(spark, sf):
    return table(spark, sf, "conversations").groupBy(F.col("role").alias("speaker")).agg(F.count("*").alias("n"))
