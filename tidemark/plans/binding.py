"""The driver's tables as words, turns, segments and frames; the same rows in DataFrame form and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import ends_sentence

#: Time that a letter takes, and pauses after a sentence, a turn and every seventeenth word, in ms.
LETTER, AFTER_SENTENCE, AFTER_TURN, AFTER_17TH = 80, 300, 1500, 2600


#: Orders of one recording.
RECORDING = 16_384


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def epoch_ms(df: DataFrame, name: str) -> Column:
    """Milliseconds since 1970 of a timestamp; one without a zone is taken as UTC."""
    if dict(df.dtypes)[name] == "timestamp_ntz":
        return F.expr(f"timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {name})")
    return F.unix_millis(F.col(name))


def word_stream(texts: DataFrame) -> DataFrame:
    """(media, turn, speaker, text), one row a turn, to words (media, ord, speaker, word, start_ms, end_ms).

    The last place of a turn is known before its words are dealt, so the words are shuffled once, by item.
    """
    t = texts.select("media", "turn", "speaker", F.split("text", r"\s+").alias("pieces"))
    t = t.withColumn("last", F.array_max(F.transform("pieces", lambda x, i: F.when(x != "", i))))  # below the explode: once a turn
    w = t.select("media", "turn", "speaker", "last", F.posexplode("pieces").alias("p", "word")).where("word <> ''")
    in_order = W.partitionBy("media").orderBy("turn", "p")
    length = F.length("word").cast("long") * LETTER
    pause = F.when(ends_sentence("word"), AFTER_SENTENCE).otherwise(0) + F.when(F.col("p") == F.col("last"), AFTER_TURN).otherwise(0) + F.when(F.col("p") % 17 == 0, AFTER_17TH).otherwise(0)
    w = w.withColumn("length", length).withColumn("step", length + pause)
    w = w.withColumn("start_ms", F.sum("step").over(in_order.rowsBetween(W.unboundedPreceding, 0)) - F.col("step"))
    return w.select("media", (F.row_number().over(in_order) - 1).cast("long").alias("ord"), "speaker", "word", "start_ms", (F.col("start_ms") + F.col("length")).alias("end_ms"))


def conversation_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_stream(table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("media"), F.col("turn").cast("long").alias("turn"), F.col("role").alias("speaker"), "text"))


def document_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_stream(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("media"), F.lit(0).cast("long").alias("turn"), F.col("lang").alias("speaker"), "text"))


def event_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns (media, ord, speaker, start_ms, end_ms): a day is a media item, four speakers, ``value`` seconds each."""
    e = table(spark, sf_dir, "events").where("ts IS NOT NULL AND value IS NOT NULL AND user_id IS NOT NULL")
    at = epoch_ms(e, "ts")
    e = e.select(F.floor(at / 86_400_000).cast("long").alias("media"), F.col("event_id").alias("ord"), (F.col("user_id") % 4).cast("long").alias("speaker"), (at % 86_400_000).cast("long").alias("start_ms"), "value")
    return e.select("media", "ord", "speaker", "start_ms", (F.col("start_ms") + F.floor(F.col("value") * 1000)).cast("long").alias("end_ms"))


def line_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames (media, track, frame_no, level): quarter seconds of recordings of four tracks each, the level in thousandths of
    full scale. A recording holds so many orders, so there are the more recordings the larger the table is."""
    media = F.floor(F.col("l_orderkey") / RECORDING).cast("long")
    rows = table(spark, sf_dir, "lineitem").select(media.alias("media"), (media * 4 + F.col("l_suppkey") % 4).cast("long").alias("track"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", F.greatest(F.col("l_quantity") - 20, F.lit(0)).cast("long").alias("level"))
    order = W.partitionBy("track").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "level")
    return rows.select("media", "track", (F.row_number().over(order) - 1).cast("long").alias("frame_no"), "level")


def _words_sql(source: str) -> str:
    return rf"""
w0 AS (SELECT media, turn, speaker, unnest(string_split_regex(text, '\s+')) AS word, generate_subscripts(string_split_regex(text, '\s+'), 1) - 1 AS p FROM ({source})),
w1 AS (SELECT *, length(word) * {LETTER} AS len_ms, max(p) OVER (PARTITION BY media, turn) AS last_p FROM w0 WHERE word <> ''),
w2 AS (SELECT *, len_ms + CASE WHEN right(word, 1) IN ('.', '!', '?', '…') THEN {AFTER_SENTENCE} ELSE 0 END + CASE WHEN p = last_p THEN {AFTER_TURN} ELSE 0 END + CASE WHEN p % 17 = 0 THEN {AFTER_17TH} ELSE 0 END AS step FROM w1),
w3 AS (SELECT *, CAST(sum(step) OVER (PARTITION BY media ORDER BY turn, p ROWS UNBOUNDED PRECEDING) AS BIGINT) - step AS start_ms, row_number() OVER (PARTITION BY media ORDER BY turn, p) - 1 AS ord FROM w2),
words AS (SELECT media, CAST(ord AS BIGINT) AS ord, speaker, word, CAST(start_ms AS BIGINT) AS start_ms, CAST(start_ms + len_ms AS BIGINT) AS end_ms FROM w3)"""


WORDS_SQL = _words_sql("SELECT conv_id AS media, turn, role AS speaker, text FROM conversations")
DOC_WORDS_SQL = _words_sql("SELECT doc_id AS media, 0 AS turn, lang AS speaker, text FROM documents")
TURNS_SQL = """
turns AS (
  SELECT CAST((epoch_us(ts) // 1000) // 86400000 AS BIGINT) AS media, event_id AS ord, CAST(user_id % 4 AS BIGINT) AS speaker, CAST((epoch_us(ts) // 1000) % 86400000 AS BIGINT) AS start_ms,
    CAST((epoch_us(ts) // 1000) % 86400000 + CAST(floor(value * 1000) AS BIGINT) AS BIGINT) AS end_ms FROM events WHERE ts IS NOT NULL AND value IS NOT NULL AND user_id IS NOT NULL)"""
FRAMES_SQL = f"""
frames AS (SELECT CAST(l_orderkey // {RECORDING} AS BIGINT) AS media, CAST(l_orderkey // {RECORDING} * 4 + l_suppkey % 4 AS BIGINT) AS track, CAST(row_number() OVER (PARTITION BY l_orderkey // {RECORDING}, l_suppkey % 4 ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, greatest(l_quantity - 20, 0)) - 1 AS BIGINT) AS frame_no,
  CAST(greatest(l_quantity - 20, 0) AS BIGINT) AS level FROM lineitem)"""
