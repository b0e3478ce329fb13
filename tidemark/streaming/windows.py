"""Structured Streaming counterparts of the window operators. Late rows count until the watermark has passed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def degraded_windows(words: DataFrame, *, time: str = "ts", late: str = "1 minute", window: str = "5 minutes", least_words: int = 80, least_share: float = 0.04) -> DataFrame:
    """(media, start, n, marks) of tumbling windows with many words and few marks, once each closes."""
    w = words.withWatermark(time, late).groupBy("media", F.window(time, window).alias("w"))
    g = w.agg(F.count("*").alias("n"), F.sum(F.rlike(F.trim("word"), F.lit(r"[.,!?…]$")).cast("long")).alias("marks"))
    return g.where((F.col("n") >= least_words) & (F.col("marks") < least_share * F.col("n"))).select("media", F.col("w.start").alias("start"), "n", "marks")


def voiced_sessions(frames: DataFrame, *, time: str = "ts", late: str = "1 minute", gap: str = "8 seconds", threshold: float = 5.6) -> DataFrame:
    """(track, start, end, n): voiced frames joined while they lie less than ``gap`` apart."""
    s = frames.where(F.col("level") > threshold).withWatermark(time, late).groupBy("track", F.session_window(time, gap).alias("s"))
    return s.agg(F.count("*").alias("n")).select("track", F.col("s.start").alias("start"), F.col("s.end").alias("end"), "n")


def counts_by_type(events: DataFrame, *, time: str = "ts", late: str = "10 minutes", window: str = "1 hour") -> DataFrame:
    g = events.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), "event_type")
    return g.agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def keyed_upsert(batches: DataFrame, path: str, checkpoint: str):
    """Write each micro-batch into a folder of its own, ``epoch=N``: a retry replaces its own folder and nothing else.

    A batch costs what it holds, however large the table; ``latest`` reads the newest row of each key and ``compact``
    folds old batches into one.
    """

    def apply(rows: DataFrame, epoch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return batches.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)


def latest(spark: SparkSession, path: str, schema: StructType | str, *, key: str, order: str) -> DataFrame:
    """The newest row of each key by ``order``, then by batch, of all batches written so far."""
    rows = spark.read.schema(schema).option("basePath", path).parquet(path)
    fields = [f for f in rows.columns if f != "epoch"]
    return rows.groupBy(key).agg(F.max_by(F.struct(*fields), F.struct(order, "epoch")).alias("r")).select("r.*")


def compact(spark: SparkSession, path: str, schema: StructType | str, *, key: str, order: str, before: int) -> None:
    """Fold the batches up to ``before`` into that one's folder, and remove the older folders.

    The folded rows stand beside the table until they are whole; readers started before keep what they listed.
    """
    from ..sources.documents import exists, remove

    old = [n for n in range(before + 1) if exists(spark, f"{path}/epoch={n}")]
    if len(old) < 2:
        return
    kept = spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/epoch={n}" for n in old])
    fields = [f for f in kept.columns if f != "epoch"]
    newest = kept.groupBy(key).agg(F.max_by(F.struct(*fields), F.struct(order, "epoch")).alias("r")).select("r.*")
    aside = f"{path.rstrip('/')}.folding"
    newest.write.mode("overwrite").parquet(aside)
    spark.read.schema(newest.schema).parquet(aside).write.mode("overwrite").parquet(f"{path}/epoch={old[-1]}")
    for n in old[:-1]:
        remove(spark, f"{path}/epoch={n}")
    remove(spark, aside)
