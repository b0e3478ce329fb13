"""JSON documents, dictionaries, file listings and sound files as tables; sinks that keep their order."""

from __future__ import annotations

import json
from datetime import UTC, datetime

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORDS = "ARRAY<STRUCT<start: DOUBLE, end: DOUBLE, word: STRING, speaker: STRING, prob: DOUBLE>>"
SEGMENTS = "ARRAY<STRUCT<id: BIGINT, start: DOUBLE, end: DOUBLE, speaker: STRING, text: STRING, text_ru: STRING, type: STRING, echo: BOOLEAN, overlap: BOOLEAN, file: STRING>>"


def _whole(spark: SparkSession, path: str) -> DataFrame:
    """(media, value): whole files, gzipped or plain; the media item is the folder that holds the file."""
    return spark.read.text(path, wholetext=True).select(F.element_at(F.split(F.input_file_name(), "/"), -2).alias("media"), "value")


def _ms(column: str):
    return F.round(F.col(column) * 1000).cast("long")


def read_words(spark: SparkSession, path: str) -> DataFrame:
    """Words of files that hold either a bare list or an object with ``language`` and ``words``."""
    words = F.coalesce(F.from_json("value", f"STRUCT<words: {WORDS}>")["words"], F.from_json("value", WORDS))
    w = _whole(spark, path).select("media", F.posexplode(words).alias("ord", "w"))
    return w.select("media", F.col("ord").cast("long").alias("ord"), "w.speaker", "w.word", "w.prob", _ms("w.start").alias("start_ms"), _ms("w.end").alias("end_ms"))


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    segments = F.coalesce(F.from_json("value", f"STRUCT<segments: {SEGMENTS}>")["segments"], F.from_json("value", SEGMENTS))
    s = _whole(spark, path).select("media", F.posexplode(segments).alias("ord", "s"))
    return s.select("media", F.col("ord").cast("long").alias("ord"), "s.*").withColumns({"start_ms": _ms("start"), "end_ms": _ms("end")}).drop("start", "end")


def read_map(spark: SparkSession, path: str, value: str = "STRING") -> DataFrame:
    """(media, key, value) of an object, without its comment."""
    m = _whole(spark, path).select("media", F.explode(F.from_json("value", f"MAP<STRING, {value}>")).alias("key", "value"))
    return m.where("key <> '_comment'")


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def first_existing(spark: SparkSession, *paths: str) -> str:
    for p in paths:
        if exists(spark, p):
            return p
    raise FileNotFoundError(f"none of {', '.join(paths)}")


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, length, modified) without reading the contents."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "length", F.col("modificationTime").alias("modified"))


def missing_files(wanted: DataFrame, files: DataFrame, *, least: int = 1024) -> DataFrame:
    """Rows of ``wanted`` (file, ...) whose file is absent or shorter than ``least`` bytes."""
    have = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "length").groupBy("file").agg(F.max("length").alias("_n"))
    return wanted.join(have, "file", "left").where(F.coalesce("_n", F.lit(0)) < least).drop("_n")


def _little_endian(hexed: Column, at: Column, n: int) -> Column:
    """The number in ``n`` bytes from byte ``at`` of a text of hex digits."""
    digits = F.concat(*[F.substring(hexed, at * 2 + (2 * i + 1), F.lit(2)) for i in reversed(range(n))])
    return F.conv(digits, 16, 10).cast("long")


def _sound_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, content, rate, block, channels, data_at, n_bytes) of 16-bit sound files, read from their headers in the JVM."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wav").load(path).withColumn("_h", F.hex(F.substring("content", 1, 4096)))
    files = files.withColumns({"_f": ((F.instr("_h", "666D7420") - 1) / 2).cast("int"), "_d": ((F.instr("_h", "64617461") - 1) / 2).cast("int")})
    h = F.col("_h")
    files = files.withColumns({"rate": _little_endian(h, F.col("_f") + 12, 4), "block": _little_endian(h, F.col("_f") + 20, 2), "channels": _little_endian(h, F.col("_f") + 10, 2), "data_at": (F.col("_d") + 8).cast("long")})
    files = files.withColumn("n_bytes", F.least(_little_endian(h, F.col("_d") + 4, 4), F.col("length") - F.col("data_at")))
    return files.where("_f >= 0 AND _d >= 0 AND rate > 0 AND block > 0").select("path", "content", "rate", "block", "channels", "data_at", "n_bytes")


def probe_durations(spark: SparkSession, path: str) -> DataFrame:
    """(path, duration_ms) of sound files, from their headers and lengths."""
    f = _sound_files(spark, path)
    return f.select("path", F.floor(F.col("n_bytes") * 1000 / (F.col("rate") * F.col("block"))).alias("duration_ms"))


def read_wav_levels(spark: SparkSession, path: str, *, frame_ms: int = 250, start_ms: int = 0, end_ms: int | None = None, part: int = 240) -> DataFrame:
    """(path, frame_no, rms) of 16-bit sound files between two moments; part frames are left out.

    The range is cut in the JVM, in parts of ``part`` frames, so that what a Python worker holds is a minute of sound
    however long the recording is.
    """

    def run(batches):
        for batch in batches:
            for p, first, size, channels, raw in zip(*(batch.column(c).to_pylist() for c in ("path", "first", "size", "channels", "raw")), strict=True):
                x = np.frombuffer(raw, "<i2").reshape(-1, size, channels).mean(2) / 32768
                n = len(x)
                yield pa.RecordBatch.from_pydict({"path": [p] * n, "frame_no": pa.array(range(first, first + n), pa.int64()), "rms": np.sqrt((x * x).mean(1))})

    f = _sound_files(spark, path).withColumn("size", F.floor(F.col("rate") * frame_ms / 1000))  # samples a frame
    samples = F.floor(F.col("n_bytes") / F.col("block"))
    begin = F.least(F.floor(F.col("rate") * start_ms / 1000), samples)
    stop = samples if end_ms is None else F.least(samples, F.floor(F.col("rate") * end_ms / 1000))
    f = f.withColumn("begin", begin).withColumn("n", F.floor((stop - F.col("begin")) / F.col("size"))).where("n > 0")
    f = f.withColumn("first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(part).cast("long"))))
    frames = F.least(F.col("n") - F.col("first"), F.lit(part).cast("long"))
    at = F.col("data_at") + (F.col("begin") + F.col("first") * F.col("size")) * F.col("block")
    cut = F.substring("content", (at + 1).cast("int"), (frames * F.col("size") * F.col("block")).cast("int"))
    return f.select("path", "first", F.col("size").cast("int").alias("size"), "channels", cut.alias("raw")).mapInArrow(run, "path string, frame_no long, rms double")


def backup_once(df: DataFrame, path: str) -> None:
    """Replace the table at ``path``; what was there before the first replacement is kept beside it and never touched again."""
    spark = df.sparkSession
    if exists(spark, path) and not exists(spark, f"{path}.bak"):
        spark.read.parquet(path).write.parquet(f"{path}.bak")
    df.write.mode("overwrite").parquet(f"{path}.next")
    spark.read.schema(df.schema).parquet(f"{path}.next").write.mode("overwrite").parquet(path)


def export_transcripts(lines: DataFrame, complete: DataFrame, path: str, at: datetime | None = None) -> str:
    """Write lines (media, turn, line) of the complete items (media) as text in order, a folder an item, under a folder
    named by the time of the run; returns it."""
    to = f"{path.rstrip('/')}/{(at or datetime.now(UTC)).strftime('%m%d-%H%M%S')}"
    text = lines.join(complete, "media", "left_semi").repartition("media").sortWithinPartitions("media", "turn")
    text.select("media", F.col("line").alias("value")).write.partitionBy("media").mode("errorifexists").text(to)
    return to


def drifted(files: DataFrame) -> DataFrame:
    """Rows of (path, value) whose JSON text is not in the canonical form."""

    def run(batches):
        for batch in batches:
            texts = batch.column("value").to_pylist()
            bad = [canonical(json.loads(t)) != t for t in texts]
            yield batch.filter(pa.array(bad))

    return files.select("path", "value").mapInArrow(run, "path string, value string")


def write_documents(df: DataFrame, path: str, *, by: str = "media", order: str = "ord") -> None:
    """One JSON line for each media item, its rows in order under ``segments``."""
    rows = F.transform(F.array_sort(F.collect_list(F.struct(order, F.struct(*[c for c in df.columns if c != by]).alias("r")))), lambda x: x["r"])
    df.groupBy(by).agg(rows.alias("segments")).write.mode("overwrite").json(path)


def append_log(spark: SparkSession, path: str, entry: dict) -> None:
    spark.createDataFrame([(json.dumps(entry),)], "entry string").coalesce(1).write.mode("append").text(path)


def timestamped_export(df: DataFrame, path: str, at: datetime | None = None) -> str:
    """Write into a new folder named by the time of the run; returns it."""
    to = f"{path.rstrip('/')}/{(at or datetime.now(UTC)).strftime('%m%d-%H%M%S')}"
    df.write.mode("errorifexists").json(to)
    return to


def rotate_if_changed(new: DataFrame, path: str) -> bool:
    """Replace the table at ``path``, keeping the former one beside it, only where the rows differ."""
    from ..operators.incremental import changed

    spark = new.sparkSession
    if exists(spark, path):
        old = spark.read.schema(new.schema).parquet(path)
        if not changed(new, old):
            return False
        old.write.mode("overwrite").parquet(f"{path}.prev")
    new.write.mode("overwrite").parquet(f"{path}.next")
    spark.read.schema(new.schema).parquet(f"{path}.next").write.mode("overwrite").parquet(path)
    return True


def canonical(value) -> str:
    """JSON as dictionaries are kept: one space of indent, key order as it is, a line break at the end."""
    return json.dumps(value, ensure_ascii=False, indent=1) + "\n"
