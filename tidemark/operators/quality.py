"""Quality flags and the gate over findings (stage, severity, seg_id, msg)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def qc_flags(heard: Column, sung: Column, sim: Column, lead_ms: Column, tail_ms: Column, *, least_sim: float = 0.75, edge_ms: int = 800) -> Column:
    """Array of flags from word counts, likeness and sound before and after the words; SILENT stands alone."""
    flags = F.array_compact(F.array(F.when(sim < least_sim, "MISMATCH"), F.when(heard > 1.25 * sung + 2, "EXTRA"), F.when(tail_ms > edge_ms, "TAIL"), F.when(lead_ms > edge_ms, "LEAD")))
    return F.when(heard == 0, F.array(F.lit("SILENT"))).otherwise(flags)


def better(flags_a: Column, sim_a: Column, flags_b: Column, sim_b: Column) -> Column:
    """Is take a better than take b: fewer flags, then the higher likeness."""
    return F.struct(-F.size(flags_a), sim_a) > F.struct(-F.size(flags_b), sim_b)


def best_take(takes: DataFrame, *, key: str) -> DataFrame:
    """Of each key's takes (flags, sim, rung) the best; the earlier rung on a tie."""
    return takes.groupBy(key).agg(F.min(F.struct(F.size("flags").alias("n"), (-F.col("sim")).alias("s"), "rung"))["rung"].alias("rung"))


def accept(findings: DataFrame, accepted: DataFrame) -> DataFrame:
    """Findings with the failures that an acceptance (ord, stage, contains) covers lowered to warnings; unused ones warn.

    A failure takes the first acceptance in order of its stage whose text it holds; warnings take none. ``accepted`` is a
    list kept by hand, a scalar subquery of one array; each row is judged by itself, so repeated
    findings are lowered alike.
    """
    listed = accepted.agg(F.array_sort(F.collect_list(F.struct("ord", "stage", "contains"))).alias("_accepted"))
    rows = findings.withColumn("_accepted", listed.scalar())
    fits = F.filter("_accepted", lambda a: (a["stage"] == F.col("stage")) & F.contains(F.col("msg"), a["contains"]))
    rows = rows.withColumn("_used", F.when((F.col("severity") == "fail") & (F.size(fits) > 0), F.get(fits, F.lit(0))["ord"]))
    lowered = rows.select("stage", F.when(F.col("_used").isNotNull(), "warn").otherwise(F.col("severity")).alias("severity"), "seg_id", "msg")
    unused = accepted.join(rows.where("_used IS NOT NULL").select(F.col("_used").alias("ord")).distinct(), "ord", "left_anti")
    return lowered.unionByName(unused.select("stage", F.lit("warn").alias("severity"), F.lit(None).cast("long").alias("seg_id"), F.concat(F.lit("unused acceptance: "), "contains").alias("msg")))


def verdict(findings: DataFrame, *, strict: bool = False) -> DataFrame:
    """(failures, warnings, ok) of all findings."""
    g = findings.agg(F.count_if(F.col("severity") == "fail").alias("failures"), F.count_if(F.col("severity") == "warn").alias("warnings"))
    return g.withColumn("ok", (F.col("failures") == 0) & ((F.col("warnings") == 0) | F.lit(not strict)))


def segment_findings(segments: DataFrame, chars: Column, *, longest_ms: int = 30_000, fast: int = 13) -> DataFrame:
    """What is wrong with segments by themselves, in one pass: no time or too much of it, no speaker, and texts too long for
    their time (over 1.3 times the fast reading and ten letters, from 1.5 s on)."""
    span = F.col("end_ms") - F.col("start_ms")
    finding = lambda when, stage, severity, msg: F.when(when, F.struct(F.lit(stage).alias("stage"), F.lit(severity).alias("severity"), F.col("ord").alias("seg_id"), msg.alias("msg")))
    told = F.concat(F.lit("span "), span.cast("string"), F.lit(" ms"))
    long_ = F.concat(F.lit("over budget: "), chars.cast("string"), F.lit(" letters"))
    found = F.array_compact(F.array(
        finding(span <= 0, "segments", "fail", told),
        finding(span > longest_ms, "segments", "warn", told),
        finding((span >= 1500) & (chars * 10_000 > span * fast * 13 + 100_000), "translation", "warn", long_),
        finding(F.col("speaker").isNull(), "segments", "fail", F.lit("speaker missing")),
    ))
    return segments.select(F.explode(found).alias("f")).select("f.*")


def runon_findings(segments: DataFrame, cuts: DataFrame, *, share: float = 0.05) -> DataFrame:
    """One failure for each media item of which more than ``share`` of the segments run on."""
    n = segments.groupBy("media").agg(F.count("*").alias("n")).join(cuts.groupBy("media").agg(F.count("*").alias("k")), "media")
    return n.where(F.col("k") > share * F.col("n")).select(F.lit("segments").alias("stage"), F.lit("fail").alias("severity"), F.col("media").alias("seg_id"), F.concat(F.col("k").cast("string"), F.lit(" run-on of "), F.col("n").cast("string")).alias("msg"))


def cut_findings(segments: DataFrame) -> DataFrame:
    """One warning for each media item with segments (media, ord, cut) that were cut in mid-sentence."""
    n = segments.where(F.coalesce("cut", F.lit(False))).groupBy("media").agg(F.count("*").alias("k"))
    return n.select(F.lit("segments").alias("stage"), F.lit("warn").alias("severity"), F.col("media").alias("seg_id"), F.concat(F.col("k").cast("string"), F.lit(" cut in mid-sentence")).alias("msg"))


def echo_words(words: DataFrame, *, near_ms: int = 600, ratio: float = 0.9) -> DataFrame:
    """Words that another speaker says too within ``near_ms``, and louder: (media, ord). Needs key and level."""
    bucket = F.floor(F.col("start_ms") / near_ms)
    a = words.where("key <> ''").select("media", "key", F.col("ord"), F.col("speaker").alias("s1"), F.col("start_ms").alias("t1"), F.col("level").alias("l1"), bucket.alias("b"))
    b = words.where("key <> ''").select("media", "key", F.col("speaker").alias("s2"), F.col("start_ms").alias("t2"), F.col("level").alias("l2"), F.explode(F.array(bucket - 1, bucket, bucket + 1)).alias("b"))
    met = a.join(b, ["media", "key", "b"]).where((F.col("s1") != F.col("s2")) & (F.abs(F.col("t1") - F.col("t2")) <= near_ms) & (F.col("l1") < ratio * F.col("l2")))
    return met.select("media", "ord").distinct()


def echo_runs(words: DataFrame, echoes: DataFrame, *, least: int = 3) -> DataFrame:
    """Echo words that stand in runs of ``least`` or more among their speaker's words: (media, ord)."""
    w = words.join(echoes.withColumn("echo", F.lit(True)), ["media", "ord"], "left").withColumn("echo", F.coalesce("echo", F.lit(False)))
    order = W.partitionBy("media", "speaker").orderBy("ord")
    w = w.withColumn("run", F.row_number().over(order) - F.sum(F.col("echo").cast("int")).over(order.rowsBetween(W.unboundedPreceding, 0))).where("echo")
    return w.withColumn("n", F.count("*").over(W.partitionBy("media", "speaker", "run"))).where(F.col("n") >= least).select("media", "ord")
