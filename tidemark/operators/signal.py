"""Operators over frames (track, frame_no, level) and over embeddings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

FRAME_MS = 250


def frame_rms(samples: DataFrame, *, frame: int) -> DataFrame:
    """(track, i, x) to (track, frame_no, rms) of whole frames; a short last frame is left out."""
    g = samples.groupBy("track", F.floor(F.col("i") / frame).alias("frame_no")).agg(F.sqrt(F.avg(F.col("x") * F.col("x"))).alias("rms"), F.count("*").alias("n"))
    return g.where(F.col("n") == frame).drop("n")


def islands(frames: DataFrame, loud: Column, *, keys: tuple[str, ...] = ("track",), order: str = "frame_no") -> DataFrame:
    """Maximal runs of rows that are ``loud``: (keys, first, last, n)."""
    w = W.partitionBy(*keys).orderBy(order)
    f = frames.withColumn("loud", loud)
    f = f.withColumn("new", (F.col("loud") & ~F.coalesce(F.lag("loud").over(w), F.lit(False))).cast("int"))
    f = f.withColumn("run", F.sum("new").over(w.rowsBetween(W.unboundedPreceding, 0))).where("loud")
    return f.groupBy(*keys, "run").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("n")).drop("run")


def voiced_islands(frames: DataFrame, *, threshold: float = 5.6, least_ms: int = 500, gap_ms: int = 8000, pad_ms: int = 400) -> DataFrame:
    """Voiced stretches in ms: short ones dropped, near ones joined, padded and cut at 0."""
    from .sequence import merge_regions

    runs = islands(frames, F.col("level") > threshold).select("track", (F.col("first") * FRAME_MS).alias("start_ms"), ((F.col("last") + 1) * FRAME_MS).alias("end_ms"))
    joined = merge_regions(runs.where(F.col("end_ms") - F.col("start_ms") >= least_ms), keys=["track"], gap_ms=gap_ms)
    return joined.select("track", F.greatest(F.col("start_ms") - pad_ms, F.lit(0)).alias("start_ms"), (F.col("end_ms") + pad_ms).alias("end_ms"))


def bleed_filter(frames: DataFrame, *, floor: float = 15, share: float = 0.12) -> DataFrame:
    """Frames at least as loud as the floor and as a share of their track's 95th percentile."""
    cut = frames.groupBy("track").agg(F.greatest(F.lit(float(floor)), share * F.percentile("level", F.lit(0.95))).alias("cut"))
    return frames.join(cut, "track").where("level >= cut").drop("cut")


def _moment(frames: DataFrame) -> list[str]:
    return ["media", "frame_no"] if "media" in frames.columns else ["frame_no"]


def pair_coefficients(frames: DataFrame, solo: DataFrame, *, least_level: float = 20, least_samples: int = 8) -> DataFrame:
    """How loud track i is while only track j sounds: (i, j, coefficient), the median ratio of levels.

    ``solo`` are the (track, frame_no) in which a track sounds alone. Null with fewer than ``least_samples``. Tracks meet
    where they are of one recording, if the frames have a column ``media``.
    """
    at = _moment(frames)
    j = frames.join(solo, ["track", "frame_no"]).where(F.col("level") > least_level).select(F.col("track").alias("j"), *at, F.col("level").alias("lj"))
    i = frames.select(F.col("track").alias("i"), *at, F.col("level").alias("li"))
    g = i.join(j, at).where("i <> j").groupBy("i", "j").agg(F.count("*").alias("n"), F.median(F.col("li") / F.col("lj")).alias("m"))
    return g.select("i", "j", F.when(F.col("n") >= least_samples, F.col("m")).alias("coefficient"))


def expected_bleed(frames: DataFrame, coefficients: DataFrame, *, audible: float = 20) -> DataFrame:
    """(track, frame_no, expected): the most that another track can leak; null where an audible one is uncalibrated."""
    at = _moment(frames)
    other = frames.select(F.col("track").alias("j"), *at, F.col("level").alias("lj"))
    met = frames.select(F.col("track").alias("i"), *at).join(other, at).where("i <> j").join(coefficients, ["i", "j"], "left")
    g = met.groupBy(F.col("i").alias("track"), "frame_no").agg(F.max(F.col("coefficient") * F.col("lj")).alias("e"), F.bool_or((F.col("lj") > audible) & F.col("coefficient").isNull()).alias("unknown"))
    return g.select("track", "frame_no", F.when(~F.col("unknown"), F.col("e")).alias("expected"))


def lone_effect_gain(frames: DataFrame, *, reach: int = 3, poke: float = 2, longest: int = 15, duck: float = 0.01, floor: float = 1e-3) -> DataFrame:
    """Gain for (track, frame_no, level, loud): short runs of bed that stand out far from any speech are ducked.

    They are measured against the bed under the speech before and after, the lower of the two; without speech on
    both sides nothing is ducked.
    """
    w = W.partitionBy("track").orderBy("frame_no")
    f = frames.withColumn("lone", ~F.max("loud").over(w.rowsBetween(-reach, reach)))
    anchor = F.when(F.col("loud"), F.col("level"))
    f = f.withColumn("before", F.last(anchor, True).over(w.rowsBetween(W.unboundedPreceding, 0)))
    back = W.partitionBy("track").orderBy(F.desc("frame_no"))  # a frame that runs to the end costs quadratic time, its mirror image does not
    f = f.withColumn("after", F.last(anchor, True).over(back.rowsBetween(W.unboundedPreceding, 0)))
    out = F.col("lone") & F.col("before").isNotNull() & F.col("after").isNotNull() & (F.col("level") > floor) & (F.col("level") > poke * F.greatest(F.least("before", "after"), F.lit(floor)))
    f = f.withColumn("out", out).withColumn("new", (F.col("out") & ~F.coalesce(F.lag("out").over(w), F.lit(False))).cast("int"))
    f = f.withColumn("run", F.sum("new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    n = F.sum(F.col("out").cast("int")).over(W.partitionBy("track", "run"))
    return f.select("track", "frame_no", F.when(F.col("out") & (n <= longest), F.lit(duck)).otherwise(F.lit(1.0)).alias("gain"))


def moving_average(frames: DataFrame, value: str, *, half: int) -> DataFrame:
    """Centred mean over 2*half+1 frames, fewer at the edges."""
    w = W.partitionBy("track").orderBy("frame_no").rowsBetween(-half, half)
    return frames.withColumn(value, F.avg(value).over(w))


def muting_gain(foreign: DataFrame, *, fade: int = 1) -> DataFrame:
    """(track, frame_no, gain) of stems: silence on the frames (track, frame_no, foreign) of another voice, faded at the edges."""
    gain = foreign.select("track", "frame_no", F.when(F.col("foreign"), 0.0).otherwise(1.0).alias("gain"))
    return moving_average(gain, "gain", half=fade)


def bursts(frames: DataFrame, *, enter: float = 0.5, leave: float = 0.3) -> DataFrame:
    """Bursts of each track: rises to ``enter`` of the peak after having been under ``leave`` of it."""
    w = W.partitionBy("track").orderBy("frame_no")
    peak = F.max("level").over(W.partitionBy("track"))
    state = F.when(F.col("level") >= enter * peak, 1).when(F.col("level") <= leave * peak, 0)
    f = frames.withColumn("s", state).withColumn("s", F.coalesce(F.last("s", True).over(w.rowsBetween(W.unboundedPreceding, 0)), F.lit(0)))
    edge = (F.col("s") == 1) & (F.coalesce(F.lag("s").over(w), F.lit(0)) == 0)
    return f.withColumn("edge", edge.cast("long")).groupBy("track").agg(F.sum("edge").alias("bursts"))


def centroids(vectors: DataFrame, *, label: str = "label", vector: str = "embedding") -> DataFrame:
    """Unit mean vector of each label, by position, with partial aggregates: (label, centroid)."""
    mean = vectors.select(label, F.posexplode(vector).alias("p", "x")).groupBy(label, "p").agg(F.avg("x").alias("x"))
    v = mean.groupBy(label).agg(F.transform(F.array_sort(F.collect_list(F.struct("p", "x"))), lambda s: s["x"]).alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    return v.select(label, F.transform("v", lambda x: x / (norm + 1e-9)).alias("centroid"))


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)) + 1e-9)


#: Centroids that go along with every row at a time (64 numbers each: 2 MB); more are taken in slices, one after another.
CENTROIDS = 4096


def voice_margin(vectors: DataFrame, *, label: str = "label", vector: str = "embedding", most: int = CENTROIDS) -> DataFrame:
    """All columns but the vector, and ``margin``: similarity to the own label's centroid less that to the nearest other one.

    Each row is judged by itself against arrays of centroids, so repeated rows stay; null where there is no own
    or no other centroid.
    """
    c = centroids(vectors, label=label, vector=vector).where(F.col(label).isNotNull())
    slices = max(1, -(-c.count() // most))
    c = c.withColumn("_slice", F.pmod(F.xxhash64(label), F.lit(slices)))
    out = vectors.withColumns({"_own": F.lit(None).cast("double"), "_other": F.lit(None).cast("double")})
    for k in range(slices):
        part = c.where(F.col("_slice") == k).agg(F.collect_list(F.struct(F.col(label).alias("label"), "centroid")).alias("_all"))
        sims = lambda own: F.array_max(F.transform(F.filter("_all", lambda x: (x["label"] == F.col(label)) == F.lit(own)), lambda x: cosine(F.col(vector), x["centroid"])))
        met = out.withColumn("_all", part.scalar())
        out = met.withColumns({"_own": F.coalesce("_own", sims(True)), "_other": F.greatest("_other", sims(False))}).drop("_all")
    return out.withColumn("margin", F.col("_own") - F.col("_other")).drop("_own", "_other", vector)


def voice_profiles(windows: DataFrame, *, top: float = 0.3, close: float = 0.5, least: int = 10) -> DataFrame:
    """(speaker, profile) from windows (speaker, level, embedding of length one): the mean of the loudest share, refined once.

    The refinement takes the windows whose similarity to the first mean is over ``close``: the loud ones of them if
    they are ``least`` at least, else all of them; with fewer than ``least`` the first mean stays.
    """
    cut = windows.groupBy("speaker").agg(F.percentile("level", F.lit(1 - top)).alias("_cut"))
    w = windows.join(cut, "speaker").withColumn("_loud", F.col("level") >= F.col("_cut"))
    first = centroids(w.where("_loud"), label="speaker").withColumnRenamed("centroid", "_first")
    dot = F.aggregate(F.zip_with("embedding", "_first", lambda p, q: p.cast("double") * q), F.lit(0.0), lambda s, v: s + v)
    near = w.join(first, "speaker").withColumn("_near", dot > close).where("_near")
    n = near.groupBy("speaker").agg(F.count("*").alias("_n"), F.count_if("_loud").alias("_n_loud"))
    used = near.join(n.where(F.col("_n") >= least), "speaker").where((F.col("_n_loud") < least) | F.col("_loud"))
    refined = centroids(used, label="speaker")
    return first.join(refined, "speaker", "left").select("speaker", F.coalesce("centroid", "_first").alias("profile"))
